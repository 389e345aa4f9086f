"""End-to-end jobs composed from operators."""

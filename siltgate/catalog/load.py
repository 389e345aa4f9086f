"""Import every query module so that the registry is complete."""

from siltgate.catalog import healing, operations, quality, silver_gold  # noqa: F401
from siltgate.catalog.registry import ORACLES, QUERIES, as_callable, oracle_text

__all__ = ["ORACLES", "QUERIES", "as_callable", "oracle_text"]

"""Siltgate: data quality and medallion analytics as plain Spark DataFrame jobs.

Every public function takes DataFrames and returns DataFrames, so batch jobs and
``foreachBatch`` streams share the same code.
"""

from siltgate.spec import DatasetSpec, Rule, SPECS

__all__ = ["DatasetSpec", "Rule", "SPECS"]

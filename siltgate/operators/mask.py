"""Map-driven masking, its log and the compliance figures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.functions.columns import partial_mask, percent, sha256_hex
from siltgate.spec import HIGH, LOW, MEDIUM, NONE

ACTIONS = {HIGH: "SHA256", MEDIUM: "PARTIAL_MASK", LOW: "NOT_MASKED", NONE: "NOT_MASKED"}
CLASSES = {HIGH: "RESTRICTED", MEDIUM: "CONFIDENTIAL", LOW: "INTERNAL", NONE: "PUBLIC"}


def masked(c: Column, level: str, salt: str | None = None, mask_short: bool = True) -> Column:
    if level == HIGH:
        return sha256_hex(c, salt)
    if level == MEDIUM:
        return partial_mask(c, mask_short=mask_short)
    return c


def mask_table(df: DataFrame, pii: Mapping[str, tuple[str, str]], salt: str | None = None,
               mask_short: bool = True) -> DataFrame:
    """Mask every column by its level in one projection; null stays null."""
    return df.select(*[
        masked(F.col(c), pii.get(c, (NONE, ""))[0], salt, mask_short).alias(c) for c in df.columns
    ])


def masking_log(df: DataFrame, pii: Mapping[str, tuple[str, str]], dataset: str) -> DataFrame:
    """What was done to each mapped column and to how many rows.  Holds no raw value."""
    counters, entries = [F.count(F.lit(1)).alias("rows")], []
    for i, (column, (level, reason)) in enumerate(pii.items()):
        found = column in df.columns
        action = ACTIONS[level] if found else "SKIP"
        touched = F.lit(0).cast("bigint")
        if found and level in (HIGH, MEDIUM):
            counters.append(F.count(column).alias(f"m{i}"))
            touched = F.col(f"m{i}")
        entries.append(F.struct(
            F.lit(dataset).alias("dataset"), F.lit(column).alias("column_name"),
            F.lit(action).alias("action"), F.lit(level).alias("pii_level"),
            F.lit(reason).alias("reason"), touched.alias("rows_masked"),
        ))
    return df.agg(*counters).select(F.inline(F.array(*entries)))


def compliance(log: DataFrame) -> DataFrame:
    """Class and action counts per dataset, and masked share of the columns that need it."""
    needs = F.col("pii_level").isin(HIGH, MEDIUM)
    done = F.col("action").isin("SHA256", "PARTIAL_MASK")
    classes = [
        F.count_if(F.col("pii_level") == level).alias(f"{name.lower()}_columns")
        for level, name in CLASSES.items()
    ]
    return log.groupBy("dataset").agg(
        *classes,
        F.count_if(F.col("action") == "SHA256").alias("hashed_columns"),
        F.count_if(F.col("action") == "PARTIAL_MASK").alias("partly_masked_columns"),
        F.count_if(F.col("action") == "NOT_MASKED").alias("open_columns"),
        F.count_if(F.col("action") == "SKIP").alias("skipped_columns"),
        percent(F.count_if(needs & done), F.count_if(needs), 1).alias("compliance_pct"),
        F.sum("rows_masked").alias("values_masked"),
    )

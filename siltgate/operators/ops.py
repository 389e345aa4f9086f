"""Operations analytics: heals, usage cost, decisions, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.spec import DAILY_BUDGET_USD, INPUT_USD_PER_TOKEN, OUTPUT_USD_PER_TOKEN


def heals_by(events: DataFrame, *columns: str) -> DataFrame:
    return events.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("heal_events"), F.sum("healed_rows").alias("healed_rows"))


def top_healed_columns(events: DataFrame, k: int = 20) -> DataFrame:
    grouped = events.groupBy("column_name", "layer").agg(F.sum("healed_rows").alias("healed_rows"))
    return grouped.orderBy(F.desc("healed_rows"), "column_name", "layer").limit(k)


def most_recent(log: DataFrame, n: int, *order: Column) -> DataFrame:
    """The newest ``n`` log rows: a distributed top-k, never a full sort."""
    return log.orderBy(*order).limit(n)


def tokens_of(text: Column) -> Column:
    """Fallback token estimate: four characters per token, rounded down."""
    return F.floor(F.length(text) / 4).cast("bigint")


def cost_usd(prompt: Column, completion: Column) -> Column:
    return prompt * F.lit(INPUT_USD_PER_TOKEN) + completion * F.lit(OUTPUT_USD_PER_TOKEN)


def turn_costs(turns: DataFrame) -> DataFrame:
    """Cost per conversation turn: what the assistant writes is output, the rest input."""
    tokens = tokens_of(F.col("text"))
    out = F.col("role") == "assistant"
    priced = turns.select(
        "conv_id", "turn", "role",
        F.when(out, 0).otherwise(tokens).alias("prompt_tokens"),
        F.when(out, tokens).otherwise(0).alias("completion_tokens"))
    return priced.withColumn("cost_usd", F.round(cost_usd(F.col("prompt_tokens"), F.col("completion_tokens")), 10))


def usage_of(events: DataFrame) -> DataFrame:
    """Metered usage from an event log: node, day and token counts."""
    return events.select(
        F.col("event_type").alias("node"), F.to_date("ts").alias("usage_day"),
        F.floor("value").cast("bigint").alias("prompt_tokens"),
        F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("completion_tokens"))


def cost_by(usage: DataFrame, *columns: str) -> DataFrame:
    sums = usage.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("calls"), F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"))
    return sums.withColumn(
        "cost_usd", F.round(cost_usd(F.col("prompt_tokens"), F.col("completion_tokens")), 8))


def daily_budget(usage: DataFrame, limit: float = DAILY_BUDGET_USD) -> DataFrame:
    return cost_by(usage, "usage_day").withColumn("over_budget", F.col("cost_usd") > limit)


def latest_decision(log: DataFrame, keys, at: str, row_id: str) -> DataFrame:
    """The newest entry per composite key.

    ``max_by`` keeps one candidate per key and task, so a hot key costs one row
    per task in the shuffle and no sort.
    """
    rest = [c for c in log.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(at, row_id)).alias("e")
    return log.groupBy(*keys).agg(newest).select(*keys, "e.*")


def pending(decisions: DataFrame, waiting: str = "PENDING") -> DataFrame:
    """Latest decisions that still wait for an answer."""
    return decisions.where(F.col("decision") == waiting)


def durations(history: DataFrame) -> DataFrame:
    """Seconds per batch from its start and end."""
    return history.withColumn("seconds", F.round(
        (F.unix_micros("ended_at") - F.unix_micros("started_at")) / 1e6, 3))


def remember(log: DataFrame, text: str, order: str, *keep: str) -> DataFrame:
    """Incident memory: one entry per distinct text, the first one wins.

    The id is a content hash, equal in every process and on every retry.
    """
    key = F.concat(F.lit("fix_"), F.sha2(F.col(text), 256))
    first = F.min_by(F.struct(order, *keep), F.col(order)).alias("e")
    return (
        log.select(key.alias("memory_id"), order, *keep)
        .groupBy("memory_id").agg(first, F.count(F.lit(1)).alias("seen"))
        .select("memory_id", "e.*", "seen")
    )

"""PII classification of columns, and PII search in free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.functions.columns import may_be_number
from siltgate.spec import HIGH, LOW, MEDIUM, NONE

# Name marks per level, and value formats.
NAME_MARKS = (
    (HIGH, ("email", "phone", "name", "address", "ssn", "account")),
    (MEDIUM, ("_id", "unique_id", "zip", "postal")),
    (LOW, ("city", "state", "category", "status", "type", "value", "amount")),
)
NOT_A_PERSON = ("category_name", "name_len")
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"\+?[0-9][0-9 ().-]{7,}[0-9]"
UUID = r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
# The same e-mail format for searching in long texts.  A match starts where a run of
# local-part characters starts (or right after the previous match), never inside
# one, so a long run without "@" is read once instead of once per character.
EMAIL_IN_TEXT = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_IN_TEXT = r"\+[0-9]{1,3}[ -][0-9]{2,4}[ -][0-9]{4,9}"
RANK = {NONE: 0, LOW: 1, MEDIUM: 2, HIGH: 3}


def level_from_name(column: str) -> tuple[str, str]:
    name = column.lower()
    if not any(m in name for m in NOT_A_PERSON):
        for mark in NAME_MARKS[0][1]:
            if mark in name:
                return HIGH, f"name contains {mark}"
    for level, marks in NAME_MARKS[1:]:
        for mark in marks:
            hit = name.endswith(mark) if mark.startswith("_") else mark in name
            if hit:
                return level, f"name contains {mark.strip('_')}"
    return NONE, "no identifying name"


def classify(df: DataFrame, dataset: str, threshold: float = 0.5) -> DataFrame:
    """Level and reason per column: the stronger of its name and its values.

    One scan: match counters for the text columns, one row of state per task.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    stats: list[Column] = []
    for c in text:
        whole = "^(?:{})$".format
        stats += [
            F.count(c).alias(f"n:{c}"),
            # A cheap look at the text comes before each pattern.
            F.count_if(F.contains(F.col(c), F.lit("@")) & F.col(c).rlike(whole(EMAIL))).alias(f"e:{c}"),
            F.count_if(may_be_number(F.col(c)) & ~F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}")
                       & F.col(c).rlike(whole(PHONE))).alias(f"p:{c}"),
            F.count_if((F.length(c) == 36) & F.col(c).rlike(whole(UUID))).alias(f"u:{c}"),
        ]
    entries = []
    for c in df.columns:
        level, reason = level_from_name(c)
        best, why = F.lit(level), F.lit(reason)
        rate = F.lit(0.0)
        if c in text:
            n = F.greatest(F.col(f"n:{c}"), F.lit(1)).cast("double")
            mail, phone, uuid = (F.col(f"{k}:{c}") / n for k in "epu")
            rate = F.greatest(mail, phone, uuid)
            if RANK[level] < RANK[MEDIUM]:
                best = F.when(uuid >= threshold, MEDIUM).otherwise(best)
                why = F.when(uuid >= threshold, "values look like uuids").otherwise(why)
            if RANK[level] < RANK[HIGH]:
                best = F.when(F.greatest(mail, phone) >= threshold, HIGH).otherwise(best)
                why = (F.when(mail >= threshold, "values look like e-mails")
                       .when(phone >= threshold, "values look like phones").otherwise(why))
        entries.append(F.struct(
            F.lit(dataset).alias("dataset"), F.lit(c).alias("column_name"),
            best.alias("pii_level"), why.alias("reason"), F.round(rate, 4).alias("value_match_rate"),
        ))
    stats = stats or [F.count(F.lit(1)).alias("n")]
    return df.agg(*stats).select(F.inline(F.array(*entries)))


def scan_text(df: DataFrame, key: str, text: str, *keep: str) -> DataFrame:
    """Rows whose free text holds an e-mail or a phone number, with hit counts.  Whole texts."""
    def hits(mark: str, pattern: str) -> Column:
        # A byte search for the one character every match needs spares most texts the pattern.
        return F.when(F.contains(F.col(text), F.lit(mark)), F.regexp_count(F.col(text), F.lit(pattern))).otherwise(0)

    found = df.select(
        key, *keep, hits("@", EMAIL_IN_TEXT).alias("email_hits"), hits("+", PHONE_IN_TEXT).alias("phone_hits"),
    )
    return found.where((F.col("email_hits") > 0) | (F.col("phone_hits") > 0))

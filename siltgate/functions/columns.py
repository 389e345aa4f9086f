"""Reusable ``Column`` expressions for cleaning, checking and masking.

All of them stay inside whole-stage code generation; there is no Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltgate.spec import STATE_ALIASES, STATES, TS_SENTINEL


def is_in(c: Column, values: Iterable[str]) -> Column:
    """Membership that is false, not null, for a null value."""
    return F.coalesce(c.isin(*values), F.lit(False))


def to_number(c: Column) -> Column:
    """Tolerant number: unparsable text and NaN become null."""
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def to_timestamp(c: Column) -> Column:
    """Tolerant timestamp without time zone: bad text becomes null."""
    return c.try_cast("timestamp_ntz")


def state_code(c: Column, aliases: Mapping[str, str] | None = None) -> Column:
    """Trim and upper-case a state; anything outside the 27 codes is ``UNKNOWN``."""
    code = F.upper(F.trim(c))
    if aliases:
        resolved = code
        for alias, target in aliases.items():
            resolved = F.when(code == alias, F.lit(target)).otherwise(resolved)
        code = resolved
    return F.when(code.isin(*STATES), code).otherwise(F.lit("UNKNOWN"))


def state_code_with_aliases(c: Column) -> Column:
    return state_code(c, STATE_ALIASES)


def city_name(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)), F.lit("unknown"))


def one_of(c: Column, allowed: Iterable[str], default: str, *, lower=False, trim=False) -> Column:
    """Keep allowed values (optionally normalised first), replace the rest and null."""
    v = F.trim(c) if trim else c
    v = F.lower(v) if lower else v
    return F.when(v.isin(*allowed), v).otherwise(F.lit(default))


def fill_sentinel(c: Column, sentinel: str = TS_SENTINEL) -> Column:
    return F.coalesce(c, F.lit(sentinel))


def non_negative(c: Column, policy: str = "zero") -> Column:
    """Null becomes 0; a negative becomes 0 (``zero``) or its size (``abs``)."""
    v = F.coalesce(to_number(c), F.lit(0.0))
    if policy == "abs":
        return F.abs(v)
    if policy == "zero":
        return F.greatest(v, F.lit(0.0))
    raise ValueError(f"unknown policy {policy!r}")


def at_least(c: Column, floor) -> Column:
    return F.greatest(F.coalesce(c, F.lit(floor)), F.lit(floor))


def clamp(c: Column, low=None, high=None) -> Column:
    """Pull values into ``[low, high]``; null stays null."""
    v = c
    if low is not None:
        v = F.greatest(v, F.lit(low).cast("double"))
    if high is not None:
        v = F.least(v, F.lit(high).cast("double"))
    return F.when(c.isNotNull(), v)


def sha256_hex(c: Column, salt: str | None = None) -> Column:
    text = c.cast("string")
    if salt:
        text = F.concat(F.lit(salt), text)
    return F.sha2(text, 256)


def partial_mask(c: Column, visible: int = 4, mask_short: bool = True) -> Column:
    """Show the first ``visible`` characters, star the rest."""
    text = c.cast("string")
    size = F.length(text)
    short = F.repeat(F.lit("*"), size) if mask_short else text
    long = F.concat(F.left(text, F.lit(visible)), F.repeat(F.lit("*"), size - visible))
    return F.when(size <= visible, short).otherwise(long)


def zip_mask(c: Column) -> Column:
    return F.concat(F.left(c.cast("string"), F.lit(2)), F.lit("***"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole`` in percent as a double; null when the whole is zero."""
    return F.round(part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def may_be_number(c: Column) -> Column:
    """Cheap first look before a number or phone pattern: a sign, point or digit leads."""
    first = F.substring(c, 1, 1)
    return (first >= "+") & (first <= "9")

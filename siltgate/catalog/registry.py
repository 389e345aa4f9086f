"""Query registry: a Spark function and, where SQL can say it, the equal SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltgate.sources.inputs import INCOMING, TABLES_OF, Inputs

Build = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query; ``sql`` may name any table or shared sub-select in ``CTES``."""

    def add(fn: Build) -> Build:
        if name in QUERIES:
            raise KeyError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def oracle_text(sql: str) -> str:
    """Prefix the shared sub-selects a statement needs, dependencies first."""
    needed: list[str] = []

    def visit(text: str) -> None:
        words = set(re.findall(r"[a-z_0-9]+", text))
        for name, body in CTES.items():
            if name in words and name not in needed:
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    parts = ",\n".join(f"{n} AS ({CTES[n]})" for n in needed)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"


def as_callable(fn: Build) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Inputs(spark, folder))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def texts(values) -> str:
    """A SQL literal list."""
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


for _name, _text in INCOMING.items():
    CTES[f"incoming_{_name}"] = _text.format(**{t: t for t in TABLES_OF[_name]})
    CTES[f"dirty_{_name}"] = f"SELECT * EXCLUDE (batch_id) FROM incoming_{_name}"

"""Declarations that drive the jobs: datasets, rules, PII levels.

Specs are small driver-side values.  Operators compile them to ``Column``
expressions; nothing here touches data.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the business definitions for right results.
# ---------------------------------------------------------------------------

STATES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
)
STATE_ALIASES = {"S": "SP", "SAOPAULO": "SP", "SAO PAULO": "SP", "SÃO PAULO": "SP"}
ORDER_STATUSES = (
    "approved", "canceled", "delivered", "invoiced", "processing", "shipped", "unavailable",
)
PAYMENT_TYPES = ("boleto", "credit_card", "debit_card", "voucher")
NULL_TOKENS = ("nan", "none", "null")
TS_SENTINEL = "1970-01-01 00:00:00"

NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
MATCH_REGEX = "expect_column_values_to_match_regex"
CUSTOM = "expect_row_expression_to_be_true"
SHORT_NAMES = {
    NOT_NULL: "not_null", UNIQUE: "unique", IN_SET: "in_set", BETWEEN: "between",
    MATCH_REGEX: "match_regex", CUSTOM: "custom",
}

HIGH, MEDIUM, LOW, NONE = "HIGH", "MEDIUM", "LOW", "NONE"

INPUT_USD_PER_TOKEN = 0.59 / 1_000_000
OUTPUT_USD_PER_TOKEN = 0.79 / 1_000_000
DAILY_BUDGET_USD = 2.00
RECALL_THRESHOLD = 0.35
BATCH_HISTORY_KEPT = 50

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One expectation on one column (or, for ``CUSTOM``, one SQL expression)."""

    kind: str
    column: str
    values: tuple[str, ...] = ()
    min_value: float | None = None
    max_value: float | None = None
    pattern: str | None = None
    mostly: float | None = None
    expression: str | None = None
    columns: tuple[str, ...] = ()

    @property
    def label(self) -> str:
        """Short name used as a quarantine reason, e.g. ``in_set(customer_state)``."""
        return f"{SHORT_NAMES.get(self.kind, self.kind)}({self.column})"

    @classmethod
    def from_dict(cls, raw: dict[str, Any]) -> "Rule":
        """Read the ``{expectation_type, column, kwargs}`` wire form."""
        kw = raw.get("kwargs") or {}
        return cls(
            kind=raw.get("expectation_type", ""),
            column=raw.get("column", ""),
            values=tuple(str(v) for v in kw.get("value_set", ())),
            min_value=kw.get("min_value"),
            max_value=kw.get("max_value"),
            pattern=kw.get("regex", kw.get("pattern")),
            mostly=kw.get("mostly"),
            expression=kw.get("expression"),
        )

    def to_dict(self) -> dict[str, Any]:
        kw: dict[str, Any] = {}
        if self.values:
            kw["value_set"] = list(self.values)
        for name, value in (
            ("min_value", self.min_value), ("max_value", self.max_value),
            ("regex", self.pattern), ("mostly", self.mostly), ("expression", self.expression),
        ):
            if value is not None:
                kw[name] = value
        out: dict[str, Any] = {"expectation_type": self.kind, "column": self.column}
        if kw:
            out["kwargs"] = kw
        return out


def not_null(column: str, mostly: float | None = None) -> Rule:
    return Rule(NOT_NULL, column, mostly=mostly)


def unique(column: str, *more: str, mostly: float | None = None) -> Rule:
    return Rule(UNIQUE, column, columns=(column, *more), mostly=mostly)


def in_set(column: str, values, mostly: float | None = None) -> Rule:
    return Rule(IN_SET, column, values=tuple(str(v) for v in values), mostly=mostly)


def between(column: str, low=None, high=None, mostly: float | None = None) -> Rule:
    return Rule(BETWEEN, column, min_value=low, max_value=high, mostly=mostly)


def match_regex(column: str, pattern: str, mostly: float | None = None) -> Rule:
    return Rule(MATCH_REGEX, column, pattern=pattern, mostly=mostly)


def custom(name: str, expression: str) -> Rule:
    return Rule(CUSTOM, name, expression=expression)


@dataclass(frozen=True)
class DatasetSpec:
    """Everything the jobs need to know about one dataset."""

    name: str
    fields: tuple[tuple[str, T.DataType], ...]
    key: tuple[str, ...]
    rules: tuple[Rule, ...]
    pii: dict[str, tuple[str, str]] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    optional: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, True) for n, t in self.fields])

    @property
    def record_id(self) -> str:
        """The column whose null makes a row unfixable."""
        return self.key[0]


_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()

CUSTOMERS = DatasetSpec(
    name="customers",
    fields=(
        ("customer_id", _S), ("customer_unique_id", _S), ("customer_zip_code_prefix", _L),
        ("customer_city", _S), ("customer_state", _S),
    ),
    key=("customer_id",),
    rules=(
        not_null("customer_id"),
        not_null("customer_state"),
        in_set("customer_state", STATES + ("UNKNOWN",)),
    ),
    pii={
        "customer_email": (HIGH, "direct contact"),
        "customer_phone": (HIGH, "direct contact"),
        "customer_id": (MEDIUM, "indirect identifier"),
        "customer_unique_id": (MEDIUM, "indirect identifier"),
        "customer_zip_code_prefix": (MEDIUM, "fine location"),
        "customer_city": (LOW, "coarse location"),
        "customer_state": (LOW, "coarse location"),
    },
    domains={"customer_state": STATES + ("UNKNOWN",)},
    optional=("customer_email", "customer_phone"),
)

ORDERS = DatasetSpec(
    name="orders",
    fields=(
        ("order_id", _S), ("customer_id", _S), ("order_status", _S),
        ("order_purchase_timestamp", _S), ("order_approved_at", _S),
        ("order_delivered_carrier_date", _S), ("order_delivered_customer_date", _S),
        ("order_estimated_delivery_date", _S),
    ),
    key=("order_id",),
    rules=(
        not_null("order_id"),
        not_null("customer_id"),
        in_set("order_status", ORDER_STATUSES + ("unknown",)),
    ),
    pii={
        "order_id": (MEDIUM, "indirect identifier"),
        "customer_id": (MEDIUM, "indirect identifier"),
        "order_status": (LOW, "context"),
    },
    domains={"order_status": ORDER_STATUSES + ("unknown",)},
)

PAYMENTS = DatasetSpec(
    name="payments",
    fields=(
        ("order_id", _S), ("payment_sequential", _L), ("payment_type", _S),
        ("payment_installments", _L), ("payment_value", _D),
    ),
    key=("order_id", "payment_sequential"),
    rules=(
        not_null("order_id"),
        not_null("payment_value"),
        between("payment_value", 0, 999999),
        in_set("payment_type", PAYMENT_TYPES),
    ),
    pii={
        "order_id": (MEDIUM, "indirect identifier"),
        "payment_type": (LOW, "context"),
        "payment_value": (LOW, "amount"),
    },
    domains={"payment_type": PAYMENT_TYPES},
    ranges={"payment_value": (0, 999999)},
)

PRODUCTS = DatasetSpec(
    name="products",
    fields=(
        ("product_id", _S), ("product_category_name", _S), ("product_name_lenght", _D),
        ("product_description_lenght", _D), ("product_photos_qty", _D), ("product_weight_g", _D),
        ("product_length_cm", _D), ("product_height_cm", _D), ("product_width_cm", _D),
    ),
    key=("product_id",),
    rules=(
        not_null("product_id"),
        between("product_weight_g", 0, 100000),
    ),
    pii={"product_category_name": (LOW, "context")},
    ranges={"product_weight_g": (0, 100000)},
)

PRODUCT_NUMERICS = tuple(n for n, t in PRODUCTS.fields if isinstance(t, T.DoubleType))

SPECS: dict[str, DatasetSpec] = {
    d.name: d for d in (CUSTOMERS, ORDERS, PAYMENTS, PRODUCTS)
}

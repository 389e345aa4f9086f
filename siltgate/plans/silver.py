"""The four Silver tables with warehouse-script semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.functions import columns as C
from siltgate.operators.dedup import keep_last
from siltgate.spec import ORDER_STATUSES, PAYMENT_TYPES

ORDER_TIMES = (
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
)


def customers(raw: DataFrame) -> DataFrame:
    """Latest load per id; city and state standardised."""
    latest = keep_last(raw.select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
        "customer_state", "load_seq",
    ), ["customer_id"])
    return latest.select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        C.city_name(F.col("customer_city")).alias("customer_city"),
        C.state_code(F.col("customer_state")).alias("customer_state"),
        "load_seq",
    )


def orders(raw: DataFrame) -> DataFrame:
    """Latest load per id among orders with a customer; status checked as written."""
    latest = keep_last(raw.where(F.col("customer_id").isNotNull()), ["order_id"])
    return latest.select(
        "order_id", "customer_id",
        C.one_of(F.col("order_status"), ORDER_STATUSES, "unknown").alias("order_status"),
        *[C.to_timestamp(F.col(c)).alias(c) for c in ORDER_TIMES],
        "load_seq",
    )


def payments(raw: DataFrame) -> DataFrame:
    """No dedup on this path; types checked as written, amounts floored."""
    return raw.where(F.col("order_id").isNotNull()).select(
        "order_id", "payment_sequential",
        C.one_of(F.col("payment_type"), PAYMENT_TYPES, "boleto").alias("payment_type"),
        C.at_least(F.col("payment_installments"), 1).alias("payment_installments"),
        C.at_least(F.col("payment_value"), 0.0).alias("payment_value"),
    )


PRODUCT_FLOORS = {
    "product_name_lenght": 0.0, "product_description_lenght": 0.0, "product_photos_qty": 1.0,
    "product_weight_g": 0.0, "product_length_cm": 0.0, "product_height_cm": 0.0,
    "product_width_cm": 0.0,
}


def products(raw: DataFrame) -> DataFrame:
    floors = [
        C.at_least(F.col(c), floor).alias(c)
        for c, floor in PRODUCT_FLOORS.items() if c in raw.columns
    ]
    return raw.where(F.col("product_id").isNotNull()).select(
        "product_id",
        F.coalesce("product_category_name", F.lit("unknown")).alias("product_category_name"),
        *floors,
    )


BUILDERS = {"customers": customers, "orders": orders, "payments": payments, "products": products}


def masked_customers(silver: DataFrame) -> DataFrame:
    return silver.select(
        C.sha256_hex(F.col("customer_id")).alias("customer_id"),
        C.sha256_hex(F.col("customer_unique_id")).alias("customer_unique_id"),
        C.zip_mask(F.col("customer_zip_code_prefix")).alias("customer_zip_code_prefix"),
        "customer_city", "customer_state", "load_seq",
    )


def masked_orders(silver: DataFrame) -> DataFrame:
    return silver.select(
        C.sha256_hex(F.col("order_id")).alias("order_id"),
        C.sha256_hex(F.col("customer_id")).alias("customer_id"),
        "order_status", "order_purchase_timestamp", "order_approved_at", "load_seq",
    )

"""The four raw datasets, derived from the star-schema tables.

The given tables are clean, so defects (nulls, bad categories, sign flips,
duplicates) are injected by fixed formulas over *every* row.  One SQL text
serves both engines: Spark binds the ``{table}`` names to DataFrames and the
cross-check reads the same names as views.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from siltgate.spec import STATES

# A state per nation key, from the list of states that the rules know.
STATE_OF_NATION = "CASE c_nationkey " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(STATES)) + " END"

INCOMING_CUSTOMERS = """
WITH base AS (
  SELECT c_custkey AS k, c_nationkey AS nk, n_name,
         """ + STATE_OF_NATION + """ AS uf
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey),
loads AS (SELECT *, 1 AS load_seq FROM base
          UNION ALL SELECT *, 2 AS load_seq FROM base WHERE k % 50 = 0)
SELECT CASE WHEN k % 41 = 0 THEN NULL ELSE 'c' || CAST(k AS STRING) END AS customer_id,
       'u' || CAST(k % 1200 AS STRING)                                  AS customer_unique_id,
       'user' || CAST(k AS STRING) || '@example.com'                    AS customer_email,
       '+55-11-9' || lpad(CAST(k AS STRING), 8, '0')                    AS customer_phone,
       1000 + (k * 37) % 98999                                          AS customer_zip_code_prefix,
       CASE WHEN k % 29 = 0 THEN NULL
            WHEN k % 13 = 0 THEN '  ' || upper(n_name) || ' '
            ELSE lower(n_name) END                                      AS customer_city,
       CASE WHEN k % 23 = 0 THEN NULL
            WHEN k % 19 = 0 THEN 'XX'
            WHEN k % 31 = 0 THEN 'null'
            WHEN k % 11 = 0 THEN lower(uf)
            ELSE uf END                                                 AS customer_state,
       load_seq,
       load_seq AS batch_id
FROM loads
"""

INCOMING_ORDERS = """
SELECT CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE 'o' || CAST(o_orderkey AS STRING) END AS order_id,
       CASE WHEN o_orderkey % 33 = 0 THEN NULL ELSE 'c' || CAST(o_custkey AS STRING) END AS customer_id,
       CASE WHEN o_orderkey % 47 = 0 THEN NULL
            WHEN o_orderkey % 37 = 0 THEN 'pending'
            WHEN o_orderkey % 43 = 0 THEN 'null'
            WHEN o_orderkey % 53 = 0 THEN 'DELIVERED'
            WHEN o_orderkey % 10 = 7 THEN 'canceled'
            WHEN o_orderstatus = 'F' THEN 'delivered'
            WHEN o_orderstatus = 'O' THEN 'shipped'
            ELSE 'processing' END                                       AS order_status,
       CAST(o_orderdate AS STRING)                                      AS order_purchase_timestamp,
       CASE WHEN o_orderkey % 12 = 0 THEN NULL
            WHEN o_orderkey % 61 = 0 THEN 'not-a-date'
            ELSE CAST(o_orderdate + INTERVAL '1' DAY AS STRING) END     AS order_approved_at,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL
            ELSE CAST(o_orderdate + INTERVAL '3' DAY AS STRING) END     AS order_delivered_carrier_date,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL
            ELSE CAST(o_orderdate + INTERVAL '6' DAY AS STRING) END     AS order_delivered_customer_date,
       CAST(o_orderdate + INTERVAL '9' DAY AS STRING)                   AS order_estimated_delivery_date,
       1 AS load_seq,
       CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT)        AS batch_id
FROM {orders}
"""

INCOMING_PAYMENTS = """
SELECT CASE WHEN l_orderkey % 67 = 0 THEN NULL ELSE 'o' || CAST(l_orderkey AS STRING) END AS order_id,
       l_linenumber                                                     AS payment_sequential,
       CASE WHEN l_partkey % 59 = 0 THEN NULL
            WHEN l_partkey % 31 = 0 THEN 'cash'
            WHEN l_partkey % 29 = 0 THEN ' Credit_Card '
            WHEN l_returnflag = 'A' THEN 'credit_card'
            WHEN l_returnflag = 'R' THEN 'boleto'
            WHEN l_linestatus = 'O' THEN 'voucher'
            ELSE 'debit_card' END                                       AS payment_type,
       CAST(1 + l_suppkey % 11 AS INT)                                  AS payment_installments,
       CASE WHEN l_partkey % 53 = 0 THEN NULL
            WHEN l_partkey % 37 = 0 THEN -l_extendedprice
            ELSE l_extendedprice END                                    AS payment_value,
       CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INT)          AS batch_id
FROM {lineitem}
"""

INCOMING_PRODUCTS = """
SELECT CASE WHEN p_partkey % 73 = 0 THEN NULL ELSE 'p' || CAST(p_partkey AS STRING) END AS product_id,
       CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE lower(p_type) END    AS product_category_name,
       CAST(length(p_name) AS DOUBLE)                                   AS product_name_lenght,
       CAST(1 + p_partkey % 9 AS DOUBLE)                                AS product_photos_qty,
       CASE WHEN p_partkey % 25 = 0 THEN NULL
            WHEN p_partkey % 41 = 0 THEN -p_retailprice
            ELSE p_retailprice END                                      AS product_weight_g,
       CAST(p_size AS DOUBLE)                                           AS product_length_cm,
       1 AS batch_id
FROM {part}
"""

INCOMING = {
    "customers": INCOMING_CUSTOMERS,
    "orders": INCOMING_ORDERS,
    "payments": INCOMING_PAYMENTS,
    "products": INCOMING_PRODUCTS,
}
TABLES_OF = {
    "customers": ("customer", "nation"),
    "orders": ("orders",),
    "payments": ("lineitem",),
    "products": ("part",),
}
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Inputs:
    """Lazy handles on one folder of Parquet tables and the datasets over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def incoming(self, dataset: str) -> DataFrame:
        """Raw rows of a dataset stamped with the ``batch_id`` they arrived in."""
        bound = {t: self.table(t) for t in TABLES_OF[dataset]}
        return self.spark.sql(INCOMING[dataset], **bound)

    def raw(self, dataset: str) -> DataFrame:
        return self.incoming(dataset).drop("batch_id")

    @cached_property
    def customers(self) -> DataFrame:
        return self.raw("customers")

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders")

    @cached_property
    def payments(self) -> DataFrame:
        return self.raw("payments")

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("products")

    def all_raw(self) -> dict[str, DataFrame]:
        return {d: getattr(self, d) for d in INCOMING}


"""Gold KPIs over Silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.functions.columns import percent, to_number
from siltgate.operators.percentiles import exact_median


def _money(c: Column) -> Column:
    return F.round(c, 2)


def counts_by(df: DataFrame, column: str, name: str = "rows") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def top_values(df: DataFrame, column: str, k: int, name: str = "rows") -> DataFrame:
    """The ``k`` most frequent non-null values, ties to the smaller value."""
    counted = counts_by(df.where(F.col(column).isNotNull()), column, name)
    return counted.orderBy(F.desc(name), F.asc(column)).limit(k)


def as_map(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Fold a bounded (key, count) table into one JSON object, largest count first."""
    pairs = F.sort_array(F.collect_list(F.struct((-F.col(value)).alias("n"), F.col(key).alias("k"))))
    body = F.array_join(
        F.transform(pairs, lambda p: F.concat(
            F.lit('"'), p["k"].cast("string"), F.lit('":'), (-p["n"]).cast("string"))), ","
    )
    return rows.agg(F.concat(F.lit("{"), body, F.lit("}")).alias("body"))


def customer_kpis(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_distinct("customer_unique_id").alias("unique_customers"),
        F.count_distinct("customer_state").alias("states_covered"),
        F.count_distinct("customer_city").alias("cities_covered"),
    )


def with_share(grouped: DataFrame, measure: str, share: str) -> DataFrame:
    """Add each group's percentage of the total.

    The total is a scalar subquery over the grouped rows, not ``sum() over ()``,
    which would pull every group into one task.  It touches all the measures, so
    that its grouping is the very same one and its shuffle is reused; a narrower
    subquery would read the table a second time.
    """
    others = [
        F.max(f.name).alias(f.name) for f in grouped.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name != measure
    ]
    total = grouped.agg(F.struct(F.sum(measure).alias("total"), *others).alias("s")).scalar()["total"]
    return grouped.withColumn(share, percent(F.col(measure), total))


def state_breakdown(silver: DataFrame, k: int = 10) -> DataFrame:
    grouped = counts_by(
        silver.where(F.col("customer_state") != "UNKNOWN"), "customer_state", "customer_count"
    )
    shared = with_share(grouped, "customer_count", "pct_of_total")
    return shared.orderBy(F.desc("customer_count"), F.asc("customer_state")).limit(k)


def order_kpis(silver: DataFrame) -> DataFrame:
    def having(s):
        return F.count_if(F.col("order_status") == s)

    rows = F.count(F.lit(1))
    return silver.agg(
        rows.alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers_with_orders"),
        having("delivered").alias("delivered_orders"),
        having("canceled").alias("canceled_orders"),
        having("shipped").alias("shipped_orders"),
        percent(having("delivered"), rows).alias("delivery_rate_pct"),
        percent(having("canceled"), rows).alias("cancellation_rate_pct"),
    )


def monthly_orders(silver: DataFrame) -> DataFrame:
    month = F.date_trunc("month", "order_purchase_timestamp").cast("timestamp_ntz")
    return (
        silver.where(F.col("order_purchase_timestamp").isNotNull())
        .groupBy(month.alias("order_month"))
        .agg(F.count(F.lit(1)).alias("order_count"),
             F.count_distinct("customer_id").alias("unique_customers"))
        .orderBy("order_month")
    )


def revenue_kpis(silver: DataFrame) -> DataFrame:
    v = F.col("payment_value")

    def of(kind):
        return F.sum(F.when(F.col("payment_type") == kind, v).otherwise(0.0))

    median = exact_median(silver, "payment_value").scalar()
    return silver.agg(
        _money(F.sum(v)).alias("total_revenue_brl"),
        _money(F.avg(v)).alias("avg_order_value_brl"),
        F.max(v).alias("max_order_value_brl"),
        F.min(F.nullif(v, F.lit(0.0))).alias("min_order_value_brl"),
        _money(of("credit_card")).alias("credit_card_revenue"),
        _money(of("boleto")).alias("boleto_revenue"),
        _money(F.avg("payment_installments")).alias("avg_installments"),
    ).withColumn("median_order_value_brl", _money(median))


def revenue_by_type(silver: DataFrame) -> DataFrame:
    v = F.col("payment_value")
    grouped = silver.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum(v).alias("revenue"),
        F.avg(v).alias("mean"),
    )
    return with_share(grouped, "revenue", "pct_of_total_revenue").select(
        "payment_type", "transaction_count", _money(F.col("revenue")).alias("total_revenue"),
        _money(F.col("mean")).alias("avg_transaction_value"), "pct_of_total_revenue",
    ).orderBy(F.desc("total_revenue"))


def product_kpis(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.count_distinct("product_category_name").alias("unique_categories"),
        _money(F.avg("product_weight_g")).alias("avg_weight_g"),
        _money(F.avg("product_photos_qty")).alias("avg_photos_per_product"),
    )


def top_categories(silver: DataFrame, k: int = 20) -> DataFrame:
    grouped = (
        silver.where(F.col("product_category_name") != "unknown")
        .groupBy("product_category_name")
        .agg(F.count(F.lit(1)).alias("product_count"),
             _money(F.avg("product_weight_g")).alias("avg_weight_g"))
    )
    shared = with_share(grouped, "product_count", "pct_of_catalog")
    return shared.orderBy(F.desc("product_count"), F.asc("product_category_name")).limit(k)


def null_rate_pct(df: DataFrame) -> Column:
    """Mean null share over all columns, in percent."""
    rows = F.count(F.lit(1)).cast("double")
    missing = sum((rows - F.count(c).cast("double") for c in df.columns[1:]),
                  start=rows - F.count(df.columns[0]).cast("double"))
    return F.round(missing / rows / F.lit(float(len(df.columns))) * 100.0, 2)


# --- the long (dataset, key, value) form ------------------------------------


#: The keys that each dataset's Gold has, whatever its rows.
KPI_KEYS = {
    "customers": ("total_customers", "unique_customers", "states_covered", "cities_covered", "null_rate_pct", "top_states",
                  "top_cities"),
    "orders": ("total_orders", "unique_customers", "delivered_pct", "canceled_pct", "null_rate_pct", "status_breakdown"),
    "payments": ("total_payments", "total_revenue", "avg_payment_value", "max_payment_value", "min_payment_value",
                 "avg_installments", "null_rate_pct", "payment_type_breakdown"),
    "products": ("total_products", "unique_categories", "avg_weight_g", "null_rate_pct", "top_categories"),
}


def _num(c: Column) -> Column:
    """Two fixed decimals, so the text is the same whatever prints it."""
    return c.cast("decimal(30,2)").cast("string")


def _entry(key: str, value: Column) -> Column:
    return F.struct(F.lit(key).alias("kpi_key"), value.cast("string").alias("kpi_value"))


def _long(dataset: str, wide: DataFrame, entries: list[Column]) -> DataFrame:
    return wide.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*entries)))


def _map_entry(dataset: str, key: str, rows: DataFrame, column: str) -> DataFrame:
    return as_map(rows, column, "rows").select(
        F.lit(dataset).alias("dataset"), F.lit(key).alias("kpi_key"),
        F.col("body").alias("kpi_value"),
    )


#: Columns whose values are counted for the KPIs, those that are averaged, and the maps: key -> (column, most frequent k).
COUNTED = {"customers": ("customer_unique_id", "customer_state", "customer_city"), "orders": ("customer_id", "order_status"),
           "payments": ("payment_type",), "products": ("product_category_name",)}
MEASURED = {"customers": (), "orders": (), "payments": ("payment_value", "payment_installments"),
            "products": ("product_weight_g",)}
MAPS = {"customers": {"top_states": ("customer_state", 5), "top_cities": ("customer_city", 5)},
        "orders": {"status_breakdown": ("order_status", None)}, "payments": {"payment_type_breakdown": ("payment_type", None)},
        "products": {"top_categories": ("product_category_name", 10)}}


def value_counts(dataset: str, silver: DataFrame) -> DataFrame:
    """(metric, value, n) of all counted columns in one scan; the row of metric '' holds the sums of the whole table."""
    missing = sum((F.col(c).isNull().cast("int") for c in silver.columns), start=F.lit(0))
    measures = {c: to_number(F.col(c)) for c in MEASURED[dataset]}
    pairs = [F.struct(F.lit("").alias("metric"), F.lit(None).cast("string").alias("value"))] + [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in COUNTED[dataset]]
    long = silver.select(missing.alias("missing"), *[v.alias(f"m_{c}") for c, v in measures.items()], F.inline(F.array(*pairs)))
    whole = F.col("metric") == ""
    aggs = [F.sum(F.when(whole, F.col("missing"))).alias("missing")]
    for c in measures:
        v = F.when(whole, F.col(f"m_{c}"))
        aggs += [F.sum(v).alias(f"sum_{c}"), F.count(v).alias(f"n_{c}"), F.max(v).alias(f"max_{c}"), F.min(v).alias(f"min_{c}")]
    return long.groupBy("metric", "value").agg(F.count(F.lit(1)).alias("n"), *aggs)


def kpi_rows(dataset: str, silver: DataFrame) -> DataFrame:
    """Gold KPIs of one dataset as (dataset, kpi_key, kpi_value) text rows, all from one scan of Silver."""
    long = value_counts(dataset, silver)
    whole, n = F.col("metric") == "", F.col("n")
    rows = F.coalesce(F.sum(F.when(whole, n)), F.lit(0))
    of = lambda name: F.max(F.when(whole, F.col(name)))
    mean = lambda c: of(f"sum_{c}") / F.nullif(of(f"n_{c}"), F.lit(0))
    distinct = lambda c: F.count_if((F.col("metric") == c) & F.col("value").isNotNull())
    having = lambda c, v: F.coalesce(F.sum(F.when((F.col("metric") == c) & (F.col("value") == v), n)), F.lit(0))
    rate = F.round(of("missing").cast("double") / rows.cast("double") / F.lit(float(len(silver.columns))) * 100.0, 2)
    values = {
        "customers": lambda: {
            "total_customers": rows, "unique_customers": distinct("customer_unique_id"),
            "states_covered": distinct("customer_state"), "cities_covered": distinct("customer_city")},
        "orders": lambda: {
            "total_orders": rows, "unique_customers": distinct("customer_id"),
            "delivered_pct": _num(percent(having("order_status", "delivered"), rows, 1)),
            "canceled_pct": _num(percent(having("order_status", "canceled"), rows, 1))},
        "payments": lambda: {
            "total_payments": rows, "total_revenue": _num(_money(of("sum_payment_value"))),
            "avg_payment_value": _num(_money(mean("payment_value"))),
            "max_payment_value": _num(_money(of("max_payment_value"))),
            "min_payment_value": _num(_money(of("min_payment_value"))),
            "avg_installments": _num(_money(mean("payment_installments")))},
        "products": lambda: {
            "total_products": rows, "unique_categories": distinct("product_category_name"),
            "avg_weight_g": _num(_money(mean("product_weight_g")))},
    }[dataset]() | {"null_rate_pct": _num(rate)}
    # Each part names all measures and filters on an aggregate, so all parts need the same counted rows and share them.
    same = F.greatest(n, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in long.columns[3:]]) >= 0
    out = _long(dataset, long.where(same).agg(*[v.cast("string").alias(k) for k, v in values.items()]),
                [_entry(k, F.col(k)) for k in values])
    for key, (column, k) in MAPS[dataset].items():
        # The metric is compared behind an aggregate: a plain comparison would be pushed below the counting.
        counted = long.where(same & (F.when(n > 0, F.col("metric")) == column)).select(
            F.col("value").alias(column), n.alias("rows"))
        if k is not None:
            counted = counted.where(F.col(column).isNotNull()).orderBy(F.desc("rows"), F.asc(column)).limit(k)
        out = out.unionByName(_map_entry(dataset, key, counted, column))
    return out


# --- facts that back business insights ---------------------------------------


def _fact(category: str, metric: str, subject: Column, value: Column) -> list[Column]:
    return [F.lit(category).alias("category"), F.lit(metric).alias("metric"),
            subject.cast("string").alias("subject"), F.round(value, 2).alias("fact_value")]


def insight_facts(customers: DataFrame, payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Ranked numbers on quality, geography, revenue and customers."""
    located = customers.where(F.col("customer_state") != "UNKNOWN")
    known = with_share(counts_by(located, "customer_state", "n"), "n", "pct")
    lead = known.orderBy(F.desc("n"), F.asc("customer_state")).limit(5)
    top = lead.limit(1).select(*_fact(
        "geography", "top_state_share_pct", F.col("customer_state"), F.col("pct")))
    rows = known.agg(F.sum("n")).scalar()
    five = lead.agg(F.sum("n").alias("n")).select(*_fact(
        "geography", "top5_state_share_pct", F.lit("top 5"), percent(F.col("n"), rows)))
    repeat = customers.agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.count_distinct("customer_unique_id").cast("double").alias("u"),
    ).select(*_fact("customers", "repeat_rate_pct", F.lit("customer_unique_id"),
                    (1.0 - F.col("u") / F.col("n")) * 100.0))
    by_type = payments.groupBy("payment_type").agg(F.sum("payment_value").alias("v"))
    best = with_share(by_type, "v", "pct").orderBy(F.desc("v"), F.asc("payment_type")).limit(1)
    kind = best.select(*_fact(
        "revenue", "top_payment_type_share_pct", F.col("payment_type"), F.col("pct")))
    months = monthly_orders(orders).orderBy(F.desc("order_month")).limit(2)
    pair = months.agg(
        F.max_by("order_count", "order_month").cast("double").alias("now"),
        F.min_by("order_count", "order_month").cast("double").alias("then"),
        F.max("order_month").alias("m"),
    )
    trend = pair.select(*_fact(
        "revenue", "month_over_month_orders_pct", F.date_format("m", "yyyy-MM"),
        (F.col("now") - F.col("then")) * 100.0 / F.nullif(F.col("then"), F.lit(0.0))))
    quality = customers.agg(null_rate_pct(customers).alias("r")).select(*_fact(
        "quality", "null_rate_pct", F.lit("customers"), F.col("r")))
    return top.unionByName(five).unionByName(repeat).unionByName(kind).unionByName(trend).unionByName(quality)

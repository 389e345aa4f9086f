"""Gold from retractable state: a batch changes what its own keys contribute, nothing else is read.

State lies in buckets: the current row per key, and how often each value of the counted columns occurs. A batch takes the
old rows of its keys back and adds the new ones; counts and sums move by the difference, distinct values and extremes
follow from the occurrences. All buckets that a batch touches change in one commit.
"""

from __future__ import annotations

import json
import uuid
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.functions.columns import percent, to_number
from siltgate.operators.store import Attempt, Store, latest_view
from siltgate.plans import gold
from siltgate.sources.manifest import Entry, Files
from siltgate.spec import DatasetSpec

#: Columns whose values are counted, and those that are summed, for each dataset's KPIs.
COUNTED = {
    "customers": ("customer_unique_id", "customer_state", "customer_city"), "orders": ("customer_id", "order_status"),
    "payments": ("payment_type", "payment_value"), "products": ("product_category_name",),
}
SUMMED = {"customers": (), "orders": (), "payments": ("payment_value", "payment_installments"), "products": ("product_weight_g",)}
EXACT = "decimal(38,8)"
COUNTS = "metric string, value string, n bigint"


class GoldState:
    """The state of one dataset in a store. One writer, which is also its only reader."""

    def __init__(self, store: Store, spark: SparkSession, spec: DatasetSpec, buckets: int = 16):
        self.store, self.spark, self.spec, self.buckets = store, spark, spec, buckets
        self.manifest = store.manifest(spark, f"{spec.name}.state")

    # Commits are keyed by bucket: rows from 0, counts from `buckets`, the totals behind both.
    def _held(self) -> tuple[dict[int, Entry], dict]:
        state = {b: c.entries[0] for b, c in self.manifest.state().items()}
        totals = state[2 * self.buckets].metrics if 2 * self.buckets in state else {"applied": {}, "sums": {}}
        return state, totals

    def _read(self, state: dict[int, Entry], ids: list[int]) -> DataFrame | None:
        found = {i: state[i] for i in ids if i in state and state[i].rows}
        return self.store._rows(self.spark, self.spec, "state", found).drop("bucket") if found else None

    def _bucket(self, *columns):
        return F.pmod(F.xxhash64(*columns), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, kind: str, ids: list[int], first: int, name: str) -> dict[int, Entry]:
        """One job for all touched buckets; a bucket without rows keeps an entry of none."""
        base = f"state/{self.spec.name}_{kind}/batch_id=0/try={name}"
        where = f"{self.store.layers.root}/{base}"
        rows.repartition(len(ids), "bucket").write.partitionBy("bucket").parquet(where)
        full = {n for n in Files(self.spark, where).names() if n.startswith("bucket=")}
        schema = rows.drop("bucket").schema.json()
        return {first + i: Entry(f"state/{self.spec.name}_{kind}", f"{base}/bucket={i}", int(f"bucket={i}" in full), schema)
                for i in ids}

    def catch_up(self) -> list[int]:
        """Apply committed batches that the state doesn't hold as they are; returns their numbers."""
        _, totals = self._held()
        late = [b for b, e in sorted(self.store.entries(self.spark, "silver", self.spec).items())
                if totals["applied"].get(str(b)) != e.folder]
        for b in late:
            self._apply(b, self.store.entries(self.spark, "silver", self.spec)[b], None)
        return late

    def apply(self, attempt: Attempt) -> None:
        """Take in a batch that is about to be committed. A try that failed after this is replaced by the next one."""
        self._apply(attempt.batch_id, attempt.entries[f"silver/{self.spec.name}"], attempt)

    def _apply(self, batch: int, entry: Entry, attempt: Attempt | None) -> None:
        spark, spec = self.spark, self.spec
        state, totals = self._held()
        keys, before = list(spec.key), totals["applied"].get(str(batch))
        own = self.store._rows(spark, spec, "silver", {batch: entry})
        wanted = own.select(*keys)
        if before not in (None, entry.folder):
            # The batch was there with other rows: keys that it has no longer count, too.
            wanted = wanted.unionByName(spark.read.parquet(f"{self.store.layers.root}/{before}").select(*keys))
        wanted = wanted.distinct().withColumn("bucket", self._bucket(*keys))
        touched = sorted(r.bucket for r in wanted.select("bucket").distinct().collect())
        current = self._read(state, touched)
        current = own.limit(0) if current is None else current.drop("batch_id").withColumnRenamed("version", "batch_id")
        old = current.join(wanted.drop("bucket"), keys, "left_semi")
        if before is None:
            new = latest_view(old.unionByName(own, allowMissingColumns=True), keys)
        else:
            log = self.store._with(self.store.entries(spark, "silver", spec), "silver", spec, None, attempt)
            new = latest_view(self.store._rows(spark, spec, "silver", log).join(wanted.drop("bucket"), keys, "left_semi"), keys)
        kept = current.join(wanted.drop("bucket"), keys, "left_anti")
        name = f"t{uuid.uuid4().hex[:12]}"
        rows = kept.unionByName(new, allowMissingColumns=True).withColumnRenamed("batch_id", "version")
        written = self._write(rows.withColumn("bucket", self._bucket(*keys)), "rows", touched, 0, name) if touched else {}
        # What was written is what counts: the old rows go, the new ones come.
        fresh = self._read(written, touched)
        added = fresh.drop("batch_id", "version").join(wanted.drop("bucket"), keys, "left_semi").withColumn("w", F.lit(1)) \
            if fresh is not None else None
        gone = old.drop("batch_id").withColumn("w", F.lit(-1))
        delta = gone if added is None else gone.unionByName(added, allowMissingColumns=True)
        changes = delta.select("w", F.inline(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in COUNTED[spec.name]])))
        changes = changes.where(F.col("value").isNotNull()).groupBy("metric", "value").agg(F.sum("w").alias("n")).where("n <> 0")
        bucket = self._bucket("metric", "value")
        moved = sorted(r.bucket for r in changes.select(bucket.alias("bucket")).distinct().collect())
        counts = {}
        if moved:
            past = self._read(state, [self.buckets + i for i in moved])
            every = changes if past is None else changes.unionByName(past.select("metric", "value", "n"))
            every = every.groupBy("metric", "value").agg(F.sum("n").alias("n")).where("n > 0").withColumn("bucket", bucket)
            counts = self._write(every, "counts", moved, self.buckets, name)
        sums = self._sums(delta, totals["sums"])
        last = Entry("state/totals", "", 0, "", {"applied": {**totals["applied"], str(batch): entry.folder}, "sums": sums})
        self.manifest.commit_all({i: [e] for i, e in {**written, **counts, 2 * self.buckets: last}.items()})
        files = Files(spark, self.store.layers.root)
        for i in [*written, *counts]:
            if i in state and state[i].folder:
                files.remove(state[i].folder)

    def _sums(self, delta: DataFrame, before: dict[str, str]) -> dict[str, str]:
        """Rows, nulls per column, sums and their numbers of values, moved by the difference; exact decimals as text."""
        w = F.col("w")
        columns = [c for c in delta.columns if c != "w"]
        parts = {"rows": F.sum(w)} | {f"null:{c}": F.sum(F.when(F.col(c).isNull(), w).otherwise(0)) for c in columns}
        for c in SUMMED[self.spec.name]:
            v = to_number(F.col(c))
            parts |= {f"sum:{c}": F.sum(v.cast(EXACT) * w), f"n:{c}": F.sum(F.when(v.isNotNull(), w).otherwise(0))}
        moved = delta.agg(*[x.alias(k) for k, x in parts.items()]).head().asDict()
        return {k: str(Decimal(before.get(k, "0")) + Decimal(moved.get(k) or 0)) for k in {*before, *moved}}

    def kpi_rows(self) -> DataFrame:
        """The rows of :func:`siltgate.plans.gold.kpi_rows`, from the state alone."""
        state, totals = self._held()
        name, sums = self.spec.name, {k: Decimal(v) for k, v in totals["sums"].items()}
        counts = self._read(state, list(range(self.buckets, 2 * self.buckets)))
        counts = self.spark.createDataFrame([], COUNTS) if counts is None else counts.select("metric", "value", "n")
        of = lambda metric: counts.where(F.col("metric") == metric)
        rows = int(sums.get("rows", 0))
        nulls = [int(v) for k, v in sums.items() if k.startswith("null:")]
        rate = F.round(F.lit(float(sum(nulls))) / F.nullif(F.lit(float(rows)), F.lit(0.0)) / F.lit(float(max(1, len(nulls)))) * 100.0, 2)
        distinct = {c: F.count_if(F.col("metric") == c) for c in COUNTED[name]}
        status = {s: F.coalesce(F.sum(F.when((F.col("metric") == "order_status") & (F.col("value") == s), F.col("n"))), F.lit(0))
                  for s in ("delivered", "canceled")}
        paid = F.when(F.col("metric") == "payment_value", F.col("value").cast("double"))
        mean = lambda c: F.lit(float(sums[f"sum:{c}"] / sums[f"n:{c}"]) if sums.get(f"n:{c}") else None).cast("double")
        money, num = (lambda c: F.round(c, 2)), gold._num
        total = F.lit(rows)
        values = {
            "customers": {"total_customers": total, "unique_customers": distinct.get("customer_unique_id"),
                          "states_covered": distinct.get("customer_state"), "cities_covered": distinct.get("customer_city")},
            "orders": {"total_orders": total, "unique_customers": distinct.get("customer_id"),
                       "delivered_pct": num(percent(status["delivered"], total, 1)),
                       "canceled_pct": num(percent(status["canceled"], total, 1))},
            "payments": {"total_payments": total,
                         "total_revenue": num(money(F.lit(float(sums.get("sum:payment_value", 0))))),
                         "avg_payment_value": num(money(mean("payment_value"))), "max_payment_value": num(money(F.max(paid))),
                         "min_payment_value": num(money(F.min(paid))),
                         "avg_installments": num(money(mean("payment_installments")))},
            "products": {"total_products": total, "unique_categories": distinct.get("product_category_name"),
                         "avg_weight_g": num(money(mean("product_weight_g")))},
        }[name] | {"null_rate_pct": num(rate)}
        out = gold._long(name, counts.agg(*[v.cast("string").alias(k) for k, v in values.items()]),
                         [gold._entry(k, F.col(k)) for k in values])
        maps = {"customers": (("top_states", "customer_state", 5), ("top_cities", "customer_city", 5)),
                "orders": (("status_breakdown", "order_status", None),),
                "payments": (("payment_type_breakdown", "payment_type", None),),
                "products": (("top_categories", "product_category_name", 10),)}[name]
        for key, metric, k in maps:
            found = of(metric).select(F.col("value").alias(metric), F.col("n").alias("rows"))
            found = found if k is None else found.orderBy(F.desc("rows"), F.asc(metric)).limit(k)
            out = out.unionByName(gold._map_entry(name, key, found, metric))
        return out

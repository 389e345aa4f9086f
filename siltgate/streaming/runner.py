"""Continuous Bronze -> Silver -> Gold with Structured Streaming.

One query per dataset.  A micro-batch first keeps its raw rows under its own
``batch_id``; all it makes of them is committed together, so a failed try
leaves nothing behind and a replay takes the place of the whole batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltgate.operators import drift, heal, lineage, mask, ops
from siltgate.operators.store import Attempt, Store
from siltgate.plans import gold, medallion
from siltgate.plans.incremental import GoldState
from siltgate.sources.layers import exists, stamps, write_table
from siltgate.spec import BATCH_HISTORY_KEPT, DatasetSpec

HISTORY = "dataset string, batch_id bigint, status string, bronze_rows bigint, silver_rows bigint, quarantine_rows bigint, heal_events bigint, error string, attempts int, started_at timestamp, ended_at timestamp"
FAILED = "error"


@dataclass(frozen=True)
class Job:
    """One dataset's stream into one store."""

    spec: DatasetSpec
    store: Store
    prefer: tuple = ()
    compact_every: int | None = None
    sweep_every: int | None = None
    incremental: bool = False     # Gold from retractable state instead of all of Silver
    on_error: str = "record"      # or "raise" to stop the stream instead
    retries: int = 2              # further tries before a batch counts as failed

    def _audit(self, name: str, batch_id: int) -> str:
        return self.store.layers.batch_path("audit", f"{name}_{self.spec.name}", batch_id)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` body: contain a bad batch, keep the stream alive."""
        spark = batch.sparkSession
        raw_path = self.store.layers.batch_path("raw", self.spec.name, batch_id)
        at = datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S")
        bronze = write_table(batch.withColumn("ingested_at", F.lit(at).cast("timestamp_ntz")), raw_path)
        error = self._attempt(spark, raw_path, batch_id, bronze)
        if error is not None and self.on_error == "raise":
            raise error

    def replay(self, spark: SparkSession, batch_id: int) -> None:
        """Run a recorded (for example failed) batch again from its Bronze rows."""
        raw_path = self.store.layers.batch_path("raw", self.spec.name, batch_id)
        error = self._attempt(spark, raw_path, batch_id, spark.read.parquet(raw_path).count())
        if error is not None:
            raise error

    def failed(self, spark: SparkSession) -> list[int]:
        """Batches whose last run failed; their Bronze rows wait for ``replay``."""
        history = self.history(spark)
        if history is None:
            return []
        return sorted(r["batch_id"] for r in history.where(F.col("status") == FAILED).select("batch_id").collect())

    def retry_failed(self, spark: SparkSession) -> list[int]:
        """Replay every failed batch; those that still fail stay on record and are returned."""
        return [b for b in self.failed(spark) if self._attempt(
            spark, path := self.store.layers.batch_path("raw", self.spec.name, b), b,
            spark.read.parquet(path).count()) is not None]

    def _attempt(self, spark: SparkSession, raw_path: str, batch_id: int, bronze: int) -> Exception | None:
        """Run a batch, again if it fails; record what was really written either way."""
        started, error = datetime.now(UTC), None
        for attempt in range(1, self.retries + 2):
            done = {"bronze": bronze, "silver": 0, "quarantine": 0, "heals": 0}
            try:
                self._refine(spark, raw_path, batch_id, started, done)
                error = None
                break
            except Exception as err:
                error = err
        row = (self.spec.name, batch_id, "complete" if error is None else FAILED, bronze, done["silver"],
               done["quarantine"], done["heals"], None if error is None else str(error), attempt, started,
               datetime.now(UTC))
        spark.createDataFrame([row], HISTORY).coalesce(1).write.mode("overwrite").parquet(
            self._audit("history", batch_id))
        return error

    def _refine(self, spark: SparkSession, raw_path: str, batch_id: int, started: datetime, done: dict[str, int]) -> None:
        """Every table of the batch in folders of this try, then one commit; nothing is visible before it."""
        # Read the stored batch, not the source: later steps share one durable input.
        arrived = spark.read.parquet(raw_path)
        raw = arrived.drop("ingested_at")
        name, run_id = self.spec.name, f"{self.spec.name}-{batch_id}"
        attempt = self.store.begin(spark, self.spec, batch_id)
        result = medallion.refine(raw, self.spec, self.prefer)
        attempt.put("silver", result.silver)
        attempt.put("quarantine", result.quarantine)
        attempt.put("masked", mask.mask_table(attempt.written("silver"), self.spec.pii))
        attempt.put("gold", self.recompute_gold(spark, attempt).coalesce(1))
        heals = result.events.unionByName(heal.kpi_events(attempt.written("gold")))
        attempt.put("audit", heals.coalesce(1), f"heals_{name}")
        events = attempt.written("audit", f"heals_{name}")
        changes = drift.drift_events(drift.declared_schema(raw, name), self.spec)
        attempt.put("audit", drift.stamp(changes, run_id, started.strftime("%Y-%m-%d %H:%M:%S")).coalesce(1), f"drift_{name}")
        # Rows as the writes have counted them: no table is read again for its lineage.
        rows = {layer: attempt.entries[f"{layer}/{name}"].rows for layer in ("silver", "quarantine", "masked", "gold")}
        arrived_rows = done["bronze"]
        counts = spark.createDataFrame([(name, layer, n) for layer, n in {"bronze": arrived_rows, **rows}.items()],
                                       "dataset string, layer string, n_rows bigint")
        attempt.put("audit", lineage.table_edges(counts, run_id).coalesce(1), f"lineage_{name}")
        totals = spark.createDataFrame([(name, rows["silver"], rows["quarantine"], arrived_rows)],
                                       "dataset string, clean_rows bigint, quarantine_rows bigint, raw_rows bigint")
        attempt.put("audit", lineage.audit_rows(events, totals, run_id).coalesce(1), f"audit_{name}")
        attempt.commit()
        done |= {"silver": rows["silver"], "quarantine": rows["quarantine"],
                 "heals": attempt.entries[f"audit/heals_{name}"].rows}
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            self.store.compact(spark, self.spec, batch_id, self.store.newest_snapshot(spark, self.spec))
        if self.sweep_every and (batch_id + 1) % self.sweep_every == 0:
            self.store.sweep(spark, self.spec)

    def recompute_gold(self, spark: SparkSession, attempt: Attempt) -> DataFrame:
        """KPIs over the whole latest-wins Silver, the batch that is being written included."""
        if self.incremental:
            state = GoldState(self.store, spark, self.spec)
            state.catch_up()
            state.apply(attempt)
            return heal.heal_kpi_rows(state.kpi_rows())
        snapshot = self.store.newest_snapshot(spark, self.spec)
        silver = self.store.silver(spark, self.spec, snapshot, attempt)
        return heal.heal_kpi_rows(gold.kpi_rows(self.spec.name, silver.drop("batch_id")))

    def log(self, spark: SparkSession, kind: str) -> DataFrame | None:
        """The heals, drift, lineage or audit rows of all committed batches."""
        return self.store.read(spark, "audit", self.spec, f"{kind}_{self.spec.name}")

    def history(self, spark: SparkSession, newest: int | None = None) -> DataFrame | None:
        """The record of all batches, or of the ``newest`` ones; older folders are then not read at all."""
        path = self.store.layers.path("audit", f"history_{self.spec.name}")
        if not exists(spark, path):
            return None
        if newest is None:
            return spark.read.schema(HISTORY).parquet(path)
        kept = sorted(stamps(spark, path))[-newest:]
        return spark.read.schema(HISTORY).parquet(*[f"{path}/batch_id={b}" for b in kept])

    def recent(self, spark: SparkSession) -> DataFrame | None:
        """The batches that reports look at, with their duration."""
        history = self.history(spark, BATCH_HISTORY_KEPT)
        return None if history is None else ops.durations(history)


def start(spark: SparkSession, job: Job, source: str, schema, checkpoint: str, *,
          interval: str | None = None, files_per_batch: int | None = None,
          source_format: str = "parquet", decode: Callable[[DataFrame], DataFrame] | None = None,
          ) -> StreamingQuery:
    """Start one dataset's query.

    With an ``interval`` it runs until stopped; without, it drains what is there
    and ends.  A new store needs a new checkpoint, because batch ids restart.
    """
    reader = spark.readStream.format(source_format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(source)
    if decode:
        stream = decode(stream)
    writer = stream.writeStream.queryName(f"refine_{job.spec.name}").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.foreachBatch(job.process).start()


def run_all(spark: SparkSession, jobs: list[tuple[Job, str, object]], checkpoints: str, **options) -> None:
    """Drain every dataset's source; the queries run side by side."""
    running = [
        start(spark, job, source, schema, f"{checkpoints}/{job.spec.name}", **options)
        for job, source, schema in jobs
    ]
    for q in running:
        q.awaitTermination()


def live_heals(stream: DataFrame, spec: DatasetSpec, name: str = "heals") -> DataFrame:
    """Attach heal counters to a stream as observed metrics (no extra job)."""
    steps = heal.present(stream, heal.bronze_steps(spec.name))
    counters = [F.count_if(s.needs(F.col(s.column))).alias(s.column) for s in steps]
    return stream.observe(name, F.count(F.lit(1)).alias("rows"), *counters)

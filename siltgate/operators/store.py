"""Cumulative layers: append, latest-wins upsert, compaction and counts."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.operators.dedup import has_key, keep_one
from siltgate.sources.layers import LAYERS, Layers, exists, write_observed, write_table
from siltgate.sources.manifest import Entry, Files, Manifest, live_folders
from siltgate.spec import BATCH_HISTORY_KEPT, DatasetSpec


def upsert(existing: DataFrame, incoming: DataFrame, keys) -> DataFrame:
    """Existing rows whose key is not in the batch, plus the batch.

    Null-key rows of the history can never match; they skip the join so that
    they do not pile up in one of its partitions.  The batch side carries its
    distinct keys only, and Spark broadcasts it only if its measured size is
    below the session's threshold.
    """
    keys = list(keys)
    fresh = incoming.where(has_key(keys)).select(*keys).distinct()
    kept = existing.where(has_key(keys)).join(fresh, keys, "left_anti")
    unmatched = existing.where(~has_key(keys))
    return kept.unionByName(unmatched).unionByName(incoming, allowMissingColumns=True)


def latest_view(log: DataFrame, keys, version: str = "batch_id", tie_break=()) -> DataFrame:
    """The newest version per key of an append-only log."""
    order = [F.col(version).desc(), *tie_break]
    order += [F.col(c).asc_nulls_last() for c in log.columns if c != version and c not in keys]
    return keep_one(log, list(keys), order)


def append_with_missing(parts: list[DataFrame]) -> DataFrame:
    """Union of differing schemas by name; absent columns are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def running_total(versions: DataFrame, keys, value: str, version: str = "batch_id") -> DataFrame:
    """The latest-wins total after every batch, without re-reading history per batch.

    Each key contributes the *change* its new version makes, so a batch's total
    is the sum of changes up to it.  ``versions`` must hold one row per (key,
    batch).  The final cumulative sum runs over one row per batch.
    """
    per_key = Window.partitionBy(*keys).orderBy(version)
    change = F.col(value) - F.coalesce(F.lag(value).over(per_key), F.lit(0.0))
    added = F.when(F.lag(value).over(per_key).isNull(), 1).otherwise(0)
    deltas = versions.select(version, change.alias("change"), added.alias("added")).groupBy(version).agg(
        F.sum("change").alias("change"), F.sum("added").alias("added"))
    so_far = Window.orderBy(version).rowsBetween(Window.unboundedPreceding, 0)
    return deltas.select(
        version, F.round("change", 2).alias("revenue_change"),
        F.round(F.sum("change").over(so_far), 2).alias("total_revenue"),
        F.sum("added").over(so_far).alias("silver_rows"),
    )


def layer_counts(frames: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Row counts per (layer, dataset).  Each table folds to one row before the union."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(layer).alias("layer"), F.lit(dataset).alias("dataset"), "n_rows")
        for (layer, dataset), df in frames.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def keyed_layers(raw: DataFrame, dataset: str, key) -> DataFrame:
    """Rows that arrived, distinct usable keys and rows without one, as layers; a hot key folds before the shuffle."""
    per_key = raw.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
    usable = has_key(key)
    sums = per_key.agg(F.sum("rows").alias("bronze"), F.count_if(usable).alias("silver"),
                       F.sum(F.when(~usable, F.col("rows"))).alias("quarantine"))
    rows = F.array(*[F.struct(F.lit(c).alias("layer"), F.lit(dataset).alias("dataset"),
                              F.coalesce(c, F.lit(0)).cast("bigint").alias("n_rows")) for c in sums.columns])
    return sums.select(F.inline(rows))


def layer_funnel(counts: DataFrame) -> DataFrame:
    return counts.groupBy("layer").agg(F.sum("n_rows").alias("n_rows"))


def quality_pct(counts: DataFrame) -> DataFrame:
    """Silver as a percentage of Bronze, per dataset."""
    wide = counts.groupBy("dataset").pivot("layer", ["bronze", "silver", "quarantine"]).agg(F.sum("n_rows"))
    return wide.select(
        "dataset", F.col("bronze").alias("bronze_rows"), F.col("silver").alias("silver_rows"),
        F.col("quarantine").alias("quarantine_rows"),
        F.round(F.col("silver") * 100.0 / F.nullif(F.col("bronze"), F.lit(0)), 1)
        .cast("double").alias("quality_pct"),
    )


class Attempt:
    """One try at a batch: tables go to folders of this try, and nobody sees them before ``commit``."""

    def __init__(self, store: Store, spark: SparkSession, spec: DatasetSpec, batch_id: int):
        self.store, self.spark, self.spec, self.batch_id = store, spark, spec, batch_id
        self.name = f"t{uuid.uuid4().hex[:12]}"
        self.entries: dict[str, Entry] = {}

    def put(self, layer: str, df: DataFrame, name: str | None = None, metrics: dict | None = None) -> int:
        """Write one table of the batch; its rows and the named aggregates are observed by the same job."""
        name = name or self.spec.name
        folder = f"{layer}/{name}/batch_id={self.batch_id}/try={self.name}"
        self.store.layers.path(layer, name)
        seen = write_observed(df, f"{self.store.layers.root}/{folder}", metrics or {}, mode="errorifexists")
        rows = seen.pop("rows")
        self.entries[f"{layer}/{name}"] = Entry(f"{layer}/{name}", folder, rows, df.schema.json(), seen)
        return rows

    def written(self, layer: str, name: str | None = None) -> DataFrame:
        """A table of this try, read back."""
        entry = self.entries[f"{layer}/{name or self.spec.name}"]
        return self.spark.read.schema(_schema(entry)).parquet(f"{self.store.layers.root}/{entry.folder}")

    def rows(self) -> dict[str, int]:
        return {table: e.rows for table, e in self.entries.items()}

    def commit(self, keep_others: bool = False) -> None:
        """All tables of the try take the place of what the batch held; with ``keep_others`` only those written anew."""
        manifest = self.store.manifest(self.spark, self.spec.name)
        entries = dict(self.entries)
        if keep_others and (held := manifest.state().get(self.batch_id)):
            entries = {e.table: e for e in held.entries} | entries
        manifest.commit(self.batch_id, entries.values())


def _schema(entry: Entry) -> T.StructType:
    return T.StructType.fromJson(json.loads(entry.schema))


@dataclass(frozen=True)
class Store:
    """Layers on a shared folder, and a manifest per dataset that says which folders count.

    A batch's tables appear together when its try is committed, and a replay takes the place of all of them at once, so
    readers see a batch whole or not at all.  Compaction writes a new snapshot folder and never rewrites one that is
    being read.  A snapshot names the folders it has folded: batches it lacks are read from the log whatever their
    number, and a snapshot of a batch that has been written anew since counts no longer.  One writer per dataset; any
    number of readers.
    """

    layers: Layers

    def manifest(self, spark: SparkSession, dataset: str) -> Manifest:
        return Manifest(spark, self.layers.root, dataset)

    def begin(self, spark: SparkSession, spec: DatasetSpec, batch_id: int) -> Attempt:
        return Attempt(self, spark, spec, batch_id)

    def put(self, layer: str, spec: DatasetSpec, batch_id: int, df: DataFrame) -> int:
        """Write and commit a single table of a batch; its other tables stay."""
        attempt = self.begin(df.sparkSession, spec, batch_id)
        rows = attempt.put(layer, df)
        attempt.commit(keep_others=True)
        return rows

    def entries(self, spark: SparkSession, layer: str, spec: DatasetSpec, name: str | None = None) -> dict[int, Entry]:
        """Batch -> what it has committed of a table."""
        state = self.manifest(spark, spec.name).state()
        found = {b: c.of(f"{layer}/{name or spec.name}") for b, c in state.items()}
        return {b: e for b, e in found.items() if e is not None}

    def read(self, spark: SparkSession, layer: str, spec: DatasetSpec, name: str | None = None,
             pending: Attempt | None = None) -> DataFrame | None:
        """All committed batches of a layer (and a pending try's own), with their number as the ``batch_id`` column.

        Columns that some batches lack hold their declared default there, or null; a column whose type has changed
        between batches can't be merged and fails the read.  Raw rows are inputs and need no commit.
        """
        if layer == "raw":
            path = self.layers.path(layer, spec.name)
            return spark.read.option("mergeSchema", True).parquet(path) if exists(spark, path) else None
        return self._rows(spark, spec, layer, self._with(self.entries(spark, layer, spec, name), layer, spec, name, pending))

    def _with(self, entries, layer, spec, name, pending) -> dict[int, Entry]:
        own = pending.entries.get(f"{layer}/{name or spec.name}") if pending else None
        return entries | ({pending.batch_id: own} if own else {})

    def _rows(self, spark: SparkSession, spec: DatasetSpec, layer: str, entries: dict[int, Entry]) -> DataFrame | None:
        """One read per schema that batches have, however many batches there are."""
        if not entries:
            return None
        table = next(iter(entries.values())).table
        types: dict[str, T.DataType] = {}
        folders: dict[str, list[str]] = {}
        for batch in sorted(entries):
            folders.setdefault(entries[batch].schema, []).append(f"{self.layers.root}/{entries[batch].folder}")
        for schema in folders:
            for f in T.StructType.fromJson(json.loads(schema)).fields:
                if types.setdefault(f.name, f.dataType) != f.dataType:
                    raise ValueError(f"cannot merge {table}: {f.name} is {types[f.name].simpleString()} in some batches and "
                                     f"{f.dataType.simpleString()} in others")
        defaults = self.defaults(spark, spec, layer) if len(folders) > 1 else {}
        parts = []
        for schema, paths in folders.items():
            own = T.StructType.fromJson(json.loads(schema))
            shape = T.StructType([*own.fields, T.StructField("batch_id", T.LongType()), T.StructField("try", T.StringType())])
            df = spark.read.schema(shape).option("basePath", f"{self.layers.root}/{table}").parquet(*paths).drop("try")
            parts.append(df.withColumns({c: F.lit(defaults.get(c)).cast(t) for c, t in types.items() if c not in own.names}))
        return append_with_missing(parts)

    # --- column defaults ---

    def set_default(self, spark: SparkSession, spec: DatasetSpec, layer: str, column: str, value: str) -> None:
        """What batches that lack a column hold in it, as text; the newest declaration counts."""
        files = Files(spark, f"{self.layers.root}/defaults/{spec.name}")
        text = json.dumps({"layer": layer, "column": column, "value": value})
        while not files.create(f"{len([n for n in files.names() if n[0] != '.']):06d}.json", text):
            pass

    def defaults(self, spark: SparkSession, spec: DatasetSpec, layer: str) -> dict[str, str]:
        files = Files(spark, f"{self.layers.root}/defaults/{spec.name}")
        rows = [json.loads(files.read(n)) for n in sorted(files.names()) if n.endswith(".json") and n[0] != "."]
        return {r["column"]: r["value"] for r in rows if r["layer"] == layer}

    # --- snapshots ---

    def _snapshots(self, spark: SparkSession, spec: DatasetSpec) -> dict[int, Entry]:
        return {b: c.entries[0] for b, c in self.manifest(spark, f"{spec.name}.snapshots").state().items()}

    def newest_snapshot(self, spark: SparkSession, spec: DatasetSpec) -> int | None:
        """The highest snapshot whose batches are still as it has folded them, or none."""
        now = {str(b): e.folder for b, e in self.entries(spark, "silver", spec).items()}
        fit = [upto for upto, e in self._snapshots(spark, spec).items()
               if all(now.get(b) == folder for b, folder in e.metrics.items())]
        return max(fit, default=None)

    def _log(self, spark: SparkSession, spec: DatasetSpec, entries: dict[int, Entry], snapshot: int | None) -> DataFrame | None:
        """A snapshot's rows and those of all batches that it lacks."""
        if snapshot is None:
            return self._rows(spark, spec, "silver", entries)
        held = self._snapshots(spark, spec)[snapshot]
        base = spark.read.schema(_schema(held)).parquet(f"{self.layers.root}/{held.folder}")
        rest = {b: e for b, e in entries.items() if held.metrics.get(str(b)) != e.folder}
        return append_with_missing([base, self._rows(spark, spec, "silver", rest)] if rest else [base])

    def silver(self, spark: SparkSession, spec: DatasetSpec, snapshot: int | None = None,
               pending: Attempt | None = None) -> DataFrame | None:
        """Latest-wins Silver by batch number: a snapshot, if given, and every batch outside of it."""
        entries = self._with(self.entries(spark, "silver", spec), "silver", spec, None, pending)
        return latest_view(self._log(spark, spec, entries, snapshot), spec.key) if entries else None

    def compact(self, spark: SparkSession, spec: DatasetSpec, upto: int, snapshot: int | None = None) -> int:
        """Fold all batches up to ``upto`` into a new snapshot folder, and name what it holds."""
        entries = {b: e for b, e in self.entries(spark, "silver", spec).items() if b <= upto}
        rows = latest_view(self._log(spark, spec, entries, snapshot), spec.key)
        folder = f"snapshots/{spec.name}/upto={upto}/try=t{uuid.uuid4().hex[:12]}"
        n = write_table(rows, f"{self.layers.root}/{folder}", mode="errorifexists")
        self.manifest(spark, f"{spec.name}.snapshots").commit(upto, [Entry(
            "snapshot", folder, n, rows.schema.json(), {str(b): e.folder for b, e in entries.items()})])
        return n

    # --- retention ---

    def sweep(self, spark: SparkSession, spec: DatasetSpec, keep_logs: int = BATCH_HISTORY_KEPT, keep_snapshots: int = 2) -> int:
        """Drop folders that nobody needs: tries that were replaced or never committed, logs and Gold of batches before
        the newest ``keep_logs``, snapshots before the newest ``keep_snapshots``.  Silver, quarantine and raw rows stay,
        since a replay may need them.  Runs between batches of the dataset's one writer; returns the folders dropped.
        """
        manifest, snapshots = self.manifest(spark, spec.name), self.manifest(spark, f"{spec.name}.snapshots")
        state, held = manifest.state(), snapshots.state()
        for batch in sorted(state)[:-keep_logs] if keep_logs else state:
            kept = [e for e in state[batch].entries if e.table.split("/")[0] not in ("audit", "gold")]
            if len(kept) < len(state[batch].entries):
                state[batch] = manifest.commit(batch, kept)
        live = live_folders([state, {b: held[b] for b in sorted(held)[-keep_snapshots:]}])
        files, dropped = Files(spark, self.layers.root), 0
        tables = {e.table for c in state.values() for e in c.entries} | {
            f"{layer}/{name}" for layer in (*LAYERS, "snapshots") if layer != "raw"
            for name in files.names(layer) if name == spec.name or name.endswith(f"_{spec.name}")}
        for table in tables | {f"snapshots/{spec.name}"}:
            for batch in files.names(table):
                tries = [t for t in files.names(f"{table}/{batch}") if t.startswith("try=")]
                gone = [t for t in tries if f"{table}/{batch}/{t}" not in live]
                for t in gone:
                    dropped += files.remove(f"{table}/{batch}/{t}")
                if tries and len(gone) == len(tries):
                    files.remove(f"{table}/{batch}")
        manifest.fold(), manifest.forget(), snapshots.fold(), snapshots.forget()
        return dropped

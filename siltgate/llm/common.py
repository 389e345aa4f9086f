"""Helpers that the training-data operators share: scratch tables and text splitting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
            "spark.sql.execution.arrow.maxBytesPerBatch": "8388608b"}


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="siltgate-scratch-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares (spark.checkpoint.dir); a local one only for a local session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage and survives lost executors."""
    return stored_in(df, name)[0]


def stored_in(df: DataFrame, name: str, by: str | None = None) -> tuple[DataFrame, str]:
    """The same, and the folder, which :func:`discard` can drop; with `by`, rows of one value lie in `folder/by=value`.

    The write's own shuffle files go when it ends, not when the driver happens to collect its garbage, and Python workers
    get their rows in small batches.
    """
    path = scratch_path(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = {k: conf.get(k) for k in _WRITING}
    try:
        for k, v in _WRITING.items():
            conf.set(k, v)
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    finally:
        for k, v in before.items():
            conf.set(k, v)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns), path


def discard(spark: SparkSession, *folders: str) -> None:
    """Drop stored folders that nothing reads any more."""
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def squeezed(x: np.ndarray) -> bytes:
    """Integers as bytes: rising ones as steps, others above their least, in the narrowest form and compressed."""
    steps = np.diff(x, prepend=x[:1])
    rising = not len(x) or bool(steps.min() >= 0)
    base = int(x[0] if rising else x.min()) if len(x) else 0
    values = steps if rising else x - base
    most = int(values.max(initial=0))
    kind = np.min_scalar_type(most) if values.min(initial=0) >= 0 else np.dtype("int64")
    data = values.astype(kind.newbyteorder("<")).tobytes()
    head = kind.str[1:].encode() + (b"+" if rising else b"=") + base.to_bytes(8, "little", signed=True)
    return head + len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unsqueezed(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[19:], int.from_bytes(data[11:19], "little"), "zstd", asbytes=True)
    values = np.frombuffer(raw, dtype="<" + data[:2].decode()).astype(np.int64)
    base = int.from_bytes(data[3:11], "little", signed=True)
    return (np.cumsum(values, dtype=np.int64) if data[2:3] == b"+" else values) + base


_CACHES: dict[str, object] = {}


def worker_cache(name: str, make: Callable[[], object]):
    """This Python worker's cache of one kind. Workers outlive their stage: asking for one kind drops the others."""
    if name not in _CACHES:
        _CACHES.clear()
        pa.default_memory_pool().release_unused()
        _CACHES[name] = make()
    return _CACHES[name]

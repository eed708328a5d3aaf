"""Shared pieces: Arrow text columns as byte arrays, work tables in the shared folder."""
from __future__ import annotations

import inspect
import os
from collections.abc import Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from gatekit.session import scratch_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows that Spark hands to Python at once; the operators cut a batch further by bytes.
BATCH_ROWS = 1000
#: Bytes that Spark hands to Python at once.
BATCH_BYTES = 4 << 20
#: Python workers give memory back that a step no longer needs: they are used again by
#: later stages, and what each has held at most would stay with it.
WORKER_ENV = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": str(1 << 18)}
#: Bytes of text that one vectorised step holds (a longer single text is one step).
STEP_BYTES = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the operators rely on. Python workers find the package at the
    driver's path if it lies there (one machine, a shared folder); else ship it with the job."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [paths, ROOT]))
    for name, value in WORKER_ENV.items():
        spark.sparkContext.environment.setdefault(name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: it cuts the
    lineage, survives lost executors, and readers see one fixed version."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{name}")
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def plain_names(*parameters: str):
    """For operators that hand on the columns of their first argument: inside, all columns
    but those that ``parameters`` name are called ``extra_0`` and so on, so no name of theirs
    (also one with a dot) can meet a name that the operator makes. A column that the operator
    adds replaces one of that name."""
    def around(f):
        own = inspect.signature(f)

        @wraps(f)
        def call(docs: DataFrame, *args, **more) -> DataFrame:
            given = own.bind(docs, *args, **more)
            given.apply_defaults()
            kept = {given.arguments[p] for p in parameters}
            names = {c if c in kept else f"extra_{i}": c for i, c in enumerate(docs.columns)}
            out = f(docs.toDF(*names), *args, **more)
            added = {c for c in out.columns if c not in names}
            out = out.select(*[c for c in out.columns if names.get(c, c) not in added or c in added])
            return out.toDF(*[names.get(c, c) for c in out.columns])
        return call
    return around


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty. Row i is
    ``bytes[offsets[i]:offsets[i + 1]]``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, offs, data = column.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1]
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0]:o[-1]], o - o[0]


def steps(offsets: np.ndarray, limit: int = STEP_BYTES, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes and ``rows`` rows, but one row at least."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), i + rows, n)
        yield i, j
        i = j

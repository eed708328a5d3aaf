"""Load each landed file once, in batch: a manifest of claimed paths.

A run first claims the files that no loaded run has: the listing (paths only, no content is
read) anti-joined with the manifest. The claim is written before any content is read and
fixes what the run loads. When all layers are written, the run is noted as loaded.

* The same run again loads its own files again and replaces its rows.
* A run that broke off holds claims but is not noted as loaded. The next run gives these
  files up again, clears what the broken run left in the tables partitioned by run, and
  loads them itself. What it upserted is replaced when its files come again.

Files are told apart by path: one that is rewritten under its path is not loaded again.
There is one writer at a time.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .landing import read_files
from .store import Store

CLAIMS, LOADED = "landing_claims", "landing_loaded"
_CLAIM = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
                       T.StructField("modified", T.TimestampType()), T.StructField("run_id", T.StringType())])


def listing(spark: SparkSession, landing: str) -> DataFrame:
    """(path, length, modified) of all files under ``landing``; no content is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
            .select("path", "length", F.col("modificationTime").alias("modified")))


def _declare(store: Store) -> None:
    store.ensure(CLAIMS, _CLAIM)
    store.ensure(LOADED, T.StructType([T.StructField("files", T.LongType()), T.StructField("run_id", T.StringType())]))


def unseen_files(spark: SparkSession, landing: str, store: Store, run_id: str) -> DataFrame:
    """The listed files that no other loaded run has claimed."""
    _declare(store)
    taken = (store.read(CLAIMS).filter(F.col("run_id") != run_id)
             .join(store.read(LOADED).select("run_id"), "run_id", "left_semi").select("path"))
    return listing(spark, landing).join(taken, "path", "left_anti")


def give_up_broken_runs(store: Store, run_id: str, tables: tuple[tuple[str, str], ...]) -> list[str]:
    """Runs that claimed files but did not come to their end: their claims and their
    rows in ``tables`` ((table, run column) pairs) go. Returns the runs."""
    _declare(store)
    broken = [r.run_id for r in store.read(CLAIMS).select("run_id").distinct().filter(F.col("run_id") != run_id)
              .join(store.read(LOADED).select("run_id"), "run_id", "left_anti").collect()]  # a few runs at most
    for run in broken:
        for table, column in tables:
            store.clear_run(table, column, run)
        store.clear_run(CLAIMS, "run_id", run)
    return broken


def claim(spark: SparkSession, landing: str, store: Store, run_id: str) -> DataFrame:
    """Claim the unseen files under ``landing`` and return their lines (``value``,
    ``_source_file``). Paths pass through the driver, as they do in any file listing."""
    # this run's own claims are left out by a partition filter: what is replaced is not read
    new = unseen_files(spark, landing, store, run_id).withColumn("run_id", F.lit(run_id))
    store.replace_run(CLAIMS, new.select("path", "length", "modified", "run_id"), "run_id", run_id)
    paths = [r.path for r in store.read(CLAIMS).filter(F.col("run_id") == run_id).select("path").collect()]
    return read_files(spark, sorted(paths))


def mark_loaded(store: Store, run_id: str) -> None:
    """The run has come to its end; its files are not loaded again by others."""
    files = store.read(CLAIMS).filter(F.col("run_id") == run_id).agg(F.count(F.lit(1)).alias("files"))
    store.replace_run(LOADED, files.withColumn("run_id", F.lit(run_id)), "run_id", run_id)

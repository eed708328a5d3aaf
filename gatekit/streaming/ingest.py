"""Structured Streaming entry points.

The landing folder is a file source; the checkpoint records which files were
taken, so a second run over the same files delivers nothing (ingest once).
``availableNow`` processes what has landed and stops, in as many
micro-batches as the source limits allow. Each micro-batch runs the plain
batch code inside ``foreachBatch``; its run id is derived from the batch id,
so a replayed micro-batch rewrites its own partitions of bronze and quarantine, and its
rows in silver and the log become newer versions of the same keys: a micro-batch that broke
off between two layers and is replayed leaves the same tables as one that went through.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.medallion import BRONZE, GoldFn, gate_raw, write_bronze
from ..sources.landing import blank
from ..sources.store import Store
from ..spec import GateSpec


ARRIVED = "_arrived"


def landing_stream(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Lines of all files under ``landing``, nested folders too, with the time of the
    micro-batch (kept in its offset log, so a replay sees the same time)."""
    r = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    lines = r.load(landing).filter(~blank("value"))
    return lines.select("value", F.col("_metadata.file_path").alias("_source_file"),
                        F.current_timestamp().alias(ARRIVED))


def arrival(df: DataFrame, as_of: str | None) -> tuple[DataFrame, str]:
    """The micro-batch without its time, and the time to gate it at: ``as_of`` where it
    is given (tests, backfills), else the micro-batch's own."""
    if as_of is None:
        first = df.select(F.date_format(ARRIVED, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).first()
        as_of = first.t if first else df.sparkSession.range(1).select(
            F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    return df.drop(ARRIVED), as_of


def micro_run_id(run_id: str, epoch: int) -> str:
    return f"{run_id}-{epoch:06d}"


def ingest_stream(spark: SparkSession, landing: str, store: Store, spec: GateSpec, run_id: str,
                  as_of: str | None, checkpoint: str, available_now: bool = True,
                  max_files: int | None = None, drift: str = "rescue") -> StreamingQuery:
    """Tail ``landing`` into bronze (rescue + lineage), one batch id per micro-batch.
    Without ``as_of`` rows carry the time of their micro-batch."""
    def sink(df: DataFrame, epoch: int) -> None:
        lines, at = arrival(df, as_of)
        store.ensure(BRONZE, spec.table_schemas()[BRONZE])
        write_bronze(lines, store, spec, micro_run_id(run_id, epoch), F.lit(at).cast(spec.ts_type), drift)

    w = (landing_stream(spark, landing, max_files).writeStream.foreachBatch(sink)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def gate_stream(spark: SparkSession, landing: str, store: Store, spec: GateSpec, run_id: str,
                as_of: str | None, checkpoint: str, gold: GoldFn | None = None,
                available_now: bool = True, max_files: int | None = None,
                drift: str = "rescue") -> StreamingQuery:
    """The whole gate on every micro-batch: bronze, metrics, quarantine, silver, gold.
    Without ``as_of`` each micro-batch is gated at its own time."""
    def sink(df: DataFrame, epoch: int) -> None:
        lines, at = arrival(df, as_of)
        gate_raw(spark, lines, store, spec, micro_run_id(run_id, epoch), at, gold, drift=drift)

    w = (landing_stream(spark, landing, max_files).writeStream.foreachBatch(sink)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def ingest_once(spark: SparkSession, landing: str, store: Store, spec: GateSpec, run_id: str,
                as_of: str | None, checkpoint: str) -> None:
    """Load only files the checkpoint has not seen, then stop."""
    ingest_stream(spark, landing, store, spec, run_id, as_of, checkpoint).awaitTermination()

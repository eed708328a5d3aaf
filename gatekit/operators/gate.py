"""Split a bronze batch into quarantine and good rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import bad_row, good_row, quarantine_reason
from ..spec import GateSpec


def batch_slice(bronze: DataFrame, spec: GateSpec, run_id: str) -> DataFrame:
    """Rows of one run; pruned to one partition when bronze is partitioned by batch."""
    return bronze.filter(F.col(spec.batch_col) == F.lit(run_id))


def latest_batch(bronze: DataFrame, spec: GateSpec) -> DataFrame:
    """One row: the batch id of the newest ingest time (ties -> larger batch id).

    A global ``max_by`` aggregate, partially aggregated per partition; an
    empty table yields one NULL row rather than an error.
    """
    return bronze.agg(F.max_by(F.col(spec.batch_col),
                               F.struct(F.col(spec.ingest_col), F.col(spec.batch_col)))
                      .alias(spec.batch_col))


def slice_latest(bronze: DataFrame, spec: GateSpec) -> DataFrame:
    """Rows of the newest batch, found without collecting anything to the driver.

    The batch id is a scalar subquery, so on a table partitioned by batch it
    becomes a partition filter: only the newest batch's files are read.
    """
    latest = latest_batch(bronze, spec).scalar()
    return bronze.filter(F.col(spec.batch_col) == latest)


def bad_rows(batch: DataFrame, spec: GateSpec) -> DataFrame:
    return batch.filter(bad_row(spec))


def good_rows(batch: DataFrame, spec: GateSpec) -> DataFrame:
    return batch.filter(good_row(spec))


QUARANTINE_COLUMNS = ("quarantine_reason", "run_id", "quarantine_ts")


def quarantine_rows(batch: DataFrame, spec: GateSpec, quarantine_ts: Column,
                    run_id: Column | None = None) -> DataFrame:
    """The quarantine projection of bad rows: required columns, rescue, source,
    batch, reason, run id and time. ``run_id`` defaults to the batch id."""
    run_id = F.col(spec.batch_col) if run_id is None else run_id
    return batch.filter(bad_row(spec)).select(
        *[F.col(c) for c in spec.required],
        F.col(spec.rescue_col), F.col(spec.source_col), F.col(spec.batch_col),
        quarantine_reason(spec).alias("quarantine_reason"),
        run_id.cast("string").alias("run_id"),
        quarantine_ts.alias("quarantine_ts"))


def with_reason(batch: DataFrame, spec: GateSpec) -> DataFrame:
    """Compute the reason once; '' marks a good row (split = filter on it)."""
    return batch.withColumn("quarantine_reason", quarantine_reason(spec))

"""Turn probe rows into metrics-log rows (PASS / WARN / FAIL)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rules import bronze_rules, rule_freshness
from ..spec import GateSpec

LOG_COLUMNS = ("run_id", "check_ts", "layer", "table_name", "rule_name", "column_name",
               "status", "failure_count", "total_count", "failure_rate", "metric_value",
               "threshold", "detail")


def _log_select(spec: GateSpec, layer: str | None = None, table: str | None = None):
    return [F.col("run_id"), F.col("check_ts"),
            F.lit(layer or spec.layer).alias("layer"),
            F.lit(table or spec.table_name).alias("table_name"),
            *[F.col(c) for c in LOG_COLUMNS[4:]]]


def evaluate_all(probe: DataFrame, spec: GateSpec, with_row_count: bool = True,
                 only: tuple[str, ...] | None = None) -> DataFrame:
    """All bronze rules for every batch of a probe, in log order: drift, one
    null-rate row per required column, duplicate, freshness, late, row count.

    Expects probe columns from :func:`bronze_probe` (+ ``trailing_avg`` when
    ``with_row_count``). One ``inline`` per probe row; no driver round trip. ``only``
    names the rules wanted: the probe needs no more than they read.
    """
    rules = bronze_rules(spec, with_row_count, only)
    exploded = probe.select(F.col(spec.batch_col).cast("string").alias("run_id"),
                          F.col("check_ts"), F.inline(F.array(*rules)))
    return exploded.select(*_log_select(spec))


def freshness_metric(fresh: DataFrame, spec: GateSpec, run_id: Column, check_ts: Column,
                     layer: str, table: str) -> DataFrame:
    """One freshness row for a whole table (silver / gold gate) from a frame
    with a ``lag_hours`` column."""
    return (fresh.select(run_id.cast("string").alias("run_id"),
                         check_ts.cast(spec.ts_type).alias("check_ts"),
                         F.inline(F.array(rule_freshness(spec.event_col, F.col("lag_hours"),
                                                         spec.freshness_sla_hours))))
            .select(*_log_select(spec, layer, table)))


def fail_count_per_run(log: DataFrame) -> DataFrame:
    return log.groupBy("run_id").agg(F.count_if(F.col("status") == "FAIL").alias("fail_count"))

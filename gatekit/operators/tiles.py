"""The seven monitoring queries over the metrics log, quarantine and gold."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..spec import GateSpec


def tile_status_over_time(log: DataFrame) -> DataFrame:
    """Checks per hour and status, with the status's share of that hour."""
    hour = F.date_trunc("HOUR", F.col("check_ts")).cast(log.schema["check_ts"].dataType)
    by = log.groupBy(hour.alias("check_hour"), "status").agg(
        F.count(F.lit(1)).alias("check_count"))
    w = Window.partitionBy("check_hour")
    return (by.withColumn("pct_of_hour",
                          F.round(F.lit(100.0) * F.col("check_count")
                                  / F.sum("check_count").over(w), 1))
              .orderBy("check_hour", "status"))


def tile_failures_by_rule(log: DataFrame) -> DataFrame:
    """Per rule and layer: checks, FAIL and WARN counts, failing rows, fail %."""
    by = log.groupBy("rule_name", "layer").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == "FAIL").alias("fail_count"),
        F.count_if(F.col("status") == "WARN").alias("warn_count"),
        F.sum("failure_count").cast("bigint").alias("total_failing_rows"))
    return (by.withColumn("fail_pct",
                          F.round(F.lit(100.0) * F.col("fail_count") / F.col("total_checks"), 1))
              .orderBy(F.col("fail_count").desc(), F.col("warn_count").desc()))


def tile_freshness_trend(log: DataFrame) -> DataFrame:
    return (log.filter(F.col("rule_name") == "freshness_sla")
            .select("check_ts", "table_name", F.col("metric_value").alias("lag_hours"),
                    F.col("threshold").alias("sla_hours"), "status")
            .orderBy("check_ts"))


def tile_quarantine_reasons(quarantine: DataFrame, spec: GateSpec) -> DataFrame:
    """Rows per whole reason string (not exploded)."""
    return (quarantine.groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(spec.table_name).alias("source_table"), "quarantine_reason", "rows")
            .orderBy(F.col("rows").desc()))


def tile_kpis(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame,
              log: DataFrame) -> DataFrame:
    """One row of four uncorrelated scalar subqueries (no join at all)."""
    def n(df):
        return df.agg(F.count(F.lit(1))).scalar()
    pass_pct = log.agg(F.round(F.lit(100.0) * F.count_if(F.col("status") == "PASS")
                               / F.count(F.lit(1)), 1).alias("overall_pass_pct"))
    return pass_pct.select(n(bronze).alias("bronze_rows"), n(silver).alias("silver_rows"),
                           n(quarantine).alias("quarantined_rows"), "overall_pass_pct")


def latest_run(log: DataFrame, layer: str = "bronze") -> DataFrame:
    """run_id of the newest check of ``layer`` (ties -> larger run id): a
    TakeOrdered of one row, never a global sort."""
    return (log.filter(F.col("layer") == layer)
            .orderBy(F.col("check_ts").desc(), F.col("run_id").desc())
            .limit(1).select("run_id"))


def severity_rank():
    return (F.when(F.col("status") == "FAIL", 0)
            .when(F.col("status") == "WARN", 1).otherwise(2))


def tile_latest_scorecard(log: DataFrame, with_detail: bool = True) -> DataFrame:
    """Checks of the latest bronze run, worst status first, then rule name.
    The latest side is one row by construction, so it is broadcast."""
    cols = ["layer", "rule_name", "column_name", "status", "failure_count", "total_count",
            "failure_rate"] + (["detail"] if with_detail else [])
    return (log.join(F.broadcast(latest_run(log)), "run_id")
            .orderBy(severity_rank(), F.col("rule_name"))
            .select(*cols))


def tile_revenue(gold_rc: DataFrame) -> DataFrame:
    return (gold_rc.select("store_region", "product_category", "total_revenue", "order_count")
            .orderBy(F.col("total_revenue").desc()))

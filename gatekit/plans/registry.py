"""Registered queries: one callable per operator, plus its DuckDB twin.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame derived from
the driver's tables. Column names equal the oracle's. ``detail`` is left out
of value-hashed outputs (see ``drop_detail``).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.exprs import quarantine_reason
from ..operators import conform as C
from ..operators import gate as G
from ..operators import probe as P
from ..operators import tiles as TL
from ..operators.evaluate import fail_count_per_run
from ..operators.gold import gold_daily, gold_region_category
from ..sources.testbind import SALES_NTZ, batch_check_ts
from . import oracle as O
from .sales import LAST_RUN, SalesRun, arrays_as_text, drop_detail

S = SALES_NTZ
Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def run(spark, sf_dir) -> SalesRun:
    return SalesRun(spark, sf_dir)


LOG_NO_DETAIL = ("run_id, check_ts, layer, table_name, rule_name, column_name, status, "
                 "failure_count, total_count, failure_rate, metric_value, threshold")

# --------------------------------------------------------------------------- #
# 2.2 projections, filters, predicates
# --------------------------------------------------------------------------- #
register("batch_slice", O.with_ctes(["bronze"], f"""
SELECT b.* FROM bronze b
JOIN (SELECT arg_max(_batch_id, (_ingest_ts, _batch_id)) AS _batch_id FROM bronze) l USING (_batch_id)"""))(
    lambda spark, d: G.slice_latest(run(spark, d).bronze, S))

register("latest_batch", O.with_ctes(["bronze"], """
SELECT arg_max(_batch_id, (_ingest_ts, _batch_id)) AS _batch_id FROM bronze"""))(
    lambda spark, d: G.latest_batch(run(spark, d).bronze, S))

register("bad_row_filter", O.with_ctes(["bronze"], f"SELECT * FROM bronze WHERE {O.bad_sql()}"))(
    lambda spark, d: G.bad_rows(run(spark, d).bronze, S))

register("good_row_filter", O.with_ctes(["bronze"], f"SELECT * FROM bronze WHERE NOT {O.bad_sql()}"))(
    lambda spark, d: G.good_rows(run(spark, d).bronze, S))

register("quarantine_reason", O.with_ctes(["bronze"], f"""
SELECT order_id, customer_id, _batch_id, {O.reason_sql()} AS quarantine_reason
FROM bronze WHERE {O.bad_sql()}"""))(
    lambda spark, d: G.bad_rows(run(spark, d).bronze, S).select(
        "order_id", "customer_id", "_batch_id", quarantine_reason(S).alias("quarantine_reason")))

register("quarantine_rows", O.with_ctes(["quarantine"], "SELECT * FROM quarantine"))(
    lambda spark, d: run(spark, d).quarantine)


def _conform_types(spark, d):
    good = G.good_rows(run(spark, d).bronze, S)
    return C.conform_types(good, S).select(*S.contract_names)


register("conform_types", O.with_ctes(["bronze"], f"""
SELECT {', '.join(
    f"try_cast({c} AS {dict(S.casts)[c].upper()}) AS {c}" if c in dict(S.casts)
    else (f"{O.ts_parse()} AS {c}" if c == S.event_col else c) for c in S.contract_names)}
FROM bronze WHERE NOT {O.bad_sql()}"""))(_conform_types)

register("conform_defaults", O.with_ctes(["bronze"], f"""
SELECT order_id, {', '.join(f"upper(coalesce({c}, '{v}')) AS {c}" for c, v in S.defaults)}
FROM bronze"""))(
    lambda spark, d: C.conform_defaults(run(spark, d).bronze, S).select(
        "order_id", *[c for c, _ in S.defaults]))

register("repair_amount", O.with_ctes(["bronze"], """
SELECT order_id, quantity, unit_price,
  coalesce(CAST(total_amount AS DOUBLE), CAST(quantity AS DOUBLE) * CAST(unit_price AS DOUBLE)) AS total_amount
FROM bronze"""))(
    lambda spark, d: C.repair_amount(run(spark, d).bronze, S).select(
        "order_id", "quantity", "unit_price", "total_amount"))

register("derive_order_date", O.with_ctes(["bronze"], f"""
SELECT order_id, order_ts, CAST({O.ts_parse()} AS DATE) AS order_date FROM bronze"""))(
    lambda spark, d: C.derive_order_date(run(spark, d).bronze, S).select(
        "order_id", "order_ts", "order_date"))

register("flag_late", O.with_ctes(["bronze"], f"""
SELECT order_id, order_ts, _ingest_ts, {O.late_sql()} AS is_late FROM bronze"""))(
    lambda spark, d: C.flag_late(run(spark, d).bronze, S).select(
        "order_id", "order_ts", "_ingest_ts", "is_late"))

register("exclude_cancelled", O.with_ctes(["silver"], f"""
SELECT * FROM silver WHERE {S.status_col} <> '{S.cancelled_value}'"""))(
    lambda spark, d: C.exclude_cancelled(run(spark, d).table("silver"), S))

# --------------------------------------------------------------------------- #
# 2.5 windows
# --------------------------------------------------------------------------- #
register("dedup_latest", O.with_ctes(["silver"], "SELECT * FROM silver"))(
    lambda spark, d: run(spark, d).silver)


def _pct_of_group(spark, d):
    q = run(spark, d).quarantine
    from pyspark.sql import Window
    by = q.groupBy("_batch_id", "quarantine_reason").agg(F.count(F.lit(1)).alias("n"))
    return by.withColumn("pct_of_batch", F.round(
        F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy("_batch_id")), 1))


register("pct_of_group", O.with_ctes(["quarantine"], f"""
SELECT _batch_id, quarantine_reason, count(*) AS n,
  {O.rnd('CAST(100.0 AS DOUBLE) * count(*) / CAST(sum(count(*)) OVER (PARTITION BY _batch_id) AS DOUBLE)', 1)} AS pct_of_batch
FROM quarantine GROUP BY _batch_id, quarantine_reason"""))(_pct_of_group)

# --------------------------------------------------------------------------- #
# 2.4 aggregations
# --------------------------------------------------------------------------- #
_PROBE_COLS = (["_batch_id", "total"] + [f"null_{c}" for c in S.required]
               + ["rescued", "distinct_keys", "late", "max_event_ts", "check_ts", "lag_hours",
                  "present", "unexpected", "missing"])

register("bronze_probe", O.with_ctes(["probe"], f"SELECT {', '.join(_PROBE_COLS)} FROM probe"))(
    lambda spark, d: arrays_as_text(run(spark, d).probe).select(*_PROBE_COLS))

register("null_counts", O.with_ctes(["bronze"], f"""
SELECT _batch_id, total, column_name, null_count FROM (
  SELECT _batch_id, count(*) AS total,
    {', '.join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in S.required)}
  FROM bronze GROUP BY _batch_id)
UNPIVOT (null_count FOR column_name IN ({', '.join(S.required)}))"""))(
    lambda spark, d: P.null_counts(run(spark, d).bronze, S))

register("distinct_keys", O.with_ctes(["bronze"], """
SELECT _batch_id, count(*) AS total, count(DISTINCT order_id) AS distinct_keys
FROM bronze GROUP BY _batch_id"""))(
    lambda spark, d: P.distinct_keys(run(spark, d).bronze, S))

register("late_count", O.with_ctes(["bronze"], f"""
SELECT _batch_id, count(*) AS total,
  count(*) FILTER (WHERE order_ts IS NOT NULL AND {O.late_sql()}) AS late
FROM bronze GROUP BY _batch_id"""))(
    lambda spark, d: P.late_count(run(spark, d).bronze, S))

register("freshness_lag", O.with_ctes(["bronze"], f"""
SELECT _batch_id, max_event_ts, check_ts, {O.lag_sql('max_event_ts', 'check_ts')} AS lag_hours
FROM (SELECT _batch_id, max({O.ts_parse()}) AS max_event_ts, {O.check_ts_sql()} AS check_ts
      FROM bronze GROUP BY _batch_id)"""))(
    lambda spark, d: P.freshness_lag(run(spark, d).bronze, S, batch_check_ts(S)))

register("silver_freshness", O.with_ctes(["silver"], f"""
SELECT count(*) AS silver_rows,
  {O.lag_sql('max(order_ts)', "TIMESTAMP '" + O.AS_OF + "'")} AS lag_hours
FROM silver"""))(
    lambda spark, d: P.silver_freshness(run(spark, d).table("silver"), S, run(spark, d).as_of))

register("trailing_avg", O.with_ctes(["metrics"], f"""
SELECT avg(metric_value) AS trailing_avg FROM metrics
WHERE rule_name = 'row_count_anomaly' AND run_id <> '{LAST_RUN}'"""))(
    lambda spark, d: P.trailing_avg(run(spark, d).table("metrics"), LAST_RUN))

register("gold_daily", O.with_ctes(["gold"], "SELECT * FROM gold_daily"))(
    lambda spark, d: (lambda r: gold_daily(r.table("silver"), S, r.as_of))(run(spark, d)))

register("gold_region_category", O.with_ctes(["gold"], "SELECT * FROM gold_rc"))(
    lambda spark, d: (lambda r: gold_region_category(r.table("silver"), S, r.as_of))(
        run(spark, d)))


def _run_row_count(spark, d):
    r = run(spark, d)
    parts = [r.bronze.select(F.lit("bronze_sales").alias("table_name"),
                             F.col("_batch_id").alias("run_id")),
             r.table("quarantine").select(F.lit("bronze_sales_quarantine").alias("table_name"),
                                          "run_id"),
             r.table("silver").select(F.lit("silver_sales").alias("table_name"), "run_id")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("table_name", "run_id").agg(F.count(F.lit(1)).alias("row_count"))


register("run_row_count", O.with_ctes(["quarantine", "silver"], """
SELECT table_name, run_id, count(*) AS row_count FROM (
  SELECT 'bronze_sales' AS table_name, _batch_id AS run_id FROM bronze
  UNION ALL SELECT 'bronze_sales_quarantine', run_id FROM quarantine
  UNION ALL SELECT 'silver_sales', run_id FROM silver)
GROUP BY table_name, run_id"""))(_run_row_count)

register("fail_count_per_run", O.with_ctes(["metrics"], """
SELECT run_id, CAST(count_if(status = 'FAIL') AS BIGINT) AS fail_count FROM metrics GROUP BY run_id"""))(
    lambda spark, d: fail_count_per_run(run(spark, d).table("metrics")))

# --------------------------------------------------------------------------- #
# 2.7 set operations / drift
# --------------------------------------------------------------------------- #
register("column_drift", O.with_ctes(["drift"], """
SELECT _batch_id, array_to_string(pl, ',') AS present, array_to_string(ul, ',') AS unexpected,
  array_to_string(ml, ',') AS missing FROM drift"""))(
    lambda spark, d: arrays_as_text(P.column_drift(run(spark, d).bronze, S)))

# --------------------------------------------------------------------------- #
# 2.9 rules
# --------------------------------------------------------------------------- #
_RULES = {"rule_schema_drift": "schema_drift", "rule_null_rate": "null_rate",
          "rule_duplicate": "duplicate", "rule_freshness": "freshness_sla",
          "rule_late_arriving": "late_arriving"}


def _rule_query(rule):
    return lambda spark, d: drop_detail(run(spark, d).rule(rule))


for _name, _rule in _RULES.items():
    register(_name, O.with_ctes(["metrics"], f"SELECT * FROM metrics WHERE rule_name = '{_rule}'"))(
        _rule_query(_rule))

register("evaluate_all", O.with_ctes(["metrics"], "SELECT * FROM bronze_metrics"))(
    lambda spark, d: drop_detail(run(spark, d).bronze_metrics))

# --------------------------------------------------------------------------- #
# 2.3 joins, 2.6 sorts / top-k, 2.10 tiles
# --------------------------------------------------------------------------- #
_LATEST = ("SELECT run_id FROM metrics WHERE layer = 'bronze' "
           "ORDER BY check_ts DESC, run_id DESC LIMIT 1")

register("latest_run", O.with_ctes(["metrics"], _LATEST))(
    lambda spark, d: TL.latest_run(run(spark, d).table("metrics")))

register("scorecard_join", O.with_ctes(["metrics"], f"""
SELECT m.{LOG_NO_DETAIL.replace(', ', ', m.')} FROM metrics m JOIN ({_LATEST}) l USING (run_id)"""))(
    lambda spark, d: (lambda log: drop_detail(log.join(F.broadcast(TL.latest_run(log)),
                                                       "run_id")))(run(spark, d).table("metrics")))

register("severity_order", O.with_ctes(["metrics"], """
SELECT run_id, rule_name, column_name, status,
  CASE status WHEN 'FAIL' THEN 0 WHEN 'WARN' THEN 1 ELSE 2 END AS severity
FROM metrics ORDER BY severity, rule_name"""))(
    lambda spark, d: run(spark, d).table("metrics").select(
        "run_id", "rule_name", "column_name", "status",
        TL.severity_rank().alias("severity")).orderBy("severity", "rule_name"))

register("leaderboard", O.with_ctes(["gold"], """
SELECT order_date, store_region, product_category, total_revenue FROM gold_daily
ORDER BY total_revenue DESC"""))(
    lambda spark, d: run(spark, d).table("gold_daily").select(
        "order_date", "store_region", "product_category", "total_revenue")
    .orderBy(F.col("total_revenue").desc()))

register("scalar_combine", O.with_ctes(["quarantine", "gold"], """
SELECT (SELECT count(*) FROM bronze) AS bronze_rows,
       (SELECT count(*) FROM quarantine) AS quarantined_rows,
       (SELECT count(*) FROM silver) AS silver_rows,
       (SELECT count(*) FROM gold_daily) AS gold_daily_rows"""))(
    lambda spark, d: (lambda r: r.table("gold_daily").agg(
        F.count(F.lit(1)).alias("gold_daily_rows")).select(
        r.bronze.agg(F.count(F.lit(1))).scalar().alias("bronze_rows"),
        r.table("quarantine").agg(F.count(F.lit(1))).scalar().alias("quarantined_rows"),
        r.table("silver").agg(F.count(F.lit(1))).scalar().alias("silver_rows"),
        "gold_daily_rows"))(run(spark, d)))

register("tile_status_over_time", O.with_ctes(["metrics"], f"""
SELECT h.hr AS check_hour, s.status, s.n AS check_count,
  {O.rnd("CAST(100.0 AS DOUBLE) * s.n / CAST(h.n AS DOUBLE)", 1)} AS pct_of_hour
FROM (SELECT date_trunc('hour', check_ts) AS hr, count(*) AS n FROM metrics GROUP BY 1) h
JOIN (SELECT date_trunc('hour', check_ts) AS hr, status, count(*) AS n FROM metrics GROUP BY 1, 2) s ON s.hr = h.hr"""))(
    lambda spark, d: TL.tile_status_over_time(run(spark, d).table("metrics")))

register("tile_failures_by_rule", O.with_ctes(["metrics"], f"""
SELECT layer, rule_name, count(*) AS total_checks,
  count(*) FILTER (WHERE status = 'FAIL') AS fail_count, count(*) FILTER (WHERE status = 'WARN') AS warn_count,
  sum(failure_count)::BIGINT AS total_failing_rows,
  {O.rnd("CAST(100.0 AS DOUBLE) * count(*) FILTER (WHERE status = 'FAIL') / count(*)", 1)} AS fail_pct
FROM metrics GROUP BY layer, rule_name"""))(
    lambda spark, d: TL.tile_failures_by_rule(run(spark, d).table("metrics")))

register("tile_freshness_trend", O.with_ctes(["metrics"], """
SELECT check_ts, table_name, metric_value AS lag_hours, threshold AS sla_hours, status
FROM metrics WHERE rule_name = 'freshness_sla'"""))(
    lambda spark, d: TL.tile_freshness_trend(run(spark, d).table("metrics")))

register("tile_quarantine_reasons", O.with_ctes(["quarantine"], f"""
SELECT '{S.table_name}' AS source_table, quarantine_reason, count(*) AS rows
FROM quarantine GROUP BY quarantine_reason"""))(
    lambda spark, d: TL.tile_quarantine_reasons(run(spark, d).table("quarantine"), S))

_KPI_COUNTS = ", ".join(f"(SELECT '{kpi}' AS kpi, count(*)::DOUBLE AS v FROM {t})" for kpi, t in (
    ("bronze_rows", "bronze"), ("silver_rows", "silver"), ("quarantined_rows", "quarantine"))).replace("), (", ") UNION ALL (")
register("tile_kpis", O.with_ctes(["quarantine", "metrics"], """
SELECT max(v) FILTER (WHERE kpi = 'bronze_rows')::BIGINT AS bronze_rows, max(v) FILTER (WHERE kpi = 'silver_rows')::BIGINT AS silver_rows,
  max(v) FILTER (WHERE kpi = 'quarantined_rows')::BIGINT AS quarantined_rows, max(v) FILTER (WHERE kpi = 'overall_pass_pct') AS overall_pass_pct
FROM counted""", extra=f"""counted AS ({_KPI_COUNTS} UNION ALL
  (SELECT 'overall_pass_pct', {O.rnd("CAST(100.0 AS DOUBLE) * sum(CASE WHEN status = 'PASS' THEN 1 ELSE 0 END) / count(*)", 1)} FROM metrics))"""))(
    lambda spark, d: (lambda r: TL.tile_kpis(r.bronze, r.table("silver"), r.table("quarantine"),
                                             r.table("metrics")))(run(spark, d)))

register("tile_latest_scorecard", O.with_ctes(["metrics"], f"""
SELECT layer, rule_name, column_name, status, failure_count, total_count, failure_rate
FROM metrics WHERE run_id IN (SELECT run_id FROM ({_LATEST}))"""))(
    lambda spark, d: TL.tile_latest_scorecard(run(spark, d).table("metrics"), with_detail=False))

register("tile_revenue", O.with_ctes(["gold"], """
SELECT store_region, product_category, total_revenue, order_count FROM gold_rc"""))(
    lambda spark, d: TL.tile_revenue(run(spark, d).table("gold_region_category")))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


from . import io_queries  # noqa: E402,F401  (registers the I/O, store, stream and injection queries)

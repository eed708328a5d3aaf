"""Registered queries for sources, sinks, stores, streams and injection.

Each one reads the driver's tables, writes what it has to under a fresh
folder of the shared checkpoint root, reads the result back and returns it.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.rules import rule_duplicate, rule_row_count
from ..operators import inject as INJ
from ..operators.merge import merge_actions
from ..operators.probe import column_drift_raw, with_trailing_avg
from ..session import scratch_dir
from ..sources.events import EPOCH, EVENTS, EVENTS_AS_OF, event_day, events, events_json
from ..sources.landing import (ingest_batch, read_landing, render_json, rescue_drift, stamp_lineage,
                               write_batch_files, write_jsonl)
from ..sources.store import Store, table_counts
from ..sources.testbind import SALES_NTZ, table
from ..streaming.ingest import gate_stream, ingest_once, ingest_stream
from .medallion import ensure_tables, ingest_once_batch
from . import oracle as O
from .registry import register, run
from .sales import drop_detail

E = EVENTS
RUN = "r1"
_EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _as_of():
    return F.lit(EVENTS_AS_OF).cast(E.ts_type)


def _typed_view(bronze: DataFrame, with_batch: bool = True, extra=()) -> DataFrame:
    """Bronze events with the time parsed and rescued keys as sorted text."""
    keys = F.array_join(F.array_sort(F.map_keys(
        F.from_json(F.col(E.rescue_col), "map<string,string>"))), ",")
    cols = [F.col(c) if c != "ts" else F.col("ts").try_cast(E.ts_type).alias("ts")
            for c in _EV_COLS]
    cols.append(keys.alias("rescued_keys"))
    cols += [F.col(c) for c in extra]
    if with_batch:
        cols.append(F.col(E.batch_col))
    return bronze.select(*cols)


def _landing(spark, d, drift=True) -> str:
    path = scratch_dir(spark, "landing")
    write_jsonl(events_json(spark, d, drift), path)
    return path


# --------------------------------------------------------------------------- #
# DuckDB: what the rescue of the drifted events must give
# --------------------------------------------------------------------------- #
def _ev(expr: str, null_modes=(9,)) -> str:
    modes = ", ".join(str(m) for m in null_modes)
    return f"CASE WHEN event_id % 10 IN ({modes}) THEN NULL ELSE {expr} END"


EV_RESCUED = f"""
SELECT {_ev('event_id')} AS event_id, {_ev('ts')} AS ts, {_ev('user_id')} AS user_id,
  {_ev('event_type')} AS event_type, {_ev('value', (5, 7, 9))} AS value, {_ev('props')} AS props,
  CASE event_id % 10 WHEN 3 THEN 'coupon' WHEN 5 THEN 'amount' WHEN 7 THEN 'value'
       WHEN 9 THEN '_corrupt_record' END AS rescued_keys"""
EV_DAY = "strftime(ts, '%Y-%m-%d')"

register("rescue_drift", f"{EV_RESCUED}, {EV_DAY} AS _batch_id FROM events")(
    lambda spark, d: _typed_view(rescue_drift(events_json(spark, d), E)))

register("ingest_batch", f"""{EV_RESCUED}, TIMESTAMP '{EVENTS_AS_OF}' AS _ingest_ts,
  '{RUN}' AS _batch_id FROM events""")(
    lambda spark, d: _typed_view(ingest_batch(spark, _landing(spark, d), E, RUN, _as_of()),
                                 extra=(E.ingest_col,)))


def _stamp(spark, d):
    raw = read_landing(spark, _landing(spark, d))
    out = stamp_lineage(rescue_drift(raw, E), E, RUN, _as_of())
    return out.select("event_id", E.ingest_col, E.batch_col,
                      F.col(E.source_col).contains("/landing-").alias("from_landing"))


register("stamp_lineage", f"""
SELECT {_ev('event_id')} AS event_id, TIMESTAMP '{EVENTS_AS_OF}' AS _ingest_ts,
  '{RUN}' AS _batch_id, true AS from_landing FROM events""")(_stamp)


def _ingest_stream(spark, d, twice=False):
    landing = _landing(spark, d)
    store = Store(spark, scratch_dir(spark, "store"))
    ckpt = scratch_dir(spark, "stream-ckpt")
    for _ in range(2 if twice else 1):
        if twice:
            ingest_once(spark, landing, store, E, RUN, EVENTS_AS_OF, ckpt)
        else:
            ingest_stream(spark, landing, store, E, RUN, EVENTS_AS_OF, ckpt).awaitTermination()
    return _typed_view(store.read("bronze"), with_batch=False, extra=(E.ingest_col,))


_EV_RESCUED_ONLY = f"{EV_RESCUED}, TIMESTAMP '{EVENTS_AS_OF}' AS {E.ingest_col} FROM events"
register("ingest_once", _EV_RESCUED_ONLY)(lambda spark, d: _ingest_stream(spark, d, twice=True))
register("ingest_stream", _EV_RESCUED_ONLY)(lambda spark, d: _ingest_stream(spark, d))


def _third(i: int):
    """The events of one third, by the id in the line (cut lines hold it too)."""
    return F.regexp_extract("value", r'"event_id":(\d+)', 1).cast("long") % 3 == i


def _ingest_once_batch(spark, d):
    """Two batch files, a run, a third file, a run, and a run without new files."""
    landing = scratch_dir(spark, "landing")
    store = Store(spark, scratch_dir(spark, "store"))
    lines = events_json(spark, d)
    for i in (0, 1):
        write_batch_files(lines.filter(_third(i)).coalesce(1), landing, "20240131", "events", first=i)
    ingest_once_batch(spark, landing, store, E, "r1", EVENTS_AS_OF)
    write_batch_files(lines.filter(_third(2)).coalesce(1), landing, "20240131", "events", first=2)
    ingest_once_batch(spark, landing, store, E, "r2", EVENTS_AS_OF)
    ingest_once_batch(spark, landing, store, E, "r3", EVENTS_AS_OF)
    return _typed_view(store.read("bronze"))


register("ingest_once_batch", f"""{EV_RESCUED}, CASE event_id % 3 WHEN 2 THEN 'r2' ELSE 'r1' END AS _batch_id FROM events""")(
    _ingest_once_batch)


def _write_jsonl(spark, d):
    """Two batches written under the generator's names, the second one sent twice."""
    landing = scratch_dir(spark, "landing")
    lines = events_json(spark, d, drift=False)
    half = F.regexp_extract("value", r'"event_id":(\d+)', 1).cast("long") % 2
    write_batch_files(lines.filter(half == 0).repartition(3), landing, "20240130")
    for parts in (4, 2):
        write_batch_files(lines.filter(half == 1).repartition(parts), landing, "20240131")
    schema = T.StructType([T.StructField(c, T.StringType() if c == "ts" else f.dataType)
                           for c, f in zip(_EV_COLS, E.contract.fields)])
    back = spark.read.schema(schema).json(landing)
    return back.withColumn("ts", F.col("ts").try_cast(E.ts_type)).withColumn(
        "batch", F.regexp_extract(F.col("_metadata.file_name"), r"^sales_(\d{8})_\d{3}\.json$", 1))


register("write_jsonl", """SELECT event_id, ts, user_id, event_type, value, props,
  CASE event_id % 2 WHEN 0 THEN '20240130' ELSE '20240131' END AS batch FROM events""")(_write_jsonl)


def _evolve(spark, d):
    """Old files lack ``coupon``; new files carry it; a mergeSchema read widens."""
    store = Store(spark, scratch_dir(spark, "store"))
    ev = events(spark, d)
    old = ev.filter(F.col("event_id") % 10 != 3).withColumn("_part", F.lit("a"))
    new = (ev.filter(F.col("event_id") % 10 == 3)
           .withColumn("coupon", F.concat(F.lit("C"), (F.col("event_id") % 7).cast("string")))
           .withColumn("_part", F.lit("b")))
    store.append_run("evolve", old, ("_part",))
    store.append_run("evolve", new, ("_part",), merge_schema=True)
    return store.read("evolve", merge_schema=True).drop("_part")


register("evolve_schema", """
SELECT event_id, ts, user_id, event_type, value, props,
  CASE WHEN event_id % 10 = 3 THEN 'C' || CAST(event_id % 7 AS VARCHAR) END AS coupon
FROM events""")(_evolve)


def _drift_json(spark, d):
    from .sales import arrays_as_text
    return arrays_as_text(column_drift_raw(events_json(spark, d), E))


_ALL = "['event_id', 'ts', 'user_id', 'event_type', 'value', 'props']"
register("column_drift_json", f"""
WITH keys AS (
  SELECT {EV_DAY} AS _batch_id, unnest(CASE event_id % 10
    WHEN 3 THEN list_append({_ALL}, 'coupon')
    WHEN 5 THEN ['event_id', 'ts', 'user_id', 'event_type', 'amount', 'props']
    WHEN 9 THEN []::VARCHAR[]
    ELSE {_ALL} END) AS k
  FROM events),
p AS (SELECT _batch_id, list_sort(list_distinct(list(k))) AS pl FROM keys GROUP BY _batch_id)
SELECT _batch_id, array_to_string(pl, ',') AS present,
  array_to_string(list_sort(list_filter(pl, lambda x: NOT list_contains({_ALL}, x))), ',') AS unexpected,
  array_to_string(list_sort(list_filter({_ALL}, lambda x: NOT list_contains(pl, x))), ',') AS missing
FROM p""")(_drift_json)

# --------------------------------------------------------------------------- #
# gate over a stream of events
# --------------------------------------------------------------------------- #
def _gate_stream(spark, d):
    """Three files, one micro-batch each, through all layers; the rows of silver, quarantine
    and log with the micro-batch that wrote them."""
    landing = scratch_dir(spark, "landing")
    store = Store(spark, scratch_dir(spark, "store"))
    lines, ckpt = events_json(spark, d), scratch_dir(spark, "gate-ckpt")
    for i in range(3):  # files are taken in the order in which they landed
        write_batch_files(lines.filter(_third(i)).coalesce(1), landing, "20240131", "events", first=i)
    gate_stream(spark, landing, store, E, RUN, EVENTS_AS_OF, ckpt, max_files=1).awaitTermination()
    return layer_rows(store)


def layer_rows(store: Store) -> DataFrame:
    """(layer, name, run_id, status, n, value) of an events gate's silver, quarantine and log."""
    none = F.lit(None)
    silver = store.read("silver").select(
        F.lit("silver").alias("layer"), F.col("event_id").cast("string").alias("name"), "run_id", F.col("event_type").alias("status"),
        F.when(F.col("is_late"), 1).otherwise(0).cast("bigint").alias("n"), F.col("value").alias("value"))
    bad = store.read("quarantine").groupBy("run_id", "quarantine_reason").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("quarantine").alias("layer"), F.col("quarantine_reason").alias("name"), "run_id", none.cast("string").alias("status"), "n", none.cast("double").alias("value"))
    log = store.read("metrics").select(
        F.concat_ws("/", F.lit("log"), "layer").alias("layer"), F.concat_ws("/", "rule_name", "column_name").alias("name"), "run_id", "status",
        F.col("failure_count").alias("n"), F.col("metric_value").alias("value"))
    return silver.unionByName(bad).unionByName(log)


_EV_NOT_CUT = "eid % 10 <> 9"
_AS_OF_SQL = f"TIMESTAMP '{EVENTS_AS_OF}'"


def gate_log_sql(runs: list[str], run_of: str) -> str:
    """CTEs ``ev``, ``p0``, ``probe`` and ``log``: the log of a gate over the drifted events,
    ``run_of`` giving the run of an event; runs without events are logged too."""
    listed = ", ".join(f"('{r}')" for r in runs)
    return f"""
runs(_batch_id) AS (VALUES {listed}),
ev AS (
  SELECT event_id AS eid, {run_of} AS _batch_id, {_ev('event_id')} AS event_id, {_ev('ts')} AS ts, {_ev('user_id')} AS user_id,
    {_ev('event_type')} AS event_type, {_ev('value', (5, 7, 9))} AS value
  FROM events),
p0 AS (
  SELECT r._batch_id, count(eid) AS total,
    {', '.join(f"count(*) FILTER (WHERE eid IS NOT NULL AND {c} IS NULL) AS null_{c}" for c in E.required)},
    count(*) FILTER (WHERE eid % 10 IN (3, 5, 7, 9)) AS rescued,
    count(DISTINCT event_id) AS distinct_keys,
    count(*) FILTER (WHERE ts IS NOT NULL AND {_AS_OF_SQL} > ts + INTERVAL 24 HOURS) AS late,
    max(ts) AS max_event_ts,
    CAST(count(*) FILTER (WHERE eid % 10 = 3) > 0 AS INTEGER) + CAST(count(*) FILTER (WHERE eid % 10 = 5) > 0 AS INTEGER) AS n_unexpected,
    CASE WHEN count(eid) = 0 THEN 0 ELSE 5 * CAST(count(*) FILTER (WHERE {_EV_NOT_CUT}) = 0 AS INTEGER)
      + CAST(count(*) FILTER (WHERE eid % 10 NOT IN (5, 9)) = 0 AS INTEGER) END AS n_missing
  FROM runs r LEFT JOIN ev ON ev._batch_id = r._batch_id GROUP BY r._batch_id),
probe AS (
  SELECT *, {_AS_OF_SQL} AS check_ts, {O.lag_sql('max_event_ts', _AS_OF_SQL)} AS lag_hours,
    avg(CAST(total AS DOUBLE)) OVER (ORDER BY _batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS trailing_avg
  FROM p0),
good AS (
  SELECT r._batch_id, max(ts) AS newest FROM runs r LEFT JOIN ev ON ev._batch_id <= r._batch_id AND eid % 10 IN (0, 1, 2, 4, 6, 8) GROUP BY r._batch_id),
log AS (
{chr(10).join(('UNION ALL ' if i else '') + r for i, r in enumerate(O.bronze_metric_rows(E, 'probe')))}
UNION ALL SELECT _batch_id, {_AS_OF_SQL}, 'silver', '{E.silver_table}', 'freshness_sla', '{E.event_col}',
  CASE WHEN coalesce({O.lag_sql('newest', _AS_OF_SQL)}, 1e9) > {E.freshness_sla_hours} THEN 'FAIL' ELSE 'PASS' END, 0, 0, 0.0,
  {O.rnd(f"coalesce({O.lag_sql('newest', _AS_OF_SQL)}, 1e9)", 3)}, {E.freshness_sla_hours} FROM good)"""


_MICRO = "printf('r1-%06d', CAST(event_id % 3 AS INTEGER))"
_LAYERS_SQL = f"""
SELECT 'silver' AS layer, CAST(eid AS VARCHAR) AS name, _batch_id AS run_id, upper(coalesce(event_type, 'UNKNOWN')) AS status,
  CASE WHEN {_AS_OF_SQL} > ts + INTERVAL 24 HOURS THEN 1 ELSE 0 END AS n, value FROM ev WHERE eid % 10 IN (0, 1, 2, 4, 6, 8)
UNION ALL SELECT 'quarantine', CASE WHEN eid % 10 = 9 THEN 'null_event_id; bad_ts; null_user_id; null_event_type; schema_drift' ELSE 'schema_drift' END,
  _batch_id, NULL, count(*), NULL FROM ev WHERE eid % 10 IN (3, 5, 7, 9) GROUP BY ALL
UNION ALL SELECT 'log/' || layer, rule_name || coalesce('/' || column_name, ''), run_id, status, failure_count, metric_value FROM log"""
register("gate_stream", f"WITH {gate_log_sql([f'r1-{i:06d}' for i in range(3)], _MICRO)} {_LAYERS_SQL}")(_gate_stream)

# --------------------------------------------------------------------------- #
# stores: per-run append, upsert, replace, ensure, counts
# --------------------------------------------------------------------------- #
S = SALES_NTZ


def _append_metrics(spark, d):
    """The log run by run, some runs again, compacted, read day by day."""
    store = Store(spark, scratch_dir(spark, "store"), compact_after=4)
    m = run(spark, d).table("metrics")
    for i in ("0", "1", "2", "3", "4", "3"):
        store.append_log("metrics", m.filter(F.col("run_id") == i))  # a rerun replaces, never doubles
    days = m.select(F.date_format(F.min("check_ts"), "yyyy-MM-dd").alias("a"), F.date_format(F.max("check_ts"), "yyyy-MM-dd").alias("b")).first()
    return drop_detail(store.read("metrics", where=F.col("_day").between(days.a, days.b)))


register("append_metrics", O.with_ctes(["metrics"], "SELECT * FROM metrics"))(_append_metrics)


def _append_quarantine(spark, d):
    store = Store(spark, scratch_dir(spark, "store"))
    q = run(spark, d).quarantine
    store.append_run("quarantine", q, ("run_id",))
    store.append_run("quarantine", q, ("run_id",))
    return store.read("quarantine")


register("append_quarantine", O.with_ctes(["quarantine"], "SELECT * FROM quarantine"))(
    _append_quarantine)

LAST = "4"


def _merge_frames(spark, d):
    """target = silver of runs 0-3; source = run 4 (inserts) + run 3 re-sent
    with a changed amount by a later run (updates)."""
    silver = run(spark, d).table("silver")          # the stored silver layer
    tgt = silver.filter(F.col("run_id") != LAST)
    resent = (silver.filter(F.col("run_id") == "3")
              .withColumn("total_amount", F.col("total_amount") + 1.0)
              .withColumn("run_id", F.lit("u")))
    src = silver.filter(F.col("run_id") == LAST).unionByName(resent)
    return tgt, src


def _upsert(spark, d):
    store = Store(spark, scratch_dir(spark, "store"), buckets=16)
    tgt, src = _merge_frames(spark, d)
    store.upsert("silver", tgt, S.key)
    store.upsert("silver", src, S.key)
    return store.read("silver")


_MERGE_SRC = f"""
  tgt AS (SELECT * FROM silver WHERE run_id <> '{LAST}'),
  src AS (SELECT * FROM silver WHERE run_id = '{LAST}'
          UNION ALL
          SELECT * REPLACE (total_amount + 1.0 AS total_amount, 'u' AS run_id)
          FROM silver WHERE run_id = '3')"""

register("upsert_silver", O.with_ctes(["silver"], """
SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.order_id = tgt.order_id)
UNION ALL SELECT * FROM src""", extra=_MERGE_SRC))(_upsert)


def _merge_join(spark, d):
    """The upsert's source and run 2 sent again as it is, against the target, in one join."""
    tgt, src = _merge_frames(spark, d)
    return merge_actions(tgt, src.unionByName(tgt.filter(F.col("run_id") == "2")), S.key).select(S.key, "run_id", "action")


register("merge_join", O.with_ctes(["silver"], """
SELECT s.order_id, s.run_id, CASE WHEN t.order_id IS NULL THEN 'insert' WHEN s = t THEN 'unchanged' ELSE 'update' END AS action
FROM (SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE run_id = '2') s LEFT JOIN tgt t ON s.order_id = t.order_id""", extra=_MERGE_SRC))(_merge_join)


def _append_silver(spark, d):
    store = Store(spark, scratch_dir(spark, "store"))
    store.append("silver", run(spark, d).silver)
    return store.read("silver")


register("append_silver", O.with_ctes(["silver"], "SELECT * FROM silver"))(_append_silver)


def _replace_gold(spark, d):
    store = Store(spark, scratch_dir(spark, "store"))
    r = run(spark, d)
    store.replace("gold_region_category", r.gold_rc)
    store.replace("gold_region_category", r.gold_rc)
    return store.read("gold_region_category")


register("replace_gold", O.with_ctes(["gold"], "SELECT * FROM gold_rc"))(_replace_gold)


def _ensure(spark, d):
    """Names and types of the gate's tables as they read back, and their rows: declared,
    one of them written to, declared again."""
    store = Store(spark, scratch_dir(spark, "store"))
    names = ensure_tables(store, S)
    store.append_run("bronze", run(spark, d).bronze, (S.batch_col,))
    ensure_tables(store, S)                       # already there: a no-op
    parts = []
    for name in names:
        df = store.read(name)
        cols = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type")) for f in df.schema.fields])
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count", F.inline(cols)))
    return reduce(DataFrame.unionByName, parts)


# The tables' columns and types, as the contract of the layers states them.
_TABLE_COLUMNS = {
    "bronze": """order_id string, customer_id string, product_id string, product_category string, quantity bigint, unit_price double,
      total_amount double, currency string, payment_method string, store_region string, order_status string, order_ts string,
      _rescued_data string, _source_file string, _ingest_ts timestamp_ntz, _batch_id string""",
    "quarantine": """order_id string, customer_id string, unit_price double, total_amount double, order_ts string, _rescued_data string,
      _source_file string, _batch_id string, quarantine_reason string, run_id string, quarantine_ts timestamp_ntz""",
    "silver": """order_id string, customer_id string, product_id string, product_category string, quantity bigint, unit_price double,
      total_amount double, currency string, payment_method string, store_region string, order_status string, order_ts timestamp_ntz,
      order_date date, is_late boolean, _ingest_ts timestamp_ntz, run_id string""",
    "metrics": """run_id string, check_ts timestamp_ntz, layer string, table_name string, rule_name string, column_name string,
      status string, failure_count bigint, total_count bigint, failure_rate double, metric_value double, threshold double, detail string""",
    "gold_daily": """order_date date, store_region string, product_category string, order_count bigint, total_units bigint,
      total_revenue double, avg_order_value double, refreshed_ts timestamp_ntz""",
    "gold_region_category": """store_region string, product_category string, order_count bigint, total_revenue double,
      revenue_per_customer double, refreshed_ts timestamp_ntz""",
}
_COLUMN_ROWS = ", ".join(f"('{t}', '{c.split()[0]}', '{c.split()[1]}')" for t, cs in _TABLE_COLUMNS.items() for c in cs.split(","))
register("ensure_tables", O.with_ctes(["bronze"], f"""
SELECT table_name, column_name, data_type, CASE table_name WHEN 'bronze' THEN (SELECT count(*) FROM bronze) ELSE 0 END AS row_count
FROM (VALUES {_COLUMN_ROWS}) AS v(table_name, column_name, data_type)"""))(_ensure)


def _table_counts(spark, d):
    r = run(spark, d)
    t = r.table
    return table_counts({"bronze_sales": r.bronze, "bronze_sales_quarantine": t("quarantine"),
                         "silver_sales": t("silver"), "gold_daily_sales": t("gold_daily"),
                         "gold_region_category": t("gold_region_category"),
                         "data_quality_metrics": t("metrics")})


register("table_counts", O.with_ctes(["quarantine", "metrics", "gold"], """
SELECT 'bronze_sales' AS table_name, count(*) AS row_count FROM bronze
UNION ALL SELECT 'bronze_sales_quarantine', count(*) FROM quarantine
UNION ALL SELECT 'silver_sales', count(*) FROM silver
UNION ALL SELECT 'gold_daily_sales', count(*) FROM gold_daily
UNION ALL SELECT 'gold_region_category', count(*) FROM gold_rc
UNION ALL SELECT 'data_quality_metrics', count(*) FROM metrics"""))(_table_counts)

# --------------------------------------------------------------------------- #
# rules on other tables: history row count (events per day), duplicate text
# --------------------------------------------------------------------------- #
HIST_DEV = 0.05


def _row_count_history(spark, d):
    spec = E.with_(rowcount_deviation=HIST_DEV)
    b = events(spark, d).withColumn(E.batch_col, event_day())
    probe = with_trailing_avg(b.groupBy(E.batch_col).agg(F.count(F.lit(1)).alias("total")),
                              E.batch_col)
    rule = rule_row_count(F.col("total"), F.col("trailing_avg"), spec.rowcount_deviation)
    return (probe.select(F.col(E.batch_col).alias("run_id"), F.inline(F.array(rule)))
            .drop("detail"))


register("rule_row_count", f"""
WITH p AS (
  SELECT {EV_DAY} AS run_id, count(*) AS total FROM events GROUP BY 1),
h AS (
  SELECT *, avg(CAST(total AS DOUBLE)) OVER (ORDER BY run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS trailing_avg FROM p)
SELECT run_id, 'row_count_anomaly' AS rule_name, CAST(NULL AS VARCHAR) AS column_name,
  CASE WHEN trailing_avg IS NULL OR trailing_avg = 0 THEN 'PASS' WHEN total = 0 THEN 'FAIL'
       WHEN total < trailing_avg * {1 - HIST_DEV} OR total > trailing_avg * {1 + HIST_DEV} THEN 'WARN'
       ELSE 'PASS' END AS status,
  CAST(0 AS BIGINT) AS failure_count, total AS total_count, CAST(0 AS DOUBLE) AS failure_rate,
  CAST(total AS DOUBLE) AS metric_value, coalesce(trailing_avg, 0) AS threshold
FROM h""")(_row_count_history)


def _duplicate_text(spark, d):
    """The same duplicate rule on another table: documents by language, key =
    the whole text (compared through its SHA-256, so the shuffle carries 32
    bytes per row instead of the document)."""
    docs = table(spark, d, "documents")
    agg = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("total"),
                                   F.count_distinct(F.sha2(F.col("text"), 256)).alias("distinct"))
    rule = rule_duplicate("text", F.col("total"), F.col("distinct"), 0)
    return agg.select("lang", F.inline(F.array(rule))).drop("detail")


register("duplicate_text", f"""
SELECT lang, 'duplicate' AS rule_name, 'text' AS column_name,
  CASE WHEN greatest(total - n, 0) > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
  CAST(greatest(total - n, 0) AS BIGINT) AS failure_count, total AS total_count,
  {O.rnd(O.rate_sql('greatest(total - n, 0)', 'total'), 4)} AS failure_rate,
  CAST(greatest(total - n, 0) AS DOUBLE) AS metric_value, CAST(0 AS DOUBLE) AS threshold
FROM (SELECT lang, count(*) AS total, count(DISTINCT text) AS n FROM documents GROUP BY lang)""")(
    _duplicate_text)

# --------------------------------------------------------------------------- #
# 2.13 injection
# --------------------------------------------------------------------------- #
RATE = 0.5
_NULL_COLS = ["o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _roll_sql(id_col: str, a: int = 7919, b: int = 13) -> str:
    return f"(({id_col} * {a} + {b}) % 1000)"


register("inject_nulls", f"""
SELECT o_orderkey,
  {', '.join(f"CASE WHEN {_roll_sql('o_orderkey')} < {INJ.per_mille(INJ.NULL_SHARE * RATE)} AND o_orderkey % {len(_NULL_COLS)} = {i} THEN NULL ELSE {c} END AS {c}" for i, c in enumerate(_NULL_COLS))},
  CASE WHEN {_roll_sql('o_orderkey')} < {INJ.per_mille(INJ.NULL_SHARE * RATE)}
       THEN CASE WHEN (o_orderkey // {len(_NULL_COLS)}) % 2 = 0 THEN 'null' ELSE 'missing' END END AS _null_style
FROM orders""")(
    lambda spark, d: INJ.inject_nulls(table(spark, d, "orders"), "o_orderkey", _NULL_COLS, RATE)
    .select("o_orderkey", *_NULL_COLS, "_null_style"))

_LATE_LO = INJ.per_mille(INJ.NULL_SHARE * RATE)
_LATE_HI = INJ.per_mille((INJ.NULL_SHARE + INJ.LATE_SHARE) * RATE)
_LATE_HIT = f"({_roll_sql('event_id')} >= {_LATE_LO} AND {_roll_sql('event_id')} < {_LATE_HI})"
_LATE_TS = (f"TIMESTAMP '{EVENTS_AS_OF}' - to_days(CAST(event_id % 29 + 2 AS INTEGER)) "
            f"- to_minutes(CAST(event_id % 1441 AS BIGINT))")

register("inject_late", f"""
SELECT event_id, CASE WHEN {_LATE_HIT} THEN {_LATE_TS} ELSE ts END AS ts, {_LATE_HIT} AS _late
FROM events""")(
    lambda spark, d: INJ.inject_late(events(spark, d), "event_id", "ts", _as_of(), RATE)
    .select("event_id", "ts", "_late"))

_BNUM = f"date_diff('day', DATE '{EPOCH}', CAST(ts AS DATE))"
_DRIFT = (f"CASE WHEN ({_BNUM} * 7919 + 13) % 1000 < {INJ.per_mille(RATE)} "
          f"THEN ['extra', 'missing', 'renamed'][{_BNUM} % 3 + 1] END")


def _batch_num():
    return F.datediff(F.to_date(F.col("ts")), F.to_date(F.lit(EPOCH)))


def _inject_drift(spark, d):
    ev = events(spark, d).withColumn("_batch_id", event_day())
    out = INJ.inject_drift(ev, _batch_num(), RATE)
    out = INJ.apply_drift(out, {"coupon": F.concat(F.lit("C"), (F.col("event_id") % 7)
                                                   .cast("string"))}, ["props"],
                          {"value": "amount"})
    return out.select("event_id", "_batch_id", "_drift", "value", "props", "coupon", "amount")


register("inject_drift", f"""
WITH x AS (SELECT *, {_DRIFT} AS _drift FROM events)
SELECT event_id, {EV_DAY} AS _batch_id, _drift,
  CASE WHEN _drift IS NULL OR _drift <> 'renamed' THEN value END AS value,
  CASE WHEN _drift IS NULL OR _drift <> 'missing' THEN props END AS props,
  CASE WHEN _drift = 'extra' THEN 'C' || CAST(event_id % 7 AS VARCHAR) END AS coupon,
  CASE WHEN _drift = 'renamed' THEN value END AS amount
FROM x""")(_inject_drift)

_DUP_HIT = f"({_roll_sql('o_orderkey', 104729, 7)} < {INJ.per_mille(INJ.DUP_SHARE * RATE)})"

register("inject_duplicates", f"""
SELECT o_orderkey, o_custkey, CAST(unnest(generate_series(1, CASE WHEN {_DUP_HIT} THEN 2 ELSE 1 END)) AS INTEGER) AS _copy,
  {_DUP_HIT} AS _dup
FROM orders""")(
    lambda spark, d: INJ.inject_duplicates(table(spark, d, "orders").select("o_orderkey", "o_custkey"),
                                           "o_orderkey", RATE))

_EV_NULL_COLS = ["user_id", "event_type", "value"]


def _injected_events(spark, d):
    ev = (events(spark, d).withColumn("_batch_id", event_day())
          .withColumn("_batch_num", _batch_num()))
    return INJ.inject_batch(ev, "event_id", "ts", F.col("_batch_num"), _as_of(), RATE,
                            _EV_NULL_COLS)


_NULL_HIT = f"({_roll_sql('event_id')} < {INJ.per_mille(INJ.NULL_SHARE * RATE)})"
_DUP_HIT_EV = f"({_roll_sql('event_id', 104729, 7)} < {INJ.per_mille(INJ.DUP_SHARE * RATE)})"

register("injection_stats", f"""
WITH x AS (SELECT {EV_DAY} AS _batch_id, {_NULL_HIT} AS n, {_LATE_HIT} AS l, {_DRIFT} AS dr,
                  {_DUP_HIT_EV} AS dup FROM events)
SELECT _batch_id, CAST(sum(CASE WHEN dup THEN 2 ELSE 1 END) AS BIGINT) AS rows,
  CAST(count_if(n) AS BIGINT) AS nulls, CAST(count_if(l) AS BIGINT) AS late, CAST(count_if(dup) AS BIGINT) AS duplicates,
  CAST(count_if(dr IS NOT NULL) AS BIGINT) AS schema_drift, CAST(count_if(NOT n AND NOT l) AS BIGINT) AS clean
FROM x GROUP BY _batch_id""")(
    lambda spark, d: INJ.injection_stats(_injected_events(spark, d), "_batch_id"))


def _inject_batch(spark, d):
    """The injected events rendered as JSON lines (missing vs explicit null kept)."""
    x = INJ.apply_drift(_injected_events(spark, d),
                        {"coupon": F.concat(F.lit("C"), (F.col("event_id") % 7).cast("string"))},
                        ["props"], {"value": "amount"})
    names = _EV_COLS + ["coupon", "amount"]
    cols = [F.col(c).cast("string").alias(c) if c == "ts" else F.col(c) for c in names]
    # a key is written when it has a value, or when it was nulled "explicitly"
    present = {c: F.col(c).isNotNull() | ((F.col("_null_col") == c)
                                          & (F.col("_null_style") == "null")) for c in names}
    return render_json(x, cols, present=present, keep=("_batch_id",))


def _inject_batch_json(spark, d):
    """The lines parsed back: sorted keys (a missing key and an explicit null differ there)
    and typed values."""
    m = F.from_json("value", "map<string,string>")
    kinds = {"event_id": "bigint", "ts": E.ts_type, "user_id": "bigint", "value": "double", "amount": "double"}
    return _inject_batch(spark, d).select("_batch_id", m.alias("m")).select(
        "_batch_id", F.array_join(F.array_sort(F.map_keys("m")), ",").alias("keys"),
        *[F.col("m")[c].try_cast(kinds.get(c, "string")).alias(c) for c in [*_EV_COLS, "coupon", "amount"]])


_INJ_COLS = ["event_id", "_batch_id", "_copy", "_dup", "_null_style", "_null_col", "_late",
             "_drift", "ts", "user_id", "event_type", "value", "props", "coupon", "amount"]


def _inject_batch_typed(spark, d):
    """The composed injection (nulls / late -> drift -> duplicates) as typed rows."""
    x = INJ.apply_drift(_injected_events(spark, d),
                        {"coupon": F.concat(F.lit("C"), (F.col("event_id") % 7).cast("string"))},
                        ["props"], {"value": "amount"})
    return x.select(*_INJ_COLS)


_PICK = f"event_id % {len(_EV_NULL_COLS)}"
_NULLED = {c: f"CASE WHEN {_NULL_HIT} AND {_PICK} = {i} THEN NULL ELSE {c} END"
           for i, c in enumerate(_EV_NULL_COLS)}
_NULL_COL_LIST = "[" + ", ".join(f"'{c}'" for c in _EV_NULL_COLS) + "]"

_INJECTED = f"""
WITH n AS (
  SELECT event_id, {EV_DAY} AS _batch_id, {_BNUM} AS bn,
    CASE WHEN {_NULL_HIT} THEN CASE WHEN (event_id // {len(_EV_NULL_COLS)}) % 2 = 0 THEN 'null' ELSE 'missing' END END AS _null_style,
    CASE WHEN {_NULL_HIT} THEN {_NULL_COL_LIST}[{_PICK} + 1] END AS _null_col,
    {_NULLED['user_id']} AS user_id, {_NULLED['event_type']} AS event_type,
    {_NULLED['value']} AS value, props,
    CASE WHEN {_LATE_HIT} THEN {_LATE_TS} ELSE ts END AS ts, {_LATE_HIT} AS _late,
    {_DUP_HIT_EV} AS _dup
  FROM events),
d AS (SELECT *, CASE WHEN (bn * 7919 + 13) % 1000 < {INJ.per_mille(RATE)}
                THEN ['extra', 'missing', 'renamed'][bn % 3 + 1] END AS _drift FROM n),
x AS (SELECT *, CAST(unnest(generate_series(1, CASE WHEN _dup THEN 2 ELSE 1 END)) AS INTEGER) AS _copy FROM d),
injected AS (
SELECT event_id, _batch_id, _copy, _dup, _null_style, _null_col, _late, _drift, ts, user_id, event_type,
  CASE WHEN _drift IS NULL OR _drift <> 'renamed' THEN value END AS value,
  CASE WHEN _drift IS NULL OR _drift <> 'missing' THEN props END AS props,
  CASE WHEN _drift = 'extra' THEN 'C' || CAST(event_id % 7 AS VARCHAR) END AS coupon,
  CASE WHEN _drift = 'renamed' THEN value END AS amount
FROM x)"""
register("inject_batch", f"{_INJECTED} SELECT * FROM injected")(_inject_batch_typed)

_WRITTEN = ", ".join(f"CASE WHEN {c} IS NOT NULL OR (_null_col = '{c}' AND _null_style = 'null') THEN '{c}' END"
                     for c in sorted([*_EV_COLS, "coupon", "amount"]))
register("inject_batch_json", f"""{_INJECTED}
SELECT _batch_id, array_to_string(list_filter([{_WRITTEN}], lambda k: k IS NOT NULL), ',') AS keys,
  {', '.join(_EV_COLS)}, coupon, amount FROM injected""")(_inject_batch_json)


# --------------------------------------------------------------------------- #
# the whole gate, one run over a landing of events
# --------------------------------------------------------------------------- #
def _run_gate(spark, d, runs=(RUN,)):
    """One run after the other over the same landing; what each layer holds and logged."""
    from .medallion import run_gate
    store = Store(spark, scratch_dir(spark, "store"))
    landing = _landing(spark, d)
    for r in runs:
        counts = run_gate(spark, landing, store, E, r, EVENTS_AS_OF)
    none = F.lit(None)
    return layer_rows(store).unionByName(counts.select(
        F.lit("table").alias("layer"), F.col("table_name").alias("name"), none.cast("string").alias("run_id"),
        none.cast("string").alias("status"), F.col("row_count").alias("n"), none.cast("double").alias("value")))


def _run_gate_sql(runs: list[str]) -> str:
    return f"""
WITH {gate_log_sql(runs, "'r1'")}
{_LAYERS_SQL}
UNION ALL SELECT 'table', 'bronze', NULL, NULL, count(*), NULL FROM ev
UNION ALL SELECT 'table', 'quarantine', NULL, NULL, count(*), NULL FROM ev WHERE eid % 10 IN (3, 5, 7, 9)
UNION ALL SELECT 'table', 'silver', NULL, NULL, count(*), NULL FROM ev WHERE eid % 10 IN (0, 1, 2, 4, 6, 8)
UNION ALL SELECT 'table', 'metrics', NULL, NULL, count(*), NULL FROM log"""


register("run_gate", _run_gate_sql([RUN]))(_run_gate)
# a second run finds no new file: it is logged, and nothing else changes
register("run_gate_again", _run_gate_sql([RUN, "r2"]))(lambda spark, d: _run_gate(spark, d, (RUN, "r2")))


def _evolving_lines(spark, d):
    """The drifted events, some with ``Coupon`` for ``coupon``, some with keys that are
    named like a lineage column or a contract key in upper case."""
    lines, id_ = events_json(spark, d), F.regexp_extract("value", r'"event_id":(\d+)', 1).cast("long")
    text = (F.when(id_ % 30 == 13, F.replace("value", F.lit('"coupon"'), F.lit('"Coupon"')))
            .when(id_ % 10 == 1, F.regexp_replace("value", r"^\{", '{"_batch_id":"x","USER_ID":"y",')).otherwise(F.col("value")))
    return lines.withColumn("value", text)


def _evolve_ingest(spark, d):
    """drift='evolve' through a run: coupon / amount become columns, also written
    otherwise, the mistyped value, the cut lines and the reserved names are rescued."""
    store = Store(spark, scratch_dir(spark, "store"))
    landing = write_jsonl(_evolving_lines(spark, d), scratch_dir(spark, "landing"))
    ingest_once_batch(spark, landing, store, E, RUN, EVENTS_AS_OF, drift="evolve")
    return _typed_view(store.read("bronze").withColumn("_more", F.to_json("_more")), with_batch=False,
                       extra=("coupon", "amount", "_more"))


register("evolve_ingest", f"""
SELECT {_ev('event_id')} AS event_id, {_ev('ts')} AS ts, {_ev('user_id')} AS user_id,
  {_ev('event_type')} AS event_type, {_ev('value', (5, 7, 9))} AS value, {_ev('props')} AS props,
  CASE event_id % 10 WHEN 1 THEN 'USER_ID,_batch_id' WHEN 7 THEN 'value' WHEN 9 THEN '_corrupt_record' END AS rescued_keys,
  CASE WHEN event_id % 10 = 3 THEN 'C' || CAST(event_id % 7 AS VARCHAR) END AS coupon,
  CASE WHEN event_id % 10 = 5 THEN CAST(value AS VARCHAR) END AS amount, CAST(NULL AS VARCHAR) AS _more
FROM events""")(_evolve_ingest)


def _inject_drift_sales(spark, d):
    b = run(spark, d).bronze
    x = INJ.inject_drift(b, F.col("_batch_id").cast("int"), 1.0)
    return INJ.sales_drift(x).select(
        "order_id", "_batch_id", "_drift", "discount_code", "loyalty_tier", "store_region",
        "payment_method", "unit_price", "price", "product_category", "category")


def _pick(values, col="quantity"):
    arr = "[" + ", ".join(f"'{v}'" for v in values) + "]"
    return f"{arr}[{col} % {len(values)} + 1]"


register("inject_drift_sales", O.with_ctes(["bronze"], f"""
SELECT order_id, _batch_id, _drift,
  CASE WHEN _drift = 'extra' THEN {_pick(INJ.SALES_DISCOUNT_CODES)} END AS discount_code,
  CASE WHEN _drift = 'extra' THEN {_pick(INJ.SALES_LOYALTY_TIERS)} END AS loyalty_tier,
  CASE WHEN _drift = 'missing' THEN NULL ELSE store_region END AS store_region,
  CASE WHEN _drift = 'missing' THEN NULL ELSE payment_method END AS payment_method,
  CASE WHEN _drift = 'renamed' THEN NULL ELSE unit_price END AS unit_price,
  CASE WHEN _drift = 'renamed' THEN unit_price END AS price,
  CASE WHEN _drift = 'renamed' THEN NULL ELSE product_category END AS product_category,
  CASE WHEN _drift = 'renamed' THEN product_category END AS category
FROM (SELECT *, CASE WHEN (CAST(_batch_id AS INTEGER) * 7919 + 13) % 1000 < 1000
                THEN ['extra', 'missing', 'renamed'][CAST(_batch_id AS INTEGER) % 3 + 1] END AS _drift
      FROM bronze)""", ))(_inject_drift_sales)


# --------------------------------------------------------------------------- #
# every rule over another table: the rescued events, one batch per day
# --------------------------------------------------------------------------- #
def _evaluate_events(spark, d):
    from ..operators.evaluate import evaluate_all
    from ..operators.probe import bronze_probe
    raw = events_json(spark, d)
    bronze = rescue_drift(raw, E).withColumn(E.ingest_col, _as_of())
    probe = (bronze_probe(bronze, E, _as_of(), with_drift=False)
             .join(column_drift_raw(raw, E), E.batch_col, "left"))
    return drop_detail(evaluate_all(with_trailing_avg(probe, ["check_ts", E.batch_col]), E))


register("evaluate_all_events", f"""
WITH ev AS (
  SELECT event_id AS eid, {EV_DAY} AS _batch_id,
    {_ev('event_id')} AS event_id, {_ev('ts')} AS ts, {_ev('user_id')} AS user_id,
    {_ev('event_type')} AS event_type
  FROM events),
p0 AS (
  SELECT _batch_id, count(*) AS total,
    {', '.join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in E.required)},
    count(*) FILTER (WHERE eid % 10 IN (3, 5, 7, 9)) AS rescued,
    count(DISTINCT event_id) AS distinct_keys,
    count(*) FILTER (WHERE ts IS NOT NULL
                     AND TIMESTAMP '{EVENTS_AS_OF}' > ts + INTERVAL 24 HOURS) AS late,
    max(ts) AS max_event_ts,
    CAST(count(*) FILTER (WHERE eid % 10 = 3) > 0 AS INTEGER)
      + CAST(count(*) FILTER (WHERE eid % 10 = 5) > 0 AS INTEGER) AS n_unexpected,
    5 * CAST(count(*) FILTER (WHERE {_EV_NOT_CUT}) = 0 AS INTEGER)
      + CAST(count(*) FILTER (WHERE eid % 10 NOT IN (5, 9)) = 0 AS INTEGER) AS n_missing
  FROM ev GROUP BY _batch_id),
probe AS (
  SELECT *, TIMESTAMP '{EVENTS_AS_OF}' AS check_ts,
    {O.lag_sql('max_event_ts', f"TIMESTAMP '{EVENTS_AS_OF}'")} AS lag_hours,
    avg(CAST(total AS DOUBLE)) OVER (ORDER BY _batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS trailing_avg
  FROM p0)
{chr(10).join(('UNION ALL ' if i else '') + r for i, r in enumerate(O.bronze_metric_rows(E, 'probe')))}""")(
    _evaluate_events)

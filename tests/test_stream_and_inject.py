"""Streaming = batch, ingest once, and the injection transforms."""
import json

from pyspark.sql import functions as F

from conftest import SF0001
from gatekit.operators import inject as INJ
from gatekit.session import scratch_dir
from gatekit.sources.events import EVENTS, events, events_json
from gatekit.sources.landing import ingest_batch, render_json, write_jsonl
from gatekit.sources.store import Store
from gatekit.streaming.ingest import ingest_once, ingest_stream

AS_OF = "2024-01-31 00:00:00"
COLS = ["event_id", "ts", "user_id", "event_type", "value", "props", "_rescued_data",
        "_ingest_ts"]


def _rows(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


def test_stream_equals_batch_and_ingests_once(spark):
    landing = write_jsonl(events_json(spark, SF0001), scratch_dir(spark, "t-landing"))
    batch = ingest_batch(spark, landing, EVENTS, "r", F.lit(AS_OF).cast("timestamp_ntz"))
    st = Store(spark, scratch_dir(spark, "t-store"))
    ckpt = scratch_dir(spark, "t-ckpt")
    ingest_stream(spark, landing, st, EVENTS, "r", AS_OF, ckpt, max_files=2).awaitTermination()
    assert _rows(st.read("bronze")) == _rows(batch)
    n = st.read("bronze").count()
    ingest_once(spark, landing, st, EVENTS, "r", AS_OF, ckpt)       # nothing new landed
    assert st.read("bronze").count() == n


def _injected(spark, rate):
    ev = events(spark, SF0001).withColumn("_b", F.datediff(F.to_date("ts"), F.lit("2024-01-01")))
    return INJ.inject_batch(ev, "event_id", "ts", F.col("_b"),
                            F.lit(AS_OF).cast("timestamp_ntz"), rate,
                            ["user_id", "event_type", "value"])


def test_rate_zero_is_identity(spark):
    x = _injected(spark, 0.0)
    src = events(spark, SF0001)
    assert x.count() == src.count()
    assert x.filter(F.col("_null_style").isNotNull() | F.col("_late") | F.col("_dup")
                    | F.col("_drift").isNotNull()).count() == 0
    assert sorted(map(tuple, x.select(*src.columns).collect()), key=repr) == \
        sorted(map(tuple, src.collect()), key=repr)


def test_high_rate_injects_every_kind(spark):
    s = INJ.injection_stats(_injected(spark, 0.5).withColumn("_batch_id", F.lit("all")),
                            "_batch_id").first()
    assert s.nulls > 0 and s.late > 0 and s.duplicates > 0 and s.rows > 1000


def test_render_keeps_missing_and_null_apart(spark):
    df = spark.createDataFrame([(1, None, "missing"), (2, None, "null"), (3, "x", None)],
                               "id long, v string, style string")
    present = {"id": F.lit(True), "v": F.col("v").isNotNull() | (F.col("style") == "null")}
    out = [json.loads(r.value) for r in
           render_json(df, ["id", "v"], present=present).orderBy("value").collect()]
    assert {"id": 1} in out and {"id": 2, "v": None} in out and {"id": 3, "v": "x"} in out


def test_gate_stream_in_several_micro_batches(spark):
    from gatekit.streaming.ingest import gate_stream
    landing = write_jsonl(events_json(spark, SF0001).repartition(6), scratch_dir(spark, "t-l"))
    st = Store(spark, scratch_dir(spark, "t-store"))
    gate_stream(spark, landing, st, EVENTS, "s", AS_OF, scratch_dir(spark, "t-ckpt"),
                max_files=2).awaitTermination()
    runs = st.read("metrics").select("run_id").distinct().count()
    assert runs >= 3                                   # one run per micro-batch
    ev = events(spark, SF0001)
    good = ev.filter((F.col("event_id") % 10).isin(0, 1, 2, 4, 6, 8)).count()
    assert st.read("silver").count() == good
    assert st.read("quarantine").count() == ev.count() - good


def test_each_column_gets_both_null_styles(spark):
    cols = ["a", "b", "c", "d"]
    df = spark.range(4000).select("id", *[F.lit("x").alias(c) for c in cols])
    got = INJ.inject_nulls(df, "id", cols, 0.5).filter("_null_style is not null").select("_null_col", "_null_style").distinct()
    assert sorted(map(tuple, got.collect())) == [(c, style) for c in cols for style in ("missing", "null")]

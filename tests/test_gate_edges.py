"""Batches without bad rows, without good rows and without rows; reruns; buckets; streams."""
import json
import os

import pytest
from pyspark.sql import functions as F

from gatekit import SALES, Store, gate_stream, run_gate, sales_gold
from gatekit.session import scratch_dir, to_local

AS_OF = "2024-06-02 12:00:00"


def record(i, **more):
    return {"order_id": f"o{i}", "customer_id": f"c{i % 3}", "product_id": "p", "product_category": "Toys", "quantity": 2,
            "unit_price": 5.0, "total_amount": 10.0, "currency": "USD", "payment_method": "CARD", "store_region": "EU",
            "order_status": "PLACED", "order_ts": "2024-06-02T11:00:00+00:00", **more}


def landing(spark, rows, sub="", extra_lines=()):
    d = to_local(scratch_dir(spark, "edge-landing"))
    os.makedirs(os.path.join(d, sub), exist_ok=True)
    with open(os.path.join(d, sub, "a.json"), "w") as f:
        f.write("".join(json.dumps(r) + "\n" for r in rows) + "".join(extra_lines))
    return d


def counts(df):
    return {r.table_name: r.row_count for r in df.collect()}


@pytest.mark.parametrize("more, silver, bad", [({}, 20, 0), ({"coupon": "x"}, 0, 20)])
def test_clean_and_fully_drifted_first_batch(spark, more, silver, bad):
    store = Store(spark, scratch_dir(spark, "edge"), buckets=4)
    c = counts(run_gate(spark, landing(spark, [record(i, **more) for i in range(20)]), store, SALES, "r1", AS_OF, gold=sales_gold))
    assert (c["bronze"], c["silver"], c["quarantine"]) == (20, silver, bad) and c["metrics"] > 0


def test_empty_first_landing(spark):
    store = Store(spark, scratch_dir(spark, "edge"), buckets=4)
    c = counts(run_gate(spark, landing(spark, []), store, SALES, "r1", AS_OF, gold=sales_gold))
    assert c["bronze"] == c["silver"] == c["quarantine"] == 0


def test_rerun_with_corrected_lines_clears_the_quarantine(spark):
    store = Store(spark, scratch_dir(spark, "edge"), buckets=4)
    run_gate(spark, landing(spark, [record(i, **({"coupon": 1} if i < 5 else {})) for i in range(20)]), store, SALES, "r1", AS_OF)
    c = counts(run_gate(spark, landing(spark, [record(i) for i in range(20)]), store, SALES, "r1", AS_OF))
    assert (c["bronze"], c["silver"], c["quarantine"]) == (20, 20, 0)


def test_blank_lines_are_no_rows(spark):
    store = Store(spark, scratch_dir(spark, "edge"), buckets=4)
    c = counts(run_gate(spark, landing(spark, [record(0), record(1)], extra_lines=("\n", "   \n")), store, SALES, "r1", AS_OF))
    assert c["bronze"] == 2


def test_upsert_keeps_the_tables_bucket_count(spark):
    root = scratch_dir(spark, "edge")
    src = spark.range(50).withColumn("v", F.lit(1))
    Store(spark, root, buckets=8).upsert("t", src, "id")
    again = Store(spark, root, buckets=3)
    again.upsert("t", src.withColumn("v", F.lit(2)), "id")
    assert again.read("t").count() == 50 and again.read("t").filter("v = 2").count() == 50


def test_stream_takes_nested_files_at_its_own_time(spark):
    store = Store(spark, scratch_dir(spark, "edge"), buckets=4)
    d = landing(spark, [record(0)], sub="2024/01", extra_lines=("\n",))
    with open(os.path.join(d, "b.json"), "w") as f:
        f.write(json.dumps(record(1)) + "\n")
    gate_stream(spark, d, store, SALES, "s", None, scratch_dir(spark, "edge-ckpt")).awaitTermination()
    assert store.read("bronze").count() == 2 and store.read("silver").count() == 2
    assert store.read("bronze").filter("_ingest_ts < timestamp'2025-01-01'").isEmpty()


def test_numbers_that_json_does_not_have_are_rescued(spark):
    store = Store(spark, scratch_dir(spark, "edge"), buckets=4)
    rows = [record(0), record(1, unit_price="NaN"), record(2, total_amount="Infinity"), record(3, total_amount="-Infinity")]
    c = counts(run_gate(spark, landing(spark, rows), store, SALES, "r1", AS_OF))
    assert (c["bronze"], c["silver"], c["quarantine"]) == (4, 1, 3)
    why = {r.order_id: (r.quarantine_reason, json.loads(r._rescued_data)) for r in store.read("quarantine").collect()}
    assert why["o1"] == ("null_unit_price; schema_drift", {"unit_price": "NaN"})


def test_tiles_come_in_order(spark):
    from gatekit.operators import tiles
    from gatekit.plans.sales import SalesRun
    from conftest import SF0001
    r = SalesRun(spark, SF0001)
    log, rank = r.table("metrics"), {"FAIL": 0, "WARN": 1, "PASS": 2}
    status = [(x.check_hour, x.status) for x in tiles.tile_status_over_time(log).collect()]
    fails = [(-x.fail_count, -x.warn_count) for x in tiles.tile_failures_by_rule(log).collect()]
    trend = [x.check_ts for x in tiles.tile_freshness_trend(log).collect()]
    reasons = [-x.rows for x in tiles.tile_quarantine_reasons(r.table("quarantine"), r.spec).collect()]
    card = [(rank[x.status], x.rule_name) for x in tiles.tile_latest_scorecard(log).collect()]
    money = [-x.total_revenue for x in tiles.tile_revenue(r.table("gold_region_category")).collect()]
    for got in (status, fails, trend, reasons, card, money):
        assert got and got == sorted(got)


def test_history_is_ordered_by_time_not_by_run_id(spark):
    from gatekit.operators.probe import with_trailing_avg
    probe = spark.createDataFrame([("2", "2024-01-01", 10), ("10", "2024-01-02", 30)], "_batch_id string, check_ts string, total long")
    got = {r._batch_id: r.trailing_avg for r in with_trailing_avg(probe, ["check_ts", "_batch_id"]).collect()}
    assert got == {"2": None, "10": 10.0}

"""Files loaded once in batch, broken and repeated runs; evolving feeds; batch file names;
a stream that is killed between two layers."""
import json
import os

import pytest
from pyspark.sql import functions as F

from gatekit import SALES, Store, gate_stream, ingest_once_batch, run_gate, write_batch_files
from gatekit.plans import medallion
from gatekit.session import scratch_dir, to_local
from gatekit.sources.landing import evolve_drift, read_files, read_landing
from gatekit.spec import GateSpec
from test_gate_edges import AS_OF, record


def put(folder, name, *records):
    os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("".join(json.dumps(r) + "\n" for r in records))


def folder(spark):
    d = to_local(scratch_dir(spark, "once"))
    os.makedirs(d)
    return d


def ids(df):
    return sorted(r.order_id for r in df.select("order_id").collect())


def test_only_unseen_files_are_loaded(spark):
    d, store = folder(spark), Store(spark, scratch_dir(spark, "store"), buckets=2)
    put(d, "a [1].json", record(1))
    put(d, "deep/b{2}.json", record(2))
    assert ids(ingest_once_batch(spark, d, store, SALES, "r1", AS_OF)) == ["o1", "o2"]
    put(d, "c?.json", record(3))
    assert ids(ingest_once_batch(spark, d, store, SALES, "r2", AS_OF)) == ["o3"]
    assert ids(ingest_once_batch(spark, d, store, SALES, "r3", AS_OF)) == []
    assert ids(ingest_once_batch(spark, d, store, SALES, "r1", AS_OF)) == ["o1", "o2"]  # its own files again
    assert ids(store.read("bronze")) == ["o1", "o2", "o3"]


def test_a_broken_run_is_taken_over(spark, monkeypatch):
    d, store = folder(spark), Store(spark, scratch_dir(spark, "store"), buckets=2)
    put(d, "a.json", record(1), record(2))
    put(d, "b.json", record(3, coupon="x"))
    real = medallion.build_silver
    monkeypatch.setattr(medallion, "build_silver", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run_gate(spark, d, store, SALES, "dead", AS_OF)
    assert store.read("bronze").count() == 3  # written, but the run did not come to its end
    monkeypatch.setattr(medallion, "build_silver", real)
    counts = dict(run_gate(spark, d, store, SALES, "next", AS_OF).collect())
    assert (counts["bronze"], counts["quarantine"], counts["silver"]) == (3, 1, 2)
    assert {r[0] for r in store.read("bronze").select("_batch_id").distinct().collect()} == {"next"}


def test_an_empty_landing_and_the_same_run_again(spark):
    d, store = folder(spark), Store(spark, scratch_dir(spark, "store"), buckets=2)
    assert dict(run_gate(spark, d, store, SALES, "r0", AS_OF).collect())["bronze"] == 0
    put(d, "a.json", record(1))
    first = dict(run_gate(spark, d, store, SALES, "r1", AS_OF).collect())
    assert dict(run_gate(spark, d, store, SALES, "r1", AS_OF).collect()) == first and first["silver"] == 1
    assert read_files(spark, []).count() == 0


def test_batch_files_have_names_of_their_own(spark):
    d = folder(spark)
    lines = spark.range(10).select(F.to_json(F.struct("id")).alias("value"))
    assert write_batch_files(lines.repartition(3), d, "s1") == [f"sales_s1_{i:03d}.json" for i in range(3)]
    assert write_batch_files(lines.coalesce(1), d, "s1") == ["sales_s1_000.json"]  # sent again, by fewer
    assert write_batch_files(lines.coalesce(1), d, "s1", first=7) == ["sales_s1_007.json"]
    assert write_batch_files(lines.limit(0), d, "s2") == []

    def broken(batches):
        for b in batches:
            yield b
        raise ValueError("lost")
    with pytest.raises(Exception, match="lost"):
        write_batch_files(lines.mapInArrow(broken, "value string"), d, "s3")
    assert sorted(f for f in os.listdir(d) if f.endswith(".json")) == ["sales_s1_000.json", "sales_s1_007.json"]
    assert read_landing(spark, d).count() == 20  # what a failed job left is hidden


SPEC = GateSpec()


def evolved(spark, lines, **more):
    raw = spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in lines], "value string")
    return evolve_drift(raw, SPEC, **more)


def test_evolve_with_keys_that_differ_in_case(spark):
    out = evolved(spark, [record(1, Coupon="a"), record(2, coupon="b"), record(3, coupon="c"), record(4, coupon="d", COUPON="e"), record(5, Coupon="f", COUPON="g"),
                          record(6, _batch_id="x", ORDER_ID="y", Order_Date="z"), "{broken", record(7, quantity="many"), record(8, coupon=None)])
    got = {r.order_id: r for r in out.collect()}
    assert "coupon" in out.columns and len(out.columns) == len({c.lower() for c in out.columns})
    assert [got[f"o{i}"].coupon for i in (1, 2, 3, 4, 5, 8)] == ["a", "b", "c", "d", "g", None]  # its own spelling, then in order
    assert json.loads(got["o4"]._rescued_data) == {"COUPON": "e"} and json.loads(got["o5"]._rescued_data) == {"Coupon": "f"}
    assert json.loads(got["o6"]._rescued_data) == {"_batch_id": "x", "ORDER_ID": "y", "Order_Date": "z"}
    assert json.loads(got["o7"]._rescued_data) == {"quantity": "many"} and json.loads(got[None]._rescued_data) == {"_corrupt_record": "{broken"}
    assert got["o1"]._rescued_data is None


def test_evolve_width_and_known_columns(spark):
    rows = [record(i, **{f"k{j}": str(j) for j in range(5) if i >= j}) for i in range(6)]
    out = evolved(spark, rows, width=2)
    assert [c for c in out.columns if c.startswith("k")] == ["k0", "k1"]  # in most rows
    last = next(r for r in out.collect() if r.order_id == "o5")
    assert last._more == {"k2": "2", "k3": "3", "k4": "4"} and last._rescued_data is None
    assert [c for c in evolved(spark, rows, width=2, known=("k4", "order_id", "_more")).columns if c.startswith("k")] == ["k4", "k0"]
    assert evolved(spark, [record(1)]).filter(F.col("_more").isNotNull()).count() == 0


def test_evolve_through_runs_keeps_the_columns(spark):
    d, store = folder(spark), Store(spark, scratch_dir(spark, "store"), buckets=2)
    put(d, "a.json", record(1, coupon="a"), record(2))
    run_gate(spark, d, store, SALES, "r1", AS_OF, drift="evolve")
    put(d, "b.json", record(3, Coupon="b", tier=1))
    run_gate(spark, d, store, SALES, "r2", AS_OF, drift="evolve")
    got = {r.order_id: (r.coupon, r.tier) for r in store.read("bronze").collect()}
    assert got == {"o1": ("a", None), "o2": (None, None), "o3": ("b", "1")}
    rule = {r.run_id: r.metric_value for r in store.read("metrics").filter("rule_name = 'schema_drift'").collect()}
    assert rule == {"r1": 1.0, "r2": 2.0}


LAYERS = ("bronze", "quarantine", "silver", "metrics")


def tables(store):
    return {t: sorted(str(tuple(r)) for r in store.read(t).drop("_source_file").collect()) for t in LAYERS}


@pytest.mark.parametrize("step", ["replace_run", "append_log", "upsert"])
def test_a_killed_micro_batch_is_replayed_to_the_same_tables(spark, monkeypatch, step):
    d = folder(spark)
    for k in range(3):
        put(d, f"{k}.json", record(k), record(k + 1, total_amount=11.0 + k), record(10 + k, coupon=1))
        os.utime(f"{d}/{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))

    def go(store, ckpt):
        gate_stream(spark, d, store, SALES, "s", AS_OF, ckpt, max_files=1).awaitTermination()
    whole = Store(spark, scratch_dir(spark, "store"), buckets=2)
    go(whole, scratch_dir(spark, "ckpt"))
    store, ckpt, calls = Store(spark, scratch_dir(spark, "store"), buckets=2), scratch_dir(spark, "ckpt"), []
    real = getattr(store, step)

    def dies(*a, **b):  # after this write of the second micro-batch, before the next layer
        real(*a, **b)
        calls.append(a[0])
        if len(calls) == 2 * {"replace_run": 2, "append_log": 2, "upsert": 1}[step]:
            raise RuntimeError("killed")
    monkeypatch.setattr(store, step, dies)
    with pytest.raises(Exception, match="killed"):
        go(store, ckpt)
    monkeypatch.setattr(store, step, real)
    go(store, ckpt)
    assert tables(store) == tables(whole)

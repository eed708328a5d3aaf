"""Row versions: crashes at any moment lose no row, the newest version wins, the log stays
in few files; fixed schemas refuse before a file is written."""
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatekit.session import scratch_dir, to_local
from gatekit.sources.store import SchemaError, Store


def rows(store, table="t"):
    return {r.id: r.v for r in store.read(table).collect()}


def batch(spark, ids, v):
    return spark.createDataFrame([(i, v) for i in ids], "id long, v string")


class Crash(Exception):
    pass


def crash_in(monkeypatch, store, method, after=False):
    real = getattr(store, method)

    def fail(*a, **b):
        if after:
            real(*a, **b)
        raise Crash
    monkeypatch.setattr(store, method, fail)


@pytest.mark.parametrize("method, after", [("_put", False), ("_put", True), ("_write_version", False), ("_write_version", True)])
def test_crash_in_an_upsert_loses_nothing(spark, monkeypatch, method, after):
    root = scratch_dir(spark, "versions")
    Store(spark, root, buckets=4).upsert("t", batch(spark, range(50), "old"), "id")
    broken = Store(spark, root)
    crash_in(monkeypatch, broken, method, after)
    with pytest.raises(Crash):
        broken.upsert("t", batch(spark, [3, 99], "new"), "id")
    there = rows(Store(spark, root))
    assert set(there) >= set(range(50)) and all(there[i] == "old" for i in range(50) if i != 3)
    Store(spark, root).upsert("t", batch(spark, [3, 99], "new"), "id")  # sent again
    assert rows(Store(spark, root)) == {**{i: "old" for i in range(50)}, 3: "new", 99: "new"}


def test_crash_in_the_first_upsert(spark, monkeypatch):
    root = scratch_dir(spark, "versions")
    broken = Store(spark, root, buckets=4)
    crash_in(monkeypatch, broken, "_write_version")
    with pytest.raises(Crash):
        broken.upsert("t", batch(spark, range(9), "x"), "id")
    Store(spark, root).upsert("t", batch(spark, range(9), "y"), "id")
    assert rows(Store(spark, root)) == {i: "y" for i in range(9)}


def test_folders_without_a_note_are_an_error(spark):
    root = scratch_dir(spark, "versions")
    Store(spark, root, buckets=4).upsert("t", batch(spark, range(50), "old"), "id")
    os.remove(f"{to_local(root)}/_tables/t.json")
    with pytest.raises(ValueError, match="nothing is noted"):
        Store(spark, root).upsert("t", batch(spark, [1], "new"), "id")


def test_compaction_keeps_the_table_at_every_step(spark, monkeypatch):
    root = scratch_dir(spark, "versions")
    store, want = Store(spark, root, buckets=3, compact_after=0), {}
    for k in range(4):
        store.upsert("t", batch(spark, range(k * 5, k * 5 + 12), f"v{k}"), "id")
        want |= {i: f"v{k}" for i in range(k * 5, k * 5 + 12)}
    assert rows(store) == want
    broken = Store(spark, root)
    crash_in(monkeypatch, broken, "_write_version", after=True)
    with pytest.raises(Crash):
        broken.compact("t", 1)
    assert rows(store) == want  # the compacted rows stand beside what they stand for
    store.upsert("t", batch(spark, [0], "w"), "id")
    assert rows(store) == {**want, 0: "w"}
    assert store.compact("t", 1) and rows(store) == {**want, 0: "w"}
    store.compact("t", 1)  # now the versions behind are gone
    versions = {v for vs in store._folders(store._versions("t", store._facts("t")), "_bucket").values() for v in vs}
    assert len(versions) <= 2 and rows(store) == {**want, 0: "w"}


def test_null_keys_match_nothing(spark):
    store = Store(spark, scratch_dir(spark, "versions"), buckets=2)
    for v in ("a", "b"):
        store.upsert("t", spark.createDataFrame([(None, v), (1, v)], "id long, v string"), "id")
    assert sorted((r.id or 0, r.v) for r in store.read("t").collect()) == [(0, "a"), (0, "b"), (1, "b")]


def test_buckets_follow_the_bytes(spark, monkeypatch):
    from gatekit.sources import store as module
    monkeypatch.setattr(module, "BUCKET_BYTES", 1000)
    path = scratch_dir(spark, "versions-src")
    spark.range(20_000).withColumn("v", F.lit("x")).write.parquet(path)
    store = Store(spark, scratch_dir(spark, "versions"))
    store.upsert("t", spark.read.parquet(path), "id")
    assert store._facts("t")["buckets"] > module.LEAST_BUCKETS and store.read("t").count() == 20_000


def test_log_replaces_runs_and_stays_in_few_files(spark):
    store = Store(spark, scratch_dir(spark, "versions"), compact_after=5)
    for k in range(24):
        df = spark.createDataFrame([(f"r{k % 12}", "bronze", str(k)), (f"r{k % 12}", "bronze", "x")], "run_id string, layer string, v string")
        store.append_log("m", df.withColumn("check_ts", F.lit("2024-05-01 10:00:00").cast("timestamp")))
    got = store.read("m").groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("v")).collect()
    assert {(r.run_id, r.n, r.v) for r in got} == {(f"r{k}", 2, str(k + 12)) for k in range(12)}
    files = [f for _, _, fs in os.walk(to_local(store.path("m"))) for f in fs if f.endswith(".parquet")]
    assert len(files) <= 3 * 5


FIXED = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("run_id", T.StringType())])


@pytest.mark.parametrize("ddl, message", [
    ("id long, x string, run_id string", "string does not go into double"),
    ("id decimal(10,0), x double, run_id string", "does not go into bigint"),
    ("id long, run_id string", "missing"), ("id long, x double, y int, run_id string", "not in its schema")])
def test_a_fixed_schema_refuses_before_it_writes(spark, ddl, message):
    store = Store(spark, scratch_dir(spark, "versions"))
    store.ensure("t", FIXED)
    for write in (lambda d: store.append_run("t", d), lambda d: store.replace_run("t", d, "run_id", "a"), lambda d: store.append("t", d),
                  lambda d: store.replace("t", d), lambda d: store.upsert("t", d, "id")):
        with pytest.raises(SchemaError, match=message):
            write(spark.createDataFrame([], ddl))
    assert not [f for _, _, fs in os.walk(to_local(store.path("t"))) for f in fs]
    assert store.read("t").schema == FIXED and store.read("t").count() == 0


def test_a_fixed_schema_widens_and_orders(spark):
    store = Store(spark, scratch_dir(spark, "versions"))
    store.ensure("t", FIXED)
    store.append_run("t", spark.createDataFrame([("a", 1.5, 7)], "run_id string, X float, ID int"))
    assert store.read("t").schema == FIXED and tuple(store.read("t").first()) == (7, 1.5, "a")

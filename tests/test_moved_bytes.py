"""What the stored layers send over the network: each row once per step, and no more of it than
the step needs."""
import re

from pyspark.sql import functions as F, types as T

from gatekit.operators import conform as C
from gatekit.operators.conform import dedup_latest
from gatekit.operators.merge import merge_actions, row_digest
from gatekit.session import conf_for, scratch_dir, to_local
from gatekit.sources import store as module
from gatekit.sources import testbind
from gatekit.sources.store import Store


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark) -> str:
    """Two customers, parts and orders (one order of an unknown customer), lines sent twice."""
    d = scratch_dir(spark, "moved")
    def put(name, ddl, *rows):
        spark.createDataFrame(list(rows), ddl).write.parquet(f"{d}/{name}.parquet")
    put("region", "r_regionkey int, r_name string", (0, "ASIA"), (1, "EUROPE"))
    put("nation", "n_nationkey int, n_regionkey int", (0, 0), (1, 1))
    put("customer", "c_custkey bigint, c_nationkey int", (1, 0), (2, 1), (None, 1))
    put("part", "p_partkey bigint, p_type string", (1, "TIN"), (2, "BRASS"), (2, "STEEL"))
    put("orders", "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate string, o_orderpriority string",
        (1, 1, "O", "1995-01-01", "1-URGENT"), (2, 2, "P", "1995-01-02", "2-HIGH"), (3, 9, "F", "1995-01-03", "5-LOW"), (4, None, "F", "1995-01-03", "5-LOW"))
    put("lineitem", "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate string",
        *[(o, p, n, 2.0, 10.0 * (o or 9) + n, "1995-02-01") for o in (1, 2, 3, 4, None) for p in (1, 2, None) for n in (1, 1, 2)])
    return d


def test_lines_are_not_shuffled_for_their_customers(spark):
    with conf_for(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        p = plan(testbind.sales_bronze(spark, tables(spark)))
    lines = p.splitlines()
    at = [i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\(o_custkey", line)]
    assert at
    for i in at:  # the branch under the exchange reads orders and no lines
        depth = len(re.match(r"[ :|+-]*", lines[i]).group())
        under = []
        for line in lines[i + 1:]:
            if len(re.match(r"[ :|+-]*", line).group()) <= depth:
                break
            under.append(line)
        assert "o_custkey" in "".join(under) and "l_orderkey" not in "".join(under)


def test_stored_bronze_has_every_line_once_per_match(spark):
    d = tables(spark)
    stored = testbind.stored_sales_bronze(spark, d)
    view = testbind.sales_bronze(spark, d)
    # orders 1 and 2, part 1 once and part 2 under both its types, three lines each
    assert stored.count() == view.count() == 2 * 3 * 3
    assert stored.exceptAll(view).count() == 0 and view.exceptAll(stored).count() == 0


def test_conf_for_puts_back_what_was_there(spark):
    k = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(k)
    with conf_for(spark, {k: "8"}):
        assert spark.conf.get(k) == "8"
    assert spark.conf.get(k) == before


def _repeated(spark):
    """Keys 0 .. 499 three times in different rows, some with nulls, and equal rows."""
    df = spark.range(1500).select((F.col("id") % 500).cast("string").alias("k"),
                                  F.when(F.col("id") % 7 != 0, F.col("id") % 11).alias("t"), (F.col("id") % 3).alias("v"))
    return df.unionByName(df.filter("v = 1"))


def test_upsert_keeps_the_newest_row_of_a_key_in_one_shuffle(spark, monkeypatch):
    df, order, seen = _repeated(spark), ["t", "v"], []
    real = Store._write_version

    def keep(self, table, df, by, name, dealt=False):
        seen.append((plan(df), dealt))
        real(self, table, df, by, name, dealt)
    monkeypatch.setattr(Store, "_write_version", keep)
    monkeypatch.setattr(module, "PART_BYTES", 1 << 10)
    st = Store(spark, scratch_dir(spark, "t-newest"), buckets=4)
    st.upsert("t", df, "k", order)
    st.upsert("t", df.withColumn("v", F.col("v") + 10).filter("k < '3'"), "k", order)
    for p, dealt in seen:
        assert dealt and p.count("Exchange") == 1
    want = (dedup_latest(df, "k", order).filter("not k < '3'")
            .unionByName(dedup_latest(df.withColumn("v", F.col("v") + 10).filter("k < '3'"), "k", order)))
    got = st.read("t").select("k", "t", "v")
    assert got.count() == 500 and got.exceptAll(want.select("k", "t", "v")).count() == 0
    # every row lies in the bucket that an upsert of distinct keys would put it in
    folders = spark.read.parquet(to_local(st.path("t")))
    assert folders.filter(F.col("_bucket").cast("string") != st.bucket_of("k", 4)).count() == 0


def test_hot_keys_are_cut_before_the_shuffle(spark):
    hot = spark.range(30_000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    df = hot.unionByName(spark.range(10_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")))
    cut = C.limit_hot_keys(df, "k", ["v"])
    assert cut.count() == 10_001 and cut.filter("k = 'hot'").first()["v"] == 29_999
    assert C.limit_hot_keys(df.filter("k <> 'hot'"), "k", ["v"]).count() == 10_000
    assert C.limit_hot_keys(df.limit(0), "k", ["v"]).count() == 0
    st = Store(spark, scratch_dir(spark, "t-hot"))
    st.upsert("t", df, "k", ["v"])
    assert st.read("t").count() == 10_001 and st.read("t").filter("k = 'hot'").first()["v"] == 29_999


def test_merge_sends_a_digest_of_32_bytes(spark):
    df = spark.range(4).withColumn("v", F.lit("a"))
    d = df.select(row_digest(["v"]).alias("d"))
    assert d.schema["d"].dataType == T.BinaryType() and d.select(F.length("d")).first()[0] == 32
    new = df.filter("id > 0").withColumn("v", F.when(F.col("id") == 1, F.lit("b")).otherwise(F.col("v"))).unionByName(spark.range(9, 10).withColumn("v", F.lit("a")))
    assert {r["id"]: r["action"] for r in merge_actions(df, new, "id").collect()} == {1: "update", 2: "unchanged", 3: "unchanged", 9: "insert"}

"""Scale properties of the physical plans (what `explain` showed when they
were designed); a regression here costs little locally and a lot at 100 TB."""
import os
import re

from pyspark.sql import functions as F

from conftest import SF0001
from gatekit.operators.gate import slice_latest
from gatekit.operators.probe import bronze_probe
from gatekit.plans.sales import SalesRun
from gatekit.session import scratch_dir, to_local
from gatekit.sources.store import Store


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_each_key_before_the_shuffle(spark):
    p = plan(SalesRun(spark, SF0001).silver)
    # a partial WindowGroupLimit sits under the Exchange, a final one above it
    assert p.count("WindowGroupLimit") >= 2
    assert re.search(r"Exchange hashpartitioning\(order_id[^\n]*\n(.*\n)*?.*WindowGroupLimit", p)


def test_probe_is_a_hash_aggregate_without_expand(spark):
    r = SalesRun(spark, SF0001)
    p = plan(bronze_probe(r.bronze, r.spec, with_drift=False))
    assert "HashAggregate" in p and "ObjectHashAggregate" not in p and "Expand" not in p


def test_newest_batch_slice_prunes_partitions(spark):
    r = SalesRun(spark, SF0001)
    p = plan(slice_latest(r.bronze, r.spec))
    assert re.search(r"PartitionFilters: \[[^\]]*_batch_id[^\]]*[Ss]ubquery", p)


def test_probe_shuffles_batch_and_key_only(spark):
    r = SalesRun(spark, SF0001)
    p = plan(bronze_probe(r.bronze, r.spec, with_drift=False))
    keyed = [line for line in p.splitlines() if "Exchange hashpartitioning" in line and "order_id" in line]
    assert keyed and all(re.search(r"hashpartitioning\(_b\w+#\d+, order_id#\d+", line) for line in keyed)
    # under that exchange: the two columns and nothing else
    assert re.search(r"HashAggregate\(keys=\[_\w+#\d+, order_id#\d+\], functions=\[\]", p)


def test_a_rule_reads_what_it_declares(spark):
    p = plan(SalesRun(spark, SF0001).rule("late_arriving"))
    columns = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert columns == ["order_ts:string,_ingest_ts:timestamp_ntz"]  # and the batch, a partition column
    assert "order_id" not in p and "Join" not in p


def test_merge_actions_is_one_join(spark):
    from gatekit.operators.merge import merge_actions
    a = spark.range(10).withColumn("v", F.lit("a"))
    p = plan(merge_actions(a, a.withColumn("v", F.lit("b")), "id"))
    assert len(re.findall(r"\w*Join\b", p.split("+- == Initial Plan ==")[0])) == 1


def test_upsert_writes_the_batch_and_reads_no_target(spark):
    st = Store(spark, scratch_dir(spark, "t-plan"), buckets=4, compact_after=0)
    text = F.sha2(F.col("id").cast("string"), 256)
    st.upsert("t", spark.range(200_000).withColumn("v", text), "id")
    st.upsert("t", spark.range(2_000).withColumn("v", F.reverse(text)), "id")
    size = {}
    for top, _, files in os.walk(to_local(st.path("t"))):
        version = top.rpartition("_version=")[2]
        size[version] = size.get(version, 0) + sum(os.path.getsize(f"{top}/{f}") for f in files if f.endswith(".parquet"))
    base, delta = size["000000001c"], size["000000002"]
    assert delta < 0.02 * base
    # reading: the base is not shuffled by key as long as the delta is small
    p = plan(st.read("t"))
    assert "WindowGroupLimit" in p and "LeftAnti" in p


def test_log_day_filter_prunes_folders(spark):
    st = Store(spark, scratch_dir(spark, "t-plan"))
    log = spark.range(4).select(F.col("id").cast("string").alias("run_id"), F.lit("bronze").alias("layer"),
                                F.timestamp_add("DAY", "id", F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("check_ts"))
    st.append_log("m", log)
    st.append_log("m", log.filter("id = 1"))
    p = plan(st.read("m", where=F.col("_day") == "2024-01-02"))
    assert all("_day" in f for f in re.findall(r"PartitionFilters: \[([^\]]*)\]", p))
    assert st.read("m", where=F.col("_day") == "2024-01-02").count() == 1


def test_scans_read_only_needed_columns(spark):
    r = SalesRun(spark, SF0001)
    p = plan(r.bronze.groupBy("_batch_id").agg(F.count_distinct("order_id")))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert schema == "order_id:string"

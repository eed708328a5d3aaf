"""Store semantics (idempotent per-run writes, bucketed upsert) and the
end-to-end gate on JSON landings, run twice."""
from pyspark.sql import functions as F

from conftest import SF0001
from gatekit.plans.medallion import run_gate, sales_gold
from gatekit.session import scratch_dir
from gatekit.sources.landing import render_json, write_jsonl
from gatekit.sources.store import Store
from gatekit.sources.testbind import sales_bronze
from gatekit.spec import SALES


def test_append_run_replaces_the_run(spark):
    st = Store(spark, scratch_dir(spark, "t-store"))
    a = spark.range(10).withColumn("run_id", F.lit("a"))
    st.append_run("log", a)
    st.append_run("log", a)
    st.append_run("log", spark.range(3).withColumn("run_id", F.lit("b")))
    got = {r.run_id: r["count"] for r in st.read("log").groupBy("run_id").count().collect()}
    assert got == {"a": 10, "b": 3}


def test_upsert_replaces_matched_and_inserts_new(spark):
    st = Store(spark, scratch_dir(spark, "t-store"), buckets=4)
    tgt = spark.createDataFrame([(k, "old") for k in range(1, 6)], "k long, v string")
    src = spark.createDataFrame([(k, "new") for k in range(4, 8)], "k long, v string")
    st.upsert("t", tgt, "k")
    st.upsert("t", src, "k")
    got = dict(st.read("t").select("k", "v").collect())
    assert got == {1: "old", 2: "old", 3: "old", 4: "new", 5: "new", 6: "new", 7: "new"}
    st.upsert("t", src, "k")                     # rerun: nothing changes
    assert st.read("t").count() == 7


def _sales_landings(spark, root):
    """The sales binding rendered as JSON lines, one landing folder per batch;
    rescued rows carry an extra "price" key instead of a rescue column."""
    b = sales_bronze(spark, SF0001)
    names = SALES.contract_names
    present = {c: F.col(c).isNotNull() for c in names}
    present["price"] = F.col("_rescued_data").isNotNull()
    text = render_json(b, [F.col(c) for c in names] + [F.lit(1).alias("price")],
                       present=present, keep=("_batch_id",))
    dirs = {}
    for i in range(5):
        dirs[str(i)] = write_jsonl(text.filter(F.col("_batch_id") == str(i)), f"{root}/run{i}")
    return b, dirs


def test_run_gate_end_to_end_and_rerun(spark):
    root = scratch_dir(spark, "t-gate")
    b, dirs = _sales_landings(spark, root)
    st = Store(spark, f"{root}/store", buckets=8)
    for run_id, path in dirs.items():
        counts = run_gate(spark, path, st, SALES, run_id, f"2002-01-0{int(run_id) + 1} 00:00:00",
                          gold=sales_gold)
    c1 = dict(counts.collect())
    total = b.count()
    assert c1["bronze"] == total
    good = total - c1["quarantine"]
    assert st.read("bronze").schema == SALES.table_schemas()["bronze"]
    keys = st.read("bronze").filter(F.col("_rescued_data").isNull()).count()
    assert keys >= good
    # every key of a good row survives exactly once
    assert c1["silver"] == st.read("silver").select("order_id").distinct().count()
    assert c1["metrics"] == 5 * 12          # 10 bronze + silver + gold freshness
    # the rescue caught exactly the rows that had the extra key
    assert st.read("quarantine").filter(F.col("quarantine_reason").contains("schema_drift")).count() \
        == b.filter(F.col("_rescued_data").isNotNull()).count()
    # rerun one run: nothing doubles
    c2 = dict(run_gate(spark, dirs["2"], st, SALES, "2", "2002-01-03 00:00:00",
                       gold=sales_gold).collect())
    assert c2 == c1
    # row-count rule saw the trailing average of the other runs
    rc = st.read("metrics").filter("rule_name = 'row_count_anomaly' AND run_id = '4'").first()
    assert rc.threshold > 0


def test_empty_rerun_is_logged(spark):
    """A second run without new files: null rate 0/0 PASS, duplicate PASS, freshness FAIL
    (no event time), row count FAIL against the history, drift PASS."""
    root = scratch_dir(spark, "t-empty")
    _, dirs = _sales_landings(spark, root)
    st = Store(spark, f"{root}/store", buckets=4)
    before = dict(run_gate(spark, dirs["0"], st, SALES, "0", "2002-01-01 00:00:00").collect())
    after = dict(run_gate(spark, dirs["0"], st, SALES, "9", "2002-01-02 00:00:00").collect())
    assert {k: v for k, v in after.items() if k != "metrics"} == {k: v for k, v in before.items() if k != "metrics"}
    m = {(r.rule_name, r.column_name): r.status for r in
         st.read("metrics").filter("run_id = '9' AND layer = 'bronze'").collect()}
    assert len(m) == 10
    assert m[("null_rate", "order_id")] == "PASS" and m[("duplicate", "order_id")] == "PASS"
    assert m[("freshness_sla", "order_ts")] == "FAIL"
    assert m[("row_count_anomaly", None)] == "FAIL"
    assert m[("schema_drift", None)] == "PASS"


def test_notebook_form_of_the_gate(spark):
    """Without the row-count rule, silver appended, every file each time."""
    root = scratch_dir(spark, "t-notebook")
    _, dirs = _sales_landings(spark, root)
    st = Store(spark, f"{root}/store")
    for run_id in ("a", "b"):
        run_gate(spark, dirs["1"], st, SALES, run_id, "2002-01-01 00:00:00", once=False, with_row_count=False, silver_mode="append")
    n = {r.run_id: r["count"] for r in st.read("silver").groupBy("run_id").count().collect()}
    assert n["a"] == n["b"] > 0
    assert st.read("metrics").filter("rule_name = 'row_count_anomaly'").isEmpty()


def test_repair_before_the_gate(spark):
    root = scratch_dir(spark, "t-repair")
    _, dirs = _sales_landings(spark, root)
    got = {}
    for mode in (False, True):
        st = Store(spark, f"{root}/store-{mode}", buckets=4)
        run_gate(spark, dirs["2"], st, SALES, "r", "2002-01-01 00:00:00", repair_before_gate=mode)
        got[mode] = st.read("quarantine").filter(F.col("quarantine_reason") == "null_total_amount").count()
        rule = st.read("metrics").filter("rule_name = 'null_rate' AND column_name = 'total_amount'").first()
        assert rule.failure_count > 0  # the log still says what came in
    assert got[False] > 0 and got[True] == 0
    assert st.read("silver").filter(F.abs(F.col("total_amount") - F.col("quantity") * F.col("unit_price")) < 1e-6).count() > 0


def test_gate_with_evolve_widens_bronze(spark):
    from gatekit.sources.events import EVENTS, events_json
    root = scratch_dir(spark, "t-evolve")
    landing = write_jsonl(events_json(spark, SF0001), f"{root}/landing")
    st = Store(spark, f"{root}/store", buckets=4)
    run_gate(spark, landing, st, EVENTS, "e1", "2024-01-31 00:00:00", drift="evolve")
    bronze = st.read("bronze", merge_schema=True)
    assert {"coupon", "amount"} <= set(bronze.columns)
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    # only mistyped values (id % 10 == 7) and cut lines (id % 10 == 9) are rescued
    assert st.read("quarantine").count() == ev.filter(F.col("event_id") % 10 >= 7)\
        .filter(F.col("event_id") % 2 == 1).count()
    drift = st.read("metrics").filter("rule_name = 'schema_drift'").first()
    assert drift.status == "FAIL" and drift.metric_value == 2.0      # coupon, amount

"""run_gate: one run from raw JSON lines to bronze, metrics, quarantine,
silver and gold, written to a Store.

Every step is a lazy DataFrame plan; only writes leave Spark. The run id and
``as_of`` are arguments (never ``uuid()`` / ``current_timestamp()`` inside a
plan), so re-running a run id replaces its rows instead of doubling them.

The lines are read and parsed once, while bronze is written; the keyless counters and the
contract keys that occur are observed on the way. What follows reads the run's stored slice
by column: its keys for the distinct count, its rescued rows for the drift, then quarantine
and silver.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.exprs import parse_event
from ..operators.conform import build_silver, repair_amount
from ..operators.evaluate import evaluate_all, freshness_metric
from ..operators.gate import quarantine_rows
from ..operators.probe import (counters, distinct_count, drift_of_keys, observed_probe,
                               silver_freshness, trailing_avg)
from ..sources.landing import (CORRUPT_KEY, PARSED, bronze_columns, parse_lines, parse_raw,
                               read_landing, stamp_lineage)
from ..sources.manifest import claim, give_up_broken_runs, mark_loaded
from ..sources.store import Store
from ..spec import GateSpec

BRONZE, QUARANTINE, SILVER, METRICS = "bronze", "quarantine", "silver", "metrics"
GOLD_TABLE = "gold_daily_sales"

GoldFn = Callable[[DataFrame, GateSpec, object], dict[str, DataFrame]]


def ensure_tables(store: Store, spec: GateSpec, gold: bool = True) -> list[str]:
    """Declare the gate's tables with their fixed schemas where they do not exist."""
    made = []
    for name, schema in spec.table_schemas().items():
        if gold or not name.startswith("gold"):
            store.ensure(name, schema)
            made.append(name)
    return made


def write_bronze(raw: DataFrame, store: Store, spec: GateSpec, run_id: str, as_of, drift: str = "rescue") -> tuple[dict, dict]:
    """Write one run's lines as bronze. Returns what was observed on the way: the keyless
    counters of the probe (``max_event_ts`` as text) and, per contract key, whether a line
    holds it (also as a null).

    The write is one stage that reads the landing files, so each row is observed in the one
    task attempt that is committed."""
    keys, counts = Observation(), Observation()
    m = F.col(PARSED)
    parsed = parse_lines(raw).observe(keys, *[F.max(F.map_contains_key(m, c)).alias(f"k{i}") for i, c in enumerate(spec.contract_names)])
    known = tuple(f.name for f in store.schema(BRONZE).fields) if drift == "evolve" else ()
    bronze = stamp_lineage(parse_raw(parsed, spec, drift, known), spec, run_id, as_of)
    if drift == "rescue":
        bronze = bronze.select(*bronze_columns(spec))
    columns = bronze.columns
    seen = bronze.withColumn("_ts", parse_event(spec)).observe(counts, *counters(spec, as_text=True)).select(*[F.col(f"`{c}`") for c in columns])
    store.replace_run(BRONZE, seen, spec.batch_col, run_id, merge_schema=drift == "evolve")
    return counts.get, {c: bool(keys.get[f"k{i}"]) for i, c in enumerate(spec.contract_names)}


def gate_raw(spark: SparkSession, raw: DataFrame, store: Store, spec: GateSpec, run_id: str,
             as_of: str, gold: GoldFn | None = None, with_row_count: bool = True,
             drift: str = "rescue", silver_mode: str = "upsert",
             repair_before_gate: bool = False) -> None:
    """Gate one run of raw lines (``value`` [+ ``_source_file``]).

    ``silver_mode``: 'upsert' (by key) or 'append' (plain, doubled by a rerun).
    ``repair_before_gate``: a missing amount is repaired before rows are judged, so it
    sends no row to quarantine (the log counts it as null all the same).
    """
    if silver_mode not in ("upsert", "append"):
        raise ValueError(f"silver_mode must be 'upsert' or 'append', not {silver_mode!r}")
    ensure_tables(store, spec, gold is not None)
    as_of_c, run = F.lit(as_of).cast(spec.ts_type), F.lit(run_id)
    seen, present = write_bronze(raw, store, spec, run_id, as_of_c, drift)
    batch = store.read(BRONZE).filter(F.col(spec.batch_col) == run_id)

    # drift from the keys actually present; a run without rows has no drift
    probe = observed_probe(spark, seen, distinct_count(batch, spec), spec, run_id, as_of_c)
    probe = drift_of_keys(probe, batch, spec, [c for c, there in present.items() if there], (CORRUPT_KEY,)) \
        if seen["total"] else probe.withColumns({c: F.array().cast("array<string>") for c in ("unexpected", "missing")})
    if with_row_count:
        probe = probe.withColumn("trailing_avg", trailing_avg(store.read(METRICS), run_id).scalar())
    store.append_log(METRICS, evaluate_all(probe, spec, with_row_count))

    if repair_before_gate and spec.repair:
        batch = repair_amount(batch, spec)
    store.replace_run(QUARANTINE, quarantine_rows(batch, spec, as_of_c, run), "run_id", run_id)
    clean = build_silver(batch, spec, run)
    if silver_mode == "upsert":
        store.upsert(SILVER, clean, spec.key)
    else:
        store.append(SILVER, clean)

    silver = store.read(SILVER)
    fresh = silver_freshness(silver, spec, as_of_c)
    rows = freshness_metric(fresh, spec, run, as_of_c, "silver", spec.silver_table)
    if gold is not None:
        for name, df in gold(silver, spec, as_of_c).items():
            store.replace(name, df)
        # the gold refresh logs its own freshness row (layer gold), as the
        # notebook path does, with the real run id
        rows = rows.unionByName(rows.withColumns({"layer": F.lit("gold"), "table_name": F.lit(GOLD_TABLE)}))
    store.append_log(METRICS, rows)


def run_gate(spark: SparkSession, landing: str, store: Store, spec: GateSpec, run_id: str,
             as_of: str, gold: GoldFn | None = None, drift: str = "rescue", once: bool = True,
             with_row_count: bool = True, silver_mode: str = "upsert",
             repair_before_gate: bool = False) -> DataFrame:
    """Gate the files under ``landing`` as one run; returns the table counts.

    ``once`` (default): only files that no other run has loaded (see ``sources.manifest``);
    the same run again loads its own files again. Without it, every file."""
    if once:
        give_up_broken_runs(store, run_id, ((BRONZE, spec.batch_col), (QUARANTINE, "run_id")))
        lines = claim(spark, landing, store, run_id)
    else:
        lines = read_landing(spark, landing)
    gate_raw(spark, lines, store, spec, run_id, as_of, gold, with_row_count, drift, silver_mode, repair_before_gate)
    if once:
        mark_loaded(store, run_id)
    tables = [BRONZE, QUARANTINE, SILVER, METRICS] + (["gold_daily", "gold_region_category"]
                                                      if gold else [])
    return store.counts(tables)


def ingest_once_batch(spark: SparkSession, landing: str, store: Store, spec: GateSpec, run_id: str,
                      as_of: str, drift: str = "rescue") -> DataFrame:
    """Load the files under ``landing`` that no other run has loaded into bronze, as rows of
    ``run_id``; returns them. The same run again replaces its rows."""
    store.ensure(BRONZE, spec.table_schemas()[BRONZE])
    give_up_broken_runs(store, run_id, ((BRONZE, spec.batch_col),))
    write_bronze(claim(spark, landing, store, run_id), store, spec, run_id, F.lit(as_of).cast(spec.ts_type), drift)
    mark_loaded(store, run_id)
    return store.read(BRONZE).filter(F.col(spec.batch_col) == run_id)


def sales_gold(silver: DataFrame, spec: GateSpec, as_of) -> dict[str, DataFrame]:
    from ..operators.gold import gold_daily, gold_region_category
    return {"gold_daily": gold_daily(silver, spec, as_of),
            "gold_region_category": gold_region_category(silver, spec, as_of)}

"""Aggregate probes that feed the rules.

One ``groupBy(batch)`` pass computes the counts that a gate asks for, for every batch at
once (partial aggregation on the map side, so a hot batch or a hot key is collapsed before
the shuffle). Distinct keys are counted apart, so their exchange carries batch and key only.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.exprs import is_late, lag_hours, parse_event, rescued_keys
from ..spec import GateSpec

def _empty() -> Column:
    return F.array().cast("array<string>")


def _lit_array(names) -> Column:
    return F.array(*[F.lit(n) for n in names]) if names else _empty()


def _presence_aggs(spec: GateSpec) -> list[Column]:
    """Whether each contract column holds a value anywhere in the batch
    (declarative max, so the aggregate stays a codegen'd HashAggregate)."""
    return [F.max(F.col(c).isNotNull()).alias(f"_has_{c}") for c in spec.contract_names]


def rescued_key_sets(bronze: DataFrame, spec: GateSpec) -> DataFrame:
    """(batch, _rescued_keys): distinct lower-cased keys of the rescue JSON.

    Only rescued rows are read (a pushed-down IS NOT NULL on a stored bronze);
    explode + distinct are partially aggregated, so each task ships at most
    one row per (batch, key) name.
    """
    keys = (bronze.filter(F.col(spec.rescue_col).isNotNull())
            .select(spec.batch_col, F.explode(rescued_keys(spec)).alias("_k"))
            .distinct())
    return keys.groupBy(spec.batch_col).agg(F.collect_set("_k").alias("_rescued_keys"))


def _drift_columns(spec: GateSpec) -> list[Column]:
    """present / unexpected / missing arrays from the presence aggregates."""
    contract = [c.lower() for c in spec.contract_names]
    seen = F.array_compact(F.array(*[F.when(F.col(f"_has_{c}"), F.lit(c.lower()))
                                     for c in spec.contract_names]))
    present = F.array_sort(F.array_union(seen, F.coalesce(F.col("_rescued_keys"), _empty())))
    unexpected = F.array_sort(F.array_except(F.array_except(present, _lit_array(contract)),
                                             _lit_array([m.lower() for m in spec.meta])))
    missing = F.array_sort(F.array_except(_lit_array(contract), present))
    return [present.alias("present"), unexpected.alias("unexpected"), missing.alias("missing")]


def _with_drift(agg: DataFrame, bronze: DataFrame, spec: GateSpec) -> DataFrame:
    """Join the per-batch key sets (one tiny row per batch) and derive the arrays."""
    out = agg.join(rescued_key_sets(bronze, spec), spec.batch_col, "left")
    return out.select("*", *_drift_columns(spec)).drop(
        *[f"_has_{c}" for c in spec.contract_names], "_rescued_keys")


def _distinct(spec: GateSpec) -> Column:
    if spec.distinct_rsd is None:
        return F.count_distinct(F.col(spec.key))
    return F.approx_count_distinct(F.col(spec.key), spec.distinct_rsd)


#: What a probe can count. ``nulls`` per required column; ``freshness``: newest event time,
#: check time and lag; ``drift``: present, unexpected and missing keys.
COUNTERS = frozenset({"total", "nulls", "rescued", "distinct_keys", "late", "freshness", "drift"})


def counters(spec: GateSpec, need: frozenset[str] | set[str] = COUNTERS, as_text: bool = False) -> list[Column]:
    """The aggregates that need no key, over rows with the parsed event time in ``_ts``.
    They can also be observed while the rows are written (the newest time ``as_text`` then:
    it passes through Python)."""
    ts, aggs = F.col("_ts"), []
    if "total" in need:
        aggs.append(F.count(F.lit(1)).alias("total"))
    if "nulls" in need:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in spec.required]
    if "rescued" in need:
        aggs.append(F.count_if(F.col(spec.rescue_col).isNotNull()).alias("rescued"))
    if "late" in need:
        aggs.append(F.count_if(F.col(spec.event_col).isNotNull() & is_late(spec, ts)).alias("late"))
    if "freshness" in need:
        newest = F.max(ts)
        aggs.append((newest.cast("string") if as_text else newest).alias("max_event_ts"))
    return aggs


def bronze_probe(bronze: DataFrame, spec: GateSpec, check_ts: Column | None = None,
                 with_drift: bool = True, run_id: str | None = None,
                 need: frozenset[str] | set[str] = COUNTERS) -> DataFrame:
    """One row per batch with the counters that ``need`` names: total, null_<required>,
    rescued, distinct_keys, late, max_event_ts, check_ts, lag_hours (+ present/unexpected/
    missing). check_ts is always there.

    ``check_ts`` is the moment the batch is checked (an ``as_of`` literal or a
    column over the batch id); freshness is measured against it. The event
    time is parsed once per row, in the projection under the aggregate.

    The keyless counters are one small row per task and batch. The distinct keys are an
    aggregate of their own over (batch, key) alone, so only these two columns are shuffled.

    With ``run_id`` the input is one run's slice and the probe is a global
    aggregate: an empty run still yields its one row (total 0), so an empty
    rerun is logged rather than silently skipped.
    """
    need = set(need) - (set() if with_drift else {"drift"})
    aggs = counters(spec, need)
    if "drift" in need:
        aggs += _presence_aggs(spec)
    if not aggs:
        aggs = counters(spec, {"total"})
    src = bronze.withColumn("_ts", parse_event(spec))
    if run_id is None:
        out = src.groupBy(spec.batch_col).agg(*aggs)
        if "distinct_keys" in need:
            keys = bronze.groupBy(F.col(spec.batch_col).alias("_batch")).agg(_distinct(spec).alias("distinct_keys"))
            out = out.join(keys, F.col(spec.batch_col).eqNullSafe(F.col("_batch"))).drop("_batch")
    else:
        out = src.agg(*aggs).select(F.lit(run_id).alias(spec.batch_col), "*")
        if "distinct_keys" in need:
            out = out.withColumn("distinct_keys", bronze.agg(_distinct(spec)).scalar())
    if "drift" in need:
        out = _with_drift(out, bronze, spec)
    check_ts = F.lit(None).cast(spec.ts_type) if check_ts is None else check_ts
    out = out.withColumn("check_ts", check_ts.cast(spec.ts_type))
    return out.withColumn("lag_hours", lag_hours(F.col("max_event_ts"), F.col("check_ts"))) if "freshness" in need else out


def observed_probe(spark: SparkSession, seen: dict, distinct: DataFrame, spec: GateSpec, run_id: str, check_ts: Column) -> DataFrame:
    """The probe row of one run from counters observed while its rows were written
    (``max_event_ts`` as text), and the one-row frame ``distinct`` of its distinct keys."""
    row = [F.lit(run_id).alias(spec.batch_col), F.lit(seen["total"]).cast("bigint").alias("total")]
    row += [F.lit(seen[f"null_{c}"]).cast("bigint").alias(f"null_{c}") for c in spec.required]
    row += [F.lit(seen[c]).cast("bigint").alias(c) for c in ("rescued", "late")]
    row += [distinct.scalar().alias("distinct_keys"), F.lit(seen["max_event_ts"]).cast(spec.ts_type).alias("max_event_ts"),
            check_ts.cast(spec.ts_type).alias("check_ts")]
    return spark.range(1).select(*row).withColumn("lag_hours", lag_hours(F.col("max_event_ts"), F.col("check_ts")))


def distinct_count(batch: DataFrame, spec: GateSpec) -> DataFrame:
    """One row: the distinct non-NULL keys of a run's slice; only its key column is read."""
    return batch.agg(_distinct(spec).alias("distinct_keys"))


def drift_of_keys(probe: DataFrame, batch: DataFrame, spec: GateSpec, present: list[str], ignored: tuple[str, ...] = ()) -> DataFrame:
    """``probe`` (one run) with present, unexpected and missing: the contract keys
    ``present`` and the rescued (or, with an evolved table, added) keys of ``batch``."""
    found = rescued_key_sets(batch, spec).agg(F.array_distinct(F.flatten(F.collect_list("_rescued_keys"))).alias("k"))
    own = {c.lower() for c in (*spec.contract_names, *spec.meta)}
    added = [c for c in batch.columns if c.lower() not in own and c != "_more"]
    keys = F.array_except(F.coalesce(found.scalar(), _empty()), _lit_array(ignored))
    if added:
        flags = batch.agg(F.array_compact(F.array(*[F.when(F.max(F.col(f"`{c}`").isNotNull()), F.lit(c.lower())) for c in added])).alias("k"))
        keys = F.array_union(keys, flags.scalar())
    if "_more" in batch.columns:
        tail = batch.filter(F.col("_more").isNotNull()).select(F.explode(F.map_keys("_more")).alias("k")).distinct().agg(F.collect_set(F.lower("k")).alias("k"))
        keys = F.array_union(keys, F.coalesce(tail.scalar(), _empty()))
    contract, meta = _lit_array([c.lower() for c in spec.contract_names]), _lit_array([m.lower() for m in spec.meta])
    out = probe.withColumn("present", F.sort_array(F.array_union(_lit_array(sorted(c.lower() for c in present)), keys)))
    return out.withColumns({"unexpected": F.sort_array(F.array_except(F.array_except("present", contract), meta)),
                            "missing": F.sort_array(F.array_except(contract, "present"))})


def column_drift(bronze: DataFrame, spec: GateSpec) -> DataFrame:
    """Per batch: present keys, unexpected = present - contract - meta,
    missing = contract - present (lower-cased, sorted)."""
    agg = bronze.groupBy(spec.batch_col).agg(*_presence_aggs(spec))
    return _with_drift(agg, bronze, spec).select(spec.batch_col, "present", "unexpected",
                                                 "missing")


def column_drift_raw(raw: DataFrame, spec: GateSpec, value_col: str = "value") -> DataFrame:
    """Same as :func:`column_drift` but from raw JSON text, where a key that is
    present with an explicit null still counts as present.

    Keys are exploded and de-duplicated per (batch, key) with a partial
    aggregate and a shuffle, so the only collected list per batch holds
    distinct column *names* (bounded by the width of the feed's schema).
    """
    parsed = (F.col("_m") if "_m" in raw.columns
              else F.from_json(F.col(value_col), "map<string,string>"))
    keys = F.explode(F.transform(F.map_keys(parsed), lambda k: F.lower(k)))
    contract = [c.lower() for c in spec.contract_names]
    names = (raw.select(spec.batch_col, keys.alias("_k")).distinct()
             .groupBy(spec.batch_col).agg(F.array_sort(F.collect_list("_k")).alias("present")))
    batches = raw.select(spec.batch_col).distinct()
    present = F.coalesce(F.col("present"), _empty())
    return (batches.join(names, spec.batch_col, "left")
            .select(spec.batch_col, present.alias("present"))
            .select(spec.batch_col, "present",
                    F.array_sort(F.array_except(F.array_except("present", _lit_array(contract)),
                                                _lit_array([m.lower() for m in spec.meta])))
                    .alias("unexpected"),
                    F.array_sort(F.array_except(_lit_array(contract), "present")).alias("missing")))


def null_counts(bronze: DataFrame, spec: GateSpec) -> DataFrame:
    """Per batch and required column: (column_name, null_count, total)."""
    agg = bronze.groupBy(spec.batch_col).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in spec.required])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.col(f"null_{c}").alias("null_count")) for c in spec.required])
    return agg.select(spec.batch_col, "total", F.inline(pairs))


def distinct_keys(bronze: DataFrame, spec: GateSpec) -> DataFrame:
    """Exact count of distinct non-NULL keys per batch (NULL keys count as duplicates)."""
    return bronze.groupBy(spec.batch_col).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(F.col(spec.key)).alias("distinct_keys"))


def late_count(bronze: DataFrame, spec: GateSpec) -> DataFrame:
    return bronze.groupBy(spec.batch_col).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(spec.event_col).isNotNull() & is_late(spec)).alias("late"))


def freshness_lag(bronze: DataFrame, spec: GateSpec, check_ts: Column) -> DataFrame:
    """Hours from the newest valid event time to ``check_ts``; NULL if none."""
    return (bronze.groupBy(spec.batch_col).agg(F.max(parse_event(spec)).alias("max_event_ts"))
            .withColumn("check_ts", check_ts.cast(spec.ts_type))
            .withColumn("lag_hours", lag_hours(F.col("max_event_ts"), F.col("check_ts"))))


def silver_freshness(silver: DataFrame, spec: GateSpec, as_of: Column) -> DataFrame:
    """Row count and lag over the whole silver table (one row)."""
    return silver.agg(F.count(F.lit(1)).alias("silver_rows"),
                      lag_hours(F.max(F.col(spec.event_col)), as_of.cast(spec.ts_type))
                      .alias("lag_hours"))


def trailing_avg(log: DataFrame, run_id: str) -> DataFrame:
    """Mean bronze row count of every *other* run in the log (one row, NULL if none)."""
    return (log.filter((F.col("rule_name") == "row_count_anomaly") & (F.col("run_id") != run_id))
            .agg(F.avg("metric_value").alias("trailing_avg")))


def with_trailing_avg(probe: DataFrame, order: str | list[str], last_n: int | None = None) -> DataFrame:
    """Add the mean ``total`` of all earlier batches (prior-only) to a probe, in the order
    of the given columns (check time, then run id: "10" comes after "2" if it ran later).

    The probe holds one row per batch, so this window sees one tiny row per
    run, never the data rows themselves.
    """
    start = Window.unboundedPreceding if last_n is None else -last_n
    order = [order] if isinstance(order, str) else order
    w = Window.orderBy(*[F.col(c).asc() for c in order]).rowsBetween(start, -1)
    return probe.withColumn("trailing_avg", F.avg(F.col("total").cast("double")).over(w))

"""Conform good rows to the silver contract and keep one row per key."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import (conform_columns, good_row, is_late, parse_event,
                               repaired_amount)
from ..spec import GateSpec


def conform_types(df: DataFrame, spec: GateSpec) -> DataFrame:
    """try_cast the configured columns and parse the event time (bad -> NULL)."""
    out = df
    for name, typ in spec.casts:
        out = out.withColumn(name, F.col(name).try_cast(typ))
    return out.withColumn(spec.event_col, parse_event(spec))


def conform_defaults(df: DataFrame, spec: GateSpec) -> DataFrame:
    """upper(coalesce(col, default)) for each configured column."""
    out = df
    for name, default in spec.defaults:
        out = out.withColumn(name, F.upper(F.coalesce(F.col(name), F.lit(default))))
    return out


def repair_amount(df: DataFrame, spec: GateSpec) -> DataFrame:
    """target = coalesce(target, left * right)."""
    return df.withColumn(spec.repair[0], repaired_amount(spec))


def derive_order_date(df: DataFrame, spec: GateSpec) -> DataFrame:
    return df.withColumn(spec.date_col, parse_event(spec).cast("date"))


def flag_late(df: DataFrame, spec: GateSpec) -> DataFrame:
    """is_late = ingest > event + late_hours (strict)."""
    return df.withColumn(spec.late_col, is_late(spec))


def exclude_cancelled(silver: DataFrame, spec: GateSpec) -> DataFrame:
    return silver.filter(F.col(spec.status_col) != F.lit(spec.cancelled_value))


def conform(good: DataFrame, spec: GateSpec, run_id: Column | None = None) -> DataFrame:
    """Silver projection of (already gated) good rows; run id defaults to the batch id."""
    run_id = F.col(spec.batch_col).cast("string") if run_id is None else run_id
    return good.select(*conform_columns(spec, run_id))


def silver_order(spec: GateSpec) -> list[str]:
    """Dedup tie-break: newest ingest, newest event, then every other output
    column, all descending, so the survivor never depends on task order."""
    first = [spec.ingest_col, spec.event_col]
    rest = [c for c in spec.silver_columns() if c not in first and c != spec.key]
    return first + rest + list(spec.extra_order)


def dedup_latest(df: DataFrame, key: str, order_cols: list[str], within: tuple[str, ...] = ()) -> DataFrame:
    """Keep one row per key: the first by ``order_cols`` descending, NULLs last.
    Rows that are already dealt out by columns ``within``, which follow from the key,
    stay where they are.

    ``row_number() = 1`` is planned with WindowGroupLimit, which also runs
    before the shuffle, so a key holding a third of all rows is cut to one row
    per map task before it is exchanged.
    """
    w = Window.partitionBy(*within, key).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


#: A key is hot with more rows than this, and more than one in HOT_SHARE of all.
HOT_ROWS, HOT_SHARE = 10_000, 1000


def limit_hot_keys(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """``df`` with the rows of its hot keys cut to one a key, as :func:`dedup_latest` does
    it (before their shuffle), and all other rows as they are. Reads the keys at once: a
    sketch of their most frequent hashes, at most HOT_SHARE of which can be hot."""
    h = F.xxhash64(key)
    top, n = df.select(h.alias("h")).agg(F.expr(f"approx_top_k(h, {HOT_SHARE}, 10000)"), F.count(F.lit(1))).first()
    hot = [t["item"] for t in top or [] if t["count"] > max(HOT_ROWS, n // HOT_SHARE)]
    if not hot:
        return df
    return df.filter(~h.isin(hot)).unionByName(dedup_latest(df.filter(h.isin(hot)), key, order_cols))


def build_silver(batch: DataFrame, spec: GateSpec, run_id: Column | None = None) -> DataFrame:
    """good rows -> conform -> one row per key. NULL keys are bad rows, so they
    are gone before the key shuffle (no hot NULL partition)."""
    silver = conform(batch.filter(good_row(spec)), spec, run_id)
    return dedup_latest(silver, spec.key, silver_order(spec))


__all__ = ["conform_types", "conform_defaults", "repair_amount", "derive_order_date",
           "flag_late", "exclude_cancelled", "conform", "silver_order", "dedup_latest",
           "limit_hot_keys", "build_silver"]

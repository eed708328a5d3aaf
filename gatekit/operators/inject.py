"""Anomaly injection as deterministic DataFrame transforms.

Each row draws a pseudo-random roll from its own numeric id,
``pmod(id * 7919 + 13, 1000)`` per mille, so the same rows are hit on every run
and on every engine (no ``rand()``, no driver-side generator). Shares follow
the classic generator: of an anomaly rate r, 0.4 r of rows get a NULL in one
required field, the next 0.2 r are backdated (exclusive with nulls), 0.15 r
are emitted twice, and a whole batch drifts with probability r.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the classic generator.
NULL_SHARE, LATE_SHARE, DUP_SHARE = 0.4, 0.2, 0.15
LATE_DAYS = (2, 30)          # inclusive
LATE_MINUTES = (0, 1440)     # inclusive
DRIFT_MODES = ("extra", "missing", "renamed")
# Sales-contract drift: extra keys and their values, dropped keys, renames.
SALES_DISCOUNT_CODES = ("SAVE10", "FREESHIP", "VIP20", "NONE")
SALES_LOYALTY_TIERS = ("BRONZE", "SILVER", "GOLD")
SALES_MISSING = ("store_region", "payment_method")
SALES_RENAMED = (("unit_price", "price"), ("product_category", "category"))


def roll(id_col: str, a: int = 7919, b: int = 13) -> Column:
    """Deterministic integer in [0, 1000) from a non-negative integer id
    (per mille, so every threshold compare is exact)."""
    return F.pmod(F.col(id_col) * a + b, F.lit(1000))


def per_mille(x: float) -> int:
    return int(round(x * 1000))


def inject_nulls(df: DataFrame, id_col: str, columns: list[str], rate: float) -> DataFrame:
    """Rows with roll < 0.4 r get one of ``columns`` (chosen by id) set NULL.
    ``_null_style`` says whether a JSON render writes it as null or drops the key."""
    hit = roll(id_col) < per_mille(NULL_SHARE * rate)
    pick = F.pmod(F.col(id_col), F.lit(len(columns)))
    out = df
    for i, c in enumerate(columns):
        out = out.withColumn(c, F.when(hit & (pick == i), F.lit(None)).otherwise(F.col(c)))
    turn = F.pmod(F.call_function("div", F.col(id_col), F.lit(len(columns))), F.lit(2))  # each column gets both styles
    style = F.when(hit, F.when(turn == 0, "null").otherwise("missing"))
    which = F.when(hit, F.element_at(F.array(*[F.lit(c) for c in columns]), (pick + 1).cast("int")))
    return out.withColumn("_null_style", style).withColumn("_null_col", which)


def inject_late(df: DataFrame, id_col: str, ts_col: str, as_of: Column, rate: float) -> DataFrame:
    """Rows with 0.4 r <= roll < 0.6 r: event time = as_of - (2..30 days + 0..1440 min)."""
    r = roll(id_col)
    hit = (r >= per_mille(NULL_SHARE * rate)) & (r < per_mille((NULL_SHARE + LATE_SHARE) * rate))
    days = F.pmod(F.col(id_col), F.lit(LATE_DAYS[1] - LATE_DAYS[0] + 1)) + LATE_DAYS[0]
    mins = F.pmod(F.col(id_col), F.lit(LATE_MINUTES[1] - LATE_MINUTES[0] + 1)) + LATE_MINUTES[0]
    back = as_of - F.make_dt_interval(days.cast("int"), F.lit(0), mins.cast("int"))
    typ = df.schema[ts_col].dataType.simpleString()
    return (df.withColumn(ts_col, F.when(hit, back.cast(typ)).otherwise(F.col(ts_col)))
              .withColumn("_late", hit))


def inject_drift(df: DataFrame, batch_num: Column, rate: float) -> DataFrame:
    """Whole batches drift with probability r; the mode follows the batch number."""
    b = batch_num.cast("long")
    hit = F.pmod(b * 7919 + 13, F.lit(1000)) < per_mille(rate)
    mode = F.element_at(F.array(*[F.lit(m) for m in DRIFT_MODES]),
                        (F.pmod(b, F.lit(len(DRIFT_MODES))) + 1).cast("int"))
    return df.withColumn("_drift", F.when(hit, mode))


def apply_drift(df: DataFrame, extra: dict[str, Column], missing: list[str],
                renamed: dict[str, str]) -> DataFrame:
    """Typed view of drifted rows: extra columns appear, missing ones go NULL,
    renamed ones move their value to the new name."""
    d = F.col("_drift")
    out = df
    for name, expr in extra.items():
        out = out.withColumn(name, F.when(d == "extra", expr))
    for old, new in renamed.items():
        out = out.withColumn(new, F.when(d == "renamed", F.col(old)))
    for c in missing:
        out = out.withColumn(c, F.when(d.isNull() | (d != "missing"), F.col(c)))
    for old in renamed:
        out = out.withColumn(old, F.when(d.isNull() | (d != "renamed"), F.col(old)))
    return out


def inject_duplicates(df: DataFrame, id_col: str, rate: float) -> DataFrame:
    """Rows with a second roll < 0.15 r are emitted twice (``_copy`` = 1, 2)."""
    hit = roll(id_col, 104729, 7) < per_mille(DUP_SHARE * rate)
    return (df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(hit, 2).otherwise(1))))
              .withColumn("_dup", hit))


def injection_stats(df: DataFrame, batch_col: str) -> DataFrame:
    """Per batch: rows, injected nulls, late, duplicate copies, drifted, clean."""
    nulls = F.col("_null_style").isNotNull()
    late = F.coalesce(F.col("_late"), F.lit(False))
    return df.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(nulls & (F.col("_copy") == 1)).alias("nulls"),
        F.count_if(late & (F.col("_copy") == 1)).alias("late"),
        F.count_if(F.col("_copy") == 2).alias("duplicates"),
        F.count_if(F.col("_drift").isNotNull() & (F.col("_copy") == 1)).alias("schema_drift"),
        F.count_if(~nulls & ~late & (F.col("_copy") == 1)).alias("clean"))


def inject_batch(df: DataFrame, id_col: str, ts_col: str, batch_num: Column, as_of: Column,
                 rate: float, null_columns: list[str]) -> DataFrame:
    """nulls / late -> drift -> duplicates, in the classic order."""
    out = inject_nulls(df, id_col, null_columns, rate)
    out = inject_late(out, id_col, ts_col, as_of, rate)
    out = inject_drift(out, batch_num, rate)
    return inject_duplicates(out, id_col, rate)


def sales_drift(df: DataFrame, pick_col: str = "quantity") -> DataFrame:
    """The classic drift modes on the sales contract; the extra values are
    picked by ``pick_col`` modulo the list length (deterministic)."""
    def choose(values):
        arr = F.array(*[F.lit(v) for v in values])
        return F.element_at(arr, (F.pmod(F.col(pick_col), F.lit(len(values))) + 1).cast("int"))
    return apply_drift(df, {"discount_code": choose(SALES_DISCOUNT_CODES),
                            "loyalty_tier": choose(SALES_LOYALTY_TIERS)},
                       list(SALES_MISSING), dict(SALES_RENAMED))

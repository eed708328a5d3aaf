"""Mixing sources to target weights: capped water-filling, seeded repetitions.

The mix has ``share`` of all words. Each source gets a part of it by its weight, at most
``epochs`` times its size; what a clamped source cannot take is dealt to the others by
weight, round by round, until none lies above its cap (a round is one aggregate over the
sources, and clamps one source at least). A source's target over its size is its number
of repetitions: each document is taken the whole number of times, and the fraction is
filled by documents in a seeded order. That order has ``BUCKETS`` steps: documents whose
step lies before the last one that fits are taken once more, and those of the last step
by the fraction that is left, so a source misses its target by less than a word per
document of one step, however large a single document is. A step is found from sums per
(source, step), which are made before the shuffle; no source's documents meet in a task.

The step of a document is a hash of seed, id and text, so reruns and any partitioning
agree, and repeated rows (equal id and text) are treated alike.

Cases: a null text has size 0; a null source is a source of its own, the last one; a
source without words has target 0; a null id is an id like others; an empty table gives
an empty result; other columns are ignored, whatever their names. Texts of any length
are counted whole.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatekit.llm.common import stored
from gatekit.llm.sharding import numbered

#: Steps of the seeded order inside a source.
BUCKETS = 1 << 12
#: Weights by the place of a source in code point order, repeating.
WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"


def source_table(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """(source, source_size, weight), one row per source; null comes last."""
    found = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = found.select("source", "source_size", F.col("source").isNull().cast("int").alias("last"), F.coalesce("source", F.lit("")).alias("name"))
    ranked, _ = numbered(rows, ["last", "name"])
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("row_number") % len(weights) + 1).cast("int"))
    return stored(ranked.select("source", "source_size", weight.cast("long").alias("weight")), "sources")


def water_level(sources: DataFrame, share: tuple[int, int], epochs: int) -> tuple[int, int] | None:
    """(words, weight): a source that is not clamped gets words * its weight / weight.
    None if every source is clamped. Exact: all sums are integers."""
    num, den = share
    cap = F.col("source_size") * (epochs * den)  # everything in units of 1 / den words
    row = sources.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    left, weight, clamped = (row.n or 0) * num, row.w or 0, -1
    while weight:
        over = cap.cast("decimal(38,0)") * weight < F.lit(left).cast("decimal(38,0)") * F.col("weight")
        row = sources.filter(over).agg(F.count(F.lit(1)).alias("n"), F.sum(cap).alias("cap"), F.sum("weight").alias("w")).first()
        if row.n == clamped or not row.n:
            return left, weight * den
        total = sources.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
        left, weight, clamped = total.n * num - row.cap, total.w - row.w, row.n
    return None


def with_targets(sources: DataFrame, share: tuple[int, int], epochs: int) -> DataFrame:
    """``sources`` with ``target`` (double)."""
    cap = (F.col("source_size") * epochs).cast("double")
    level = water_level(sources, share, epochs)
    if level is None:
        return sources.withColumn("target", cap)
    words, weight = level
    return sources.withColumn("target", F.least(cap, F.lit(float(words)) * F.col("weight") / F.lit(float(weight))))


def _step(seed: int, id: Column, text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), id, text), 64 - (BUCKETS.bit_length() - 1)).cast("int")


def mix(docs: DataFrame, share: tuple[int, int] = (3, 2), epochs: int = 2, weights: tuple[int, ...] = WEIGHTS, seed: int = 0,
        id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, repeats
    (taken in times of the document). ``share``: words of the mix as a fraction of all."""
    sizes = stored(docs.select(
        F.col(id).alias("doc_id"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _step(seed, F.col(id), F.col(text)).alias("step")), "sizes")
    sources = with_targets(source_table(sizes, weights), share, epochs)
    n = F.col("source_size")
    whole = F.when(n > 0, F.least(F.floor(F.col("target") / n), F.lit(epochs))).otherwise(0).cast("long")
    more = sources.withColumn("whole", whole).withColumn("rest", F.round(F.col("target") - F.col("whole") * n).cast("long"))
    # the last step that fits, per source: at most BUCKETS sums each
    sums = sizes.groupBy("source", "step").agg(F.sum("size").alias("words"))
    before = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = (sums.withColumn("before", before).alias("s").join(more.alias("m"), F.col("s.source").eqNullSafe(F.col("m.source")))
           .filter((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
           .select(F.col("m.source").alias("source"), "step", "words", (F.col("rest") - F.col("before")).alias("fill")))
    plan = stored(more.alias("m").join(cut.alias("c"), F.col("m.source").eqNullSafe(F.col("c.source")), "left").select(
        F.col("m.source").alias("p_source"), "source_size", "target", "whole", "rest",
        F.coalesce("step", F.lit(BUCKETS)).alias("p_step"), F.coalesce("fill", F.lit(0)).alias("fill"), F.coalesce("words", F.lit(1)).alias("words")), "mix")
    size = F.col("size")
    # a source whose rest is 0 has its cut at its first step with words, filled by 0
    part = F.expr("(cast(size AS decimal(19, 0)) * cast(fill AS decimal(19, 0))) div words").cast("long")
    extra = F.when(F.col("rest") <= 0, 0).when(F.col("step") < F.col("p_step"), size).when(F.col("step") == F.col("p_step"), part).otherwise(0)
    taken = size * F.col("whole") + extra
    return sizes.join(plan, F.col("source").eqNullSafe(F.col("p_source"))).select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"),
        F.when(size > 0, taken / size).otherwise(0.0).alias("repeats"))

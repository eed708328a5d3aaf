"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered 0 to N - 1 in the order of their key, digest and size (so the numbers
do not depend on how the input is partitioned). A balanced Feistel network over the
smallest even number of bits that holds N permutes the numbers; a result of N or more is
permuted again until it falls below N (cycle walking), which makes it a permutation of
0 .. N - 1. Row p of the permuted order lies in shard ``p % shards`` at slot
``p // shards``: shard sizes differ by one row at most (law ``rows``), and the place of a
row, or the row at a place, is computed without looking at any other row.

The numbers come from a range partitioning (sampled bounds, so a cluster of equal keys is
split by the further sort columns) and the row counts of the partitions.

Cases: rows with a null key come first; a null text has size ``overhead``. Repeated rows
get numbers of their own in any order among themselves: being equal, either order gives
the same table. An empty table gives an empty result. Other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatekit.llm.common import stored

ROUNDS = 6


def _half_bits(n: int) -> int:
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def _round(x: np.ndarray, key: int, r: int, mask: int) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64((key * 0xD1342543DE82EF95 + (r + 1) * 0xA0761D6478BD642F) % (1 << 64))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x & np.uint64(mask)


def _walk(x: np.ndarray, n: int, once) -> np.ndarray:
    x = once(np.asarray(x, np.uint64))
    out = np.flatnonzero(x >= n)
    while len(out):
        x[out] = once(x[out])
        out = out[x[out] >= n]
    return x.astype(np.int64)


def permute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """Where the rows numbered ``x`` (each below n) go."""
    bits = _half_bits(n)
    mask = (1 << bits) - 1

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(bits), v & np.uint64(mask)
        for r in range(ROUNDS):
            left, right = right, left ^ _round(right, key, r, mask)
        return (left << np.uint64(bits)) | right
    return _walk(x, n, once)


def unpermute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """The rows that stand at the places ``x``."""
    bits = _half_bits(n)
    mask = (1 << bits) - 1

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(bits), v & np.uint64(mask)
        for r in reversed(range(ROUNDS)):
            left, right = right ^ _round(left, key, r, mask), left
        return (left << np.uint64(bits)) | right
    return _walk(x, n, once)


def permuted(number: Column, n: int, key: int) -> Column:
    @F.pandas_udf("long")
    def place(x: pd.Series) -> pd.Series:
        return pd.Series(permute(x.to_numpy(), n, key))
    return place(number)


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` from 0 in the given order, and how many there are."""
    # the row's place in its split parts equal rows, so no key is too hot for a range
    cut = rows.withColumn("__at", F.monotonically_increasing_id()).repartitionByRange(*order, "__at").sortWithinPartitions(*order, "__at")
    local = F.monotonically_increasing_id()
    kept = stored(cut.drop("__at").withColumn("__part", F.shiftright(local, 33)).withColumn("__pos", local.bitwiseAND(F.lit((1 << 33) - 1))), "numbered")
    counts = kept.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # one row per partition of the range exchange
    first = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col("__part").alias("__p"), F.coalesce(first, F.lit(0)).alias("__first"))
    out = kept.join(F.broadcast(starts), F.col("__part") == F.col("__p"))
    return out.withColumn("row_number", F.col("__first") + F.col("__pos")).drop("__part", "__pos", "__p", "__first"), kept.count()


def shard(docs: DataFrame, shards: int, key: int = 42, id: str = "doc_id", text: str = "text", overhead: int = 16) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard
    (null: only laws by key say where one more shard would take a row), row_number."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(id).alias("doc_id"), (F.octet_length(body) + overhead).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    out, n = numbered(rows, ["doc_id", "text_crc32", "size"])
    p = F.col("__place")
    return out.withColumn("__place", permuted(F.col("row_number"), n, key)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (p % shards).cast("int").alias("shard"),
        F.expr(f"__place div {shards}").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row_number")

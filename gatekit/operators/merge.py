"""What an upsert does to each row of its source."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"


def row_digest(columns: list[str]) -> Column:
    """SHA-256 over the columns in their order, nulls told apart from each other's places,
    as its 32 bytes: half of what its text would shuffle."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"}), 256))


def merge_actions(target: DataFrame, source: DataFrame, key: str, compare: list[str] | None = None) -> DataFrame:
    """``source`` with ``action``: insert (its key is new to ``target``), update (another
    row is there) or unchanged (an equal one, by a digest of ``compare``, default all other
    columns). One join; the target sends its key and digest only. Both sides hold a key
    once; a null key is never matched."""
    columns = sorted(set(compare or source.columns) - {key})
    there = target.select(F.col(key).alias("_key"), row_digest(columns).alias("_there"))
    action = (F.when(F.col("_there").isNull(), INSERT)
              .when(F.col("_there") == F.col("_here"), UNCHANGED).otherwise(UPDATE))
    return (source.withColumn("_here", row_digest(columns)).join(there, F.col(key) == F.col("_key"), "left")
            .select(*[F.col(c) for c in source.columns], action.alias("action")))

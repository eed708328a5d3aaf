"""Bind the driver's ``events`` table to a JSON landing zone.

Each event becomes one JSON line; its batch is its day. Drift is injected
per row by ``event_id % 10`` so that every kind the rescue column must catch
appears, and DuckDB can predict the outcome from the same arithmetic:

  3 -> extra key ``coupon``          5 -> ``value`` renamed to ``amount``
  7 -> ``value`` holds text "n/a"    9 -> line cut after 20 characters
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..spec import GateSpec
from .landing import render_json
from .testbind import table

EVENTS_CONTRACT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

EVENTS = GateSpec(
    contract=EVENTS_CONTRACT, key="event_id",
    required=("event_id", "ts", "user_id", "event_type"),
    event_col="ts", ts_type="timestamp_ntz",
    layer="bronze", table_name="bronze_events", silver_table="silver_events",
    casts=(("value", "double"),), defaults=(("event_type", "UNKNOWN"),), repair=None,
    date_col="event_date", status_col="event_type", cancelled_value="ERROR",
)

EVENTS_AS_OF = "2024-01-31 00:00:00"
EPOCH = "2024-01-01"
CUT = 20


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def event_day(ts: str = "ts"):
    return F.date_format(F.col(ts), "yyyy-MM-dd")


def events_json(spark: SparkSession, sf_dir: str, drift: bool = True) -> DataFrame:
    """(value, _batch_id): one JSON line per event, batch = event day."""
    e = events(spark, sf_dir).withColumn("_batch_id", event_day())
    ts = F.col("ts").cast("string").alias("ts")
    base = [F.col("event_id"), ts, F.col("user_id"), F.col("event_type"), F.col("value"),
            F.col("props")]
    if not drift:
        return render_json(e, base, keep=("_batch_id",))
    mode = F.col("event_id") % 10
    clean = F.to_json(F.struct(*base))
    extra = F.to_json(F.struct(*base, F.concat(F.lit("C"), (F.col("event_id") % 7).cast("string"))
                               .alias("coupon")))
    renamed = F.to_json(F.struct(*base[:4], F.col("value").alias("amount"), F.col("props")))
    mistyped = F.to_json(F.struct(*base[:4], F.lit("n/a").alias("value"), F.col("props")))
    text = (F.when(mode == 3, extra).when(mode == 5, renamed).when(mode == 7, mistyped)
            .when(mode == 9, F.substring(clean, 1, CUT)).otherwise(clean))
    return e.select(text.alias("value"), "_batch_id")

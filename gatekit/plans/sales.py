"""The medallion run over the sales binding, all batches at once.

Every frame here is lazy and derived from the driver's tables, so each
registered query grows with them. Batches are evaluated together with
``groupBy(_batch_id)`` instead of one job per run.
"""
from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.rules import NEEDS
from ..functions.exprs import good_row
from ..operators.conform import build_silver, conform, silver_order
from ..operators.evaluate import evaluate_all, freshness_metric
from ..operators.gate import quarantine_rows
from ..operators.gold import gold_daily, gold_region_category
from ..operators.probe import bronze_probe, silver_freshness, with_trailing_avg
from ..session import path_exists, scratch_dir
from ..sources.store import Store
from ..sources.testbind import (AS_OF, N_BATCHES, SALES_NTZ, batch_check_ts,
                                stored_sales_bronze)

SILVER_CHECK = "2002-01-01 04:00:00"   # as_of + (N_BATCHES - 1) hours
LAST_RUN = str(N_BATCHES - 1)


def drop_detail(df: DataFrame) -> DataFrame:
    """Value-hashed outputs leave out the free-text ``detail`` (float formatting
    differs between engines); the library itself always writes it."""
    return df.drop("detail")


def arrays_as_text(df: DataFrame, cols=("present", "unexpected", "missing")) -> DataFrame:
    for c in cols:
        if c in df.columns:
            df = df.withColumn(c, F.array_join(F.col(c), ","))
    return df


class SalesRun:
    """Lazily built layers of one end-to-end run over the sales binding."""

    def __init__(self, spark: SparkSession, sf_dir: str, spec=SALES_NTZ):
        self.spark, self.sf_dir, self.spec = spark, sf_dir, spec

    @cached_property
    def bronze(self) -> DataFrame:
        return stored_sales_bronze(self.spark, self.sf_dir)

    @property
    def as_of(self):
        return F.lit(AS_OF).cast(self.spec.ts_type)

    @cached_property
    def probe(self) -> DataFrame:
        p = bronze_probe(self.bronze, self.spec, batch_check_ts(self.spec))
        return with_trailing_avg(p, ["check_ts", self.spec.batch_col])

    @cached_property
    def bronze_metrics(self) -> DataFrame:
        return evaluate_all(self.probe, self.spec)

    @cached_property
    def quarantine(self) -> DataFrame:
        return quarantine_rows(self.bronze, self.spec, batch_check_ts(self.spec))

    @cached_property
    def silver(self) -> DataFrame:
        return build_silver(self.bronze, self.spec)

    @cached_property
    def silver_metric(self) -> DataFrame:
        check = F.lit(SILVER_CHECK).cast(self.spec.ts_type)
        fresh = silver_freshness(self.silver, self.spec, check)
        return freshness_metric(fresh, self.spec, F.lit(LAST_RUN), check, "silver",
                                self.spec.silver_table)

    @property
    def stored_silver_metric(self) -> DataFrame:
        """The freshness row of the stored silver: no dedup, two columns read."""
        check = F.lit(SILVER_CHECK).cast(self.spec.ts_type)
        return freshness_metric(silver_freshness(self.table("silver"), self.spec, check), self.spec, F.lit(LAST_RUN),
                                check, "silver", self.spec.silver_table)

    def rule(self, name: str) -> DataFrame:
        """The log rows of one rule, from a probe that counts no more than it reads."""
        p = bronze_probe(self.bronze, self.spec, batch_check_ts(self.spec), need=NEEDS[name])
        rows = evaluate_all(p, self.spec, with_row_count=False, only=(name,))
        return rows.unionByName(self.stored_silver_metric) if name == "freshness_sla" else rows

    @cached_property
    def metrics(self) -> DataFrame:
        return self.bronze_metrics.unionByName(self.silver_metric)

    @cached_property
    def gold_daily(self) -> DataFrame:
        return gold_daily(self.silver, self.spec, self.as_of)

    @cached_property
    def gold_rc(self) -> DataFrame:
        return gold_region_category(self.silver, self.spec, self.as_of)

    # ------------------------------------------------------------------ #
    # the stored layers, as the gate writes them (read by the dashboard tiles)
    # ------------------------------------------------------------------ #
    @cached_property
    def store(self) -> Store:
        return stored_layers(self)

    def table(self, name: str) -> DataFrame:
        return stored_layers(self, ("silver",) if name == "silver" else ALL_LAYERS).read(name)


ALL_LAYERS = ("silver", "quarantine", "metrics", "gold")
#: Per session and scale: the store's root and the layers that are in it.
_LAYERS: dict[tuple[str, str], tuple[str, set[str]]] = {}


def stored_layers(r: SalesRun, layers: tuple[str, ...] = ALL_LAYERS) -> Store:
    """Write the silver, quarantine, log and gold of the run that are asked for, once per
    session and scale, through the store's real paths: per-run partitions for quarantine,
    the upsert for silver, the log by day, a replace for gold."""
    key = (r.spark.sparkContext.applicationId, os.path.abspath(r.sf_dir))
    root, done = _LAYERS.get(key, (None, set()))
    if root is None or not path_exists(r.spark, f"{root}/silver"):
        root, done = scratch_dir(r.spark, "sales-layers"), set()
    _LAYERS[key] = root, done
    store = Store(r.spark, root)
    for layer in ALL_LAYERS:
        if layer in done or layer not in layers:
            continue
        if layer == "silver":
            # good rows as build_silver has them; one row per key is kept in the upsert's own shuffle
            store.upsert("silver", conform(r.bronze.filter(good_row(r.spec)), r.spec), r.spec.key, silver_order(r.spec))
        elif layer == "quarantine":
            store.append_run("quarantine", r.quarantine, ("run_id",))
        elif layer == "metrics":
            store.append_log("metrics", r.bronze_metrics.unionByName(r.stored_silver_metric))
        else:
            silver = store.read("silver")
            store.replace("gold_daily", gold_daily(silver, r.spec, r.as_of))
            store.replace("gold_region_category", gold_region_category(silver, r.spec, r.as_of))
        done.add(layer)
    return store

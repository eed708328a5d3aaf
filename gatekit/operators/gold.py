"""Full-refresh business aggregates over silver."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..spec import GateSpec
from .conform import exclude_cancelled

# Money is summed as an exact decimal: a double sum depends on the order in
# which tasks add up, so totals would change with the partitioning.
MONEY = "decimal(38,6)"


def _money_round(x, places: int = 2):
    return F.round(x, places).cast("double")


def gold_daily(silver: DataFrame, spec: GateSpec, refreshed_ts: Column,
               dims: tuple[str, ...] = ("store_region", "product_category"),
               units: str = "quantity", amount: str = "total_amount") -> DataFrame:
    """By date x dims: order_count, total_units, total_revenue, avg_order_value."""
    return (exclude_cancelled(silver, spec)
            .groupBy(spec.date_col, *dims)
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum(units).cast("bigint").alias("total_units"),
                 F.sum(F.col(amount).cast(MONEY)).alias("_rev"),
                 F.count(F.col(amount)).alias("_n"))
            .select(spec.date_col, *dims, "order_count", "total_units",
                    _money_round(F.col("_rev")).alias("total_revenue"),
                    _money_round(F.col("_rev") / F.nullif(F.col("_n"), F.lit(0)))
                    .alias("avg_order_value"))
            .withColumn("refreshed_ts", refreshed_ts))


def gold_region_category(silver: DataFrame, spec: GateSpec, refreshed_ts: Column,
                         dims: tuple[str, ...] = ("store_region", "product_category"),
                         amount: str = "total_amount",
                         customer: str = "customer_id") -> DataFrame:
    """By dims: order_count, total_revenue, revenue_per_customer
    (= sum / nullif(count distinct customers, 0))."""
    return (exclude_cancelled(silver, spec)
            .groupBy(*dims)
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum(F.col(amount).cast(MONEY)).alias("_rev"),
                 F.count_distinct(customer).alias("_cust"))
            .select(*dims, "order_count",
                    _money_round(F.col("_rev")).alias("total_revenue"),
                    _money_round(F.col("_rev") / F.nullif(F.col("_cust"), F.lit(0)))
                    .alias("revenue_per_customer"),
                    refreshed_ts.alias("refreshed_ts")))

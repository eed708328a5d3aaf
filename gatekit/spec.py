"""GateSpec: one description of a gated table drives every operator.

Nothing in the library hard-codes a table: key, required columns, event and
ingest columns, conform casts, defaults and thresholds all come from here, so
the same gate runs on sales orders, events or documents, in batch or stream.
"""
from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# Fixed values that must equal the reference's for the same results.
# Contract (ordered): order_id, customer_id, product_id, product_category,
# quantity, unit_price, total_amount, currency, payment_method, store_region,
# order_status, order_ts.
# Required: order_id, customer_id, unit_price, total_amount, order_ts.
# Meta columns: _rescued_data, _source_file, _ingest_ts, _batch_id.
# Thresholds: null rate 0.05, freshness SLA 24 h, late arrival 24 h,
# duplicate tolerance 0, row-count deviation 0.5.
# Defaults (upper-cased after coalesce): currency USD; payment_method,
# store_region, order_status UNKNOWN.
# Quarantine labels, in order: null_order_id, null_customer_id,
# null_unit_price, null_total_amount, bad_order_ts, schema_drift.
# Statuses: PASS, WARN, FAIL. Rule names: schema_drift, null_rate, duplicate,
# freshness_sla, late_arriving, row_count_anomaly.
PASS, WARN, FAIL = "PASS", "WARN", "FAIL"

META_COLUMNS = ("_rescued_data", "_source_file", "_ingest_ts", "_batch_id")

SALES_CONTRACT = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("store_region", T.StringType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("order_ts", T.StringType()),
])


@dataclass(frozen=True)
class GateSpec:
    """Everything the gate needs to know about one table."""

    contract: T.StructType = SALES_CONTRACT
    key: str = "order_id"
    required: tuple[str, ...] = ("order_id", "customer_id", "unit_price",
                                 "total_amount", "order_ts")
    event_col: str = "order_ts"
    # 'timestamp' for offset-bearing text (JSON path, session TZ = UTC);
    # 'timestamp_ntz' when raw times are zone-less (driver parquet tables).
    ts_type: str = "timestamp"
    ingest_col: str = "_ingest_ts"
    batch_col: str = "_batch_id"
    rescue_col: str = "_rescued_data"
    source_col: str = "_source_file"
    run_col: str = "run_id"
    layer: str = "bronze"
    table_name: str = "bronze_sales"
    silver_table: str = "silver_sales"
    # conform step
    casts: tuple[tuple[str, str], ...] = (("quantity", "bigint"),
                                          ("unit_price", "double"),
                                          ("total_amount", "double"))
    defaults: tuple[tuple[str, str], ...] = (("currency", "USD"),
                                             ("payment_method", "UNKNOWN"),
                                             ("store_region", "UNKNOWN"),
                                             ("order_status", "UNKNOWN"))
    # repair: target = coalesce(target, left * right)
    repair: tuple[str, str, str] | None = ("total_amount", "quantity", "unit_price")
    date_col: str = "order_date"
    late_col: str = "is_late"
    status_col: str = "order_status"
    cancelled_value: str = "CANCELLED"
    # thresholds
    null_rate_threshold: float = 0.05
    freshness_sla_hours: float = 24.0
    late_hours: float = 24.0
    duplicate_tolerance: int = 0
    rowcount_deviation: float = 0.5
    # exact distinct keys by default; a relative error (e.g. 0.01) switches the
    # duplicate probe to approx_count_distinct for very large batches
    distinct_rsd: float | None = None
    # extra tie-break columns (beyond the conformed output) for dedup
    extra_order: tuple[str, ...] = field(default_factory=tuple)

    # ------------------------------------------------------------------ #
    @property
    def contract_names(self) -> list[str]:
        return [f.name for f in self.contract.fields]

    @property
    def meta(self) -> tuple[str, ...]:
        return (self.rescue_col, self.source_col, self.ingest_col, self.batch_col)

    def with_(self, **kw) -> "GateSpec":
        return replace(self, **kw)

    def silver_columns(self) -> list[str]:
        """Ordered silver schema: contract + date, late flag, ingest, run."""
        return self.contract_names + [self.date_col, self.late_col,
                                      self.ingest_col, self.run_col]

    # ------------------------------------------------------------------ #
    # the tables that a gate writes, with fixed names and types
    # ------------------------------------------------------------------ #
    def table_schemas(self, dims: tuple[str, ...] = ("store_region", "product_category")) -> dict[str, T.StructType]:
        """Schemas of bronze, quarantine, silver, metrics and, where the contract has the
        dimensions, the two gold tables."""
        ts, text = T.DataType.fromDDL(self.ts_type), T.StringType()
        own = {f.name: f.dataType for f in self.contract.fields}

        def fields(*pairs) -> T.StructType:
            return T.StructType([T.StructField(n, T.DataType.fromDDL(t) if isinstance(t, str) else t) for n, t in pairs])
        clean = {**own, **dict(self.casts), self.event_col: ts}
        if self.repair:
            clean[self.repair[0]] = "double"
        out = {
            "bronze": fields(*own.items(), (self.rescue_col, text), (self.source_col, text), (self.ingest_col, ts), (self.batch_col, text)),
            "quarantine": fields(*((c, own[c]) for c in self.required), (self.rescue_col, text), (self.source_col, text), (self.batch_col, text),
                                 ("quarantine_reason", text), ("run_id", text), ("quarantine_ts", ts)),
            "silver": fields(*clean.items(), (self.date_col, "date"), (self.late_col, "boolean"), (self.ingest_col, ts), (self.run_col, text)),
            "metrics": fields(("run_id", text), ("check_ts", ts), *((c, text) for c in ("layer", "table_name", "rule_name", "column_name", "status")),
                              ("failure_count", "bigint"), ("total_count", "bigint"), *((c, "double") for c in ("failure_rate", "metric_value", "threshold")),
                              ("detail", text)),
        }
        if set(dims) <= set(own):
            by = [(d, own[d]) for d in dims]
            out["gold_daily"] = fields((self.date_col, "date"), *by, ("order_count", "bigint"), ("total_units", "bigint"),
                                       ("total_revenue", "double"), ("avg_order_value", "double"), ("refreshed_ts", ts))
            out["gold_region_category"] = fields(*by, ("order_count", "bigint"), ("total_revenue", "double"),
                                                 ("revenue_per_customer", "double"), ("refreshed_ts", ts))
        return out


SALES = GateSpec()

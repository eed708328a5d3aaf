"""gatekit: data-quality gates and medallion layers on Spark DataFrames."""
from .spec import FAIL, PASS, SALES, WARN, GateSpec
from .sources.store import SchemaError, Store
from .sources.landing import evolve_drift, read_landing, rescue_drift, stamp_lineage, write_batch_files, write_jsonl
from .operators.probe import bronze_probe, column_drift, column_drift_raw, with_trailing_avg
from .operators.evaluate import evaluate_all
from .operators.gate import quarantine_rows, slice_latest
from .operators.conform import build_silver, dedup_latest
from .operators.gold import gold_daily, gold_region_category
from .operators.merge import merge_actions
from .plans.medallion import ensure_tables, gate_raw, ingest_once_batch, run_gate, sales_gold
from .streaming.ingest import gate_stream, ingest_once, ingest_stream

__all__ = [
    "FAIL", "PASS", "WARN", "SALES", "GateSpec", "SchemaError", "Store",
    "read_landing", "rescue_drift", "evolve_drift", "stamp_lineage", "write_batch_files", "write_jsonl",
    "bronze_probe", "column_drift", "column_drift_raw", "with_trailing_avg", "evaluate_all",
    "quarantine_rows", "slice_latest", "build_silver", "dedup_latest",
    "gold_daily", "gold_region_category", "ensure_tables", "gate_raw", "ingest_once_batch", "merge_actions", "run_gate", "sales_gold",
    "gate_stream", "ingest_once", "ingest_stream",
]

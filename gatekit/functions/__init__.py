"""Column expressions: row predicates, conform projection and rule structs."""
from .exprs import (bad_row, conform_columns, good_row, hours_interval, is_late, lag_hours,
                    parse_event, quarantine_reason, repaired_amount, rescued_keys)
from .rules import (bronze_rules, rate, rule_duplicate, rule_freshness, rule_late_arriving,
                    rule_null_rate, rule_row_count, rule_schema_drift)

__all__ = [
    "bad_row", "conform_columns", "good_row", "hours_interval", "is_late", "lag_hours",
    "parse_event", "quarantine_reason", "repaired_amount", "rescued_keys", "bronze_rules",
    "rate", "rule_duplicate", "rule_freshness", "rule_late_arriving", "rule_null_rate",
    "rule_row_count", "rule_schema_drift",
]

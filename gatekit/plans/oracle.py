"""DuckDB twins of the registered queries (the driver's correctness oracle).

The SQL is generated from the same spec and constants as the Spark plans, but
it is an independent formulation in DuckDB's dialect: DuckDB parses and runs
it on the same parquet tables.
"""
from __future__ import annotations

from ..operators.conform import silver_order
from ..sources.testbind import AS_OF, DEFECTS, N_BATCHES, SALES_NTZ
from .sales import LAST_RUN, SILVER_CHECK

S = SALES_NTZ
TS = "TIMESTAMP"
D = "DOUBLE"


def ts_parse(col: str = S.event_col) -> str:
    return f"try_cast({col} AS {TS})"


def late_sql(ts: str | None = None, hours: float = S.late_hours) -> str:
    ts = ts or ts_parse()
    return f"({S.ingest_col} > {ts} + to_microseconds(CAST({int(hours * 3600e6)} AS BIGINT)))"


def lag_sql(max_ts: str, as_of: str) -> str:
    return f"CAST(date_sub('second', {max_ts}, {as_of}) AS {D}) / 3600.0"


def rnd(expr: str, places: int) -> str:
    """Spark's round on a double: HALF_UP on the value's decimal text."""
    return (f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {places}) "
            f"AS {D})")


def money(expr: str) -> str:
    """Exact-decimal money rounded half-up to cents, returned as double."""
    return f"CAST(round({expr}, 2) AS {D})"


def rate_sql(n: str, total: str) -> str:
    return f"(CASE WHEN {total} = 0 THEN CAST(0 AS {D}) ELSE CAST({n} AS {D}) / {total} END)"


# --------------------------------------------------------------------------- #
# CTE library
# --------------------------------------------------------------------------- #
def _bronze() -> str:
    d = DEFECTS

    def hit(name):
        return f"k % {d[name]} = 0"
    return f"""
  geo AS (SELECT n.n_nationkey, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
  cust AS (SELECT c.c_custkey, g.r_name FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey),
  base AS (
    SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_shipdate,
           o.o_custkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority, cu.r_name, p.p_type,
           l.l_orderkey * 7 + l.l_linenumber * 3 + l.l_partkey AS k
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN cust cu ON o.o_custkey = cu.c_custkey
    JOIN part p ON l.l_partkey = p.p_partkey),
  bronze AS (
    SELECT
      CASE WHEN {hit('order_id')} THEN NULL ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS order_id,
      CASE WHEN {hit('customer_id')} THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
      CAST(l_partkey AS VARCHAR) AS product_id,
      p_type AS product_category,
      CAST(l_quantity AS BIGINT) AS quantity,
      CASE WHEN {hit('unit_price')} THEN NULL ELSE l_extendedprice / l_quantity END AS unit_price,
      CASE WHEN {hit('total_amount')} THEN NULL ELSE l_extendedprice END AS total_amount,
      CASE WHEN {hit('currency')} THEN NULL ELSE 'usd' END AS currency,
      o_orderpriority AS payment_method,
      r_name AS store_region,
      CASE WHEN o_orderstatus = 'P' THEN 'cancelled' WHEN o_orderstatus = 'O' THEN 'placed' ELSE 'delivered' END AS order_status,
      CASE WHEN {hit('order_ts')} THEN 'not-a-ts' ELSE CAST(o_orderdate AS VARCHAR) END AS order_ts,
      CASE WHEN {hit('rescue')} THEN '{{"price":1}}' ELSE NULL END AS _rescued_data,
      'landing/sales_' || CAST(l_orderkey % {N_BATCHES} AS VARCHAR) || '.json' AS _source_file,
      l_shipdate AS _ingest_ts,
      CAST(l_orderkey % {N_BATCHES} AS VARCHAR) AS _batch_id
    FROM base)"""


def check_ts_sql() -> str:
    return f"(TIMESTAMP '{AS_OF}' + to_hours(CAST(_batch_id AS INTEGER)))"


def bad_sql() -> str:
    terms = [f"{c} IS NULL" for c in S.required if c != S.event_col]
    terms += [f"{S.event_col} IS NULL", f"{ts_parse()} IS NULL", f"{S.rescue_col} IS NOT NULL"]
    return "(" + " OR ".join(terms) + ")"


def reason_sql() -> str:
    parts = []
    for c in S.required:
        if c == S.event_col:
            parts.append(f"CASE WHEN {c} IS NULL OR {ts_parse()} IS NULL THEN 'bad_{c}' END")
        else:
            parts.append(f"CASE WHEN {c} IS NULL THEN 'null_{c}' END")
    parts.append(f"CASE WHEN {S.rescue_col} IS NOT NULL THEN 'schema_drift' END")
    return "concat_ws('; ', " + ", ".join(parts) + ")"


def _keys() -> str:
    """Present keys per batch: non-NULL contract columns + rescued JSON keys."""
    arms = [f"SELECT _batch_id, lower(unnest(json_keys({S.rescue_col}))) AS k FROM bronze "
            f"WHERE {S.rescue_col} IS NOT NULL"]
    arms += [f"SELECT _batch_id, '{c}' AS k FROM bronze WHERE {c} IS NOT NULL"
             for c in S.contract_names]
    contract = "[" + ", ".join(f"'{c}'" for c in S.contract_names) + "]"
    meta = "[" + ", ".join(f"'{c}'" for c in S.meta) + "]"
    return f"""
  keys AS ({' UNION '.join(arms)}),
  drift0 AS (SELECT _batch_id, list_sort(list_distinct(list(k))) AS pl FROM keys GROUP BY _batch_id),
  drift AS (
    SELECT _batch_id, pl,
      list_sort(list_filter(pl, lambda x: NOT list_contains({contract}, x) AND NOT list_contains({meta}, x))) AS ul,
      list_sort(list_filter({contract}, lambda x: NOT list_contains(pl, x))) AS ml
    FROM drift0)"""


def _probe() -> str:
    nulls = ",\n      ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in S.required)
    return f"""
  probe0 AS (
    SELECT _batch_id,
      count(*) AS total,
      {nulls},
      count(*) FILTER (WHERE {S.rescue_col} IS NOT NULL) AS rescued,
      count(DISTINCT {S.key}) AS distinct_keys,
      count(*) FILTER (WHERE {S.event_col} IS NOT NULL AND {late_sql()}) AS late,
      max({ts_parse()}) AS max_event_ts
    FROM bronze GROUP BY _batch_id),
  probe AS (
    SELECT p.*, {check_ts_sql()} AS check_ts,
      {lag_sql('max_event_ts', check_ts_sql())} AS lag_hours,
      array_to_string(d.pl, ',') AS present,
      array_to_string(d.ul, ',') AS unexpected,
      array_to_string(d.ml, ',') AS missing,
      len(d.ul) AS n_unexpected, len(d.ml) AS n_missing,
      avg(CAST(total AS {D})) OVER (ORDER BY p._batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS trailing_avg
    FROM probe0 p JOIN drift d USING (_batch_id))"""


def _metric_row_base(rule, column, status, fc, total, rate, value, thr, src="probe",
                run="_batch_id", check="check_ts", layer=None, table=None) -> str:
    col = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (f"SELECT CAST({run} AS VARCHAR) AS run_id, {check} AS check_ts, "
            f"'{layer or S.layer}' AS layer, '{table or S.table_name}' AS table_name, "
            f"'{rule}' AS rule_name, {col} AS column_name, {status} AS status, "
            f"CAST({fc} AS BIGINT) AS failure_count, CAST({total} AS BIGINT) AS total_count, "
            f"CAST({rate} AS {D}) AS failure_rate, CAST({value} AS {D}) AS metric_value, "
            f"CAST({thr} AS {D}) AS threshold FROM {src}")


def bronze_metric_rows(spec=S, src="probe") -> list[str]:
    def _metric_row(*a, **k):
        k.setdefault("layer", spec.layer)
        k.setdefault("table", spec.table_name)
        return _metric_row_base(*a, **k)
    rows = [_metric_row(
        "schema_drift", None,
        "CASE WHEN rescued > 0 OR n_unexpected > 0 OR n_missing > 0 THEN 'FAIL' ELSE 'PASS' END",
        "rescued", "total", rnd(rate_sql('rescued', 'total'), 4),
        "n_unexpected + n_missing", 0, src=src)]
    for c in spec.required:
        r = rate_sql(f"null_{c}", "total")
        rows.append(_metric_row(
            "null_rate", c,
            f"CASE WHEN {r} > {spec.null_rate_threshold} THEN 'FAIL' WHEN null_{c} > 0 THEN 'WARN' ELSE 'PASS' END",
            f"null_{c}", "total", rnd(r, 4), rnd(r, 4), spec.null_rate_threshold,
            src=src))
    dup = "greatest(total - distinct_keys, 0)"
    rows.append(_metric_row(
        "duplicate", spec.key,
        f"CASE WHEN {dup} > {spec.duplicate_tolerance} THEN 'FAIL' ELSE 'PASS' END",
        dup, "total", rnd(rate_sql(dup, 'total'), 4), dup, spec.duplicate_tolerance,
        src=src))
    lag = f"coalesce(lag_hours, CAST(1e9 AS {D}))"
    rows.append(_metric_row(
        "freshness_sla", spec.event_col,
        f"CASE WHEN {lag} > {spec.freshness_sla_hours} THEN 'FAIL' ELSE 'PASS' END",
        0, 0, 0, rnd(lag, 3), spec.freshness_sla_hours, src=src))
    rows.append(_metric_row(
        "late_arriving", spec.event_col, "CASE WHEN late > 0 THEN 'WARN' ELSE 'PASS' END",
        "late", "total", rnd(rate_sql('late', 'total'), 4), "late", spec.late_hours,
        src=src))
    rows.append(_row_count_row(spec, src))
    return rows


def _metric_row(*a, **k) -> str:
    return _metric_row_base(*a, **k)


def _row_count_row(spec, src, rows="total", avg="trailing_avg") -> str:
    dev = spec.rowcount_deviation
    status = (f"CASE WHEN {avg} IS NULL OR {avg} = 0 THEN 'PASS' WHEN {rows} = 0 THEN 'FAIL' "
              f"WHEN {rows} < {avg} * {1 - dev} OR {rows} > {avg} * {1 + dev} THEN 'WARN' "
              f"ELSE 'PASS' END")
    return _metric_row_base("row_count_anomaly", None, status, 0, rows, 0, rows,
                            f"coalesce({avg}, 0)", src=src, layer=spec.layer,
                            table=spec.table_name)


def _silver() -> str:
    casts = dict(S.casts)
    defaults = dict(S.defaults)
    cols = []
    for c in S.contract_names:
        if S.repair and c == S.repair[0]:
            t, a, b = S.repair
            cols.append(f"coalesce(CAST({t} AS {D}), CAST({a} AS {D}) * CAST({b} AS {D})) AS {c}")
        elif c == S.event_col:
            cols.append(f"{ts_parse()} AS {c}")
        elif c in defaults:
            cols.append(f"upper(coalesce({c}, '{defaults[c]}')) AS {c}")
        elif c in casts:
            cols.append(f"try_cast({c} AS {casts[c].upper()}) AS {c}")
        else:
            cols.append(c)
    cols += [f"CAST({ts_parse()} AS DATE) AS {S.date_col}",
             f"{late_sql()} AS {S.late_col}", S.ingest_col,
             f"CAST(_batch_id AS VARCHAR) AS {S.run_col}"]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in silver_order(S))
    return f"""
  good AS (SELECT * FROM bronze WHERE NOT {bad_sql()}),
  conformed AS (SELECT {', '.join(cols)} FROM good),
  silver AS (
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY {S.key} ORDER BY {order}) AS rn FROM conformed)
    WHERE rn = 1)"""


def _quarantine() -> str:
    req = ", ".join(S.required)
    return f"""
  quarantine AS (
    SELECT {req}, {S.rescue_col}, {S.source_col}, _batch_id,
      {reason_sql()} AS quarantine_reason, CAST(_batch_id AS VARCHAR) AS run_id,
      {check_ts_sql()} AS quarantine_ts
    FROM bronze WHERE {bad_sql()})"""


def _metrics() -> str:
    bronze_rows = "\n    UNION ALL ".join(bronze_metric_rows())
    lag = f"coalesce(lag_hours, CAST(1e9 AS {D}))"
    silver_row = _metric_row(
        "freshness_sla", S.event_col,
        f"CASE WHEN {lag} > {S.freshness_sla_hours} THEN 'FAIL' ELSE 'PASS' END",
        0, 0, 0, rnd(lag, 3), S.freshness_sla_hours, src="silver_fresh",
        run=f"'{LAST_RUN}'", check=f"TIMESTAMP '{SILVER_CHECK}'", layer="silver",
        table=S.silver_table)
    return f"""
  silver_fresh AS (
    SELECT count(*) AS silver_rows,
      {lag_sql(f'max({S.event_col})', f"TIMESTAMP '{SILVER_CHECK}'")} AS lag_hours
    FROM silver),
  bronze_metrics AS ({bronze_rows}),
  metrics AS (SELECT * FROM bronze_metrics UNION ALL {silver_row})"""


def _gold() -> str:
    return f"""
  gold_daily AS (
    SELECT {S.date_col}, store_region, product_category, count(*) AS order_count,
      CAST(sum(quantity) AS BIGINT) AS total_units,
      {money('sum(CAST(total_amount AS DECIMAL(38,6)))')} AS total_revenue,
      {money('CAST(sum(CAST(total_amount AS DECIMAL(38,6))) / nullif(count(total_amount), 0) AS DECIMAL(38,6))')} AS avg_order_value,
      TIMESTAMP '{AS_OF}' AS refreshed_ts
    FROM silver WHERE {S.status_col} <> '{S.cancelled_value}'
    GROUP BY {S.date_col}, store_region, product_category),
  gold_rc AS (
    SELECT store_region, product_category, count(*) AS order_count,
      {money('sum(CAST(total_amount AS DECIMAL(38,6)))')} AS total_revenue,
      {money('CAST(sum(CAST(total_amount AS DECIMAL(38,6))) / nullif(count(DISTINCT customer_id), 0) AS DECIMAL(38,6))')} AS revenue_per_customer,
      TIMESTAMP '{AS_OF}' AS refreshed_ts
    FROM silver WHERE {S.status_col} <> '{S.cancelled_value}'
    GROUP BY store_region, product_category)"""


_CTES = {
    "bronze": ([], _bronze),
    "drift": (["bronze"], _keys),
    "probe": (["bronze", "drift"], _probe),
    "silver": (["bronze"], _silver),
    "quarantine": (["bronze"], _quarantine),
    "metrics": (["probe", "silver"], _metrics),
    "gold": (["silver"], _gold),
}


def with_ctes(needs: list[str], select: str, extra: str | None = None) -> str:
    order: list[str] = []

    def visit(n):
        for d in _CTES[n][0]:
            visit(d)
        if n not in order:
            order.append(n)
    for n in needs:
        visit(n)
    body = ",".join([_CTES[n][1]() for n in order] + ([extra] if extra else []))
    return f"WITH {body}\n{select}"

"""Row-level column expressions built from a GateSpec (all JVM-side)."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ..spec import GateSpec


def parse_event(spec: GateSpec, col: str | None = None) -> Column:
    """Event time parsed with try_cast: bad text -> NULL, never an error (ANSI)."""
    return F.col(col or spec.event_col).try_cast(spec.ts_type)


def hours_interval(hours: float) -> Column:
    """A day-time interval of ``hours`` (fractional hours allowed)."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                              F.lit(round(hours * 3600.0, 6)).cast("decimal(18,6)"))


def is_late(spec: GateSpec, ts: Column | None = None) -> Column:
    """ingest > event + late_hours (strict); NULL when the event time is NULL."""
    ts = parse_event(spec) if ts is None else ts
    return F.col(spec.ingest_col) > ts + hours_interval(spec.late_hours)


def lag_hours(max_ts: Column, as_of: Column) -> Column:
    """Whole seconds from ``max_ts`` to ``as_of`` / 3600 as double; NULL if no ts."""
    return F.timestamp_diff("SECOND", max_ts, as_of).cast("double") / F.lit(3600.0)


def null_terms(spec: GateSpec) -> list[tuple[str, Column]]:
    """(label, condition) per reason, in the fixed label order."""
    terms = []
    for c in spec.required:
        if c == spec.event_col:
            terms.append((f"bad_{c}", F.col(c).isNull() | parse_event(spec).isNull()))
        else:
            terms.append((f"null_{c}", F.col(c).isNull()))
    terms.append(("schema_drift", F.col(spec.rescue_col).isNotNull()))
    return terms


def bad_row(spec: GateSpec) -> Column:
    """OR over required NULLs, unparsable event time and rescued content.

    Every term is IS [NOT] NULL, so the result is never NULL: bad and ~bad
    partition the batch exactly.
    """
    return reduce(lambda a, b: a | b, [cond for _, cond in null_terms(spec)])


def good_row(spec: GateSpec) -> Column:
    return ~bad_row(spec)


def quarantine_reason(spec: GateSpec) -> Column:
    """'; '-joined labels in fixed order; concat_ws skips the NULL branches."""
    return F.concat_ws("; ", *[F.when(cond, F.lit(label)) for label, cond in null_terms(spec)])


def repaired_amount(spec: GateSpec) -> Column:
    target, left, right = spec.repair
    return F.coalesce(F.col(target).cast("double"),
                      F.col(left).cast("double") * F.col(right).cast("double"))


def conform_columns(spec: GateSpec, run_id: Column) -> list[Column]:
    """Projection bronze -> silver: casts, defaults, repair, parsed time, flags."""
    casts = dict(spec.casts)
    defaults = dict(spec.defaults)
    ts = parse_event(spec)
    out = []
    for name in spec.contract_names:
        if spec.repair and name == spec.repair[0]:
            e = repaired_amount(spec)
        elif name == spec.event_col:
            e = ts
        elif name in defaults:
            e = F.upper(F.coalesce(F.col(name), F.lit(defaults[name])))
        elif name in casts:
            e = F.col(name).try_cast(casts[name])
        else:
            e = F.col(name)
        out.append(e.alias(name))
    out += [ts.cast("date").alias(spec.date_col),
            is_late(spec, ts).alias(spec.late_col),
            F.col(spec.ingest_col),
            run_id.alias(spec.run_col)]
    return out


def rescued_keys(spec: GateSpec) -> Column:
    """Lower-cased keys of the rescue JSON (NULL when nothing was rescued)."""
    m = F.from_json(F.col(spec.rescue_col), "map<string,string>")
    return F.transform(F.map_keys(m), lambda k: F.lower(k))

"""JSON-lines landing zone: render, read, rescue drift, stamp lineage.

Raw lines are read as text and parsed once into ``map<string,string>``; the
typed contract columns and the rescue column both come from that map. Nothing
fails on bad input: extra keys, values of the wrong type and malformed lines
end up in ``_rescued_data`` as JSON.
"""
from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..spec import GateSpec

CORRUPT_KEY = "_corrupt_record"


def _fragment(c: Column, name: str) -> Column:
    """'"name":<json value>' of one column, escaped by to_json."""
    j = F.to_json(F.struct(c.alias(name)), {"ignoreNullFields": "false"})
    return j.substr(F.lit(2), F.length(j) - 2)


def render_json(df: DataFrame, cols: list[Column | str], drop_nulls: Column | None = None,
                value_col: str = "value", keep: tuple[str, ...] = (),
                present: dict[str, Column] | None = None) -> DataFrame:
    """One JSON object per row (+ the ``keep`` columns).

    By default NULL fields are written as explicit nulls; on rows where
    ``drop_nulls`` is true they are left out. ``present`` decides per key and
    row whether the key is written at all: that is how a *missing* field
    differs from a null one, and how drifted rows get their own key set.
    """
    if present is not None:
        names = df.select(*cols).columns
        body = F.concat_ws(",", *[F.when(present[n], _fragment(c if isinstance(c, Column) else F.col(c), n))
                                  for c, n in zip(cols, names)])
        return df.select(F.concat(F.lit("{"), body, F.lit("}")).alias(value_col), *keep)
    s = F.struct(*cols)
    text = F.to_json(s, {"ignoreNullFields": "false"})
    if drop_nulls is not None:
        text = F.when(drop_nulls, F.to_json(s, {"ignoreNullFields": "true"})).otherwise(text)
    return df.select(text.alias(value_col), *keep)


def write_jsonl(df: DataFrame, path: str, value_col: str = "value",
                partition_by: str | None = None, mode: str = "overwrite") -> str:
    """Write the text column as JSON lines (one file per task / partition)."""
    w = df.select(value_col, *([partition_by] if partition_by else [])).write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.text(path)
    return path


def write_batch_files(df: DataFrame, landing: str, stamp: str, prefix: str = "sales", first: int = 0,
                      value_col: str = "value") -> list[str]:
    """Write the text column as JSON lines into files ``<prefix>_<stamp>_<idx>.json`` of the
    folder ``landing``; returns their names. ``idx`` counts from ``first`` in the order of
    the frame's partitions (an empty partition gives no file).

    Spark writes into a folder beside them first and commits the job, so only files of
    tasks that ended well are there; then each is renamed into place (one rename a file).
    Readers of ``landing`` never meet a half-written file. Sent again, a batch replaces its
    own files, also by fewer.
    """
    spark = df.sparkSession
    staging = f"{landing.rstrip('/')}/_writing-{uuid.uuid4().hex[:12]}"  # hidden from readers
    df.select(value_col).write.text(staging)
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    source, target = files.Path(staging), files.Path(landing)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted(st.getPath().getName() for st in fs.globStatus(files.Path(f"{staging}/part-*")) if st.getLen() > 0)
    old = {st.getPath().getName() for st in fs.globStatus(files.Path(target, f"{prefix}_{stamp}_*.json")) or []} if first == 0 else set()
    names = [f"{prefix}_{stamp}_{first + i:03d}.json" for i in range(len(parts))]
    for part, name in zip(parts, names):
        to = files.Path(target, name)
        fs.delete(to, False)
        if not fs.rename(files.Path(source, part), to):
            raise OSError(f"cannot rename {staging}/{part} to {to}")
    for name in old - set(names):
        fs.delete(files.Path(target, name), False)
    fs.delete(source, True)
    return names


def blank(column: str) -> Column:
    """Lines that hold no record (white space only)."""
    return F.col(column).rlike(r"^\s*$")


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """All lines but blank ones of all files under ``path`` with their source file."""
    return (spark.read.option("recursiveFileLookup", "true").text(path).filter(~blank("value"))
            .select("value", F.col("_metadata.file_path").alias("_source_file")))


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines, but blank ones, of exactly these files."""
    if not paths:
        return spark.createDataFrame([], "value string, _source_file string")
    plain = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]  # names are no patterns
    return (spark.read.text(plain).filter(~blank("value"))
            .select("value", F.col("_metadata.file_path").alias("_source_file")))


PARSED = "_m"


def parse_lines(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Add the parsed ``map<string,string>`` of each line (once per line)."""
    if PARSED in raw.columns:
        return raw
    return raw.withColumn(PARSED, F.from_json(F.col(value_col), "map<string,string>"))


def typed(m: Column, f: T.StructField) -> Column:
    """The value of a contract field from the parsed map; text that does not cast is null.
    JSON has no NaN and no infinite numbers, so texts that cast to them are no numbers either."""
    value = m[f.name].try_cast(f.dataType)
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return F.when(F.abs(value) < float("inf"), value)  # false for NaN, the greatest of all
    return value


def rescued_key_list(spec: GateSpec, m: Column) -> Column:
    """Keys to rescue from the parsed map, found without a lambda: keys outside
    the contract, plus typed contract keys whose text does not cast."""
    names = F.array(*[F.lit(c) for c in spec.contract_names])
    extra = F.array_except(F.map_keys(m), names)
    others = [f for f in spec.contract.fields if not isinstance(f.dataType, T.StringType)]
    if not others:
        return extra
    bad = F.array_compact(F.array(*[
        F.when(m[f.name].isNotNull() & typed(m, f).isNull(), F.lit(f.name))
        for f in others]))
    return F.array_union(extra, bad)


def rescue_drift(raw: DataFrame, spec: GateSpec, value_col: str = "value") -> DataFrame:
    """Typed contract columns + ``_rescued_data`` (JSON of rescued keys, NULL if
    none). Other columns of ``raw`` (source file, batch id) are kept.

    Rescued = keys outside the contract, plus contract keys whose text does not
    cast to the contract type; a line that is not a JSON object is kept whole
    under ``_corrupt_record``. The line is parsed once; the rescued map is only
    built (one small lambda) on the rows that have something to rescue.
    """
    m = F.col("_m")
    keys = F.col("_rk")
    rescued = F.map_from_arrays(keys, F.transform(keys, lambda k: m[k]))
    resc = (F.when(m.isNull() & (F.trim(F.col(value_col)) != ""),
                   F.to_json(F.create_map(F.lit(CORRUPT_KEY), F.col(value_col))))
            .when(F.size(keys) > 0, F.to_json(rescued, {"ignoreNullFields": "false"})))
    own = [typed(m, f).alias(f.name) for f in spec.contract.fields]
    keep = [c for c in raw.columns if c not in (value_col, PARSED)]
    return (parse_lines(raw, value_col).withColumn("_rk", rescued_key_list(spec, m))
            .select(*own, resc.alias(spec.rescue_col), *keep))


#: Columns that evolving feeds may add; keys beyond go into one map column.
EVOLVE_WIDTH = 200
TAIL = "_more"


def key_catalogue(raw: DataFrame, spec: GateSpec, value_col: str = "value") -> DataFrame:
    """(folded, spelling, rows, reserved): every key outside the contract, by its lower-cased
    name: its most frequent spelling (ties: the smallest) and the rows that hold one of its
    spellings. Reserved are names that differ from a contract, lineage or layout column in
    case only. Counted before the shuffle, so a hot key is one row per task."""
    names = F.array(*[F.lit(c) for c in spec.contract_names])
    counts = (parse_lines(raw, value_col).select(F.explode(F.array_except(F.map_keys(F.col(PARSED)), names)).alias("key"))
              .groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    taken = sorted({c.lower() for c in (*spec.contract_names, *spec.silver_columns(), *spec.meta)} | set(_LAYOUT))
    return (counts.groupBy(F.lower("key").alias("folded"))
            .agg(F.max_by("key", F.struct("n", F.translate("key", _ORDER, _ORDER[::-1]))).alias("spelling"), F.sum("n").alias("rows"))
            .withColumn("reserved", F.col("folded").isin(taken) | F.col("folded").startswith("_")))


#: Names of the store's partition columns, the work columns of a parse and the tail itself.
_LAYOUT = ("_bucket", "_version", "_day", "_m", "_rk", TAIL, CORRUPT_KEY)
#: Printable ASCII; mapped to its reverse, the greatest text is the smallest one.
_ORDER = "".join(map(chr, range(32, 127)))


def evolve_columns(raw: DataFrame, spec: GateSpec, value_col: str = "value", width: int = EVOLVE_WIDTH,
                   known: tuple[str, ...] = ()) -> list[str]:
    """Names of the columns to add: those that a stored table has (``known``), then the
    most frequent keys (ties by name), ``width`` at most; these names alone reach the driver."""
    old = list(dict.fromkeys(c for c in known if c.lower() not in {x.lower() for x in (*spec.contract_names, *spec.meta, TAIL)}))
    room = max(0, width - len(old))
    new = (key_catalogue(raw, spec, value_col).filter(~F.col("reserved") & ~F.col("folded").isin([c.lower() for c in old]))
           .orderBy(F.desc("rows"), "folded").limit(room).collect())
    return old + sorted(r.spelling for r in new)


def evolve_drift(raw: DataFrame, spec: GateSpec, value_col: str = "value", width: int = EVOLVE_WIDTH,
                 known: tuple[str, ...] = ()) -> DataFrame:
    """``drift='evolve'``: keys outside the contract become new (string) columns, so the
    table widens. Keys that differ in case only share a column, named by the most frequent
    spelling; if a row holds several of them, the column takes the first of its own
    spelling, then in the order of the names, and the others are rescued. Keys whose names
    are reserved (see :func:`key_catalogue`) are rescued; keys beyond ``width`` columns go
    into the map column ``_more`` (null where there are none). Values of the wrong type and
    malformed lines are rescued as ever.
    """
    m = F.col(PARSED)
    names = evolve_columns(raw, spec, value_col, width, known)
    contract = F.array(*[F.lit(c) for c in spec.contract_names])
    parsed = parse_lines(raw, value_col)
    extra = F.array_sort(F.array_except(F.map_keys(m), contract))
    taken = sorted({c.lower() for c in (*spec.contract_names, *spec.silver_columns(), *spec.meta)} | set(_LAYOUT))

    def chosen(name: str) -> Column:  # the spelling that a row's column is filled from
        first = F.get(F.col("_extra"), F.array_position(F.col("_low"), name.lower()).cast("int") - 1)
        return F.when(F.array_contains(F.col("_extra"), name), F.lit(name)).otherwise(first)
    folded = [n.lower() for n in names]
    used = F.array_compact(F.array(*[F.col("_spelled")[i] for i in range(len(names))])) if names else F.array().cast("array<string>")
    rest = F.array_except(F.col("_extra"), F.col("_used"))
    reserved = lambda k: F.lower(k).isin([*taken, *folded]) | F.lower(k).startswith("_")
    bad = F.array_intersect(rescued_key_list(spec, m), contract)
    rescued = F.array_union(F.filter(rest, reserved), bad)
    tail = F.filter(rest, lambda k: ~reserved(k))
    keep = [F.col(f"`{c}`") for c in raw.columns if c not in (value_col, PARSED)]
    own = [typed(m, f).alias(f.name) for f in spec.contract.fields]
    spelled = F.array(*[chosen(n) for n in names]) if names else F.array().cast("array<string>")

    def as_map(keys: Column) -> Column:
        return F.map_from_arrays(keys, F.transform(keys, lambda k: m[k]))
    resc = (F.when(m.isNull() & (F.trim(F.col(value_col)) != ""), F.to_json(F.create_map(F.lit(CORRUPT_KEY), F.col(value_col))))
            .when(F.size(F.col("_rk")) > 0, F.to_json(as_map(F.col("_rk")), {"ignoreNullFields": "false"})))
    return (parsed.withColumn("_extra", extra).withColumn("_low", F.transform("_extra", F.lower)).withColumn("_spelled", spelled).withColumn("_used", used)
            .withColumn("_rk", rescued).withColumn("_tail", tail)
            .select(*own, *[m[F.col("_spelled")[i]].alias(n) for i, n in enumerate(names)],
                    F.when(F.size("_tail") > 0, as_map(F.col("_tail"))).alias(TAIL), resc.alias(spec.rescue_col), *keep))


def stamp_lineage(df: DataFrame, spec: GateSpec, run_id: str | Column, as_of: Column) -> DataFrame:
    """Add ingest time and batch id; the source file comes from the file
    metadata (``read_landing``) when present."""
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    out = df
    if spec.source_col not in df.columns:
        out = out.withColumn(spec.source_col, F.lit(None).cast("string"))
    return out.select(*[c for c in out.columns if c not in (spec.ingest_col, spec.batch_col)],
                      as_of.alias(spec.ingest_col), run.cast("string").alias(spec.batch_col))


def bronze_columns(spec: GateSpec) -> list[str]:
    return spec.contract_names + list(spec.meta)


def parse_raw(raw: DataFrame, spec: GateSpec, drift: str = "rescue", known: tuple[str, ...] = ()) -> DataFrame:
    """``drift='rescue'`` (default): extra keys go to the rescue column;
    ``drift='evolve'``: they become new columns, those of ``known`` first."""
    if drift == "evolve":
        return evolve_drift(raw, spec, known=known)
    if drift != "rescue":
        raise ValueError(f"drift must be 'rescue' or 'evolve', not {drift!r}")
    return rescue_drift(raw, spec)


def ingest_batch(spark: SparkSession, landing: str, spec: GateSpec, run_id: str,
                 as_of: Column, drift: str = "rescue") -> DataFrame:
    """Every line under ``landing`` as bronze rows of one run (no file tracking)."""
    out = stamp_lineage(parse_raw(read_landing(spark, landing), spec, drift), spec, run_id, as_of)
    if drift == "rescue":
        return out.select(*bronze_columns(spec))
    return out

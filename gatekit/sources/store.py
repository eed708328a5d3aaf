"""Tables as partitioned parquet folders written by Spark.

* bronze and quarantine are partitioned by run id; re-running a run replaces its rows,
  also by none;
* silver and the metrics log keep row versions: a write appends its rows under a new
  version, the newest version of a key wins on read, and partitions with many versions are
  compacted. Silver is split by ``_bucket = pmod(xxhash64(key), B)``, the log by day;
* gold is replaced whole (it never reads itself);
* what is known of a table (schema, split, versions given out) is noted beside it in
  ``_tables``, before any of its data is written and by an atomic rename. A table that is
  declared with a fixed schema refuses other columns and types before it writes a file.

No row-level table format is assumed. With one configured, ``upsert`` is where a
``MERGE INTO`` would go. A table has one writer at a time.
"""
from __future__ import annotations

import json
import uuid
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from ..operators.conform import dedup_latest, limit_hot_keys
from ..session import UNSORTED_WRITE, checkpoint_root, conf_for

BUCKET, VERSION, DAY = "_bucket", "_version", "_day"
#: Versions whose partitions hold one row per key over all older versions end in this.
COMPACTED = "c"
#: The part of a bucket that one task of an upsert writes, and the bytes of input it is sized for.
PART, PART_BYTES, MOST_PARTS = "_part", 32 << 20, 1 << 18
#: Bytes of input that a bucket is sized for, and the bounds of the bucket count.
BUCKET_BYTES = 512 << 20
LEAST_BUCKETS, MOST_BUCKETS = 8, 1 << 16

#: A value of the first type may go into a column of the second one.
_WIDER = {"tinyint": ("smallint", "int", "bigint"), "smallint": ("int", "bigint"), "int": ("bigint",), "float": ("double",)}


class SchemaError(ValueError):
    """Columns or types that a table's fixed schema does not take."""


class Store:
    def __init__(self, spark: SparkSession, root: str | None = None, buckets: int | None = None,
                 compact_after: int = 8):
        """``buckets``: bucket count of tables that are first written here (default: sized
        from the bytes of the first input). ``compact_after``: versions that a bucket or day
        gathers before it is compacted."""
        self.spark = spark
        self.root = (root or f"{checkpoint_root(spark)}/store").rstrip("/")
        self.buckets = buckets
        self.compact_after = compact_after

    # ------------------------------------------------------------------ #
    # what is known of a table
    # ------------------------------------------------------------------ #
    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _facts(self, table: str) -> dict | None:
        """Schema, split and last version of a table that was written or declared here."""
        p, fs = self._fs(f"{self.root}/_tables/{table}.json")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, table: str, facts: dict) -> None:
        """Replace the note as a whole: readers see the old or the new one."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        p, fs = self._fs(f"{self.root}/_tables/{table}.json")
        new, _ = self._fs(f"{self.root}/_tables/.{table}-{uuid.uuid4().hex}")
        out = fs.create(new, True)
        try:
            out.write(bytearray(json.dumps(facts).encode()))
        finally:
            out.close()
        files = jvm.org.apache.hadoop.fs
        how = gateway.new_array(files.Options.Rename, 1)
        how[0] = files.Options.Rename.OVERWRITE
        files.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(
            fs.makeQualified(new), fs.makeQualified(p), how)

    def _note(self, table: str, schema: T.StructType, **more) -> dict:
        """Keep the schema, with the columns that earlier writes had, before data comes."""
        old = self._facts(table) or {}
        fields = {f.name: f for f in T.StructType.fromJson(old["schema"]).fields} if old else {}
        fields.update({f.name: T.StructField(f.name, f.dataType) for f in schema.fields if f.name not in fields or not old.get("fixed")})
        facts = {**old, "schema": T.StructType(list(fields.values())).jsonValue(), **more}
        if facts != old:
            self._put(table, facts)
            d, fs = self._fs(self.path(table))
            fs.mkdirs(d)
        return facts

    def exists(self, table: str) -> bool:
        return self._facts(table) is not None

    def schema(self, table: str) -> T.StructType | None:
        facts = self._facts(table)
        return T.StructType.fromJson(facts["schema"]) if facts else None

    def ensure(self, table: str, schema: T.StructType, partition_by: tuple[str, ...] = ()) -> None:
        """Declare an empty table with a fixed schema if it does not exist. Later writes
        are held to it; ``merge_schema`` writes may add columns."""
        if not self.exists(table):
            self._note(table, T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]), fixed=True)

    def checked(self, table: str, df: DataFrame, merge_schema: bool = False) -> DataFrame:
        """``df`` as the table's fixed schema has it: its columns in its order, types
        widened where no value can change. Raises :class:`SchemaError` otherwise. Tables
        without a fixed schema take anything."""
        facts = self._facts(table)
        if not (facts and facts.get("fixed")):
            return df
        want = T.StructType.fromJson(facts["schema"])
        own = {f.name.lower(): f for f in df.schema.fields}
        names = {f.name.lower() for f in want.fields}
        if missing := [f.name for f in want.fields if f.name.lower() not in own and not merge_schema]:
            raise SchemaError(f"{table}: columns {missing} are missing")
        if (extra := [f.name for f in df.schema.fields if f.name.lower() not in names]) and not merge_schema:
            raise SchemaError(f"{table}: columns {extra} are not in its schema")
        columns = []
        for f in want.fields:
            have = own.get(f.name.lower())
            if have is None:
                columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            elif have.dataType == f.dataType:
                columns.append(F.col(f"`{have.name}`").alias(f.name))
            elif _widens(have.dataType, f.dataType):
                columns.append(F.col(f"`{have.name}`").cast(f.dataType).alias(f.name))
            else:
                raise SchemaError(f"{table}.{f.name}: {have.dataType.simpleString()} does not go into {f.dataType.simpleString()}")
        return df.select(*columns, *[F.col(f"`{c}`") for c in extra])

    # ------------------------------------------------------------------ #
    # reading
    # ------------------------------------------------------------------ #
    def read(self, table: str, merge_schema: bool = False, where: Column | None = None) -> DataFrame:
        """The table with its widest schema, in its newest row versions. ``where`` may use
        the split (``_day``, ``_bucket``) and is applied first, so it prunes folders.
        Folders written by others have no note: ``merge_schema`` merges their schemas."""
        r, facts = self.spark.read, self._facts(table)
        if facts and facts.get("by"):
            return self._newest(self._versions(table, facts, where), facts).drop(facts["by"], VERSION)
        if facts:
            r = r.schema(T.StructType.fromJson(facts["schema"]))
        elif merge_schema:
            r = r.option("mergeSchema", "true")
        df = r.parquet(self.path(table))
        return df if where is None else df.filter(where)

    def _versions(self, table: str, facts: dict, where: Column | None = None) -> DataFrame:
        schema = T.StructType.fromJson(facts["schema"]).add(facts["by"], "string").add(VERSION, "string")
        df = self.spark.read.schema(schema).parquet(self.path(table))
        return df if where is None else df.filter(where)

    def _folders(self, df: DataFrame, by: str) -> dict[str, list[str]]:
        """Versions of each partition in order, from the file listing that ``df`` has anyway."""
        text = self.spark.sparkContext._jvm.org.apache.hadoop.util.StringUtils.join("\n", df._jdf.inputFiles())
        found: dict[str, set[str]] = {}
        for file in text.split("\n") if text else []:
            parts = dict(p.split("=", 1) for p in file.split("/")[:-1] if "=" in p)
            found.setdefault(unquote(parts[by]), set()).add(parts[VERSION])
        return {k: sorted(v) for k, v in found.items()}

    def _newest(self, df: DataFrame, facts: dict) -> DataFrame:
        """Rows of the newest version of each key, from the last compaction of their partition on."""
        by, keys = facts["by"], facts["keys"]
        folders = self._folders(df, by)
        base = {k: max((v for v in vs if v.endswith(COMPACTED)), default="") for k, vs in folders.items()}
        if not any(v < base[k] or not v.endswith(COMPACTED) for k, vs in folders.items() for v in vs):
            return df  # one version a partition
        # versions behind a compaction are left over until the next one
        least = min(base.values())
        df = df.filter(F.col(VERSION) >= least)
        old = [f"{k}/{v}" for k, vs in folders.items() for v in vs if least <= v < base[k]]
        if old:
            df = df.filter(~F.concat_ws("/", by, VERSION).isin(old))
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        rank = F.rank().over(Window.partitionBy(*keys).orderBy(F.col(VERSION).desc()))
        delta = df.filter(~F.col(VERSION).endswith(COMPACTED))
        newest = delta.filter(known).withColumn("_rank", rank).filter("_rank = 1").drop("_rank").unionByName(delta.filter(~known))
        if not any(base.values()):
            return newest
        gone = delta.filter(known).select(*keys)
        return df.filter(F.col(VERSION).endswith(COMPACTED)).join(gone, keys, "left_anti").select(*df.columns).unionByName(newest)

    # ------------------------------------------------------------------ #
    # writing by run
    # ------------------------------------------------------------------ #
    def append_run(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ("run_id",),
                   merge_schema: bool = False) -> None:
        """Append the rows of runs; re-writing a run replaces its rows (a run
        without any row here keeps what it had: see :meth:`replace_run`).

        The rows are rebalanced on the partition columns first, so each
        partition folder gets a few files instead of one per task (AQE still
        splits a partition that is larger than the advisory size)."""
        df = self.checked(table, df, merge_schema)
        self._note(table, df.schema)
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("mergeSchema", str(merge_schema).lower())
         .partitionBy(*partition_by).parquet(self.path(table)))

    def replace_run(self, table: str, df: DataFrame, column: str, run: str, merge_schema: bool = False) -> None:
        """One run's rows, whole, into its own partition folder: no shuffle on the
        run's constant, and a run without rows clears what it had."""
        df = self.checked(table, df, merge_schema)
        self._note(table, df.schema)
        (df.drop(column).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{self.path(table)}/{column}={quote(run, safe='-_.')}"))

    def clear_run(self, table: str, column: str, run: str) -> None:
        """Remove what a run has written into a table partitioned by run."""
        p, fs = self._fs(f"{self.path(table)}/{column}={quote(run, safe='-_.')}")
        fs.delete(p, True)

    def append(self, table: str, df: DataFrame) -> None:
        """Plain append (not idempotent), as the notebook path does for silver."""
        df = self.checked(table, df)
        self._note(table, df.schema)
        df.write.mode("append").parquet(self.path(table))

    def replace(self, table: str, df: DataFrame) -> None:
        """Full refresh. ``df`` must not read ``table`` itself."""
        df = self.checked(table, df)
        self._note(table, df.schema)
        df.write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .parquet(self.path(table))

    # ------------------------------------------------------------------ #
    # row versions
    # ------------------------------------------------------------------ #
    def bucket_of(self, key: str, buckets: int):
        return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("string")

    def _bytes(self, src: DataFrame) -> int:
        """Bytes that ``src`` reads."""
        leaves = src._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))

    def _sized(self, src: DataFrame) -> int:
        """Buckets for the bytes that ``src`` reads."""
        return min(max(-(-self._bytes(src) // BUCKET_BYTES), LEAST_BUCKETS), MOST_BUCKETS)

    def upsert(self, table: str, src: DataFrame, key: str, newest: list[str] | None = None) -> None:
        """MERGE by key: matched rows are replaced whole, unmatched inserted.

        ``src`` must hold one row per key; rows with a null key match nothing. Only the
        rows of ``src`` are written, under a new version, so the cost follows the batch;
        the table is read by nobody here. The bucket count is the one that the table was
        first written with. A write that ended half way and is sent again comes out right:
        its rows are older versions of the same keys.

        With ``newest`` the rows of ``src`` may repeat a key: the first one by these columns
        is kept (:func:`dedup_latest`), in the shuffle that splits the rows by bucket.
        """
        facts = self._facts(table) or {}
        buckets = facts.get("buckets") or self.buckets or self._sized(src)
        def split(df):
            return df.withColumn(BUCKET, self.bucket_of(key, buckets))
        if newest is None:
            return self._add_version(table, src, BUCKET, [key], split, buckets=buckets)
        # a part lies in one bucket, as its number modulo the bucket count is the bucket's
        parts = buckets * max(min(-(-self._bytes(src) // PART_BYTES), MOST_PARTS) // buckets, 1)

        def dealt(df):
            df = limit_hot_keys(df, key, newest).withColumn(PART, F.pmod(F.xxhash64(F.col(key)), F.lit(parts)).cast("int"))
            return split(dedup_latest(df.repartitionById(parts, PART), key, newest, (PART,)).drop(PART))
        self._add_version(table, src, BUCKET, [key], dealt, dealt=True, buckets=buckets)

    def append_log(self, table: str, df: DataFrame, keys: tuple[str, ...] = ("run_id", "layer"), at: str = "check_ts") -> None:
        """Append rows to a log that is split by the day of ``at``. Inside a day the rows
        of a run (of equal ``keys``) replace those that it wrote before."""
        day = F.date_format(F.col(at), "yyyy-MM-dd")
        self._add_version(table, df, DAY, [DAY, *keys], lambda x: x.withColumn(DAY, F.coalesce(day, F.lit("none"))))

    def _add_version(self, table: str, df: DataFrame, by: str, keys: list[str], split, dealt: bool = False, **more) -> None:
        df = self.checked(table, df)
        facts = self._facts(table)
        if not (facts and facts.get("by")):
            p, fs = self._fs(f"{self.path(table)}/{by}=*")
            found = fs.globStatus(p)
            if found is not None and len(found):
                raise ValueError(f"{self.path(table)} holds {by} folders but nothing is noted of it in {self.root}/_tables")
        number = (facts or {}).get("version", 0) + 1
        # the first version is written over nothing, so it is as good as compacted
        name = f"{number:09d}" + (COMPACTED if number == 1 else "")
        self._note(table, df.schema, by=by, keys=keys, version=number, **more)
        self._write_version(table, split(df), by, name, dealt)
        if self.compact_after and number % self.compact_after == 0:
            self.compact(table)

    def _write_version(self, table: str, df: DataFrame, by: str, name: str, dealt: bool = False) -> None:
        """``dealt``: each task holds rows of few partitions already."""
        df = df.withColumn(VERSION, F.lit(name))
        with conf_for(df.sparkSession, UNSORTED_WRITE):
            (df if dealt else df.hint("rebalance", by)).write.mode("append").partitionBy(by, VERSION).parquet(self.path(table))

    def compact(self, table: str, after: int | None = None) -> list[str]:
        """Write the newest rows of each partition that has gathered ``after`` versions
        (default: ``compact_after``) as one compacted version; returns the partitions.

        Until the new version is complete, its rows are equal to what they stand for, so
        readers see the same table at every moment, also after a crash. The versions behind
        it stay until the next compaction, for readers that have begun."""
        after = self.compact_after if after is None else after
        facts = self._facts(table)
        by = facts["by"]
        df = self._versions(table, facts)
        folders = self._folders(df, by)
        base = {k: max((v for v in vs if v.endswith(COMPACTED)), default="") for k, vs in folders.items()}
        for k, vs in folders.items():
            for v in vs:
                if v < base[k]:
                    p, fs = self._fs(f"{self.path(table)}/{by}={quote(k, safe='-_.')}/{VERSION}={v}")
                    fs.delete(p, True)
        ripe = sorted(k for k, vs in folders.items() if sum(v > base[k] for v in vs) >= after)
        if ripe:
            number = facts["version"] + 1
            df = self._versions(table, facts, F.col(by).isin(ripe))  # a fresh listing
            self._note(table, T.StructType([]), version=number)
            self._write_version(table, self._newest(df, facts).drop(VERSION), by, f"{number:09d}{COMPACTED}")
        return ripe

    # ------------------------------------------------------------------ #
    def counts(self, tables: list[str]) -> DataFrame:
        """(table_name, row_count) for each table, in one job."""
        parts = [self.read(t).agg(F.count(F.lit(1)).alias("row_count"))
                 .select(F.lit(t).alias("table_name"), "row_count") for t in tables]
        return reduce(DataFrame.unionByName, parts)


def _widens(have: T.DataType, want: T.DataType) -> bool:
    if isinstance(have, T.NullType):
        return True
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        return want.scale >= have.scale and want.precision - want.scale >= have.precision - have.scale
    return want.simpleString() in _WIDER.get(have.simpleString(), ())


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of several DataFrames as one union of one-row aggregates."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)

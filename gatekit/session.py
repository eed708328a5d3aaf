"""Session helpers: configuration we rely on and a shared scratch folder."""
from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # partition values (run ids, buckets) stay strings when read back
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app: str = "gatekit", extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and bench; on a cluster use the session you have
    and call :func:`configure`."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         # the call site of each column expression is not noted: plans are built twice as fast
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         # checkpointed upsert sources are removed once no longer referenced
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in {**CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in CONF.items():
        spark.conf.set(k, v)
    return spark


#: For writes into partition folders: a task keeps one file open for each of a few folders,
#: so its rows are not sorted by folder first (beyond that many it sorts, as without this).
UNSORTED_WRITE = {"spark.sql.maxConcurrentOutputFileWriters": "8"}
#: For joins whose smaller side has small partitions once it is shuffled: hashed, not sorted.
HASHED_JOINS = {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB"}


@contextmanager
def conf_for(spark: SparkSession, conf: dict[str, str]):
    """Set ``conf`` while one action runs."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by whoever runs the job and is read as is. Where
    it is unset, a local master gets a fresh temporary folder; others are refused.
    """
    sc_dir = _sc_checkpoint_dir(spark)
    d = spark.conf.get("spark.checkpoint.dir", None) or sc_dir
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="gatekit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc_dir:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def _sc_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        d = spark.sparkContext._jsc.sc().getCheckpointDir()
        return d.get() if d.isDefined() else None
    except Exception:  # pragma: no cover - remote / connect sessions
        return None


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the checkpoint root for one run's tables."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def to_local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def configure_for_scale(spark: SparkSession, input_bytes: int,
                        partition_bytes: int = 256 << 20) -> SparkSession:
    """Size shuffles and scans for a large cluster.

    Shuffle partitions are set so an average partition is ~``partition_bytes``
    of input (AQE then coalesces small ones and splits skewed ones); scans
    read ``2 x partition_bytes`` per task. At 100 TB this gives ~400k shuffle
    partitions before coalescing, so a partition fits in executor memory
    without spilling the sort of the dedup window.
    """
    configure(spark)
    parts = max(200, int(input_bytes // partition_bytes))
    for k, v in {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }.items():
        spark.conf.set(k, v)
    return spark

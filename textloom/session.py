"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings the jobs are written for. AQE splits skewed join partitions and merges small
#: ones at run time; it never makes more of them, so ``size_shuffles`` says how many there
#: are to begin with.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_UNLOAD = "spark.sql.streaming.stateStore.unloadOnCommit"

#: Compressed bytes of a table that may be broadcast.
BROADCAST_BYTES = 64 << 20

#: Input bytes a shuffle partition begins with, and the range of their number.
PARTITION_BYTES = 128 << 20
FEWEST_PARTITIONS, MOST_PARTITIONS = 200, 100_000
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

#: Bytes of a batch of rows that goes to a Python worker.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_local_dirs: dict[str, str] = {}


def build_session(app: str = "textloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Let shuffles of this session begin with partitions fit for an input of that many
    bytes, and at least two for each slot of the cluster; returns their number."""
    wanted = max(-(-input_bytes // PARTITION_BYTES), 2 * spark.sparkContext.defaultParallelism)
    number = min(MOST_PARTITIONS, max(FEWEST_PARTITIONS, wanted))
    spark.conf.set(_INITIAL, str(number))
    return number


def state_on_disk(spark: SparkSession, ends: bool = False) -> None:
    """Streams of this session keep their state in RocksDB, not on the heap: sets of all
    URLs ever seen outgrow memory. It stays so, hence streams may start side by side.

    ``ends`` is for a query that ends by itself: its tasks close their stores when a
    micro-batch is done, and read them again from the checkpoint for the next. Else executors
    keep a store a partition, each with open files and threads, for a minute or two after the
    query has ended, and streams run one after another pile them up. A query takes the
    settings it finds at its start.
    """
    spark.conf.set(_STATE_STORE, _ON_DISK)
    spark.conf.set(_UNLOAD, "true" if ends else "false")


def bound_batches(spark: SparkSession) -> None:
    """Send Python workers of this session batches of at most ``BATCH_BYTES``, or of one
    longer row. Spark's own limit counts rows, whatever their size: texts of ten thousand
    rows, and what is made of them, fill a worker. A limit that was set stays."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def work_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``, or what
    ``setCheckpointDir`` was given.

    Only a session on one machine that names none gets a temporary one. On a cluster
    that is an error: every executor would write to its own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    given = context._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get().rstrip("/")
    if not context.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="textloom-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def clear_work(spark: SparkSession) -> None:
    """Remove what this application wrote to the work folder. For the end of a session:
    results that were not written elsewhere cannot be read any more."""
    remove_path(spark, f"{work_root(spark)}/textloom-{spark.sparkContext.applicationId}")


def remove_path(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's part of the work folder, which can be
    removed as a whole when the application is done."""
    app = spark.sparkContext.applicationId
    return f"{work_root(spark)}/textloom-{app}/{label}-{uuid.uuid4().hex}"


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result once to the work folder and read it back.

    For results several later steps use. It outlives lost executors, cuts the
    lineage, and its row count comes from file footers.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bytes_of(df: DataFrame) -> int:
    """What the optimizer knows of the size of ``df``; of a table, its bytes on disk."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_or_shuffled(df: DataFrame, label: str, max_rows: int) -> DataFrame:
    """A join side that is broadcast only when it is known to be small: at most
    ``max_rows`` rows and ``BROADCAST_BYTES`` on disk.

    It is written out first, which settles its size. A larger one is left to a
    shuffle join whose two inputs are plain exchanges, the form in which adaptive
    execution can split the partitions of a hot key.
    """
    written = stash(df, label)
    small = bytes_of(written) <= BROADCAST_BYTES and written.count() <= max_rows
    return F.broadcast(written) if small else written


def paths_matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths a path or glob pattern names, on whatever file system its URI names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = hadoop_path.getFileSystem(conf).globStatus(hadoop_path)
    return [status.getPath().toString() for status in found or ()]


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on whatever file system its URI names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).exists(hadoop_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    """True when ``path`` is a folder on whatever file system its URI names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).getFileStatus(hadoop_path).isDirectory()

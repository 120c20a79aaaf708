"""Session helpers: builder, shared scratch folder, reliable checkpoints and size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tidemart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects (UTC clock, AQE with skew joins)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting (tests, a laptop) gets a folder of its own; on a cluster its lack is an error, since
    executors would write where others cannot read.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not configured and not (spark.sparkContext.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tidemart-"))
        current = spark.sparkContext.getCheckpointDir()
    return configured or current


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for a table that has to be written and read back."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables that this process has made, once nothing reads them any more; how many there were.

    Checkpoints go by themselves where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on, as in ``get_session``.
    """
    n = len(_SCRATCH)
    while _SCRATCH:
        where = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return n


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; costs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """Size of everything a plan reads (its leaves); costs no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


# Spark deletes the shuffle files of an action when it ends, instead of when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, path: str) -> DataFrame:
    """A frame written as compressed files and read back.

    The files take a fraction of the room of a checkpoint's, whose rows Spark writes as they lie in memory, and what was shuffled for them
    goes with the write.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.parquet(path)


def packed(df: DataFrame, label: str = "packed") -> DataFrame:
    """Cut the lineage as ``settle`` does, by compressed files in the shared folder; how rows are dealt is not kept."""
    return stored(df, scratch_path(df.sparkSession, label))


# A plan that reads no more than this is cheap to repeat and has no key that is too large for one task.
SMALL_BYTES = 64 << 20


def reused(df: DataFrame) -> DataFrame:
    """An intermediate result that several branches read.

    On a large input it is written once to the shared folder instead of being computed by every branch.
    """
    return settle(df) if input_bytes(df) > SMALL_BYTES else df


# Bytes of input for each task of a step whose rows take many times their room on disk, and the most tasks it is dealt to.
TASK_BYTES = 8 << 20
MOST_TASKS = 4096
# Spark's size of a leaf of which it knows none, as of rows that come from Python.
UNKNOWN_BYTES = 1 << 60


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by keys to as many tasks as the input has parts of ``TASK_BYTES``; a small input, or one of unknown size, stays as it is.

    Spark joins shuffled partitions by their compressed size, so what one task holds of a large input would be many times that.
    """
    size = input_bytes(df)
    return df if size <= SMALL_BYTES or size >= UNKNOWN_BYTES else df.repartition(min(MOST_TASKS, size // TASK_BYTES), *keys)


def broadcast_limit(spark: SparkSession) -> int:
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower().rstrip("b")
    factor = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(raw[-1:], 1)
    return int(raw.rstrip("kmg")) * factor


# Bytes of a row in a broadcast table at least, with its place in the hash map.
ROW_BYTES = 64


def beside(df: DataFrame, rows: int) -> DataFrame:
    """A join side of ``rows`` counted rows; sizes of files tell little of them, so Spark would broadcast a large one by its estimate."""
    return df if rows * ROW_BYTES <= broadcast_limit(df.sparkSession) else df.hint("merge")

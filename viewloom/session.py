"""Session helpers: sizing for local runs and the checkpoint folder for iterative jobs."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths of the materialized frames, in the order of writing.
_WRITTEN: list[str] = []


def local_session(cores: int = 8, app: str = "viewloom", **conf: str) -> SparkSession:
    """A local session for tests and the bench. A cluster brings its own session and sizing."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # joins whose shuffled partitions turn out small hash them instead of sorting both sides
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.files.maxPartitionBytes", "64m")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialized frames.

    A cluster names it in ``spark.checkpoint.dir``; it is used as it stands. Without that setting a folder
    below the warehouse is taken, which every node of a cluster reaches; a warehouse on one machine's disk
    is accepted only with a local master.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not context.master.startswith("local") and (warehouse.startswith("file:") or "://" not in warehouse):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running operators that write")
        configured = f"{warehouse}/_viewloom_scratch"
    context.setCheckpointDir(configured)
    return configured


#: A frame with this column is materialized in buckets of it.
BUCKET = "__bucket"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside go when an action is over, not when the driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet below the checkpoint folder and read it back.

    Used where a frame feeds several branches or an iteration: the plan is cut, a lost executor reads
    files instead of recomputing, and unlike a checkpoint the readers prune columns and the planner knows
    the size. ``release`` deletes the files once the actions that read them are over.

    Rows with a column ``BUCKET`` must lie as ``repartition(buckets(spark), BUCKET)`` deals them; what reads them by that column then needs no shuffle.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/viewloom/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    with _shuffles_dropped(spark):
        if BUCKET not in df.columns:
            df.write.parquet(path)
            return spark.read.schema(df.schema).parquet(path)
        table = f"viewloom_{uuid.uuid4().hex}"
        df.write.bucketBy(buckets(spark), BUCKET).format("parquet").option("path", path).saveAsTable(table)
    stored = spark.table(table)
    # a table at a given path: its entry goes, its files stay
    spark.sql(f"drop table {table}")
    return stored


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted by ``release`` like the materialized frames."""
    path = f"{ensure_checkpoint_dir(spark)}/viewloom/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def written() -> int:
    """A mark for ``release``: frames materialized after it belong to the caller."""
    return len(_WRITTEN)


def release(spark: SparkSession, mark: int = 0, keep: int = 0) -> None:
    """Delete what ``materialize`` wrote since ``mark``, but for the last ``keep`` frames.

    Call it after the action: frames that are not computed yet would lose their input.
    """
    end = len(_WRITTEN) - keep
    for path in _WRITTEN[mark:end]:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    del _WRITTEN[mark:end]

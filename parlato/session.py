"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins from measured sizes and splits skewed shuffle partitions. Audio
# rows are large, so readers and Arrow batches hold few of them at a time.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.python.filterPushdown.enabled": "true",
}


# Input of this size moves in well under a second, on any cluster.
SMALL_BYTES = 64 << 20


def build_session(app: str = "parlato", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`RECOMMENDED`; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it.

    Only a local session may go without it; a cluster must name one, since a
    folder of one machine would lose its files with that machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="parlato-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/parlato/{label}-{uuid.uuid4().hex}"


# Spark's own setting: the shuffle files of a query go when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: short lineage, fixed rows.

    The shuffle files that made it are deleted as soon as it is there.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what jobs have stored for their own use. Frames that read it, results of earlier jobs included, end with it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/parlato")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fill_cluster(df: DataFrame, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Spread a scan of at most ``max_bytes``, which may be one split however many cores wait.

    The planner's own estimate decides. Anything larger comes back unchanged, so
    no shuffle of it is added, whatever the number of cores.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= max_bytes else df

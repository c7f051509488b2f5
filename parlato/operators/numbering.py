"""Row numbers over whole tables, without a task that holds a whole table."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parlato.functions.keys import BUCKETS, hash_bucket, order_hash
from parlato.session import scratch_path, staged

# A broadcast table of file offsets has one row per file: 16 bytes of its name's digest and a number,
# about 100 bytes in a hash table. The limit is reached at 20 million files.
OFFSET_BYTES = 100
MAX_BROADCAST_BYTES = 2_000_000_000


def _with_offsets(df: DataFrame, files: DataFrame, n_files: int, out: str) -> DataFrame:
    """Number rows by (file, row in file). ``files`` holds ``__file, __start`` for every file of ``df``.

    Names meet by their 128-bit digest. Rows are not moved unless the offsets of
    all files are too many to send.
    """
    files = files.select(F.unhex(F.md5("__file")).alias("__digest"), "__start")
    if n_files * OFFSET_BYTES <= MAX_BROADCAST_BYTES:
        files = F.broadcast(files)
    digest = F.unhex(F.md5(F.col("_metadata.file_path"))).alias("__digest")
    return (
        df.select("*", digest, F.col("_metadata.row_index").alias("__row"))
        .join(files, "__digest")
        .withColumn(out, F.col("__start") + F.col("__row"))
        .drop("__digest", "__row", "__start")
    )


def number_by_file(df: DataFrame, out: str = "row_number", file_order: Column | None = None) -> DataFrame:
    """0-based position of each row of a plain Parquet scan: files in path order, rows as stored.

    Reads row counts first, then every row once; rows are not moved. The running
    total goes over one row per file.
    """
    n_files = len(df.inputFiles())
    if n_files == 1:
        return df.select("*", F.col("_metadata.row_index").alias(out))
    order = F.col("__file") if file_order is None else file_order
    counts = df.groupBy(F.col("_metadata.file_path").alias("__file")).agg(F.count("*").alias("__n"))
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return _with_offsets(df, starts, n_files, out)


def number_by_block(df: DataFrame, at: str, out: str = "row_number") -> DataFrame:
    """0-based position of each row of stored rows with ``at``, a struct of ``file``, ``start`` of a part of it, and ``row``.

    Rows of a part have consecutive values of ``row``, whatever the first is.
    Parts are counted, a running total goes over one row a part, and rows are not moved unless there are too many parts.
    """
    parts = df.groupBy(F.col(f"{at}.file").alias("__file"), F.col(f"{at}.start").alias("__from")).agg(
        F.count("*").alias("__n"), F.min(f"{at}.row").alias("__first")
    )
    parts = staged(parts, "parts")
    before = Window.orderBy("__file", "__from").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")
    starts = parts.select(F.unhex(F.md5("__file")).alias("__digest"), "__from", start.alias("__start"))
    if parts.count() * OFFSET_BYTES <= MAX_BROADCAST_BYTES:
        starts = F.broadcast(starts)
    tagged = df.withColumns({"__digest": F.unhex(F.md5(F.col(f"{at}.file"))), "__from": F.col(f"{at}.start")})
    numbered = tagged.join(starts, ["__digest", "__from"]).withColumn(out, F.col("__start") + F.col(f"{at}.row"))
    return numbered.drop("__digest", "__from", "__start")


def number_by_key(df: DataFrame, keys: Sequence[str], out: str = "row_number") -> DataFrame:
    """0-based position of each row in the order of ``keys``, which must be unique.

    The table is sorted by range and written to the shared folder once. Its files
    follow each other in key order, so positions come from their row counts and a
    lost executor cannot shift a range boundary between two passes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "sorted")
    df.orderBy(*keys).write.option("maxRecordsPerFile", 0).parquet(path)
    part = F.regexp_extract("__file", r"part-(\d+)-", 1).cast("long")
    return number_by_file(spark.read.schema(df.schema).parquet(path), out, part)


def shard_of(row_number: Column, rows_per_shard: int) -> Column:
    """Contiguous shard of a 0-based position."""
    return F.floor(row_number / rows_per_shard)


def index_in_shard(row_number: Column, rows_per_shard: int) -> Column:
    return F.pmod(row_number, F.lit(rows_per_shard))


def shuffle_rank(df: DataFrame, key: str, seed: int = 42, out: str = "rank") -> DataFrame:
    """0-based position of each row in a reproducible random order of the unique ``key``.

    Hash order is cut into even buckets. Rows are ranked inside their bucket and
    shifted by the rows before it, at most one offset per bucket.
    """
    hashed = order_hash(seed, F.col(key))
    tagged = df.withColumns({"__hash": hashed, "__bucket": hash_bucket(hashed)})
    counts = df.groupBy(hash_bucket(hashed).alias("__bucket")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__bucket").orderBy("__hash", key)
    return (
        tagged.withColumn("__at", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), "__bucket")
        .withColumn(out, F.col("__start") + F.col("__at"))
        .drop("__hash", "__bucket", "__at", "__start")
    )


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in a reproducible random order, the same for any number of partitions.

    Hashes are even, so equal ranges of them are known beforehand: rows go to
    their range and are sorted there. A sort by range would read ``df`` twice, once
    for a sample. Rows without a key are spread by a hash of their
    columns without binary parts.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    others = [name for name, kind in df.dtypes if name != key and "binary" not in kind]
    spread = order_hash(seed, F.xxhash64(*others) if others else F.lit(None))
    hashed = F.when(F.col(key).isNotNull(), order_hash(seed, F.col(key))).otherwise(spread)
    bucket = F.conv(hash_bucket(hashed), 16, 10).cast("int")
    target = F.floor(bucket * parts / BUCKETS).cast("int")
    return df.repartitionById(parts, target).sortWithinPartitions(hashed, key)


def reader_of(shard: Column, num_readers: int) -> Column:
    """Which of ``num_readers`` readers a shard belongs to."""
    return F.pmod(shard, F.lit(num_readers))


def count_per_shard(df: DataFrame, shard: str = "shard") -> DataFrame:
    return df.groupBy(shard).agg(F.count("*").alias("n_rows"))


def first_rows(spark: SparkSession, files: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of Parquet ``files``, named as ``inputFiles`` does, taken in path order, reading no file after them."""
    if n < 0:
        raise ValueError(f"cannot take {n} rows")
    files = [unquote(file) for file in sorted(files)]
    taken = 1
    while taken < len(files) and spark.read.parquet(*files[:taken]).count() < n:
        taken = min(2 * taken, len(files))
    head = spark.read.parquet(*files[:taken])
    return head.orderBy("_metadata.file_path", "_metadata.row_index").limit(n)

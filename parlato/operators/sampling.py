"""Train and test labels: an exact number of random test rows in every shard."""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parlato.functions.keys import HASH_DIGITS, hash_bucket, order_hash
from parlato.session import staged

# Share of test rows and seed.
TEST_FRACTION = 0.048
SEED = 42

# Bytes of cutoffs that are sent to all rows: some 150 a shard with names and keys of usual length.
MAX_BROADCAST_BYTES = 500_000_000


# A bucket of this many (hash, key) rows is sorted by one task; larger ones are cut finer.
MAX_SORTED_ROWS = 2_000_000

# Hexadecimal digits per cut: 256 counts per shard at first, 4096 per bucket that is too large.
_FIRST_DIGITS, _MORE_DIGITS = 2, 3


def _shard_key(shard: str | Sequence[str] | None) -> Column:
    if shard is None:
        return F.lit(0)
    return F.col(shard) if isinstance(shard, str) else F.struct(*shard)


class RepeatedKey(ValueError):
    """The sample of a shard ends among rows of one key, so no exact sample can be told by keys."""


def _order(seed: int, key: str, tie: Column | None) -> Column:
    """Hexadecimal digits that order a shard's rows: of the key, then of ``tie`` for rows of one key."""
    hashed = order_hash(seed, F.col(key))
    return hashed if tie is None else F.concat(hashed, order_hash(seed, tie))


def _last_buckets(counts: DataFrame) -> DataFrame:
    """The bucket in which each shard's sample ends, with the ``__need`` rows to take of its ``__n``.

    ``counts`` holds ``__shard, __bucket, __n`` and the rows wanted of the shard, ``__k``.
    """
    upto = Window.partitionBy("__shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    return (
        counts.withColumn("__upto", F.sum("__n").over(upto))
        .filter((F.col("__upto") >= F.col("__k")) & (F.col("__upto") - F.col("__n") < F.col("__k")))
        .select("__shard", "__bucket", "__n", (F.col("__k") - F.col("__upto") + F.col("__n")).alias("__need"))
    )


def _sent_if_small(stored: DataFrame) -> DataFrame:
    """``stored`` marked for a broadcast if its values and their overhead stay within :data:`MAX_BROADCAST_BYTES`."""
    size = stored.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))) + 100)).first()[0] or 0
    return F.broadcast(stored) if size <= MAX_BROADCAST_BYTES else stored


def _rows_of(rows: DataFrame, last: DataFrame) -> tuple[DataFrame, int]:
    """The rows that lie in the ``last`` buckets, and the size of the largest of these."""
    last = staged(last, "buckets")
    largest = last.agg(F.max("__n")).first()[0]
    ends = last.select(F.col("__shard").alias("__s"), F.col("__bucket").alias("__b"), "__need")
    ends = _sent_if_small(ends)
    inside = F.col("__shard").eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b"))
    return rows.join(ends, inside).drop("__s", "__b"), largest or 0


def sample_size(rows: Column, fraction: float = TEST_FRACTION) -> Column:
    """Test rows of a shard: the rounded-down share, one at least."""
    return F.greatest(F.lit(1), F.floor(rows * F.lit(float(fraction))).cast("long"))


def split_cutoffs(
    df: DataFrame,
    key: str,
    shard: str | Sequence[str] | None,
    fraction: float = TEST_FRACTION,
    seed: int = SEED,
    max_sorted: int = MAX_SORTED_ROWS,
    tie: Column | None = None,
) -> DataFrame:
    """Per shard the last (hash, key) that is still a test row: ``shard, cut_hash, cut_key, n_tied``.

    A shard may be of any size. Its rows are counted per range of hashes, which
    finds the range where the sample ends; that range alone is cut finer until one
    task can sort it. Reads ``key``, ``shard`` and ``tie`` and no other column.
    ``n_tied`` rows after the last one have its hash and key, none if keys and ties are
    unique.
    """
    hashed = _order(seed, key, tie).alias("__hash")
    narrow = df.select(_shard_key(shard).alias("__shard"), F.col(key).alias("__key"), hashed)
    most_digits = HASH_DIGITS * (1 if tie is None else 2)
    digits = _FIRST_DIGITS
    rows = narrow.withColumn("__bucket", hash_bucket(F.col("__hash"), digits))
    counts = rows.groupBy("__shard", "__bucket").agg(F.count("*").alias("__n"))
    in_shard = F.sum("__n").over(Window.partitionBy("__shard"))
    rows, largest = _rows_of(rows, _last_buckets(counts.withColumn("__k", sample_size(in_shard, fraction))))
    while largest > max_sorted and digits + _MORE_DIGITS <= most_digits:
        digits += _MORE_DIGITS
        # a 256th of the keys or less
        rows = staged(rows.withColumn("__bucket", hash_bucket(F.col("__hash"), digits)), "candidates")
        counts = rows.groupBy("__shard", "__bucket").agg(F.count("*").alias("__n"), F.max("__need").alias("__k"))
        rows, largest = _rows_of(rows.drop("__need"), _last_buckets(counts))
    inside = Window.partitionBy("__shard", "__bucket").orderBy("__hash", "__key")
    equal = Window.partitionBy("__shard", "__bucket", "__hash", "__key")
    ranked = rows.withColumn("__at", F.row_number().over(inside)).withColumn("__end", F.max("__at").over(equal))
    return ranked.filter(F.col("__at") == F.col("__need")).select(
        F.col("__shard").alias("shard"),
        F.col("__hash").alias("cut_hash"),
        F.col("__key").alias("cut_key"),
        (F.col("__end") - F.col("__at")).alias("n_tied"),
    )


def assign_split(
    df: DataFrame,
    key: str,
    shard: str | Sequence[str] | None,
    fraction: float = TEST_FRACTION,
    seed: int = SEED,
    split_col: str = "split",
    tie: Column | None = None,
) -> DataFrame:
    """``df`` with ``split_col`` set to ``test`` on an exact random sample of each shard, ``train`` elsewhere.

    ``shard`` is a column, several, or None if all of ``df`` is one shard; ``key``
    may be null or repeat if ``tie`` tells such rows apart, for stored rows their file and
    place in it. Without ``tie``, :class:`RepeatedKey` is raised where a shard's sample
    would end among rows of one key. The result depends on seed, keys, ties and shards
    only. The cutoffs, one row per shard, are worked out first and stored. Up to a size
    of :data:`MAX_BROADCAST_BYTES` they are sent to the rows, so that no row of ``df`` is
    moved; a planner that guesses their size would shuffle ``df`` first.
    """
    if tie is not None:
        # a column of its own, since the cutoffs come from files as well
        df, tie = df.withColumn("__tie", tie), F.col("__tie")
    mine = F.struct(_order(seed, key, tie).alias("hash"), F.col(key).alias("key"))
    last = F.struct(F.col("cut_hash").alias("hash"), F.col("cut_key").alias("key"))
    cuts = staged(split_cutoffs(df, key, shard, fraction, seed, tie=tie), "cutoffs")
    tied = cuts.filter("n_tied > 0").limit(3).collect()
    if tied:
        raise RepeatedKey(f"{key} repeats at the end of the samples of {[row.shard for row in tied]}; pass tie")
    cuts = cuts.drop("n_tied").withColumnRenamed("shard", "__cut_shard")
    if shard is None:
        cut = cuts.select(last).scalar()
        return df.withColumn(split_col, F.when(mine <= cut, "test").otherwise("train")).drop("__tie")
    cuts = _sent_if_small(cuts)
    return (
        df.join(cuts, _shard_key(shard).eqNullSafe(F.col("__cut_shard")), "left")
        .withColumn(split_col, F.when(mine <= last, "test").otherwise("train"))
        .drop("__cut_shard", "cut_hash", "cut_key", "__tie")
    )


def sampled_positions(sizes: DataFrame, fraction: float = TEST_FRACTION, seed: int = SEED) -> DataFrame:
    """``n_rows, idx``: the positions Python's seeded sampler picks in a shard of ``n_rows`` rows.

    The positions depend on the shard's size only, so each distinct size is drawn
    once. Made for shards cut to a fixed row count: the draw is sequential, and one
    task holds all picks of a size.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in batch.column("n_rows").to_pylist():
                picks = random.Random(seed).sample(range(n), max(1, int(n * fraction)))
                for start in range(0, len(picks), 10_000):
                    part = picks[start : start + 10_000]
                    yield pa.RecordBatch.from_pydict({"n_rows": [n] * len(part), "idx": part}, _POSITIONS)

    return sizes.select(F.col("n_rows").cast("long")).distinct().mapInArrow(draw, "n_rows bigint, idx bigint")


_POSITIONS = pa.schema([("n_rows", pa.int64()), ("idx", pa.int64())])


def assign_split_by_position(
    df: DataFrame,
    shard: str,
    idx: str,
    fraction: float = TEST_FRACTION,
    seed: int = SEED,
    split_col: str = "split",
) -> DataFrame:
    """Labels as a seeded Python sampler gives them per shard, for results that must match older shards.

    ``idx`` is the 0-based row position within ``shard``. Prefer :func:`assign_split`.
    """
    sizes = df.groupBy(F.col(shard).alias("__shard")).agg(F.count("*").alias("n_rows"))
    picks = sizes.join(sampled_positions(sizes, fraction, seed), "n_rows").select(
        "__shard", F.col("idx").alias("__idx"), F.lit(True).alias("__picked")
    )
    return (
        df.join(picks, (F.col(shard) == F.col("__shard")) & (F.col(idx) == F.col("__idx")), "left")
        .withColumn(split_col, F.when(F.col("__picked"), "test").otherwise("train"))
        .drop("__shard", "__idx", "__picked")
    )

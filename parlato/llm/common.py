"""Helpers that the jobs of this subpackage share."""

from __future__ import annotations

import math
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlato.session import staged

# Bytes of text that one group of documents holds on average.
CHUNK_BYTES = 2 << 20
# Keys that one shard of a distributed count holds on average.
SHARD_KEYS = 2_000_000

# Odd multipliers of the rolling hashes and of the finaliser.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored in the shared folder and read back; the shuffle files that made it go."""
    return staged(df, label)


def n_words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` in UTF-8, unchanged."""
    return text.encode("utf-8").split() if text else []


def chunks_for(total_bytes: int | None, chunk_bytes: int = CHUNK_BYTES) -> int:
    return max(1, math.ceil((total_bytes or 0) / chunk_bytes))


def chunk_of(key: Column, text: Column, chunks: int) -> Column:
    """A group number for each row. Rows of one key meet; rows without a key are spread by their text."""
    return F.pmod(F.when(key.isNull(), F.xxhash64(text)).otherwise(F.xxhash64(key)), F.lit(chunks)).cast("int")


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(MIX[0])
    h ^= h >> np.uint64(27)
    h *= np.uint64(MIX[1])
    h ^= h >> np.uint64(31)
    return h


def slices(sizes: np.ndarray, rows: int, most: int) -> Iterator[slice]:
    """Cuts of a batch into runs of at most ``rows`` rows and ``most`` bytes; a larger row is alone."""
    lo = held = 0
    for hi, size in enumerate(sizes):
        if hi > lo and (hi - lo >= rows or held + size > most):
            yield slice(lo, hi)
            lo = hi
            held = 0
        held += size
    if lo < len(sizes):
        yield slice(lo, len(sizes))


class WordIds(dict):
    """Numbers words as they come; ``halves`` has the two 64-bit halves of each word's digest."""

    def __init__(self) -> None:
        super().__init__()
        self.halves = array("Q")

    def __missing__(self, word: bytes) -> int:
        self.halves.frombytes(blake2b(word, digest_size=16).digest())
        self[word] = n = len(self)
        return n

    def of(self, word_list: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, word_list), np.int64, len(word_list))


class Windows:
    """Windows of ``size`` consecutive words of some texts, with a 128-bit hash each.

    ``doc`` and ``start`` tell where a window starts, in the order of the texts;
    ``first`` and ``second`` are the halves of its hash, which depends on the words
    alone. With ``short``, a text of fewer words, but not of none, has one window. With
    one of the ``halves``, ``second`` is 0.
    """

    def __init__(self, texts: Iterable[str | None], size: int, short: bool = False, halves: int = 2) -> None:
        ids = WordIds()
        pad = ids[b" "]  # no word holds a space
        parts, counts = [], []
        for text in texts:
            found = ids.of(words(text))
            counts.append(len(found))
            if short and 0 < len(found) < size:
                found = np.append(found, np.full(size - len(found), pad))
            parts.append(found)
        self.n_words = np.array(counts, np.int64)
        held = np.array([len(p) for p in parts], np.int64)
        flat = np.concatenate([*parts, np.empty(0, np.int64)])
        n = np.maximum(held - (size - 1), 0)
        self.n_windows = n
        self.doc = np.repeat(np.arange(len(parts)), n)
        self.start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(np.cumsum(held) - held, n) + self.start
        digests = np.frombuffer(ids.halves, np.uint64).reshape(-1, 2)
        made = [self._rolled(digests[:, k][flat], size, base)[at] for k, base in enumerate(BASES[:halves])]
        self.first, self.second = made if halves == 2 else (*made, np.zeros(len(at), np.uint64))

    @staticmethod
    def _rolled(h: np.ndarray, size: int, base: int) -> np.ndarray:
        m = len(h) - size + 1
        if m <= 0:
            return np.empty(0, np.uint64)
        out = h[:m].copy()
        for j in range(1, size):
            out *= np.uint64(base)
            out += h[j : j + m]
        return mix(out)


def member_index(sorted_values: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value stands in ``sorted_values``, and whether it does."""
    if not len(sorted_values):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return at, sorted_values[at] == values


def cuts_of(keys: DataFrame, rows_per_range: int, total: int) -> list[str]:
    """Sorted text keys that cut ``keys`` (one column, distinct values) into even ranges.

    Reads about eight keys of each range, picked by hash, so reruns agree.
    """
    ranges = math.ceil(total / rows_per_range)
    if ranges < 2:
        return []
    name = keys.columns[0]
    share = max(1, rows_per_range // 8)
    picked = keys.where(F.pmod(F.xxhash64(name), F.lit(share)) == 0)
    sample = sorted(row[0] for row in picked.collect())
    step = len(sample) / ranges
    return sorted({sample[int(step * i)] for i in range(1, ranges)}) if step >= 1 else sample


def in_ranges(
    rows: DataFrame, range_rows: int, guests: Callable[[list[tuple[int, str, str]]], dict[str, list[int]]]
) -> DataFrame:
    """``rows`` with ``range`` and ``guest``: cut into ranges of the order of their text column ``order``.

    ``guests`` gets ``range, first, last`` of every range, in order, and tells by
    order keys which rows also go to which other ranges; so neighbours meet
    although each range is worked on by itself. What the driver holds is a few
    keys for each range.
    """
    keys = rows.select("order")
    context = rows.sparkSession.sparkContext
    cuts = context.broadcast(cuts_of(keys, range_rows, keys.count()))

    def ranges(order: pd.Series) -> pd.Series:
        return order.map(lambda key: bisect_right(cuts.value, key)).astype("int32")

    held = keys.select("order", F.pandas_udf(ranges, "int")("order").alias("range"))
    ends = held.groupBy("range").agg(F.min("order").alias("first"), F.max("order").alias("last")).collect()
    places = context.broadcast(guests(sorted((e["range"], e["first"], e["last"]) for e in ends)))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(range=ranges(batch["order"]), guest=False)
            again = batch[batch["order"].map(places.value.__contains__).astype(bool)]
            if len(again):
                again = again.assign(range=again["order"].map(places.value), guest=True).explode("range")
                yield again.astype({"range": "int32"})

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(placed, f"{kinds}, range int, guest boolean")

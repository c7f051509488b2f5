"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlato.llm.bpe import byte_letters, vocabulary_path
from parlato.llm.common import slices, table

# Fixed value: how the vocabulary's authors cut texts before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LIMIT = 1024
# Rows and bytes of text that a worker looks at in one go; a longer text is looked at alone.
SLICE_ROWS, SLICE_BYTES = 500, 4 << 20
# Counts of runs of text that a worker keeps, and the longest run that it keeps.
KEPT_RUNS, KEPT_LENGTH = 250_000, 64
# Symbols merged in one go.
STRIP = 1 << 20


class Merger:
    """The merges of a byte-level vocabulary as sorted arrays: pair of symbols, rank, symbol made."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]) -> None:
        self.width = max(vocabulary.values(), default=0) + 1
        pairs = np.array([vocabulary[a] * self.width + vocabulary[b] for a, b in merges], np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        self.none = len(merges)
        # should a pair be listed twice, the earlier one counts
        self.pairs, self.rank = np.unique(pairs, return_index=True)
        self.byte = np.array([vocabulary[letter] for letter in byte_letters()], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``none`` if no merge takes it."""
        if not self.none:
            return np.zeros(len(left), np.int64)
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.rank[at], self.none)

    def sizes(self, sequences: list[bytes]) -> np.ndarray:
        """How many symbols survive of each sequence.

        All sequences lie one after the other in one array, with the rank of the
        pair that starts at each place. In each step every sequence that still has
        a pair to merge merges its lowest-rank pair wherever it occurs, from the left where occurrences
        overlap; ranks are looked up anew next to merged places only. A
        sequence without such a pair leaves the arrays.
        """
        size = np.array([len(s) for s in sequences], np.int64)
        symbol = self.byte[np.frombuffer(b"".join(sequences), np.uint8)]
        owner = np.repeat(np.arange(len(size)), size)
        rank = np.full(len(symbol), self.none)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self.ranks(symbol[inner], symbol[inner + 1])
        while len(symbol):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, first)
            length = np.diff(np.append(first, len(symbol)))
            if (lowest == self.none).any():
                active = np.repeat(lowest < self.none, length)
                symbol, owner, rank = symbol[active], owner[active], rank[active]
                length, lowest = length[lowest < self.none], lowest[lowest < self.none]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, length))
            order = np.arange(len(at))
            apart = np.append(True, np.diff(at) > 1)
            at = at[(order - np.maximum.accumulate(np.where(apart, order, 0))) % 2 == 0]
            symbol[at] = self.made[rank[at]]
            size -= np.bincount(owner[at], minlength=len(size))
            kept = np.ones(len(symbol), bool)
            kept[at + 1] = False
            symbol, owner, rank = symbol[kept], owner[kept], rank[kept]
            at -= np.arange(len(at))
            rank[at] = self.none
            for left in (at[at > 0] - 1, at[at + 1 < len(symbol)]):
                left = left[owner[left] == owner[left + 1]]
                rank[left] = self.ranks(symbol[left], symbol[left + 1])
        return size


class Counter:
    """Token counts of whole texts, as the ``tokenizers`` library gives them for a byte-level file.

    Special tokens are found in the text as it is, one token each. No pre-token
    goes on past a space between two other characters, so texts are cut there
    into runs, whose counts are kept; the pre-tokens of all new runs are merged together.
    """

    # white space beside a space, where a cut could part a pre-token
    WIDE = re.compile(r"(?:^|\s) | (?:\s|$)")
    CUT = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model = held["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merger = Merger(model["vocab"], merges)
        names = sorted((t["content"] for t in held["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.pattern = regex.compile(PATTERN)
        self.newer = _newer(regex.compile(r"[\p{L}\p{N}]"))
        self.library = Tokenizer.from_file(path)
        self.bytes_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        # of two generations of runs the older goes when the younger is full
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def _pieces(self, run: str) -> list[str]:
        """The pre-tokens of a run with characters on which two databases may differ: the library is asked."""
        found = self.library.pre_tokenizer.pre_tokenize_str(run)
        return [bytes([self.bytes_of[letter] for letter in p]).decode("utf-8") for p, _ in found]

    def _counted(self, runs: list[str]) -> dict[str, int]:
        """Token counts of distinct runs: their distinct pre-tokens merged strip by strip, then added up."""
        if not runs:
            return {}
        plain = self.newer.isdisjoint("".join(runs))
        pieces = [self.pattern.findall(r) if plain or self.newer.isdisjoint(r) else self._pieces(r) for r in runs]
        number = {piece: n for n, piece in enumerate(dict.fromkeys(chain.from_iterable(pieces)))}
        distinct = list(map(str.encode, number))
        ends = np.cumsum(list(map(len, distinct)))
        size, lo = [], 0
        while lo < len(distinct):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + STRIP, side="right")))
            size.append(self.merger.sizes(distinct[lo:hi]))
            lo = hi
        length = np.array(list(map(len, pieces)), np.int64)
        flat = np.fromiter(map(number.__getitem__, chain.from_iterable(pieces)), np.int64, int(length.sum()))
        total = np.add.reduceat(np.concatenate(size)[flat], np.cumsum(length) - length)
        return dict(zip(runs, total.tolist(), strict=True))

    def _runs(self, text: str) -> list[str]:
        parts = self.CUT.split(text) if self.WIDE.search(text) else text.split(" ")
        # a run that follows a space begins with it
        return [parts[0], *map(" ".__add__, parts[1:])]

    def count(self, texts: list[str | None]) -> list[int]:
        """Number of tokens of each text; null counts as empty."""
        runs, extra = [], []
        for text in texts:
            parts = self.special.split(text) if text and self.special else [text]
            runs.append([run for part in parts if part for run in self._runs(part)])
            extra.append(len(parts) - 1)
        wanted = set(chain.from_iterable(runs))
        look = {run: n for run in wanted if (n := self.young.get(run) or self.old.get(run))}
        new = [run for run in wanted if run not in look]
        look |= zip(new, self._counted(new).values(), strict=True)
        if len(self.young) > KEPT_RUNS:
            self.old, self.young = self.young, {}
        self.young |= {run: n for run, n in look.items() if len(run) <= KEPT_LENGTH}
        return [sum(map(look.__getitem__, found)) + n for found, n in zip(runs, extra, strict=True)]


def _newer(letters) -> set[str]:
    """Letters and digits of the pattern's database that Python's does not know: the library may not either."""
    known = ("L", "N")
    every = map(chr, chain(range(0x80, 0xD800), range(0xE000, 0x110000)))
    return {c for c in every if letters.match(c) and unicodedata.category(c)[0] not in known}


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter of a file, which a worker builds once."""
    if path not in _counters:
        _counters.clear()
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, text: str, path: str, limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``: whether there are more than ``limit`` tokens.

    ``path`` names a byte-level BPE file that every worker can open. Whole texts
    are counted, without begin, end or added special tokens; special strings
    inside a text count as one token each. Null and empty texts have no bytes and no tokens.
    Columns of the three names are replaced, others stay. Each row is counted by itself, so
    repeated rows stay and no rows give none. Rows are not moved; a worker keeps the
    counts of ``KEPT_RUNS`` runs of text and looks at ``SLICE_BYTES`` of text, or one longer text, at a time.
    """
    added = ("n_bytes", "n_tokens", "over_limit")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    place = docs.columns.index(text)
    schema = T.StructType([*docs.schema, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = counter(path)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for cut in slices(sizes, SLICE_ROWS, SLICE_BYTES):
                part = batch.slice(cut.start, cut.stop - cut.start)
                n = made.count(part.column(place).to_pylist())
                columns = [*part.columns, pa.array(sizes[cut], pa.int64()), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, "text", vocabulary_path("byte_bpe_50k.json")).select("doc_id", "n_bytes", "n_tokens", "over_limit")

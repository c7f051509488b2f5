"""Phrase collocation mining: pairs of frequency-ranked ids counted in tiles, frequent pairs ranked and paired again."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parlato.llm.common import stage, table
from parlato.operators.numbering import number_by_key

# Phrases that count, and how many are listed.
LEAST, PERCENT, TOP = 10, 50, 2000
# Bytes of one language's text that one chunk holds, and of all languages that a task holds.
CHUNK_BYTES, HELD_BYTES = 1 << 20, 8 << 20
# A tile has 2^BITS ids a side; it is counted in dense cells from DENSE pairs on.
BITS, DENSE = 10, 1 << 16
# Pairs that a task counts in one go.
STRIP = 1 << 21
# Ids of words and of pairs lie in 31 bits, so that two of them make one key.
MOST_IDS = 1 << 31

# Letters A-Z to lower case, ends of pieces to a byte that UTF-8 never has.
EDGE = b"\xff"
LETTERS = bytes(range(0x41, 0x5B))
FOLD = bytes.maketrans(LETTERS + b".,;:!?\x0a\x0b\x0c\x0d", LETTERS.lower() + EDGE * 10)


def pieces_of(text: str) -> list[bytes]:
    """The words of a text in UTF-8, with ``EDGE`` where a piece ends."""
    return text.encode("utf-8").translate(FOLD).replace(EDGE, b" \xff ").split()


class Chunk:
    """Words of one language numbered as they come; 0 stands between pieces."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {EDGE: 0}
        self.parts: list[np.ndarray] = []
        self.bytes = 0

    def add(self, text: str) -> None:
        found, number = pieces_of(text), self.number
        for word in found:
            if word not in number:
                number[word] = len(number)
        found.append(EDGE)
        self.parts.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
        self.bytes += len(text)

    def row(self, lang: str, name: int) -> pa.RecordBatch:
        flat = np.concatenate(self.parts)
        counts = np.bincount(flat, minlength=len(self.number))[1:]
        words = pa.array(list(self.number)[1:], pa.binary()).cast(pa.string())
        flat = flat.astype(_width(len(words)))
        own = pa.StructArray.from_arrays([pa.array(np.arange(1, len(words) + 1)), words, pa.array(counts)], ["at", "word", "n"])
        values = [[name], [lang], [flat.tobytes()], [len(words)], [int(counts.sum())]]
        columns = [*map(pa.array, values), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), own)]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "lang", "seq", "most", "n", "words"])


def _width(most: int) -> type:
    """The smallest type of a chunk's own numbers, the largest being ``most``."""
    return np.uint16 if most < 1 << 16 else np.int32


CHUNKS = "chunk long, lang string, seq binary, most long, n long, words array<struct<at: long, word: string, n: long>>"


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one task as chunks by language."""
    held: dict[str, Chunk] = {}
    first = TaskContext.get().partitionId() << 32
    made = total = 0

    def done(langs: Iterable[str]) -> Iterator[pa.RecordBatch]:
        nonlocal made, total
        for lang in langs:
            chunk = held.pop(lang)
            total -= chunk.bytes
            yield chunk.row(lang, first + made)
            made += 1

    for batch in batches:
        for lang, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            chunk = held.setdefault(lang, Chunk())
            before = chunk.bytes
            chunk.add(text)
            total += chunk.bytes - before
            if chunk.bytes >= CHUNK_BYTES:
                yield from done([lang])
            if total >= HELD_BYTES:
                yield from done(list(held))
    yield from done(list(held))


class Tiles:
    """Counts pairs of ids, some millions at a time.

    Both ids are frequency ranks, so the pairs that occur most share a few tiles
    of small ids. A tile with many pairs is counted by direct address in a dense
    array of cells; the pairs of all others are sorted coordinates with counts.
    """

    def __init__(self) -> None:
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []
        self.held = 0

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        self.left.append(left)
        self.right.append(right)
        self.held += len(left)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys ``left * 2^32 + right`` and how often each was added; forgets them."""
        left, right = (np.concatenate([*side, np.empty(0, np.int64)]) for side in (self.left, self.right))
        self.__init__()
        tile = ((left >> BITS) << 32) | (right >> BITS)
        names, at, size = np.unique(tile, return_inverse=True, return_counts=True)
        keys, counts = [], []
        for t in np.flatnonzero(size >= DENSE):
            here = at == t
            cell = ((left[here] & ((1 << BITS) - 1)) << BITS) | (right[here] & ((1 << BITS) - 1))
            n = np.bincount(cell, minlength=1 << 2 * BITS)
            cell = np.flatnonzero(n)
            row, column = names[t] >> 32, names[t] & 0xFFFFFFFF
            keys.append((((row << BITS) | (cell >> BITS)) << 32) | (column << BITS) | (cell & ((1 << BITS) - 1)))
            counts.append(n[cell])
        sparse = size[at] < DENSE
        key, n = np.unique((left[sparse] << 32) | right[sparse], return_counts=True)
        return np.concatenate([*keys, key]), np.concatenate([*counts, n])


def _counted(pairs: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]]) -> Callable:
    """Counts in tiles over one task's chunks; ``pairs`` gives the two ids of each occurrence in one chunk after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = Tiles()
        for batch in batches:
            for left, right in pairs(batch):
                tiles.add(left, right)
                if tiles.held >= STRIP:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, tiles.counts())), ["key", "n"])
        if tiles.held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, tiles.counts())), ["key", "n"])

    return run


def _ids(seq: bytes) -> np.ndarray:
    return np.frombuffer(seq, np.int32).astype(np.int64)


def _word_pairs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for seq in batch.column("seq"):
        ids = _ids(seq.as_py())
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        yield ids[at], ids[at + 1]


def _pair_words(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of frequent pairs, each with the word that follows where that ends a frequent pair too."""
    for seq, known in zip(batch.column("seq"), batch.column("known"), strict=True):
        ids, known = _ids(seq.as_py()), known.values
        keys, names = (known.field(c).to_numpy() for c in ("key", "id"))
        order = np.argsort(keys)
        keys, names = keys[order], names[order]
        key = (ids[:-1] << 32) | ids[1:]
        at = np.searchsorted(keys, key)
        at[at == len(keys)] = 0
        pair = np.where((ids[:-1] >= 0) & (ids[1:] >= 0) & (keys[at] == key), names[at], -1)
        place = np.flatnonzero((pair[:-1] >= 0) & (pair[1:] >= 0))
        yield pair[place], ids[place + 2]


def _own_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of each chunk."""
    for batch in batches:
        for chunk, (left, right) in zip(batch.column("chunk"), _word_pairs(batch), strict=True):
            keys = np.unique((left << 32) | right)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), chunk.as_py())), pa.array(keys)], ["chunk", "key"])


def _recoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in ids of the whole corpus; -1 stands between pieces and for rare words, once where several meet."""
    for batch in batches:
        for chunk, seq, most, known in zip(*(batch.column(c) for c in ("chunk", "seq", "most", "known")), strict=True):
            local, known = np.frombuffer(seq.as_py(), _width(most.as_py())), known.values
            ids = np.full(most.as_py() + 1, -1, np.int32)
            ids[known.field("at").to_numpy()] = known.field("id").to_numpy()
            out = ids[local]
            out = out[np.append(True, (out[1:] >= 0) | (out[:-1] >= 0))]
            yield pa.RecordBatch.from_arrays([pa.array([chunk.as_py()]), pa.array([out.tobytes()], pa.binary())], ["chunk", "seq"])


def _numbered(rows: DataFrame, order: list, label: str) -> DataFrame:
    """``rows`` with ``id``: their place in the order given, stored."""
    made = stage(number_by_key(rows, order, "id"), label)
    if made.where(F.col("id") >= MOST_IDS).limit(1).count():
        raise ValueError("more than 2^31 frequent words or pairs")
    return made


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in whole numbers of up to 38 digits."""
    a, left, right = (f"cast({c} as decimal(16, 0))" for c in (a, left, right))
    return F.expr(f"cast(cast(1000000 * {a} * {a} as decimal(38, 0)) div cast({left} * {right} as decimal(38, 0)) as long)")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, percent: int = PERCENT, top: int = TOP
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the phrases of two or three words that stick together most.

    Texts with A-Z in lower case are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces
    and those into words ``[^\\x20\\x09]+``; no phrase crosses a piece. All is per
    language: ``n`` word occurrences, ``a`` occurrences of a phrase. A phrase
    counts from ``least`` on. Cut after its first words, with ``l`` and ``r``
    occurrences of the two parts, it scores floor(1000000 * a * a / (l * r)); the
    cut with the lowest score counts, of equal ones the first. A phrase
    inside a longer one that has at least ``percent`` per cent of its occurrences
    is dropped. The first ``top`` of each language are returned, by score, then
    ``a``, then the bytes of the phrase.

    Tasks number the words of their texts chunk by chunk. Words that occur often
    enough are ranked by frequency over the corpus, and each chunk gets the ranks of
    its own words back. Tasks count pairs of ranks tile by tile, the cells of
    busy tiles by direct address, and Spark sums the counts by pair. Frequent
    pairs are ranked in turn, sent back to their chunks and paired with the word that
    follows. Nothing is broadcast and no group holds more than one chunk's words; hash tables of
    joins are of words or pairs, each of which occurs there once.

    Null texts are empty, a null language is ``und``; repeated rows count each
    time, other columns are ignored, and no rows give none. At most 2^31 words or
    pairs may be frequent; counts up to 10^15 are exact.
    """
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    chunks = stage(rows.mapInArrow(_chunked, CHUNKS), "phrase-chunks")
    own = chunks.select("chunk", "lang", F.inline("words"))
    words = own.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    words = _numbered(stage(words, "phrase-words"), ["lang", F.desc("f"), "word"], "phrase-ranks")
    back = own.select("chunk", "lang", "at", "word").join(words.select("lang", "word", "id").hint("shuffle_hash"), ["lang", "word"])
    back = back.groupBy("chunk").agg(F.collect_list(F.struct("at", F.col("id").cast("int").alias("id"))).alias("known"))
    coded = chunks.select("chunk", "seq", "most").join(back, "chunk")
    coded = stage(coded.mapInArrow(_recoded, "chunk long, seq binary"), "phrase-codes")

    def often(counts: DataFrame, label: str) -> DataFrame:
        return stage(counts.groupBy("key").agg(F.sum("n").alias("a")).where(F.col("a") >= least), label)

    pairs = often(coded.mapInArrow(_counted(_word_pairs), "key long, n long"), "phrase-pairs")
    pairs = _numbered(pairs, [F.desc("a"), "key"], "phrase-pair-ranks")
    back = coded.mapInArrow(_own_pairs, "chunk long, key long").join(pairs.select("key", "id").hint("shuffle_hash"), "key")
    back = back.groupBy("chunk").agg(F.collect_list(F.struct("key", "id")).alias("known"))
    paired = coded.join(back, "chunk").select("seq", "known")
    triples = often(paired.mapInArrow(_counted(_pair_words), "key long, n long"), "phrase-triples")

    def first(key: str) -> Column:
        return F.shiftright(key, 32)

    def second(key: str) -> Column:
        return F.col(key).bitwiseAND(0xFFFFFFFF)

    lefts = words.select(F.col("id").alias("i"), "lang", F.col("word").alias("w1"), F.col("f").alias("f1"))
    rights = words.select(F.col("id").alias("j"), F.col("word").alias("w2"), F.col("f").alias("f2"))
    two = pairs.withColumn("i", first("key")).withColumn("j", second("key")).join(lefts, "i").join(rights, "j")
    two = stage(two.select("id", "key", "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "f1", "f2", "j"), "phrase-two")
    heads = two.select(F.col("id").alias("p"), "lang", "phrase", F.col("a").alias("f12"), "f1", "j")
    three = triples.withColumn("p", first("key")).withColumn("k", second("key")).drop("key").join(heads, "p")
    tails = pairs.select("key", F.col("id").alias("q"), F.col("a").alias("f23"))
    three = three.withColumn("key", F.shiftleft("j", 32).bitwiseOR(F.col("k"))).join(tails, "key")
    three = three.join(rights.select(F.col("j").alias("k"), F.col("w2").alias("w3"), F.col("f2").alias("f3")), "k")
    three = stage(three.drop("key", "j", "k"), "phrase-three")
    whole = three.select(F.explode(F.array("p", "q")).alias("id"), "a").groupBy("id").agg(F.max("a").alias("longer"))
    kept = two.join(whole, "id", "left").where(f"longer is null or 100 * longer < {percent} * a")
    kept = kept.select("lang", "phrase", "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score"))
    one, other = _score("a", "f1", "f23"), _score("a", "f12", "f3")
    early = one <= other
    longer = three.select(
        "lang",
        F.concat_ws(" ", "phrase", "w3").alias("phrase"),
        "a",
        F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least(one, other).alias("score"),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.unionByName(longer).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    totals = chunks.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS t FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(t, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
o AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g1 AS (SELECT lang, w[i] AS g, count(*) AS f FROM o GROUP BY ALL),
g2 AS (SELECT lang, w[i] AS a, w[i + 1] AS b, count(*) AS f FROM o WHERE i + 1 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
g3 AS (
  SELECT lang, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, count(*) AS f
  FROM o WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
k AS (
  SELECT g2.lang, concat(g2.a, ' ', g2.b) AS phrase, 1 AS k, g2.f AS a, x.f AS l, y.f AS r
  FROM g2 JOIN g1 x ON x.lang = g2.lang AND x.g = g2.a JOIN g1 y ON y.lang = g2.lang AND y.g = g2.b
  WHERE NOT EXISTS (
    SELECT 1 FROM g3 WHERE g3.lang = g2.lang AND g3.a = g2.a AND g3.b = g2.b AND 100 * g3.f >= 50 * g2.f)
  AND NOT EXISTS (
    SELECT 1 FROM g3 WHERE g3.lang = g2.lang AND g3.b = g2.a AND g3.c = g2.b AND 100 * g3.f >= 50 * g2.f)
  UNION ALL
  SELECT g3.lang, concat(g3.a, ' ', g3.b, ' ', g3.c), 1, g3.f, x.f, y.f
  FROM g3 JOIN g1 x ON x.lang = g3.lang AND x.g = g3.a JOIN g2 y ON y.lang = g3.lang AND y.a = g3.b AND y.b = g3.c
  UNION ALL
  SELECT g3.lang, concat(g3.a, ' ', g3.b, ' ', g3.c), 2, g3.f, x.f, y.f
  FROM g3 JOIN g2 x ON x.lang = g3.lang AND x.a = g3.a AND x.b = g3.b JOIN g1 y ON y.lang = g3.lang AND y.g = g3.c),
s AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM k),
x AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
n AS (SELECT lang, count(*) AS n FROM o GROUP BY lang),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INTEGER AS rank FROM x)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM r JOIN n USING (lang) WHERE rank <= 2000
"""

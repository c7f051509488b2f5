"""Removal of word windows that occur earlier in the corpus: a count-min prefilter, then exact grouping."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlato.llm.common import CHUNK_BYTES, SHARD_KEYS, Windows, chunk_of, chunks_for, member_index, mix, n_words, stage, table, words

WINDOW = 20
LAST = np.iinfo(np.int64).max


def cells_of(windows: Windows, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard and the cell in it that count each window in the sketch."""
    h = mix(windows.first + np.uint64(0x632BE59BD9B4E019) * windows.second)
    return ((h >> np.uint64(32)) % np.uint64(shards)).astype(np.int64), (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def parted(shard: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    """Shards that occur in a sorted array, and where."""
    edges = np.searchsorted(shard, np.arange(shards + 1))
    for s in range(shards):
        if edges[s] < edges[s + 1]:
            yield s, slice(edges[s], edges[s + 1])


def in_order(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.assign(text=rows["text"].fillna("")).sort_values(["doc", "text"], kind="stable", ignore_index=True)


def sketched(size: int, shards: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The sketch of one chunk of documents, sparse and cut in shards: cells that are not 0, and whether above 1."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        shard, cell = cells_of(Windows(rows["text"], size), shards)
        both, n = np.unique((shard.astype(np.uint64) << np.uint64(32)) | cell, return_counts=True)
        shard, cell = (both >> np.uint64(32)).astype(np.int64), both.astype(np.uint32)
        made = [(s, cell[at].tobytes(), np.packbits(n[at] > 1).tobytes()) for s, at in parted(shard, shards)]
        return pd.DataFrame(made, columns=["shard", "cells", "twice"]).assign(chunk=rows["chunk"].iat[0])

    return run


def merged(rows: pd.DataFrame) -> pd.DataFrame:
    """One shard's sketches summed; gives each chunk back those of its cells that count two or more."""
    cells = [np.frombuffer(c, np.uint32) for c in rows["cells"]]
    twice = [np.unpackbits(np.frombuffer(t, np.uint8), count=len(c)).astype(bool) for c, t in zip(cells, rows["twice"], strict=True)]
    every = np.sort(np.concatenate(cells))
    hot = np.union1d(every[1:][every[1:] == every[:-1]], np.concatenate([c[t] for c, t in zip(cells, twice, strict=True)]))
    mine = [c[member_index(hot, c)[1]] for c in cells]
    out = pd.DataFrame({"chunk": rows["chunk"].to_numpy(), "shard": rows["shard"].to_numpy(), "cells": [m.tobytes() for m in mine]})
    return out[[len(m) > 0 for m in mine]]


def suspected(size: int, shards: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """A chunk's windows that the merged sketch takes for repeated: each once, with the first document that has it."""

    def run(rows: pd.DataFrame, hot: pd.DataFrame) -> pd.DataFrame:
        columns = ["shard", "first", "second", "docs", "twice", "chunk"]
        if not len(rows) or not len(hot):
            return pd.DataFrame(columns=columns)
        rows = in_order(rows)
        windows = Windows(rows["text"], size)
        shard, cell = cells_of(windows, shards)
        known = np.sort(
            np.concatenate([np.frombuffer(c, np.uint32) | np.uint64(s << 32) for s, c in zip(hot["shard"], hot["cells"], strict=True)])
        )
        at = np.flatnonzero(member_index(known, (shard.astype(np.uint64) << np.uint64(32)) | cell)[1])
        # stable, so the first of equal windows is the earliest
        at = at[np.lexsort((windows.second[at], windows.first[at], shard[at]))]
        a, b = windows.first[at], windows.second[at]
        new = np.ones(len(at), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        n = np.diff(np.append(np.flatnonzero(new), len(at)))
        at = at[new]
        doc = rows["doc"].to_numpy(np.int64)[windows.doc[at]]
        made = [
            (s, windows.first[at[k]].tobytes(), windows.second[at[k]].tobytes(), doc[k].tobytes(), np.packbits(n[k] > 1).tobytes())
            for s, k in parted(shard[at], shards)
        ]
        return pd.DataFrame(made, columns=columns[:-1]).assign(chunk=rows["chunk"].iat[0])

    return run


def grouped(rows: pd.DataFrame) -> pd.DataFrame:
    """One shard's windows grouped by their whole hash; tells each chunk which of its own do repeat, and whether
    the earliest of all is in it."""
    sizes = [len(x) // 8 for x in rows["first"]]
    first, second = (np.concatenate([np.frombuffer(x, np.uint64) for x in rows[c]]) for c in ("first", "second"))
    docs = np.concatenate([np.frombuffer(x, np.int64) for x in rows["docs"]])
    twice = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n) for t, n in zip(rows["twice"], sizes, strict=True)])
    chunk = np.repeat(rows["chunk"].to_numpy(), sizes)
    order = np.lexsort((chunk, docs, second, first))
    new = np.ones(len(order), bool)
    a, b = first[order], second[order]
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.cumsum(new) - 1
    n = np.bincount(group, minlength=1)
    repeated = np.empty(len(order), bool)
    repeated[order] = (n[group] > 1) | (twice[order] == 1)
    earliest = np.empty(len(order), bool)
    earliest[order] = new
    made = []
    for c, lo, hi in zip(rows["chunk"], np.cumsum(sizes) - sizes, np.cumsum(sizes), strict=True):
        k = lo + np.flatnonzero(repeated[lo:hi])
        if len(k):
            made.append((c, first[k].tobytes(), second[k].tobytes(), np.packbits(earliest[k]).tobytes()))
    return pd.DataFrame(made, columns=["chunk", "first", "second", "earliest"])


def removed(size: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """A chunk's documents without the words of windows that occur earlier."""

    def run(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        rows = in_order(rows)
        texts = rows["text"].tolist()
        out = {"doc": rows["doc"], "no_id": rows["no_id"]}
        gone: dict[int, np.ndarray] = {}
        n = None
        if len(known):
            windows = Windows(texts, size)
            n = windows.n_words
            first, second = (np.concatenate([np.frombuffer(x, np.uint64) for x in known[c]]) for c in ("first", "second"))
            sizes = [len(x) // 8 for x in known["first"]]
            here = np.concatenate(
                [np.unpackbits(np.frombuffer(t, np.uint8), count=m) for t, m in zip(known["earliest"], sizes, strict=True)]
            ).astype(bool)
            order = np.lexsort((second, first))
            first, second, here = first[order], second[order], here[order]
            at, met = member_index(first, windows.first)
            # windows that share the first half of their hash stand side by side
            while (other := np.flatnonzero(met & (second[at] != windows.second))).size:
                at[other] += 1
                met[other] = at[other] < len(first)
                at[other[~met[other]]] = 0
                met[other] &= first[at[other]] == windows.first[other]
            at, place = at[met], np.flatnonzero(met)
            original = np.zeros(len(place), bool)
            original[np.unique(at, return_index=True)[1]] = True
            place = place[~(original & here[at])]
            where = windows.doc[place]
            for doc in np.unique(where):
                lo, hi = np.searchsorted(where, [doc, doc + 1])
                start = windows.start[place[lo:hi]]
                edge = np.zeros(n[doc] + 1, np.int64)
                edge[start] += 1
                np.add.at(edge, start + size, -1)
                gone[int(doc)] = np.cumsum(edge[:-1]) > 0
        kept, counts, lost = [], [], []
        for k, text in enumerate(texts):
            found = words(text)
            counts.append(len(found))
            lost.append(int(gone[k].sum()) if k in gone else 0)
            if k in gone:
                found = [w for w, g in zip(found, gone[k], strict=True) if not g]
            kept.append(b" ".join(found).decode("utf-8"))
        return pd.DataFrame(out | {"n_words": counts, "n_removed": lost, "kept": kept})

    return run


def remove_repeats(docs: DataFrame, size: int = WINDOW, chunk_bytes: int = CHUNK_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: documents ``doc_id, text`` without the words of repeated windows.

    A window is ``size`` words in a row; it is repeated if the same words also
    start earlier, in a document of a smaller ``doc_id`` or further left. Windows
    are judged on the texts as they are.

    Documents are dealt to chunks by id. Each chunk counts its windows in a
    count-min sketch of one row, whose cells are cut in shards of 2^32, as many as
    the windows need; the sketches of all chunks are summed shard by shard, and
    each chunk learns which of its cells count two or more. No window that
    repeats can be missed. Only windows in such cells go to the second pass, once
    for each chunk with their 128-bit hash, where equal ones are grouped
    and the earliest is found. So what is sent for a passage that many documents
    share is bounded by the number of chunks, and nothing is broadcast.

    Null texts have no words. Null ids come after all others; the rows of one
    id are one document after another, in the order of their texts. Other columns
    are ignored, and no rows give none.
    """
    ordered = F.coalesce("doc_id", F.lit(int(LAST))).alias("doc")
    docs = docs.select(ordered, F.col("doc_id").isNull().alias("no_id"), "text")
    totals = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.sum(n_words(F.col("text"))).alias("words")).first()
    shards = max(1, -(-(totals["words"] or 0) // shard_keys))
    chunk = chunk_of(F.when(~F.col("no_id"), F.col("doc")), F.col("text"), chunks_for(totals["bytes"], chunk_bytes))
    docs = docs.withColumn("chunk", chunk)
    sketch = docs.groupBy("chunk").applyInPandas(sketched(size, shards), "chunk int, shard int, cells binary, twice binary")
    hot = stage(sketch.groupBy("shard").applyInPandas(merged, "chunk int, shard int, cells binary"), "repeat-cells")
    pairs = docs.groupBy("chunk").cogroup(hot.groupBy("chunk")).applyInPandas(
        suspected(size, shards), "chunk int, shard int, first binary, second binary, docs binary, twice binary"
    )
    known = pairs.groupBy("shard").applyInPandas(grouped, "chunk int, first binary, second binary, earliest binary")
    known = stage(known, "repeat-windows")
    made = docs.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(
        removed(size), "doc long, no_id boolean, n_words long, n_removed long, kept string"
    )
    return made.select(F.when(~F.col("no_id"), F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept")


def op3_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (SELECT doc_id, w, unnest(range(len(w) - 19)) AS p FROM w WHERE len(w) >= 20),
h AS (SELECT doc_id, p, row_number() OVER (PARTITION BY array_to_string(w[p + 1 : p + 20], ' ') ORDER BY doc_id, p) AS k FROM s),
g AS (SELECT doc_id, list_distinct(flatten(list(range(p, p + 20)))) AS gone FROM h WHERE k > 1 GROUP BY doc_id),
r AS (
  SELECT w.doc_id, len(w) AS n, coalesce(len(gone), 0) AS m,
    CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
      ELSE coalesce((SELECT string_agg(w[i + 1], ' ' ORDER BY i) FROM (
        SELECT unnest(range(len(w))) AS i) WHERE NOT list_contains(gone, i)), '') END AS kept
  FROM w LEFT JOIN g USING (doc_id))
SELECT doc_id, n::BIGINT AS n_words, m::BIGINT AS n_removed, sha256(kept) AS kept_sha256 FROM r
"""

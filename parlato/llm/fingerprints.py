"""MinHash fingerprints: universal hash permutations over word shingles, and pairs by signature bands."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlato.llm.common import Windows, in_ranges, stage, table

SHINGLE = 5
PERMUTATIONS = 128
BANDS = 32
THRESHOLD = 0.8
# Documents that one range of the document order holds on average.
RANGE_ROWS = 1024
# Shingles hashed at once.
STRIP = 1 << 16


def permutations(n: int = PERMUTATIONS, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of ``n`` multiply-shift hashes on 64 bits, a universal family."""
    drawn = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, (2, n), np.uint64)
    return drawn[0] | np.uint64(1), drawn[1]


def signatures(texts: Iterable[str | None], n: int = PERMUTATIONS, seed: int = 1) -> np.ndarray:
    """One row of ``n`` 32-bit minima for each text; a text without words has the largest value throughout.

    A shingle is five words in a row; a text of one to four words is one shingle.
    """
    windows = Windows(texts, SHINGLE, short=True)
    out = np.full((len(windows.n_words), n), 0xFFFFFFFF, np.uint32)
    filled = np.flatnonzero(windows.n_windows)
    if not len(filled):
        return out
    sizes = windows.n_windows[filled]
    ends = np.cumsum(sizes)
    a, b = permutations(n, seed)
    lo = 0
    while lo < len(filled):
        base = ends[lo] - sizes[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, base + STRIP, side="right")))
        x = windows.first[base : ends[hi - 1]]
        starts = ends[lo:hi] - sizes[lo:hi] - base
        buffer = np.empty_like(x)
        for k in range(n):
            np.multiply(x, a[k], out=buffer)
            buffer += b[k]
            out[filled[lo:hi], k] = np.minimum.reduceat(buffer, starts) >> np.uint64(32)
        lo = hi
    return out


def fingerprint_text(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal minima, an estimate of the Jaccard similarity; two texts without words are alike."""
    return (a == b).mean(axis=-1)


def signature_of(text: pd.Series) -> pd.Series:
    """The signature of each text as an array of longs."""
    return pd.Series(list(signatures(text).astype(np.int64)))


def shingle_jaccard(left: pd.Series, right: pd.Series) -> pd.Series:
    """Exact Jaccard similarity of the shingle sets of two texts; 0 where either has no words."""
    found = []
    for a, b in zip(left, right, strict=True):
        windows = Windows([a, b], SHINGLE, short=True)
        x, y = (np.unique(windows.first[windows.doc == k]) for k in (0, 1))
        both = len(np.intersect1d(x, y, assume_unique=True))
        found.append(both / max(1, len(x) + len(y) - both) if len(x) and len(y) else 0.0)
    return pd.Series(found)


def near_pairs(docs: DataFrame, key: str, text: str, threshold: float = THRESHOLD, bands: int = BANDS) -> DataFrame:
    """``left, right, jaccard``: each text linked to a more central one it resembles, verified.

    Texts that are equal are one; the smallest key stands for them. Signatures
    are cut into bands and rows that share a band meet in Spark by its hash. In a
    band every member is compared with the member of the smallest hash, so a band
    of n texts makes n - 1 pairs and not all of them; similar texts share many
    bands, each with a centre of its own. Null or empty texts and null keys make
    no pairs.
    """
    signed, verified = F.pandas_udf(signature_of, "array<long>"), F.pandas_udf(shingle_jaccard, "double")
    rows = docs.where(F.col(key).isNotNull() & F.col(text).rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.groupBy(F.sha2(text, 256).alias("sha")).agg(F.min(key).alias("id"), F.first(text).alias("text"))
    rows = stage(rows.select("id", "text", signed("text").alias("signature")), "fingerprints")
    width = PERMUTATIONS // bands
    cut = F.expr(f"transform(sequence(0, {bands - 1}), b -> xxhash64(b, slice(signature, b * {width} + 1, {width})))")
    banded = rows.select("id", F.explode(cut).alias("band"))
    centre = F.min(F.struct(F.xxhash64("band", "id").alias("h"), "id")).alias("centre")
    centres = stage(banded.groupBy("band").agg(centre, F.count("*").alias("n")).where("n > 1"), "fingerprint-bands")
    pairs = banded.join(centres.select("band", F.col("centre.id").alias("centre")), "band").where("id <> centre")
    pairs = pairs.select(F.least("id", "centre").alias("left"), F.greatest("id", "centre").alias("right")).distinct()
    texts = rows.select("id", "text")
    pairs = pairs.join(texts.select(F.col("id").alias("left"), F.col("text").alias("a")), "left")
    pairs = pairs.join(texts.select(F.col("id").alias("right"), F.col("text").alias("b")), "right")
    return pairs.select("left", "right", verified("a", "b").alias("jaccard")).where(F.col("jaccard") >= threshold)


def edited(text: str | None, following: str | None) -> str:
    """``text`` with its last floor(n / 2) characters replaced by the first as many, or all, of ``following``."""
    text, following = text or "", following or ""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(rows: pd.DataFrame) -> pd.DataFrame:
    """One range of documents in order, with the document that follows the range's last as a guest."""
    rows = rows.sort_values(["guest", "order"], ascending=[True, False], kind="stable")
    texts = rows["text"].fillna("").tolist()
    mine = int((~rows["guest"]).sum())
    following = texts[1 : mine + 1] if len(texts) > mine else [*texts[1:], texts[0]]
    changed = [edited(t, f) for t, f in zip(texts[:mine], following, strict=True)]
    own, other = signatures(texts), signatures(changed)
    nxt = own[1 : mine + 1] if len(texts) > mine else np.roll(own, -1, axis=0)
    return pd.DataFrame(
        {
            "order": rows["order"].to_numpy()[:mine],
            "n_chars": [len(t) for t in texts[:mine]],
            "edited": changed,
            "fingerprint": [fingerprint_text(s) for s in own[:mine]],
            "edited_fingerprint": [fingerprint_text(s) for s in other],
            "near_edited": likeness(own[:mine], other),
            "near_next": likeness(own[:mine], nxt),
        }
    )


def compare_with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of ``doc_id, text``, of its edited text and how near they are to the text's own.

    The edited text takes its end from the next document in descending ``doc_id``
    (after the last: the first). Documents are cut into ranges of the order; the
    largest of a range also goes to the range above it, so each range is compared
    by itself and texts are shuffled once. A table of one document follows
    itself. Null ids come last, rows of one id are in the order of their texts'
    hashes, null texts are empty, other columns are ignored, no rows give none.
    """
    # 20 digits sort like the number; nulls are below all of them
    number = F.lpad((F.col("doc_id").cast("decimal(20,0)") + F.lit(Decimal(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    tie = F.sha1(F.coalesce("text", F.lit("")))
    rows = docs.select("text", F.concat(F.coalesce(number, F.lit("-")), F.lit("/"), tie).alias("order"))

    def guests(ends: list[tuple[int, str, str]]) -> dict[str, list[int]]:
        return {last: [ends[(i + 1) % len(ends)][0]] for i, (_, _, last) in enumerate(ends)}

    rows = in_ranges(rows, range_rows, guests)
    made = rows.groupBy("range").applyInPandas(
        _compared,
        "order string, n_chars long, edited string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )
    digits = F.when(F.length("order") > 42, F.substring("order", 1, 20).cast("decimal(20,0)"))
    doc_id = (digits - F.lit(Decimal(1 << 63)).cast("decimal(20,0)")).cast("long")
    return made.select(doc_id.alias("doc_id"), *[c for c in made.columns if c != "order"])


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )

"""Corpus word error rate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlato.functions.edits import word_edits
from parlato.functions.text import normalize, words


def pair_edits(pairs: DataFrame, ref: str = "ref", hyp: str = "hyp", clean: bool = False) -> DataFrame:
    """``pairs`` with ``edits`` and ``ref_words``; both null where the reference is null or blank.

    ``clean`` normalises both sides first. A null hypothesis counts as empty.
    """
    sides = {"__ref": F.col(ref), "__hyp": F.coalesce(F.col(hyp), F.lit(""))}
    if clean:
        sides = {name: normalize(side) for name, side in sides.items()}
    scored = pairs.withColumns(sides).withColumns(
        {"__ref_words": words(F.col("__ref")), "__hyp_words": words(F.col("__hyp"))}
    )
    # a text that is not blank has a word
    kept = F.coalesce(F.size("__ref_words") > 0, F.lit(False))
    return scored.withColumns(
        {
            "edits": F.when(kept, word_edits(F.col("__ref_words"), F.col("__hyp_words"))),
            "ref_words": F.when(kept, F.size("__ref_words")),
        }
    ).drop("__ref", "__hyp", "__ref_words", "__hyp_words")


def word_error_rate(edited: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``n_pairs, edits, ref_words, wer`` of :func:`pair_edits`'s result, per group if ``by`` names columns.

    All edits over all reference words, not a mean of per-pair rates. Pairs
    without a reference do not count; where none counts, ``wer`` is 0.0.
    """
    sums = edited.groupBy(*by).agg(
        F.count("ref_words").alias("n_pairs"),
        F.coalesce(F.sum("edits"), F.lit(0)).alias("edits"),
        F.coalesce(F.sum("ref_words"), F.lit(0)).alias("ref_words"),
    )
    rate = F.when(F.col("ref_words") > 0, F.col("edits") / F.col("ref_words")).otherwise(F.lit(0.0))
    return sums.withColumn("wer", rate)


def score(
    pairs: DataFrame, ref: str = "ref", hyp: str = "hyp", by: Sequence[str] = (), clean: bool = False
) -> DataFrame:
    """Corpus word error rate of (reference, hypothesis) pairs: one row, or one per group."""
    return word_error_rate(pair_edits(pairs.select(ref, hyp, *by), ref, hyp, clean), by)

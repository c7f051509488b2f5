"""Scoring a recogniser: names, references and hypotheses to transcript files and word error rate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlato.functions.text import normalize
from parlato.operators.filters import MIN_VOTES, voted
from parlato.operators.lookup import last_reference, with_references
from parlato.operators.scoring import score
from parlato.session import staged
from parlato.sources.tables import read_references, suffix_of
from parlato.sources.transcripts import read_script_names, write_transcripts


def scoring_pairs(
    names: DataFrame,
    refs: DataFrame,
    hyps: DataFrame,
    order: str | None = None,
    votes: int = MIN_VOTES,
    on_missing: str = "error",
) -> DataFrame:
    """``utt_id, ref, hyp``, both sides normalised, for every name that has a hypothesis.

    ``hyps`` holds ``name, hyp``, one row per recording that was transcribed; names
    without one are dropped as missing audio. Votes are applied before repeated
    paths are resolved.
    """
    chosen = last_reference(voted(refs, votes), order)
    heard = names.join(hyps, "name")
    found = with_references(heard, chosen, on_missing=on_missing)
    return found.select("utt_id", normalize(F.col("sentence")).alias("ref"), normalize(F.col("hyp")).alias("hyp"))


def evaluate(
    spark: SparkSession,
    script_path: str,
    references_path: str,
    hyps: DataFrame,
    output_path: str,
    votes: int = MIN_VOTES,
    on_missing: str = "error",
    multi_line: bool = True,
) -> DataFrame:
    """Write ``hyp`` and ``ref`` transcript folders below ``output_path``; returns the score row.

    Of a path that repeats in a CSV of references the last row that has enough
    votes counts. Pairs are worked out once and stored. ``multi_line`` is that of
    :func:`parlato.sources.tables.read_csv`.
    """
    names = read_script_names(spark, script_path)
    order = "ord" if suffix_of(references_path) == ".csv" else None
    refs = read_references(spark, references_path, multi_line, order)
    pairs = staged(scoring_pairs(names, refs, hyps, order, votes, on_missing), "pairs")
    write_transcripts(pairs, output_path)
    return score(pairs)

"""Summaries of an utterance table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlato.operators.filters import SPLITS


def split_report(df: DataFrame, corpus: str = "OG_corpus", split_col: str = "split") -> DataFrame:
    """Utterances and seconds per corpus and split, and whether such rows are ``dropped``.

    All rows count, before any filter: those of an unknown or null split are left
    out of both tables, which this is the place to see.
    """
    dropped = ~F.coalesce(F.col(split_col).isin(*SPLITS), F.lit(False))
    return df.groupBy(corpus, split_col, dropped.alias("dropped")).agg(
        F.count("*").alias("n_utterances"), F.sum("duration").alias("total_seconds")
    )


def total_rows(df: DataFrame) -> DataFrame:
    """``n_rows`` of a whole table, for Parquet out of the file footers."""
    return df.agg(F.count("*").alias("n_rows"))

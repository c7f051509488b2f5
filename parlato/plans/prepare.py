"""Preparing a dataset for training: normalise, filter, write train and test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlato.functions.text import normalize
from parlato.operators.filters import MAX_SECONDS, MIN_SECONDS, at_least, at_most, known_splits
from parlato.schema import require_columns
from parlato.sources.shards import read_shards, write_splits
from parlato.sources.versions import read_current


def prepared(
    df: DataFrame,
    filter_by_duration: bool = False,
    split_col: str = "split",
    max_seconds: float = MAX_SECONDS,
    min_seconds: float = MIN_SECONDS,
    min_duration_splits: Sequence[str] = ("train",),
    lowercase: bool = False,
) -> DataFrame:
    """Rows of both splits with normalised text, as they are to be written: a scan with no shuffle.

    ``filter_by_duration`` also leaves out short rows of ``min_duration_splits``.
    """
    if "text" in df.columns:
        df = df.withColumn("text", normalize(F.col("text"), lowercase))
    df = known_splits(at_most(df, max_seconds), split_col)
    return at_least(df, min_seconds, min_duration_splits) if filter_by_duration else df


def prepare(
    spark: SparkSession, source: str | Sequence[str], target: str, filter_by_duration: bool = False, **options
) -> None:
    """``source`` shards to ``target/split=train`` and ``target/split=test`` in one pass.

    ``ValueError`` if a source lacks the split or ``duration``, which would read as
    null and leave no row; other columns may be missing.
    """
    for path in [source] if isinstance(source, str) else source:
        require_columns(read_current(spark, path), ["duration", options.get("split_col", "split")])
    rows = prepared(read_shards(spark, source), filter_by_duration, **options)
    write_splits(rows, target, options.get("split_col", "split"))

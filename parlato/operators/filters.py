"""Row predicates of the preparation and scoring steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlato.functions.text import strip_ws
from parlato.schema import require_columns

# Seconds kept at most, seconds kept at least, votes needed.
MAX_SECONDS = 30.0
MIN_SECONDS = 0.5
MIN_VOTES = 5

SPLITS = ("train", "test")


def at_most(df: DataFrame, seconds: float = MAX_SECONDS) -> DataFrame:
    """Durations up to and including ``seconds``; null and NaN go."""
    return df.filter(F.col("duration") <= seconds)


def at_least(df: DataFrame, seconds: float = MIN_SECONDS, splits: Sequence[str] | None = None) -> DataFrame:
    """Durations from ``seconds`` up. With ``splits`` only rows of those splits are tested."""
    keep = F.col("duration") >= seconds
    if splits is not None:
        keep = keep | ~F.coalesce(F.col("split").isin(*splits), F.lit(False))
    return df.filter(keep)


def known_splits(df: DataFrame, split_col: str = "split", splits: Sequence[str] = SPLITS) -> DataFrame:
    """Rows whose split is one of ``splits``; other values and null go."""
    return require_columns(df, [split_col]).filter(F.col(split_col).isin(*splits))


def voted(df: DataFrame, votes: int = MIN_VOTES, column: str = "up_votes") -> DataFrame:
    return require_columns(df, [column]).filter(F.col(column) >= votes)


def has_words(text: Column) -> Column:
    """True where ``text`` is neither null nor blank."""
    return F.coalesce(strip_ws(text) != "", F.lit(False))


def _faults(strict: bool) -> dict[str, Column]:
    """What makes a stored row unusable. ``strict`` also refuses a null text, which otherwise passes."""
    faults = {
        "no audio": F.col("audio").isNull(),
        "no audio bytes": F.col("audio.bytes").isNull(),
        "no duration": F.col("duration").isNull(),
    }
    return {**faults, "no text": F.col("text").isNull()} if strict else faults


def bad_row_reason(strict: bool = False) -> Column:
    """The first fault of a row, null if it has none."""
    return F.coalesce(*[F.when(fault, name) for name, fault in _faults(strict).items()])


def usable_rows(df: DataFrame, strict: bool = False) -> DataFrame:
    """Rows without a fault; each test reaches the scan on its own."""
    for fault in _faults(strict).values():
        df = df.filter(~fault)
    return df


def unusable_rows(df: DataFrame, strict: bool = False) -> DataFrame:
    """Path and reason of the rows :func:`usable_rows` leaves out."""
    return df.select(F.col("audio.path").alias("path"), bad_row_reason(strict).alias("reason")).filter(
        F.col("reason").isNotNull()
    )


def relabel_corpus(df: DataFrame, path: Column, tag: str = "YODAS", name: str = "yodas_granary") -> DataFrame:
    """Overwrite ``OG_corpus`` where ``path`` contains ``tag``, for instance ``_metadata.file_path``."""
    current = F.col("OG_corpus") if "OG_corpus" in df.columns else F.lit(None).cast("string")
    return df.withColumn("OG_corpus", F.when(F.contains(path, F.lit(tag)), name).otherwise(current))

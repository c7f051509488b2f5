"""The utterance table: fixed schema, conforming frames to it, column checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names, order and types of the stored utterance table.
UTTERANCE = T.StructType(
    [
        T.StructField(
            "audio",
            T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("path", T.StringType())]),
        ),
        T.StructField("text", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("split", T.StringType()),
        T.StructField("OG_corpus", T.StringType()),
        T.StructField("utt_id", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("task", T.StringType()),
        T.StructField("translation_en", T.StringType()),
        T.StructField("original_audio_id", T.StringType()),
        T.StructField("original_audio_offset", T.DoubleType()),
    ]
)

# What an audio-file record carries where it has no metadata.
# The text "None" is a string, not a null.
FILLERS = {
    "utt_id": "None",
    "lang": "None",
    "task": "None",
    "translation_en": "None",
    "original_audio_id": "None",
    "original_audio_offset": 0.0,
}


def with_fillers(df: DataFrame, strict: bool = False) -> DataFrame:
    """Add the metadata columns that ``df`` lacks; ``strict`` fills real nulls."""
    missing = {name: value for name, value in FILLERS.items() if name not in df.columns}
    return df.withColumns(
        {name: F.lit(None if strict else value).cast(UTTERANCE[name].dataType) for name, value in missing.items()}
    )


def conform(df: DataFrame, schema: T.StructType = UTTERANCE) -> DataFrame:
    """Reorder, null-fill, drop extras and upcast so that ``df`` has ``schema``."""
    return df.to(schema)


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` unchanged, or ``ValueError`` naming the columns it lacks."""
    lacking = [name for name in names if name not in df.columns]
    if lacking:
        raise ValueError(f"missing column(s) {lacking}; got {df.columns}")
    return df


def align_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Project onto ``names`` in that order; extras go, a missing one raises."""
    names = list(names)
    return require_columns(df, names).select(*names)

"""Reading a dataset for training: drop unusable rows, transform, shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from parlato.operators.buffering import BUFFER_ROWS
from parlato.operators.filters import usable_rows
from parlato.operators.numbering import shuffled
from parlato.sources.reader_streams import reader_streams
from parlato.sources.shards import read_split


def map_rows(df: DataFrame, change: Callable[[dict], dict | None], schema: T.StructType) -> DataFrame:
    """Apply a row function in Arrow batches; rows for which it returns None go."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row for row in map(change, batch.to_pylist()) if row is not None]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return df.mapInArrow(run, schema)


def training_rows(
    df: DataFrame,
    key: str = "audio.path",
    seed: int = 42,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Usable rows in a reproducible random order, then ``transform``."""
    rows = shuffled(usable_rows(df, strict), key, seed)
    return rows.transform(transform) if transform else rows


def read_streams(
    spark: SparkSession, path: str, num_readers: int, split: str = "train", buffer_rows: int = BUFFER_ROWS, seed: int = 42, **options
) -> DataFrame:
    """Usable rows of one split as the streams of ``num_readers`` training readers, shuffled through a small buffer each.

    Unlike :func:`read_for_training` this sends no recording anywhere; rows stay near
    those that they are stored with.
    """
    files = [file for file in read_split(spark, path, split).inputFiles() if f"/split={split}/" in file]
    return reader_streams(spark, files, num_readers, buffer_rows=buffer_rows, seed=seed, **options)


def read_for_training(spark: SparkSession, path: str, split: str = "train", **options) -> DataFrame:
    return training_rows(read_split(spark, path, split), **options)

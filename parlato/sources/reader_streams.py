"""Stored shards as the streams of training readers: each task reads its own files, and no row is sent anywhere."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from parlato.operators.buffering import BUFFER_ROWS, let_go
from parlato.schema import UTTERANCE

# Rows that are read and let go at once.
READ_ROWS = 64


def open_file(uri: str) -> pa.NativeFile:
    """A file as Spark names it."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(unquote(parts.path) if parts.scheme else uri)
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(unquote(path))


def usable(batch: pa.RecordBatch, strict: bool = False) -> pa.Array:
    """Which rows :func:`parlato.operators.filters.usable_rows` keeps."""
    audio = batch.column("audio")
    found = [audio, pc.struct_field(audio, "bytes"), batch.column("duration"), *([batch.column("text")] if strict else [])]
    kept = pc.is_valid(found[0])
    for column in found[1:]:
        kept = pc.and_(kept, pc.is_valid(column))
    return kept


def _as(schema: pa.Schema, batch: pa.RecordBatch) -> pa.RecordBatch:
    """``batch`` with the columns of ``schema``; those that it lacks are null."""
    columns = [
        batch.column(f.name).cast(f.type) if f.name in batch.schema.names else pa.nulls(len(batch), f.type) for f in schema
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def reader_streams(
    spark: SparkSession,
    files: Sequence[str],
    num_readers: int,
    schema: T.StructType = UTTERANCE,
    keep: Callable[[pa.RecordBatch], pa.Array] | None = usable,
    buffer_rows: int = BUFFER_ROWS,
    seed: int = 42,
) -> DataFrame:
    """The rows of Parquet ``files`` as ``num_readers`` shuffled streams, with ``reader`` and ``place`` in its stream.

    File ``i`` in path order belongs to reader ``i % num_readers``. A reader takes
    its files one after the other, drops the rows that ``keep`` refuses, and lets the
    rest go through a buffer of ``buffer_rows``; see :mod:`parlato.operators.buffering`. Partition ``r`` of
    the result is reader ``r``'s stream. Only file names are dealt out; a task holds
    its buffer and ``READ_ROWS`` more rows.
    """
    if num_readers < 1:
        raise ValueError(f"{num_readers} readers")
    names = [(i % num_readers, i, name) for i, name in enumerate(sorted(files))]
    dealt = spark.createDataFrame(names, "reader int, at long, file string")
    dealt = dealt.repartitionById(num_readers, dealt["reader"]).sortWithinPartitions("at")
    out = T.StructType([*schema.fields, T.StructField("reader", T.IntegerType()), T.StructField("place", T.LongType())])
    arrow = to_arrow_schema(schema)
    whole = to_arrow_schema(out)

    def read(files: list[str]) -> Iterator[pa.RecordBatch]:
        for name in files:
            with open_file(name) as stream:
                file = pq.ParquetFile(stream)
                wanted = [c for c in arrow.names if c in file.schema_arrow.names]
                for batch in file.iter_batches(READ_ROWS, columns=wanted):
                    made = _as(arrow, batch)
                    yield made.filter(keep(made)) if keep else made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = [row for batch in batches for row in batch.to_pylist()]
        if not mine:
            return
        reader, place = mine[0]["reader"], 0
        for batch in let_go(read([row["file"] for row in mine]), reader, buffer_rows, seed):
            at = np.arange(place, place + len(batch))
            place += len(batch)
            columns = [*batch.columns, pa.array(np.full(len(batch), reader), pa.int32()), pa.array(at, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=whole)

    return dealt.mapInArrow(run, out)

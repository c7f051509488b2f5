"""Large CSV files in many tasks, with line breaks inside quotes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parlato.session import staged
from parlato.sources.listing import Place

BLOCK_BYTES = 32 << 20
_READ_BYTES = 1 << 20

# What follows a record's start or a delimiter: a quoted field up to its end, or to the end of the block.
QUOTED = re.compile(rb'(?:(?<=[,\n\r])|\A)"(?:[^"]++|"")*+("?)')
REST_OF_QUOTED = re.compile(rb'(?:[^"]++|"")*+("?)')


def _line_start(stream: BinaryIO, at: int, size: int) -> int:
    """The first byte after a line feed at or behind ``at - 1``; ``size`` if there is none."""
    if at <= 0:
        return 0
    at -= 1
    stream.seek(at)
    while piece := stream.read(_READ_BYTES):
        found = piece.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(piece)
    return size


def _read(stream: BinaryIO, start: int, end: int) -> bytes:
    stream.seek(start)
    return stream.read(end - start)


def quoted_at_end(block: bytes, quoted: bool) -> bool:
    """Whether a quoted field is open behind ``block``, which starts a record or, if ``quoted``, lies in a quoted field."""
    at = 0
    if quoted:
        head = REST_OF_QUOTED.match(block)
        if not head[1]:
            return True
        at = head.end()
    is_open = False
    for field in QUOTED.finditer(block, at):
        is_open = not field[1]
    return is_open


def record_ends(block: bytes) -> list[int]:
    """Where each whole record of ``block`` ends, behind its line feed."""
    ends, at = [], 0
    for field in [*((m.start(), m.end()) for m in QUOTED.finditer(block)), (len(block), len(block))]:
        while (cut := block.find(b"\n", at, field[0])) >= 0:
            at = cut + 1
            ends.append(at)
        at = field[1]
    return ends


def csv_records(spark: SparkSession, files: DataFrame, folder: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``file, block, place, record``: records of CSV files ``path, size``, as text without the line's end, in many tasks.

    A block begins behind the first line feed at or after a multiple of
    ``block_bytes``. Whether a quoted field is open there is not known to the task that
    reads it, so each block tells how it ends for either beginning; these two
    values, a row a block, are combined in the order of blocks. Then each
    task cuts the records that begin in its block, and reads on where the last one
    goes past the end. Quotes count where a field begins; elsewhere they are characters.
    Empty lines are left out, a last record needs no line's end.
    """
    place = Place(spark, folder)
    steps = F.sequence(F.lit(0), F.floor((F.col("size") - 1) / block_bytes).cast("int"))
    blocks = files.where("size > 0").select("path", "size", F.explode(steps).alias("block"))
    parts = spark.sparkContext.defaultParallelism
    blocks = staged(blocks.repartition(max(parts, 1), "path", "block"), "csv-blocks")

    def bounds(stream: BinaryIO, block: int, size: int) -> tuple[int, int]:
        return _line_start(stream, block * block_bytes, size), _line_start(stream, min((block + 1) * block_bytes, size), size)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place.open()
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(root + place.below(row["path"])) as stream:
                    start, end = bounds(stream, row["block"], row["size"])
                    held = _read(stream, start, end)
                made = {**row, "start": start, "end": end, "after_plain": quoted_at_end(held, False), "after_quoted": quoted_at_end(held, True)}
                yield pa.RecordBatch.from_pylist([made], schema=_SEEN)

    seen = staged(blocks.mapInArrow(look, _SEEN_SQL), "csv-seen")
    # an empty block, which one long line leaves, changes nothing; a block that ends the same way for both beginnings fixes it
    fixed = F.col("after_plain") == F.col("after_quoted")
    order = Window.partitionBy("path").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.when(~fixed & F.col("after_plain"), 1).otherwise(0)
    known = seen.withColumn("turns", F.sum(turns).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last(F.when(fixed, F.struct("after_plain", "turns")), ignorenulls=True).over(before)
    turned = F.coalesce(F.max("turns").over(before), F.lit(0))
    known = known.withColumn("last", last).withColumn("turned", turned)
    begins = F.coalesce(F.col("last.after_plain"), F.lit(False)).cast("int") + F.col("turned") - F.coalesce("last.turns", F.lit(0))
    known = known.select("path", "size", "block", "start", "end", (F.pmod(begins, F.lit(2)) == 1).alias("quoted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place.open()
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(root + place.below(row["path"])) as stream:
                    yield from _records(stream, row)

    known = known.repartition(max(parts, 1), "path", "block")
    return known.mapInArrow(cut, "file string, block int, place int, record string")


_SEEN_SQL = "path string, size long, block int, start long, end long, after_plain boolean, after_quoted boolean"
_SEEN = pa.schema(
    [("path", pa.string()), ("size", pa.int64()), ("block", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]
    + [(name, pa.bool_()) for name in ("after_plain", "after_quoted")]
)
_CUT = pa.schema([("file", pa.string()), ("block", pa.int32()), ("place", pa.int32()), ("record", pa.string())])


def _records(stream: BinaryIO, row: dict) -> Iterator[pa.RecordBatch]:
    end, size = row["end"], row["size"]
    held = _read(stream, row["start"], end)
    if row["quoted"]:
        head = REST_OF_QUOTED.match(held)
        feed = -1
        if head[1]:
            # the record that an earlier block began ends behind the field, or behind more fields
            ends = record_ends(b'"' + b" " * (head.end() - 1) + b'"' + held[head.end() :])
            feed = ends[0] - 1 if ends else -1
        if feed < 0:
            return
        held = held[feed:]
    ends = record_ends(held)
    kept = ends[-1] if ends else 0
    if kept < len(held):
        # the last record goes past the block; what is read of it doubles until it is whole
        more = _READ_BYTES
        while True:
            tail = held[kept:] + _read(stream, end, min(end + more, size))
            found = record_ends(tail)
            if found or end + more >= size:
                break
            more *= 2
        held = held[:kept] + (tail[: found[0]] if found else tail)
        ends.append(len(held))
    cuts = [0, *ends]
    texts = [held[a:b].rstrip(b"\r\n").decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)]
    texts = [text for text in texts if text]
    for k in range(0, len(texts), 10_000):
        some = texts[k : k + 10_000]
        columns = [[row["path"]] * len(some), [row["block"]] * len(some), range(k, k + len(some)), some]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _CUT.types, strict=True)], schema=_CUT)

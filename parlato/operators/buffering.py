"""Shuffling through a bounded buffer: a seeded order that a reader can make while it reads on.

A reader fills a buffer of ``size`` slots with its first rows. Each further row takes
the place of one that is let go; which one depends on the seed, the reader and the
row's place in the stream. At the end the slots are emptied from the last to the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fixed value: rows that a training reader holds back.
BUFFER_ROWS = 8
DIGITS = 8


def slot_of(seed: int, reader: int, index: int, size: int) -> int:
    """The slot that row ``index`` of a reader's stream takes over once the buffer is full."""
    return int(md5(f"{seed}:{reader}:{index}".encode()).hexdigest()[:DIGITS], 16) % size


def slot_column(seed: int, reader: Column, index: Column, size: int) -> Column:
    """:func:`slot_of` as a Column; the first rows take the slots in turn."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), reader.cast("string"), index.cast("string"))), 1, DIGITS)
    return F.when(index < size, index).otherwise(F.conv(digits, 16, 10).cast("long") % size)


def buffer_places(df: DataFrame, reader: str, index: str, size: int = BUFFER_ROWS, seed: int = 42, out: str = "place") -> DataFrame:
    """``df`` with each row's 0-based place in what its reader lets go.

    ``index`` counts a reader's rows from 0. A row goes when the next one takes its slot,
    so only the numbers of a reader's rows have to meet; keep large columns out of ``df``.
    """
    if size < 1:
        raise ValueError(f"a buffer of {size} rows")
    slot = slot_column(seed, F.col(reader), F.col(index), size)
    taken_over = F.lead(index).over(Window.partitionBy(reader, "__slot").orderBy(index))
    totals = df.groupBy(reader).agg(F.count("*").alias("__n"))
    # the buffer is no larger than the stream
    held = F.least(F.col("__n"), F.lit(size))
    drained = F.col("__n") - 1 - F.col("__slot")
    return (
        df.withColumn("__slot", slot)
        .withColumn("__next", taken_over)
        .join(totals, reader)
        .withColumn(out, F.coalesce(F.col("__next") - held, drained).cast("long"))
        .drop("__slot", "__next", "__n")
    )


def let_go(batches: Iterator[pa.RecordBatch], reader: int, size: int = BUFFER_ROWS, seed: int = 42) -> Iterator[pa.RecordBatch]:
    """The rows of one reader's stream in the order of :func:`buffer_places`; holds ``size`` rows and one batch."""
    if size < 1:
        raise ValueError(f"a buffer of {size} rows")
    held: pa.RecordBatch | None = None
    seen = 0
    for batch in batches:
        both = batch if held is None else pa.concat_batches([held, batch])
        slots = list(range(len(both) - len(batch)))
        order = []
        for at in range(len(slots), len(both)):
            if len(slots) < size:
                slots.append(at)
            else:
                k = slot_of(seed, reader, seen, size)
                order.append(slots[k])
                slots[k] = at
            seen += 1
        if order:
            yield both.take(pa.array(order, pa.int64()))
        held = both.take(pa.array(slots, pa.int64()))
    if held is not None and len(held):
        yield held.take(pa.array(range(len(held) - 1, -1, -1), pa.int64()))

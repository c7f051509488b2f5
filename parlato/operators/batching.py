"""Label arrays: batches, padding, start tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlato.operators.numbering import shuffle_rank

# Fixed value: the label that a loss function skips.
IGNORED = -100


def assign_batches(df: DataFrame, key: str, batch_size: int, seed: int = 42, out: str = "batch_id") -> DataFrame:
    """``out`` and ``pos``: full batches along a reproducible random order, the last one maybe short."""
    ranked = shuffle_rank(df, key, seed, "__rank")
    return ranked.withColumns(
        {
            out: F.floor(F.col("__rank") / batch_size),
            "pos": F.pmod(F.col("__rank"), F.lit(batch_size)).cast("int"),
        }
    ).drop("__rank")


def restore_padding(labels: Column, pad_id: int) -> Column:
    """Ignored labels back to the pad token, as decoding needs it."""
    return F.transform(labels, lambda label: F.when(label == IGNORED, F.lit(pad_id)).otherwise(label))


def pad_labels(df: DataFrame, batch: str = "batch_id", labels: str = "labels", start_token: int | None = None) -> DataFrame:
    """Bring the label arrays of each batch to one length, filling up with :data:`IGNORED`.

    If every row of a batch starts with ``start_token``, that token is cut off all
    of them. Batches are summarised with partial aggregation and joined back, so a
    batch of any size works and rows are moved only where the summary is large.
    """
    first = F.try_element_at(F.col(labels), F.lit(1))
    all_start = F.lit(False) if start_token is None else F.every(F.coalesce(first == start_token, F.lit(False)))
    shape = df.groupBy(F.col(batch).alias("__batch")).agg(
        F.max(F.size(labels)).alias("__longest"), all_start.alias("__cut")
    )
    element = df.schema[labels].dataType.elementType
    fill = F.array_repeat(F.lit(IGNORED).cast(element), F.col("__longest") - F.size(labels))
    padded = F.concat(F.col(labels), fill)
    cut = F.when(F.col("__cut"), F.slice(padded, F.lit(2), F.greatest(F.size(padded) - 1, F.lit(0)))).otherwise(padded)
    return (
        df.join(shape, F.col(batch).eqNullSafe(F.col("__batch")))
        .withColumn(labels, cut)
        .drop("__batch", "__longest", "__cut")
    )

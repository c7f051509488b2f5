"""Putting shards of differing layout together."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlato.schema import align_columns

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)


def _common_type(name: str, types: Sequence[T.DataType]) -> T.DataType:
    """The type all of ``types`` fit in; whole and real numbers together become double."""
    distinct = list(dict.fromkeys(t for t in types if not isinstance(t, T.NullType)))
    if len(distinct) <= 1:
        return distinct[0] if distinct else T.NullType()
    if all(isinstance(t, _WHOLE) for t in distinct):
        return max(distinct, key=lambda t: _WHOLE.index(type(t)))
    if all(isinstance(t, _WHOLE + _REAL) for t in distinct):
        return T.DoubleType()
    raise ValueError(f"column {name!r} has types that do not combine: {[t.simpleString() for t in distinct]}")


def common_types(names: Sequence[str], schemas: Sequence[T.StructType]) -> dict[str, T.DataType]:
    """The type of each column that its types in all ``schemas`` fit in."""
    return {name: _common_type(name, [schema[name].dataType for schema in schemas]) for name in names}


def union_shards(shards: Sequence[DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """All rows of ``shards`` with the columns of the first one, or ``columns``.

    Later shards are reordered to fit, lose extra columns and must have every
    column asked for; numbers widen to a common type. For a folder of shards that
    agree, or that differ from a known schema, one read is the better plan: see
    :func:`parlato.sources.shards.read_shards`; for many files of a few layouts
    :func:`parlato.sources.drift.union_files`.
    """
    if not shards:
        raise ValueError("no shards to put together")
    names = list(columns or shards[0].columns)
    aligned = [align_columns(df, names) for df in shards]
    types = common_types(names, [df.schema for df in aligned])
    cast = [df.select(*[F.col(name).cast(types[name]).alias(name) for name in names]) for df in aligned]
    return reduce(DataFrame.unionByName, cast)

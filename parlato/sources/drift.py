"""Many stored shards of differing layout read as one table: one scan for each layout, not for each shard."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from parlato.operators.union import common_types
from parlato.schema import require_columns
from parlato.session import staged
from parlato.sources.reader_streams import open_file

# Fixed value: where Spark keeps a table's own schema in a Parquet file.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def layouts(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """``file, layout`` of Parquet ``files``, named as ``inputFiles`` does: names and types of the columns, in order, as JSON.

    Tasks read the footers, nothing else. Files that Spark wrote tell their schema themselves.
    """
    names = spark.createDataFrame([(name,) for name in files], "file string")
    names = names.repartition(min(len(files) or 1, spark.sparkContext.defaultParallelism))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for name in batch.column(0).to_pylist():
                with open_file(name) as stream:
                    schema = pq.read_schema(stream)
                own = (schema.metadata or {}).get(SPARK_SCHEMA)
                kind = T.StructType.fromJson(json.loads(own)) if own else from_arrow_schema(schema)
                found.append(T.StructType([T.StructField(f.name, f.dataType) for f in kind]).json())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["file", "layout"])

    return staged(names.mapInArrow(look, "file string, layout string"), "layouts")


def union_files(spark: SparkSession, files: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """All rows of Parquet ``files`` with the columns of the first one in path order, or ``columns``.

    Files are grouped by layout and each group is one scan, so the plan grows with
    the number of layouts. Columns are reordered to fit, extra ones go, numbers widen to a type
    that holds all; a layout that lacks a column asked for raises ``ValueError``.
    """
    if not files:
        raise ValueError("no files to put together")
    files = sorted(files)
    found = layouts(spark, files)
    groups = found.groupBy("layout").agg(F.min("file").alias("first"), F.sort_array(F.collect_list("file")).alias("files"))
    rows = groups.orderBy("first").collect()
    schemas = [T.StructType.fromJson(json.loads(row["layout"])) for row in rows]
    names = list(columns or schemas[0].names)
    scans = [
        require_columns(spark.read.schema(schema).parquet(*map(unquote, row["files"])), names)
        for schema, row in zip(schemas, rows, strict=True)
    ]
    types = common_types(names, schemas)
    cast = [df.select(*[F.col(name).cast(types[name]).alias(name) for name in names]) for df in scans]
    return reduce(DataFrame.unionByName, cast)

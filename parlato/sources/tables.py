"""Reading tables by file type, looking at their first rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlato.operators.numbering import first_rows
from parlato.schema import align_columns
from parlato.sources.arrow_ipc import first_arrow_rows, read_arrow
from parlato.sources.csv_blocks import csv_records
from parlato.sources.listing import Place

# The columns a look at an utterance table shows, where it has them.
HEAD_COLUMNS = ["text", "duration", "split", "OG_corpus"]

REFERENCES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("sentence", T.StringType()),
        T.StructField("up_votes", T.IntegerType()),
    ]
)


def suffix_of(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return "." + name.rsplit(".", 1)[1].lower() if "." in name else ""


# CSV files above this size are read by several tasks each.
SPLIT_BYTES = 64 << 20


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
    multi_line: bool = True,
    order: str | None = None,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """A CSV file with a header, columns found by name; quotes are doubled, quoted line breaks allowed.

    ``schema`` casts and, without ``columns``, selects. Only what is selected is parsed.
    Files of more than ``split_bytes`` are cut where records begin, see
    :mod:`parlato.sources.csv_blocks`; their lines must end in a line feed, with or without carriage return.
    ``multi_line`` may be turned off for files without quoted line breaks, which Spark splits by itself.
    ``order`` names a column to add whose values rise as the rows do, file after file.
    """
    raw = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=multi_line)
    names = list(columns or (schema.names if schema else raw.columns))
    align_columns(raw, names)
    at = stored_order()
    if multi_line and (files := _large_files(spark, path, raw.inputFiles(), split_bytes)):
        records = csv_records(spark, spark.createDataFrame(files, "path string, size long"), path, split_bytes)
        # the first record of a file has its column names
        records = records.where("block > 0 or place > 0")
        kinds = ", ".join(f"`{name.replace('`', '``')}` string" for name in raw.columns)
        parsed = F.from_csv("record", kinds, {"quote": '"', "escape": '"'})
        raw = records.select(parsed.alias("row"), F.struct("file", "block", "place").alias("__at"))
        at = F.col("__at")
        value = {name: F.col("row").getField(name) for name in names}
    else:
        value = {name: F.col(f"`{name}`") for name in names}
    cast = [value[n].cast(schema[n].dataType if schema and n in schema.names else "string").alias(n) for n in names]
    return raw.select(*cast, *([at.alias(order)] if order else []))


def _large_files(spark: SparkSession, path: str, files: Sequence[str], split_bytes: int) -> list[tuple[str, int]]:
    """``path, size`` of all files, if one of them has more than ``split_bytes``; the paths begin as ``path`` does."""
    place = Place(spark, path)
    system, root = place.open()
    plain = [re.sub("^file:/+", "/", unquote(file)) for file in files]
    if not root.startswith("/"):
        plain = [file.split("://", 1)[1] for file in plain]
    sizes = [info.size for info in system.get_file_info(plain)]
    if max(sizes, default=0) <= split_bytes:
        return []
    return [(place.base + file.removeprefix(root), size) for file, size in zip(plain, sizes, strict=True)]


def stored_order() -> Column:
    """A value that rises with the rows of a plain scan of text or CSV files: file, part of it, row read there."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    multi_line: bool = True,
    order: str | None = None,
) -> DataFrame:
    """Read ``path`` by its suffix, letter case ignored: ``.csv``, ``.parquet``, ``.arrow`` or ``.feather``.

    Another suffix raises ``ValueError``; a path that is not there raises
    ``FileNotFoundError``. ``multi_line`` and ``order`` are those of :func:`read_csv`.
    """
    suffix = suffix_of(path)
    try:
        if suffix == ".csv":
            return read_csv(spark, path, schema, columns, multi_line, order)
        if suffix == ".parquet":
            df = spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
            return align_columns(df, columns) if columns else df
        if suffix in (".arrow", ".feather"):
            return read_arrow(spark, path, columns)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"{path} does not exist") from error
        raise
    raise ValueError(f"unsupported file type {suffix!r}: {path}")


def read_references(spark: SparkSession, path: str, multi_line: bool = True, order: str | None = None) -> DataFrame:
    """``path, sentence, up_votes`` of a reference-transcript table; for CSV also the rows' ``order``."""
    return read_table(spark, path, REFERENCES.names, REFERENCES, multi_line, order)


def head_columns(names: Sequence[str]) -> list[str]:
    return [name for name in HEAD_COLUMNS if name in names] or list(names)


def head(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows in stored order, with the columns of :data:`HEAD_COLUMNS` that exist, else all."""
    if n < 0:
        raise ValueError(f"cannot show {n} rows")
    suffix = suffix_of(path)
    if suffix in (".arrow", ".feather"):
        return first_arrow_rows(spark, path, n, head_columns)
    if suffix not in (".parquet", ""):
        raise ValueError(f"unsupported file type {suffix!r}: {path}")
    table = spark.read.parquet(path)
    return first_rows(spark, table.inputFiles(), n).select(*head_columns(table.columns))


def view(df: DataFrame, n: int = 20) -> None:
    """Print at most ``n`` rows, each value in full on a line of its own."""
    df.show(n, truncate=False, vertical=True)

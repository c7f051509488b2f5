"""Versions of a stored table: new data beside the old, and one step that makes them current.

``<table>/data-<id>/`` holds what one write has made, parted by its outermost partition
column (``name=AA``, ``shard=3``, ``split=train``). ``<table>/versions/<number>`` names the folder of each part. A
write that ends before its version is there has changed nothing, and readers of an
earlier version go on reading it. A folder without versions is a plain table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What ends a version file that was written in full.
END = "\n"
DIGITS = 10


def _path(spark: SparkSession, path: str):
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    at, system = _path(spark, path)
    return sorted(status.getPath().getName() for status in system.listStatus(at)) if system.exists(at) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(name) for name in _children(spark, f"{path}/versions") if name.isdigit()]


def _read(spark: SparkSession, path: str, number: int) -> dict[str, str] | None:
    """The parts of one version; nothing if the file was not written to its end."""
    at, system = _path(spark, f"{path}/versions/{number:0{DIGITS}d}")
    stream = system.open(at)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text) if text.endswith(END) else None


def _last(spark: SparkSession, path: str, numbers: list[int]) -> dict[str, str] | None:
    return next((found for n in reversed(numbers) if (found := _read(spark, path, n)) is not None), None)


def current_parts(spark: SparkSession, path: str) -> dict[str, str] | None:
    """Folder by part of the last whole version; None for a plain table."""
    return _last(spark, path, _numbers(spark, path))


def _commit(spark: SparkSession, path: str, changed: dict[str, str | None], whole: bool) -> int:
    """Make a version of the last one's parts, or of none, and the ``changed`` ones. If another writer takes the
    number first, its version is built upon."""
    while True:
        numbers = _numbers(spark, path)
        before = {} if whole else (_last(spark, path, numbers) or {})
        parts = {name: folder for name, folder in (before | changed).items() if folder is not None}
        number = max(numbers, default=0) + 1
        at, system = _path(spark, f"{path}/versions/{number:0{DIGITS}d}")
        try:
            # fails if the file exists
            stream = system.create(at, False)
        except Exception as error:
            if system.exists(at):
                continue
            raise error
        stream.write((json.dumps(parts) + END).encode())
        stream.close()
        return number


def publish(
    spark: SparkSession, path: str, write: Callable[[str], None], whole: bool = True, expected: tuple[str, ...] = ()
) -> int:
    """Let ``write`` store data in a new folder and make it current in one step; gives the version's number.

    With ``whole`` the table then consists of these data alone, else parts that were not
    written stay; of the parts ``expected``, those that were not written go.
    """
    path = path.rstrip("/")
    folder = f"data-{uuid.uuid4().hex}"
    write(f"{path}/{folder}")
    made = [name for name in _children(spark, f"{path}/{folder}") if "=" in name]
    changed = dict.fromkeys(expected, None) | dict.fromkeys(made, folder)
    return _commit(spark, path, changed, whole)


def _placed(df: DataFrame, file: str | None, row: str | None) -> DataFrame:
    columns = {file: "_metadata.file_path", row: "_metadata.row_index"}
    return df.select("*", *[F.col(source).alias(name) for name, source in columns.items() if name])


def read_current(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    only: Collection[str] | None = None,
    file: str | None = None,
    row: str | None = None,
) -> DataFrame:
    """The table's last whole version, or the plain table at ``path``: one scan for each folder that it lies in.

    ``only`` names the parts that are wanted of a version. ``file`` and ``row`` name columns to add
    for where a row is stored. A version without parts gives no rows, for which ``schema`` must be known.
    """
    path = path.rstrip("/")
    parts = current_parts(spark, path)
    if parts is None:
        return _placed((spark.read if schema is None else spark.read.schema(schema)).parquet(path), file, row)
    if only is not None:
        parts = {name: folder for name, folder in parts.items() if name in only}
    by_folder: dict[str, list[str]] = {}
    for name, folder in sorted(parts.items()):
        by_folder.setdefault(folder, []).append(name)
    scans = []
    for folder, names in by_folder.items():
        base = f"{path}/{folder}"
        stored = [name for name in _children(spark, base) if "=" in name]
        places = [base] if stored == names else [f"{base}/{name}" for name in names]
        reader = spark.read if schema is None else spark.read.schema(schema)
        scans.append(_placed(reader.option("basePath", base).parquet(*places), file, row))
    if not scans:
        if schema is None:
            raise ValueError(f"{path} has no rows, and no schema is given")
        more = [T.StructField(name, kind) for name, kind in ((file, T.StringType()), (row, T.LongType())) if name]
        return spark.createDataFrame([], T.StructType([*schema.fields, *more]))
    return reduce(DataFrame.unionByName, scans)


def remove_old(spark: SparkSession, path: str) -> int:
    """Delete the data folders and versions that the last version does not need; gives the number of folders.

    For times when nothing reads or writes the table.
    """
    path = path.rstrip("/")
    parts = current_parts(spark, path)
    if parts is None:
        return 0
    old = [name for name in _children(spark, path) if name.startswith("data-") and name not in parts.values()]
    for name in old:
        at, system = _path(spark, f"{path}/{name}")
        system.delete(at, True)
    last = [n for n in _numbers(spark, path) if _read(spark, path, n) is not None][-1]
    for number in _numbers(spark, path):
        if number < last:
            at, system = _path(spark, f"{path}/versions/{number:0{DIGITS}d}")
            system.delete(at, False)
    return len(old)

"""Files below a folder, listed and read by the tasks themselves.

Every file counts: empty ones, and those whose name or folder starts with ``_`` or
``.``, which Spark's own readers leave out. Workers need a file system that Arrow
can open.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlato.session import staged

# Bytes of file contents that one batch holds; a larger file has a batch of its own.
BATCH_BYTES = 8 << 20
# Files of a folder that one batch names.
LIST_ROWS = 10_000

LISTED = "path string, size long, modified long"
_LISTED = pa.schema([("path", pa.string()), ("size", pa.int64()), ("modified", pa.int64())])


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with file system and absolute path."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


class Place:
    """A folder as tasks reach it: paths below it are written as the caller wrote the folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.base = folder.rstrip("/")
        self.root = qualified(spark, self.base)

    def open(self) -> tuple[fs.FileSystem, str]:
        if self.root.startswith("file:"):
            return fs.LocalFileSystem(), self.root.removeprefix("file:")
        return fs.FileSystem.from_uri(self.root)

    def below(self, path: str) -> str:
        return path.removeprefix(self.base)


class Files:
    """The files below a place, for the task that makes this."""

    def __init__(self, place: Place) -> None:
        self.place = place
        self.system, self.root = place.open()

    def content(self, name: str | None, most: int | None = None) -> bytes | None:
        if name is None:
            return None
        with self.system.open_input_file(self.root + self.place.below(name)) as stream:
            return stream.read() if most is None else stream.read(most)

    def sizes(self, names: Sequence[str | None]) -> list[int | None]:
        """Null where there is no file or no name."""
        found = iter(self.system.get_file_info([self.root + self.place.below(name) for name in names if name is not None]))
        infos = [None if name is None else next(found) for name in names]
        return [info.size if info and info.type == fs.FileType.File else None for info in infos]


def list_files(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """``path, size, modified`` of every file at any depth below ``folder/name``, in tasks that each list some folders.

    ``modified`` is in nanoseconds. The name ``""`` stands for ``folder`` itself.
    Works down level by level; a level's folders are spread over the cluster. A
    name without a folder raises ``FileNotFoundError``.
    """
    place = Place(spark, folder)
    system, root = place.open()
    for name in names:
        if system.get_file_info(f"{root}/{name}".rstrip("/")).type != fs.FileType.Directory:
            raise FileNotFoundError(f"{place.base}/{name} is not a folder")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place.open()
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found = system.get_file_info(fs.FileSelector(root + place.below(path)))
                while found:
                    some = found[-LIST_ROWS:]
                    del found[-LIST_ROWS:]
                    paths = [place.base + info.path.removeprefix(root) for info in some]
                    # a folder has no size
                    sizes = [info.size if info.type == fs.FileType.File else None for info in some]
                    times = [info.mtime_ns for info in some]
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(times, pa.int64())], schema=_LISTED)

    level = spark.createDataFrame([(f"{place.base}/{name}".rstrip("/"),) for name in names], "path string")
    levels = []
    while True:
        parts = spark.sparkContext.defaultParallelism
        found = staged(level.repartition(parts, "path").mapInArrow(look, LISTED), "listed")
        levels.append(found.where("size is not null"))
        level = found.where("size is null").select("path")
        if not level.limit(1).count():
            break
    files = levels[0]
    for more in levels[1:]:
        files = files.unionByName(more)
    return files


def read_files(rows: DataFrame, folder: str, out: str = "content", path: str = "path", most: int | None = None) -> DataFrame:
    """``rows`` with the contents of the files that their column ``path`` names, or their first ``most`` bytes.

    A null path gives null. Rows come in batches of bounded bytes, in the order
    in which they were.
    """
    return read_several(rows, folder, [(out, path, most)])


def read_several(rows: DataFrame, folder: str, wanted: Sequence[tuple[str, str, int | None]]) -> DataFrame:
    """:func:`read_files` for several columns ``out, path, most`` in one pass, so that contents go through one task's Python once."""
    place = Place(rows.sparkSession, folder)
    at = [rows.columns.index(path) for _, path, _ in wanted]
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), *(f"`{out}` binary" for out, _, _ in wanted)])
    outs, limits = [out for out, _, _ in wanted], [most for _, _, most in wanted]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(place)
        for batch in batches:
            start, held, size = 0, [], 0
            names = zip(*(batch.column(k).to_pylist() for k in at), strict=True)
            for k, row in enumerate(names):
                held.append([files.content(name, most) for name, most in zip(row, limits, strict=True)])
                size += sum(len(c or b"") for c in held[-1])
                if size >= BATCH_BYTES or k == batch.num_rows - 1:
                    part = batch.slice(start, len(held))
                    contents = [pa.array(c, pa.binary()) for c in zip(*held, strict=True)]
                    held = []
                    yield pa.RecordBatch.from_arrays([*part.columns, *contents], [*batch.schema.names, *outs])
                    start, size = k + 1, 0
                    del part, contents

    return rows.mapInArrow(read, kinds)


def with_suffix(files: DataFrame, suffix: str) -> DataFrame:
    """Files whose name ends in ``suffix``, letter case included."""
    return files.where(F.col("path").endswith(suffix))


def relative_paths(df: DataFrame, folder: str) -> DataFrame:
    """``path`` of files that Spark found below ``folder``, written the way ``folder`` is."""
    place = Place(df.sparkSession, folder)
    below = F.substring(F.col("path"), F.lit(len(place.root) + 1), F.length("path"))
    return df.select(F.concat(F.lit(place.base), below).alias("path"))


def store_files(files: DataFrame, folder: str) -> int:
    """Write ``path, content`` rows as files below ``folder``, whole or not at all; gives their number."""
    place = Place(files.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place.open()
        for batch in batches:
            for path, content in zip(*(batch.column(c) for c in ("path", "content")), strict=True):
                target = root + place.below(path.as_py())
                parent, _, name = target.rpartition("/")
                system.create_dir(parent, recursive=True)
                # no reader takes a name that ends like this; a doubled task ends with the same file
                hidden = f"{parent}/{name}.{uuid.uuid4().hex}.part"
                with system.open_output_stream(hidden) as stream:
                    stream.write(content.as_buffer())
                system.move(hidden, target)
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    made = files.select("path", "content").mapInArrow(write, "n long")
    return made.agg(F.sum("n")).first()[0] or 0

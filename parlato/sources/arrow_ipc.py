"""Arrow IPC files as a Spark data source, for exchange with tools that keep their shards in that format."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import dataset, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import BooleanType, IntegralType, LongType, StringType, StructField, StructType

# Files above this size are read by several tasks, each with a run of record batches.
SPLIT_BYTES = 128 * 1024 * 1024

# Batches handed to Spark hold at most this many rows; audio rows are large.
ROWS_PER_BATCH = 1024


def _locate(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def list_arrow_files(path: str, missing_ok: bool = False) -> list[fs.FileInfo]:
    """The Arrow files at ``path``, a file or a folder, in path order; with ``missing_ok`` there may be none."""
    system, where = _locate(path)
    found = system.get_file_info(where)
    if found.type == fs.FileType.NotFound:
        if missing_ok:
            return []
        raise FileNotFoundError(f"{path} does not exist")
    if found.type == fs.FileType.File:
        return [found]
    inside = system.get_file_info(fs.FileSelector(where, recursive=True))
    files = [
        f
        for f in inside
        if f.type == fs.FileType.File
        and f.extension in ("arrow", "feather")
        and not any(part.startswith(("_", ".")) for part in f.path.removeprefix(where).split("/"))
    ]
    if not files and not missing_ok:
        raise FileNotFoundError(f"no Arrow files in {path}")
    return sorted(files, key=lambda f: f.path)


# Session setting that lets a Python source see filters.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

# Filters that the source answers itself, by Arrow's function for each.
_COMPARED = {
    EqualTo: pc.equal,
    GreaterThan: pc.greater,
    GreaterThanOrEqual: pc.greater_equal,
    LessThan: pc.less,
    LessThanOrEqual: pc.less_equal,
    StringStartsWith: lambda column, value: pc.starts_with(column, pattern=value),
    StringEndsWith: lambda column, value: pc.ends_with(column, pattern=value),
    StringContains: lambda column, value: pc.match_substring(column, pattern=value),
}


def _names(condition: Filter) -> tuple[str, ...]:
    return _names(condition.child) if isinstance(condition, Not) else condition.attribute


def _answers(condition: Filter, schema: StructType) -> bool:
    """Whether Arrow and Spark agree on a filter: one whole column of whole numbers, text or truth values."""
    if isinstance(condition, Not):
        return _answers(condition.child, schema)
    if len(condition.attribute) != 1 or condition.attribute[0] not in schema.names:
        return False
    if isinstance(condition, (IsNull, IsNotNull)):
        return True
    kind = schema[condition.attribute[0]].dataType
    known = type(condition) in _COMPARED or isinstance(condition, (In, EqualNullSafe))
    return known and isinstance(kind, (IntegralType, StringType, BooleanType))


def _mask(condition: Filter, table: pa.Table):
    if isinstance(condition, Not):
        return pc.invert(_mask(condition.child, table))
    column = table.column(condition.attribute[0])
    if isinstance(condition, IsNull):
        return pc.is_null(column)
    if isinstance(condition, IsNotNull):
        return pc.is_valid(column)
    if isinstance(condition, In):
        wanted = pa.array([v for v in condition.value if v is not None], column.type)
        found = pc.is_in(column, value_set=wanted)
        # a null is in no list, nor is it known to be in none; a list with a null knows only what is in it
        known = found if len(wanted) < len(condition.value) else pc.is_valid(column)
        return pc.if_else(pc.and_(known, pc.is_valid(column)), found, pa.scalar(None, pa.bool_()))
    if isinstance(condition, EqualNullSafe):
        if condition.value is None:
            return pc.is_null(column)
        return pc.fill_null(pc.equal(column, pa.scalar(condition.value, column.type)), False)
    if isinstance(condition, (StringStartsWith, StringEndsWith, StringContains)):
        return _COMPARED[type(condition)](column, condition.value)
    return _COMPARED[type(condition)](column, pa.scalar(condition.value, column.type))


def _batch(source: pa.NativeFile, names: Sequence[str], wanted: pa.Schema) -> Callable[[int], pa.Table]:
    """A function that reads one batch of an open file, and of it the columns ``names`` alone."""
    held = pa.ipc.open_file(source).schema
    reader = pa.ipc.open_file(source, options=pa.ipc.IpcReadOptions(included_fields=[held.get_field_index(n) for n in names]))
    kinds = pa.schema([wanted.field(n) for n in names])
    return lambda i: pa.Table.from_batches([reader.get_batch(i)]).select(list(names)).cast(kinds)


# Columns that tell where a row is stored, for readers that ask for them.
FILE, BATCH, ROW = "__file", "__batch", "__row"


@dataclass
class _Part(InputPartition):
    """Part ``number`` of ``parts`` of one file's record batches."""

    file: str
    number: int = 0
    parts: int = 1


class _Reader(DataSourceReader):
    """Partitions follow from file sizes; the task that reads a part opens the file and takes its share of batches.

    ``most`` rows of each part at most are read, if it is given, and the first ``files`` files only.
    """

    conditions: Sequence[Filter] = ()

    def __init__(self, path: str, schema: StructType, most: int | None = None, files: int | None = None):
        self.path, self.schema, self.most, self.files = path, schema, most, files

    def partitions(self) -> Sequence[InputPartition]:
        tasks: list[InputPartition] = []
        for info in list_arrow_files(self.path)[: self.files]:
            parts = max(1, -(-info.size // SPLIT_BYTES))
            tasks += [_Part(info.path, k, parts) for k in range(parts)]
        return tasks

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        system, _ = _locate(self.path)
        whole = to_arrow_schema(self.schema)
        wanted = pa.schema([field for field in whole if field.name not in (FILE, BATCH, ROW)])
        left = self.most
        with system.open_input_file(partition.file) as source:
            held = pa.ipc.open_file(source).schema
            lacking = [name for name in wanted.names if name not in held.names]
            if lacking:
                raise ValueError(f"{partition.file} lacks column(s) {lacking}")
            n = pa.ipc.open_file(source).num_record_batches
            batch = _batch(source, wanted.names, wanted)
            asked = list(dict.fromkeys(_names(c)[0] for c in self.conditions))
            asked_batch = _batch(source, asked, wanted) if asked else None
            for i in range(n * partition.number // partition.parts, n * (partition.number + 1) // partition.parts):
                if left is not None and left <= 0:
                    break
                mask = None
                if asked_batch:
                    # the columns of the filters first: a batch without a match is not read further
                    small = asked_batch(i)
                    for condition in self.conditions:
                        found = pc.fill_null(_mask(condition, small), False)
                        mask = found if mask is None else pc.and_(mask, found)
                    if not pc.any(mask, min_count=0).as_py():
                        continue
                table = batch(i).slice(0, left)
                left = None if left is None else left - table.num_rows
                if ROW in whole.names:
                    places = pa.array(range(table.num_rows), pa.int64())
                    for name, column in ((FILE, pa.repeat(partition.file, len(places))), (BATCH, pa.repeat(i, len(places))), (ROW, places)):
                        table = table.append_column(name, column)
                table = table if mask is None else table.filter(mask)
                yield from table.select(whole.names).cast(whole).to_batches(max_chunksize=ROWS_PER_BATCH)


class _FilteringReader(_Reader):
    """Reads no more of a batch than the columns of the filters if no row of it passes them."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        stored = StructType([f for f in self.schema if f.name not in (FILE, BATCH, ROW)])
        self.conditions = [c for c in filters if _answers(c, stored)]
        return [c for c in filters if not any(c is own for own in self.conditions)]


@dataclass
class _Written(WriterCommitMessage):
    hidden: str | None
    final: str | None


class _Writer(DataSourceArrowWriter):
    """One file per task that has rows, and for the first. Files are hidden until the job commits."""

    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        context = TaskContext.get()
        system, where = _locate(self.path)
        system.create_dir(where, recursive=True)
        # the attempt is part of the hidden name: a retried or doubled task never shares a file
        hidden = f"{where}/.{self.job}-{context.partitionId():05d}-{context.taskAttemptId()}.arrow"
        target, wanted = None, to_arrow_schema(self.schema)
        for batch in iterator:
            if target is None:
                sink = system.open_output_stream(hidden)
                target = pa.ipc.new_file(sink, wanted)
            target.write_table(pa.Table.from_batches([batch]).cast(wanted))
        if target is None:
            if context.partitionId():
                return _Written(None, None)
            # an empty table still has its columns
            sink = system.open_output_stream(hidden)
            target = pa.ipc.new_file(sink, wanted)
        target.close()
        sink.close()
        return _Written(hidden, f"{where}/part-{context.partitionId():05d}-{self.job}.arrow")

    def commit(self, messages: list[_Written | None]) -> None:
        system, where = _locate(self.path)
        # what a reader would find, at any depth; gone only when the new files are in place
        old = list_arrow_files(self.path, missing_ok=True) if self.overwrite else []
        for message in messages:
            if message is not None and message.hidden is not None:
                system.move(message.hidden, message.final)
        for info in old:
            system.delete_file(info.path)

    def abort(self, messages: list[_Written | None]) -> None:
        system, _ = _locate(self.path)
        for message in messages:
            if message is not None and message.hidden is not None:
                system.delete_file(message.hidden)


class ArrowIpc(DataSource):
    """``format("arrow_ipc")``. A schema given to the reader picks the columns that are read.

    Option ``positions`` adds columns for a row's file, batch and place in it,
    ``most`` bounds the rows read of each partition and ``files`` the files that are read, the
    first ones. ``push`` takes filters, which the session must allow with :data:`PUSHDOWN`.
    """

    @classmethod
    def name(cls) -> str:
        return "arrow_ipc"

    def schema(self) -> StructType:
        path = self.options["path"]
        system, _ = _locate(path)
        with system.open_input_file(list_arrow_files(path)[0].path) as source:
            held = from_arrow_schema(pa.ipc.open_file(source).schema)
        if self.options.get("positions") != "true":
            return held
        places = [StructField(FILE, StringType()), StructField(BATCH, LongType()), StructField(ROW, LongType())]
        return StructType([*held.fields, *places])

    def reader(self, schema: StructType) -> DataSourceReader:
        if self.options.get("push") == "true":
            return _FilteringReader(self.options["path"], schema)
        most, files = (int(v) if (v := self.options.get(name)) else None for name in ("most", "files"))
        return _Reader(self.options["path"], schema, most, files)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], schema, overwrite)


def read_arrow(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """An Arrow IPC file or a folder of them. Naming ``columns`` keeps the others unread.

    Where the session allows :data:`PUSHDOWN`, filters on whole numbers, text and truth values are
    answered by the tasks that read, from their columns alone for batches without a match.
    """
    spark.dataSource.register(ArrowIpc)
    list_arrow_files(path)
    push = spark.conf.get(PUSHDOWN, "false")
    reader = spark.read.format("arrow_ipc").option("push", push)
    if columns is not None:
        whole = reader.load(path).schema
        lacking = [name for name in columns if name not in whole.names]
        if lacking:
            raise ValueError(f"missing column(s) {lacking}; got {whole.names}")
        reader = spark.read.format("arrow_ipc").option("push", push).schema(StructType([whole[name] for name in columns]))
    return reader.load(path)


def write_arrow(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df`` as Arrow IPC files into the folder ``path``, one per task."""
    df.sparkSession.dataSource.register(ArrowIpc)
    df.write.format("arrow_ipc").mode(mode).save(path)


def _files_that_hold(spark: SparkSession, path: str, n: int) -> int:
    """How many files, in path order, hold the first ``n`` rows; tasks count rows from what files state of their batches."""
    names = [info.path for info in list_arrow_files(path)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _locate(path)
        for batch in batches:
            rows = [dataset.dataset(file, format="ipc", filesystem=system).count_rows() for file in batch.column("file").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("at"), pa.array(rows, pa.int64())], ["at", "n"])

    held = taken = 0
    while taken < len(names) - 1 and held < n:
        # as many more as were looked at so far
        run = [(k, names[k]) for k in range(taken, min(taken + max(taken, 8), len(names)))]
        some = spark.createDataFrame(run, "at int, file string").mapInArrow(count, "at int, n long")
        for row in sorted(some.collect()):
            if held < n:
                held, taken = held + row["n"], row["at"] + 1
    return max(taken, 1) if held >= n else len(names)


def first_arrow_rows(spark: SparkSession, path: str, n: int, pick: Callable[[Sequence[str]], list[str]]) -> DataFrame:
    """The first ``n`` rows in stored order, from the files that hold them; each task reads as many of its part at most."""
    spark.dataSource.register(ArrowIpc)
    files = _files_that_hold(spark, path, n)
    reader = spark.read.format("arrow_ipc").option("positions", "true").option("most", str(max(n, 1))).option("files", str(files))
    whole = reader.load(path).schema
    names = pick([name for name in whole.names if name not in (FILE, BATCH, ROW)])
    stored = reader.schema(StructType([whole[name] for name in [*names, FILE, BATCH, ROW]])).load(path)
    return stored.orderBy(FILE, BATCH, ROW).limit(n).select(*names)

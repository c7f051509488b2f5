from urllib.parse import unquote

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parlato.operators.buffering import buffer_places, let_go, slot_of
from parlato.plans.training import read_streams
from parlato.schema import conform, with_fillers
from parlato.sources.reader_streams import reader_streams
from parlato.sources.shards import write_splits
from parlato.sources.versions import read_current


def by_hand(rows, reader, size, seed):
    """Fill, let one go for each further row, then empty from the last slot."""
    slots, out = [], []
    for i, row in enumerate(rows):
        if len(slots) < size:
            slots.append(row)
        else:
            k = slot_of(seed, reader, i, size)
            out.append(slots[k])
            slots[k] = row
    return out + slots[::-1]


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 100])
@pytest.mark.parametrize("batch", [1, 3, 64])
@pytest.mark.parametrize("size", [1, 8])
def test_let_go(n, batch, size):
    rows = list(range(n))
    parts = [pa.RecordBatch.from_pydict({"x": rows[k : k + batch]}) for k in range(0, n, batch)]
    got = [x for made in let_go(iter(parts), 3, size, 5) for x in made.column("x").to_pylist()]
    assert got == by_hand(rows, 3, size, 5)


def test_no_buffer():
    with pytest.raises(ValueError):
        list(let_go(iter([]), 0, 0))


def test_places(spark):
    sizes = {0: 0, 1: 3, 2: 8, 3: 50}
    rows = [(r, i) for r, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "reader int, i long").repartition(4)
    got = {(r.reader, r.place): r.i for r in buffer_places(df, "reader", "i", 8, 9).collect()}
    for reader, n in sizes.items():
        assert [got[reader, k] for k in range(n)] == by_hand(list(range(n)), reader, 8, 9)


@pytest.fixture(scope="module")
def split(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("splits") / "a b")
    rows = spark.range(0, 400, 1, 7).select(
        F.struct(F.when(F.col("id") % 11 > 0, F.encode(F.lit("x"), "UTF-8")).alias("bytes"), F.col("id").cast("string").alias("path")).alias("audio"),
        F.lit("t").alias("text"),
        F.when(F.col("id") % 13 > 0, 1.0).alias("duration"),
        F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"),
    )
    write_splits(conform(with_fillers(rows)), path)
    return path


def test_streams_of_a_split(spark, split):
    rows = read_streams(spark, split, 3)
    text = rows._jdf.queryExecution().executedPlan().toString()
    # names of files are all that is sent
    assert text.count("Exchange") == 1 and "audio" not in text[text.index("Exchange") :]
    got = rows.select("audio.path", "reader", "place").collect()
    assert {int(r.path) for r in got} == {i for i in range(400) if i % 5 and i % 11 and i % 13}
    files = sorted(f for f in read_current(spark, split).inputFiles() if "/split=train/" in f)
    for reader in range(3):
        stored = [r.path for f in files[reader::3] for r in spark.read.parquet(unquote(f)).where("audio.bytes is not null and duration is not null").select("audio.path").collect()]
        mine = [r.path for r in sorted((r for r in got if r.reader == reader), key=lambda r: r.place)]
        assert mine == by_hand(stored, reader, 8, 42)
    # the partitions are the streams
    parts = rows.select("reader").rdd.mapPartitionsWithIndex(lambda k, it: [(k, r.reader) for r in it]).distinct().collect()
    assert all(k == r for k, r in parts)


def test_more_readers_than_files_and_lacking_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).coalesce(1).write.parquet(path)
    rows = reader_streams(spark, spark.read.parquet(path).inputFiles(), 4, spark.createDataFrame([], "id long, other string").schema, None)
    assert sorted((r.id, r.other, r.reader) for r in rows.collect()) == [(i, None, 0) for i in range(5)]
    assert reader_streams(spark, [], 2).collect() == []

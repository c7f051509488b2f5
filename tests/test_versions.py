import pytest
from pyspark.sql import functions as F

from parlato.sources import versions
from parlato.sources.shards import read_shards, replace_shards, rewrite_column, write_shards
from parlato.sources.versions import current_parts, publish, read_current, remove_old


def table(spark, path, ids, value, whole=True, expected=()):
    rows = spark.createDataFrame([(i, value) for i in ids], "shard long, v string")
    publish(spark, path, lambda folder: rows.write.partitionBy("shard").parquet(folder), whole, expected)


def held(spark, path):
    return sorted((r.shard, r.v) for r in read_current(spark, path).collect())


def test_parts_of_several_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, [1, 2, 3], "a")
    table(spark, path, [2], "b", whole=False)
    assert held(spark, path) == [(1, "a"), (2, "b"), (3, "a")]
    # of the parts that a write answers for, those that it did not make go
    table(spark, path, [4], "c", whole=False, expected=("shard=1", "shard=4"))
    assert held(spark, path) == [(2, "b"), (3, "a"), (4, "c")]
    assert sorted(read_current(spark, path, only=["shard=3", "shard=9"]).select("v").collect()) == [("a",)]
    table(spark, path, [9], "d")
    assert held(spark, path) == [(9, "d")]
    assert remove_old(spark, path) == 3 and held(spark, path) == [(9, "d")] and remove_old(spark, path) == 0


def test_a_write_that_stops_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, [1, 2], "a")

    def stops(folder):
        spark.createDataFrame([(1, "x")], "shard long, v string").write.partitionBy("shard").parquet(folder)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        publish(spark, path, stops)
    assert held(spark, path) == [(1, "a"), (2, "a")]
    # the version's file was begun and not ended
    (tmp_path / "t" / "versions" / "0000000002").write_text('{"shard=1": "data-')
    assert held(spark, path) == [(1, "a"), (2, "a")]
    table(spark, path, [2], "b", whole=False)
    assert held(spark, path) == [(1, "a"), (2, "b")]


def test_another_writer_is_built_upon(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    table(spark, path, [1, 2], "a")
    numbers, first = versions._numbers, [True]

    def late(*given):
        found = numbers(*given)
        if first[0]:
            first[0] = False
            table(spark, path, [1], "other", whole=False)
        return found

    monkeypatch.setattr(versions, "_numbers", late)
    table(spark, path, [2], "mine", whole=False)
    assert held(spark, path) == [(1, "other"), (2, "mine")]


def test_shards_replaced_from_themselves(spark, tmp_path):
    path = str(tmp_path / "t")
    write_shards(spark.range(10).select("id", (F.col("id") % 3).alias("shard"), F.lit("x").alias("text")), path)
    reader = read_current(spark, path)
    replace_shards(reader.where("shard = 1").withColumn("text", F.lit("y")), path)
    rewrite_column(spark, path, path, "text", F.upper)
    assert {(r.id, r.text) for r in read_shards(spark, path, None).collect()} == {(i, "Y" if i % 3 == 1 else "X") for i in range(10)}
    # a reader of the first version goes on reading it
    assert {r.text for r in reader.collect()} == {"x"}


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, [], "a")
    assert current_parts(spark, path) == {}
    with pytest.raises(ValueError):
        read_current(spark, path)
    schema = spark.createDataFrame([], "shard long, v string").schema
    assert read_current(spark, path, schema, file="f", row="r").columns == ["shard", "v", "f", "r"]

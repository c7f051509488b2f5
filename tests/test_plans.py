"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from parlato import catalogue
from parlato.operators import filters, numbering, sampling
from parlato.plans.prepare import prepared
from parlato.plans.training import training_rows
from parlato.schema import conform, with_fillers
from parlato.session import fill_cluster
from parlato.sources import audio, shards


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "t")
    rows = spark.range(2000).select(
        F.struct(F.encode(F.lit("x"), "UTF-8").alias("bytes"), F.col("id").cast("string").alias("path")).alias("audio"),
        F.lit("a [b] c").alias("text"),
        (F.col("id") / 50).alias("duration"),
        F.lit("train").alias("split"),
        (F.col("id") % 3).cast("string").alias("OG_corpus"),
    )
    conform(with_fillers(rows)).write.parquet(path)
    return path


def test_prepare_is_one_scan_without_shuffle_or_python(spark, stored):
    text = plan(prepared(shards.read_shards(spark, stored), filter_by_duration=True))
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text
    assert "LessThanOrEqual(duration,30.0)" in text and "In(split, [" in text


def test_audio_bytes_stay_unread(spark, stored):
    rows = shards.read_shards(spark, stored)
    cut = plan(sampling.split_cutoffs(rows, "audio.path", "OG_corpus"))
    assert "bytes" not in cut and "text" not in cut.replace("ReadSchema: struct<audio", "")
    assert "bytes" not in plan(rows.select("audio.path", "text"))
    report = plan(filters.at_most(rows).groupBy("OG_corpus").count())
    assert "bytes" not in report


def test_labels_move_no_rows(spark, stored):
    rows = shards.read_shards(spark, stored)
    labelled = sampling.assign_split(rows, "audio.path", "OG_corpus")
    text = plan(labelled)
    # the rows are scanned once and meet a broadcast; nothing else is exchanged
    wide = [line for line in text.splitlines() if "FileScan" in line and "bytes" in line]
    assert len(wide) == 1 and "BroadcastHashJoin" in text and text.count("Exchange") == 1
    whole = plan(sampling.assign_split(rows, "audio.path", None)).split("Subquery")[0]
    assert "Exchange" not in whole and "Join" not in whole


def test_reading_one_split_prunes_folders(spark, stored, tmp_path):
    out = str(tmp_path / "splits")
    shards.write_splits(prepared(shards.read_shards(spark, stored)), out)
    assert "PartitionFilters: [isnotnull(split" in plan(shards.read_split(spark, out, "train"))


def test_training_read_pushes_filters(spark, stored):
    text = plan(training_rows(shards.read_shards(spark, stored)))
    assert "IsNotNull(duration)" in text and "IsNotNull(audio.bytes)" in text
    assert text.count("Exchange") == 1 and "rangepartitioning" not in text


def test_audio_is_read_where_it_is_written(spark, tmp_path):
    rows = spark.createDataFrame([("x/a.wav", "n", 0)], "path string, name string, shard long")
    dealt = rows.repartition("name", "shard").sortWithinPartitions("name", "shard")
    lines = plan(audio.with_audio(dealt, str(tmp_path))).splitlines()
    read = next(k for k, line in enumerate(lines) if "MapInArrow" in line)
    assert not any("Exchange" in line for line in lines[:read]) and any("Exchange" in line for line in lines[read:])


def test_offsets_of_a_million_files_move_no_rows(spark, stored):
    rows = shards.read_shards(spark, stored)
    files = spark.createDataFrame([("f", 0)], "__file string, __start long")
    text = plan(numbering._with_offsets(rows, files, 1_000_000, "n"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and text.count("Exchange") == 1


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n.startswith("normalize_")])
def test_normalising_large_input_has_no_exchange(spark, monkeypatch, name):
    monkeypatch.setattr(catalogue, "fill_cluster", lambda df: fill_cluster(df, 100))
    assert "Exchange" not in plan(catalogue.QUERIES[name](spark, "/root/testdata/sf0.001"))


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - {"ingest_stream"}))
def test_no_query_has_a_cross_join(spark, name):
    text = plan(catalogue.QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text

import random

import pytest
from pyspark.sql import functions as F

from parlato.operators import batching, filters, lookup, numbering, report, sampling, union
from parlato.schema import UTTERANCE, align_columns, conform, require_columns, with_fillers


def split_counts(df, shard):
    rows = df.groupBy(shard).agg(F.count("*").alias("n"), F.sum((F.col("split") == "test").cast("int")).alias("t"))
    return {r[shard]: (r.n, r.t) for r in rows.collect()}


def test_split_has_exact_counts_in_every_shard(spark):
    # one shard holds a third of the rows, some hold one row, one has no name
    sizes = {"hot": 20_000, "a": 7_000, "b": 999, "c": 20, "one": 1, None: 500}
    sizes.update({f"s{i}": 21 for i in range(30)})
    rows = [(f"{shard}-{i}", shard) for shard, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "utt string, shard string")
    out = sampling.assign_split(df, "utt", "shard")
    assert split_counts(out, "shard") == {s: (n, max(1, int(n * 0.048))) for s, n in sizes.items()}
    again = sampling.assign_split(df.repartition(13, "utt"), "utt", "shard")
    key = ["utt", "shard", "split"]
    assert sorted(out.select(key).collect(), key=str) == sorted(again.select(key).collect(), key=str)
    other = sampling.assign_split(df, "utt", "shard", seed=1)
    assert {r.utt for r in out.filter("split = 'test'").collect()} != {r.utt for r in other.filter("split = 'test'").collect()}


def test_split_of_whole_table_and_of_two_columns(spark):
    df = spark.range(5000).withColumns({"name": F.lit("n"), "shard": F.col("id") % 2})
    whole = sampling.assign_split(df, "id", None, 0.1)
    assert whole.filter("split = 'test'").count() == 500
    assert whole.columns == df.columns + ["split"]
    parts = sampling.assign_split(df, "id", ["name", "shard"], 0.1)
    assert split_counts(parts, "shard") == {0: (2500, 250), 1: (2500, 250)}


def test_large_buckets_are_cut_finer(spark):
    df = spark.range(6000).select(F.col("id").cast("string").alias("utt"), (F.col("id") % 4 > 0).alias("shard"))
    for shard in ("shard", None):
        plain = sampling.split_cutoffs(df, "utt", shard, 0.3)
        finer = sampling.split_cutoffs(df, "utt", shard, 0.3, max_sorted=1)
        assert sorted(plain.collect()) == sorted(finer.collect()) and plain.count() == (2 if shard else 1)


def test_split_of_empty_table_has_no_rows(spark):
    df = spark.createDataFrame([], "utt string, shard string")
    assert sampling.assign_split(df, "utt", "shard").count() == 0
    assert sampling.assign_split(df, "utt", None).count() == 0


def test_repeated_and_null_keys(spark):
    rows = [(None if i % 2 else "same", i // 500, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "key string, shard int, place int")
    with pytest.raises(sampling.RepeatedKey):
        sampling.assign_split(df, "key", "shard")
    out = sampling.assign_split(df, "key", "shard", tie=F.col("place").cast("string"))
    assert out.columns == [*df.columns, "split"] and split_counts(out, "shard") == {0: (500, 24), 1: (500, 24)}
    cut = sampling.split_cutoffs(df, "key", "shard", max_sorted=1, tie=F.col("place").cast("string"))
    assert sorted(cut.collect()) == sorted(sampling.split_cutoffs(df, "key", "shard", tie=F.col("place").cast("string")).collect())
    assert sampling.assign_split(df, "key", None, 0.1, tie=F.col("place").cast("string")).filter("split = 'test'").count() == 100


def test_large_cutoffs_are_not_sent(spark, monkeypatch):
    df = spark.range(3000).select(F.col("id").cast("string").alias("utt"), (F.col("id") % 3).alias("shard"))
    whole = sampling.assign_split(df, "utt", "shard")
    monkeypatch.setattr(sampling, "MAX_BROADCAST_BYTES", 0)
    assert sorted(sampling.assign_split(df, "utt", "shard").collect()) == sorted(whole.collect())


def test_report_counts_dropped_rows(spark):
    rows = [("a", "train", 1.0), ("a", "validation", 2.0), ("a", None, 3.0), ("a", "test", 40.0)]
    out = report.split_report(spark.createDataFrame(rows, "OG_corpus string, split string, duration double"))
    assert {(r.split, r.dropped, r.total_seconds) for r in out.collect()} == {
        ("train", False, 1.0), ("validation", True, 2.0), (None, True, 3.0), ("test", False, 40.0),
    }


def test_positions_of_the_older_sampler(spark):
    sizes = [1, 2, 20, 21, 333]
    rows = [(shard, i) for shard, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "shard int, idx int")
    got = sampling.assign_split_by_position(df, "shard", "idx").filter("split = 'test'").collect()
    want = set()
    for shard, n in enumerate(sizes):
        random.seed(42)
        want |= {(shard, i) for i in random.sample(range(n), max(1, int(n * 0.048)))}
    assert {(r.shard, r.idx) for r in got} == want


def test_numbering(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartitionByRange(5, "id").sortWithinPartitions("id").write.parquet(path)
    df = spark.read.parquet(path)
    rows = numbering.number_by_file(df).collect()
    assert all(r.id == r.row_number for r in rows) and len(rows) == 1000

    mixed = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("x"))
    rows = numbering.number_by_key(mixed, ["k"]).collect()
    assert all(r.k == r.row_number for r in rows) and len(rows) == 1000

    sharded = df.withColumn("shard", numbering.shard_of(F.col("id"), 300))
    assert {r.shard: r.n_rows for r in numbering.count_per_shard(sharded).collect()} == {0: 300, 1: 300, 2: 300, 3: 100}


def test_shuffle(spark):
    df = spark.range(5000)
    ranks = numbering.shuffle_rank(df, "id", seed=1).collect()
    assert sorted(r.rank for r in ranks) == list(range(5000))
    by_rank = [r.id for r in sorted(ranks, key=lambda r: r.rank)]
    assert by_rank != list(range(5000))
    assert [r.id for r in numbering.shuffled(df.repartition(3), "id", seed=1).collect()] == by_rank


def test_readers(spark):
    df = spark.range(7).withColumn("reader", numbering.reader_of(F.col("id"), 3))
    assert [r.reader for r in df.orderBy("id").collect()] == [0, 1, 2, 0, 1, 2, 0]


NAN = float("nan")


def test_duration_filters(spark):
    rows = [(None, "train"), (NAN, "train"), (0.0, "train"), (0.5, "train"), (30.0, "test"), (30.1, "test"), (0.1, "test"), (0.1, None)]
    df = spark.createDataFrame(rows, "duration double, split string")
    assert sorted(r.duration for r in filters.at_most(df).collect()) == [0.0, 0.1, 0.1, 0.5, 30.0]
    kept = [r.duration for r in filters.at_least(df).collect()]
    assert sorted(x for x in kept if x == x) == [0.5, 30.0, 30.1] and len(kept) == 4
    train_only = filters.at_least(df, splits=("train",)).collect()
    assert sorted(str(r.duration) for r in train_only) == ["0.1", "0.1", "0.5", "30.0", "30.1", "nan"]


def test_split_and_vote_filters(spark):
    df = spark.createDataFrame([("train", 4), ("test", 5), ("validation", 6), (None, None)], "split string, up_votes int")
    assert sorted(r.split for r in filters.known_splits(df).collect()) == ["test", "train"]
    assert sorted(r.up_votes for r in filters.voted(df).collect()) == [5, 6]
    with pytest.raises(ValueError):
        filters.known_splits(df, "part")
    df = df.withColumns({"OG_corpus": F.lit("x"), "duration": F.lit(2.0)})
    counts = {(r.split, r.n_utterances, r.total_seconds) for r in report.split_report(df).collect()}
    assert counts == {("train", 1, 2.0), ("test", 1, 2.0), ("validation", 1, 2.0), (None, 1, 2.0)}


def test_bad_rows(spark):
    rows = [((b"x", "p0"), 1.0, "t"), (None, 1.0, "t"), ((None, "p2"), 1.0, "t"), ((b"x", "p3"), None, "t"), ((b"x", "p4"), 1.0, None)]
    df = spark.createDataFrame(rows, "audio struct<bytes:binary,path:string>, duration double, text string")
    assert [r.audio.path for r in filters.usable_rows(df).collect()] == ["p0", "p4"]
    assert [r.audio.path for r in filters.usable_rows(df, strict=True).collect()] == ["p0"]
    assert {(r.path, r.reason) for r in filters.unusable_rows(df, strict=True).collect()} == {
        (None, "no audio"), ("p2", "no audio bytes"), ("p3", "no duration"), ("p4", "no text"),
    }


def test_relabel(spark):
    df = spark.createDataFrame([("d/YODAS_shard0", "a"), ("d/FLEURS_shard0", "b")], "path string, OG_corpus string")
    assert [r.OG_corpus for r in filters.relabel_corpus(df, F.col("path")).collect()] == ["yodas_granary", "b"]
    added = filters.relabel_corpus(df.drop("OG_corpus"), F.col("path")).collect()
    assert [r.OG_corpus for r in added] == ["yodas_granary", None]


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, "t", 3)], "extra int, text string, duration int")
    out = conform(with_fillers(df))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in UTTERANCE]
    row = out.first()
    assert (row.text, row.duration, row.audio, row.split, row.lang) == ("t", 3.0, None, None, "None")
    assert with_fillers(df, strict=True).first().lang is None
    assert align_columns(df, ["text", "extra"]).columns == ["text", "extra"]
    with pytest.raises(ValueError):
        require_columns(df, ["text", "sentence"])


def test_union_of_drifting_shards(spark):
    a = spark.createDataFrame([(1, 2.5, "x")], "i int, d float, s string")
    b = spark.createDataFrame([("y", 2**40, 3.25, "extra")], "s string, i bigint, d double, e string")
    out = union.union_shards([a, b])
    assert out.dtypes == [("i", "bigint"), ("d", "double"), ("s", "string")]
    assert sorted(out.collect()) == [(1, 2.5, "x"), (2**40, 3.25, "y")]
    whole = union.union_shards([a.select("i"), spark.createDataFrame([(0.1,)], "i float")])
    assert whole.dtypes == [("i", "double")]
    with pytest.raises(ValueError):
        union.union_shards([a, b.drop("d")])
    with pytest.raises(ValueError):
        union.union_shards([a.select("s"), a.select(F.col("i").alias("s"))])
    with pytest.raises(ValueError):
        union.union_shards([])


def test_references(spark):
    refs = spark.createDataFrame(
        [("a.mp3", "one", 9, 0), ("a.mp3", "two", 5, 1), ("a.mp3", "three", 4, 2), ("b.mp3", None, 7, 3), ("d.mp3", "dee", None, 4)],
        "path string, sentence string, up_votes int, ord bigint",
    )
    voted = filters.voted(refs)
    assert sorted(tuple(r) for r in lookup.last_reference(voted, "ord").collect()) == [("a.mp3", "two"), ("b.mp3", None)]
    with pytest.raises(lookup.DuplicateReference):
        lookup.last_reference(voted)
    with pytest.raises(ValueError):
        lookup.last_reference(voted.drop("sentence"))

    names = spark.createDataFrame([("a.wav",), ("a.wav",), ("b.wav",), ("c.wav",)], "name string")
    files = spark.createDataFrame([("a.wav",), ("a.wav",), ("b.wav",)], "name string")
    present = lookup.keep_present(names, files)
    assert sorted(r.name for r in present.collect()) == ["a.wav", "a.wav", "b.wav"]
    assert [r.name for r in lookup.absent(names, files).collect()] == ["c.wav"]
    chosen = lookup.last_reference(voted, "ord")
    found = lookup.with_references(present, chosen).collect()
    assert sorted((r.utt_id, str(r.sentence)) for r in found) == [("a", "two"), ("a", "two"), ("b", "None")]
    with pytest.raises(lookup.MissingReference):
        lookup.with_references(names, chosen)
    assert lookup.with_references(names, chosen, on_missing="drop").count() == 3


def test_padding(spark):
    rows = [(0, 0, [1, 5, 6]), (0, 1, [1, 7]), (1, 0, [1, 2]), (1, 1, [3]), (2, 0, [1]), (3, 0, []), (3, 1, [1, 4])]
    df = spark.createDataFrame(rows, "batch_id int, pos int, labels array<int>")
    out = {(r.batch_id, r.pos): r.labels for r in batching.pad_labels(df, start_token=1).collect()}
    assert out == {
        (0, 0): [5, 6], (0, 1): [7, -100], (1, 0): [1, 2], (1, 1): [3, -100], (2, 0): [],
        (3, 0): [-100, -100], (3, 1): [1, 4],
    }
    kept = {(r.batch_id, r.pos): r.labels for r in batching.pad_labels(df).collect()}
    assert kept[(0, 1)] == [1, 7, -100]
    back = df.select(batching.restore_padding(F.array(F.lit(-100), F.lit(4)), 9).alias("l")).first()
    assert back.l == [9, 4]


def test_batches_are_full(spark):
    out = batching.assign_batches(spark.range(100).select(F.col("id").cast("string").alias("k")), "k", 32)
    sizes = {r.batch_id: r["count"] for r in out.groupBy("batch_id").count().collect()}
    assert sizes == {0: 32, 1: 32, 2: 32, 3: 4}
    assert sorted(r.pos for r in out.filter("batch_id = 1").collect()) == list(range(32))

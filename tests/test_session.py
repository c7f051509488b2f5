import os
from types import SimpleNamespace

import pytest

from parlato.session import fill_cluster, scratch_path, shared_dir, staged


def fake(master, named=None):
    """A session without a real context, to see what is asked of it."""
    state = {"dir": None}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda folder: state.update(dir=folder),
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named))


def test_shared_dir_is_the_named_one():
    assert shared_dir(fake("spark://host", "hdfs://x/y/")) == "hdfs://x/y"


def test_a_cluster_must_name_a_folder():
    with pytest.raises(ValueError):
        shared_dir(fake("spark://host"))


def test_a_local_session_gets_a_folder_once():
    session = fake("local[2]")
    assert os.path.isdir(shared_dir(session)) and shared_dir(session) == shared_dir(session)


def test_staged_keeps_rows_and_schema(spark):
    df = spark.range(10).withColumnRenamed("id", "n")
    out = staged(df, "numbers")
    assert sorted(out.collect()) == sorted(df.collect()) and out.dtypes == df.dtypes
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_small_scans_are_spread_and_large_ones_left(spark, tmp_path):
    small, large = str(tmp_path / "s"), str(tmp_path / "l")
    spark.range(10).coalesce(1).write.parquet(small)
    spark.range(1000).repartition(16).write.parquet(large)
    cores = spark.sparkContext.defaultParallelism
    assert fill_cluster(spark.read.parquet(small)).rdd.getNumPartitions() == cores
    many = spark.read.parquet(large)
    assert fill_cluster(many, 100) is many


def test_staged_leaves_no_shuffle_files(spark):
    from pyspark.sql import functions as F

    from parlato.session import CLEANUP, staged

    def files():
        folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}

    before = files()
    made = staged(spark.range(100_000).groupBy(F.col("id") % 1000).count(), "counts")
    assert not files() - before
    assert made.count() == 1000 and spark.conf.get(CLEANUP, "false") == "false"
    # other queries keep theirs
    assert files() - before

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from parlato.sources.drift import layouts, union_files


@pytest.fixture
def files(spark, tmp_path):
    made = []
    for k in range(30):
        rows = spark.range(k * 10, k * 10 + 10)
        if k % 3 == 1:
            rows = rows.selectExpr("cast(id as float) / 2 as d", "'x' as extra", "cast(id as int) as id")
        elif k % 3 == 2:
            rows = rows.selectExpr("id", "cast(id as double) / 2 as d")
        else:
            rows = rows.selectExpr("cast(id as short) as id", "cast(id as double) / 2 as d")
        rows.coalesce(1).write.parquet(f"{tmp_path}/a b/{k:02}")
        made += spark.read.parquet(f"{tmp_path}/a b/{k:02}").inputFiles()
    return made


def test_one_scan_for_each_layout(spark, files):
    df = union_files(spark, files)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [("id", "bigint"), ("d", "double")]
    assert sorted(map(tuple, df.collect())) == [(i, i / 2) for i in range(300)]
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 3 and "extra" not in text


def test_layouts(spark, files):
    assert layouts(spark, files).select("layout").distinct().count() == 3


def test_files_of_others(spark, tmp_path):
    pq.write_table(pa.table({"x": pa.array([1, 2], pa.int32()), "s": ["a", None]}), tmp_path / "one.parquet")
    pq.write_table(pa.table({"s": ["b"], "x": pa.array([2**40])}), tmp_path / "two.parquet")
    df = union_files(spark, [str(tmp_path / "one.parquet"), str(tmp_path / "two.parquet")])
    assert sorted(map(tuple, df.collect()), key=str) == [(1, "a"), (1 << 40, "b"), (2, None)]


def test_lacking_column_and_types_that_do_not_combine(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "x int, y string").write.parquet(f"{tmp_path}/1")
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{tmp_path}/2")
    spark.createDataFrame([("1", "a")], "x string, y string").write.parquet(f"{tmp_path}/3")
    one, two, three = (spark.read.parquet(f"{tmp_path}/{k}").inputFiles() for k in (1, 2, 3))
    with pytest.raises(ValueError, match="y"):
        union_files(spark, one + two)
    with pytest.raises(ValueError, match="x"):
        union_files(spark, one + three)
    with pytest.raises(ValueError):
        union_files(spark, [])

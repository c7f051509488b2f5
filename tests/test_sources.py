import os
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlato.operators.lookup import MissingReference
from parlato.plans.create import as_utterances, label_splits, materialise_splits, read_dataset, table_to_shards
from parlato.plans.evaluate import evaluate
from parlato.plans.prepare import prepare
from parlato.plans.training import map_rows, read_for_training
from parlato.schema import conform, with_fillers
from parlato.sources.versions import current_parts, read_current
from parlato.sources import arrow_ipc, shards, tables, transcripts
from parlato.sources.transcripts import read_transcripts


def write_ipc(path, table, rows_per_batch=None):
    with pa.OSFile(str(path), "wb") as sink, pa.ipc.new_file(sink, table.schema) as out:
        out.write_table(table, max_chunksize=rows_per_batch)


def test_csv_by_name(spark, tmp_path):
    path = tmp_path / "refs.CSV"
    path.write_text('client,up_votes,sentence,path\nx,5,"disse ""ciao"",\nbello",a.mp3\ny,,Perché,b.mp3\n', encoding="utf-8")
    rows = tables.read_references(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [("a.mp3", 'disse "ciao",\nbello', 5), ("b.mp3", "Perché", None)]
    assert tables.read_table(spark, str(path), ["path"]).columns == ["path"]
    with pytest.raises(ValueError):
        tables.read_table(spark, str(path), ["nope"])


def test_unknown_or_absent_tables(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path / "a.xml"))
    for suffix in ("csv", "parquet", "arrow"):
        with pytest.raises(FileNotFoundError):
            tables.read_table(spark, str(tmp_path / f"none.{suffix}"))


def test_head(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    df = spark.range(100).select(F.col("id").cast("string").alias("text"), F.col("id").alias("other"), F.lit(1.0).alias("duration"))
    df.repartitionByRange(7, "other").sortWithinPartitions("other").write.parquet(path)
    rows = tables.head(spark, path, 30)
    assert rows.columns == ["text", "duration"]
    assert [r.text for r in rows.collect()] == [str(i) for i in range(30)]
    assert tables.head(spark, path, 0).count() == 0
    assert tables.head(spark, path, 1000).count() == 100
    with pytest.raises(ValueError):
        tables.head(spark, path, -1)
    with pytest.raises(ValueError):
        tables.head(spark, "x.json")
    plain = str(tmp_path / "p.parquet")
    spark.range(3).write.parquet(plain)
    assert tables.head(spark, plain).columns == ["id"]


def test_view(spark, capsys):
    tables.view(spark.createDataFrame([(1, "é")], "a int, b string"))
    out = capsys.readouterr().out
    assert "a | 1" in " ".join(out.split()) and "b | é" in " ".join(out.split())


def test_arrow_files(spark, tmp_path, monkeypatch):
    table = pa.table({"text": [f"t{i}" for i in range(1000)], "n": list(range(1000)), "split": ["train"] * 1000})
    write_ipc(tmp_path / "b.arrow", table.slice(500), 100)
    write_ipc(tmp_path / "a.arrow", table.slice(0, 500), 100)
    df = arrow_ipc.read_arrow(spark, str(tmp_path))
    assert df.columns == ["text", "n", "split"] and df.count() == 1000
    assert df.agg(F.sum("n")).first()[0] == sum(range(1000))
    assert arrow_ipc.read_arrow(spark, str(tmp_path / "a.arrow"), ["n"]).agg(F.max("n"), F.count("*")).first() == (499, 500)
    with pytest.raises(ValueError):
        arrow_ipc.read_arrow(spark, str(tmp_path), ["nope"])
    head = tables.head(spark, str(tmp_path / "a.arrow"), 120)
    assert head.columns == ["text", "split"] and [r.text for r in head.collect()] == [f"t{i}" for i in range(120)]

    monkeypatch.setattr(arrow_ipc, "SPLIT_BYTES", 4000)
    reader = arrow_ipc._Reader(str(tmp_path), T.StructType([T.StructField("n", T.LongType())]))
    parts = reader.partitions()
    assert len(parts) > 2
    values = [v for part in parts for batch in reader.read(part) for v in batch.column("n").to_pylist()]
    assert values == list(range(1000))
    monkeypatch.setattr(arrow_ipc.pa.ipc, "open_file", None)
    assert reader.partitions() == parts


CONDITIONS = [
    "n = 37", "n > 990 and text <> 't995'", "n in (5, 700, 2000)", "n not in (5)", "n <=> null", "text is null", "text is not null and n < 3",
    "text like 't99%'", "text like '%7'", "text like '%55%'", "not (n >= 4)", "flag", "not flag", "x > 3.5", "x = 'NaN'", "n = 10 or n = 900",
    "text in ('t1', null)", "text not in ('t1', null)", "n <=> 5", "n between 120 and 130 and x < 125",
]


def test_filters_reach_arrow_files(spark, tmp_path, monkeypatch):
    n = [None if i % 50 == 49 else i for i in range(1000)]
    text = [None if i % 40 == 39 else f"t{i}" for i in range(1000)]
    x = [float("nan") if i % 30 == 29 else float(i) for i in range(1000)]
    flag = pa.array([None if i % 7 == 0 else i % 2 == 0 for i in range(1000)])
    table = pa.table({"text": text, "n": pa.array(n, pa.int32()), "x": x, "flag": flag})
    write_ipc(tmp_path / "a.arrow", table, 100)
    rows = arrow_ipc.read_arrow(spark, str(tmp_path))
    plain = spark.createDataFrame(list(zip(text, n, x, flag.to_pylist())), rows.schema)
    for condition in CONDITIONS:
        want, got = (sorted(map(repr, df.where(condition).collect())) for df in (plain, rows))
        assert got == want, condition

    reads = []
    whole = arrow_ipc._batch

    def counted(source, names, wanted):
        read = whole(source, names, wanted)
        return lambda i: reads.append((tuple(names), i)) or read(i)

    monkeypatch.setattr(arrow_ipc, "_batch", counted)
    reader = arrow_ipc._FilteringReader(str(tmp_path), rows.schema)
    kept = arrow_ipc.GreaterThan(("n",), 850), arrow_ipc.EqualTo(("x",), 3.0)
    assert list(reader.pushFilters(list(kept))) == [kept[1]]
    found = [b for part in reader.partitions() for b in reader.read(part)]
    assert sum(b.num_rows for b in found) == sum(v is not None and v > 850 for v in n)
    assert [i for names, i in reads if names == ("n",)] == list(range(10))
    assert [i for names, i in reads if names != ("n",)] == [8, 9]


def test_plan_shows_filters_of_arrow_files(spark, tmp_path):
    write_ipc(tmp_path / "a.arrow", pa.table({"n": list(range(100))}), 10)
    rows = arrow_ipc.read_arrow(spark, str(tmp_path)).where("n > 95")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert " Filter " not in plan and rows.count() == 4
    left = arrow_ipc.read_arrow(spark, str(tmp_path)).where("n % 2 = 1")
    assert " Filter " in left._jdf.queryExecution().executedPlan().toString()


def test_head_of_many_arrow_files(spark, tmp_path):
    sizes = [0, 3, 0, 10, 1] + [5] * 30
    at = 0
    for k, size in enumerate(sizes):
        write_ipc(tmp_path / f"{k:03d}.arrow", pa.table({"n": pa.array(range(at, at + size), pa.int64())}), 4)
        at += size
    for n, files in ((0, 1), (1, 2), (3, 2), (4, 4), (14, 5), (15, 6), (60, 15), (at, len(sizes)), (at + 5, len(sizes))):
        assert arrow_ipc._files_that_hold(spark, str(tmp_path), n) == files
        rows = arrow_ipc.first_arrow_rows(spark, str(tmp_path), n, list)
        assert [r.n for r in rows.collect()] == list(range(min(n, at)))


def test_arrow_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [((b"\0\1", "p"), "caffè", 1.5, ["a", None]), (None, None, None, None)]
    df = spark.createDataFrame(rows, "audio struct<bytes:binary,path:string>, text string, d double, l array<string>")
    for _ in range(2):
        arrow_ipc.write_arrow(df, path)
        back = arrow_ipc.read_arrow(spark, path)
        assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    assert not [name for name in os.listdir(path) if name.startswith(".")]
    # what an overwrite leaves is what it wrote, whatever a reader would have found before
    os.makedirs(f"{path}/deeper")
    for name in ("old.feather", "deeper/old.arrow"):
        parts = [f"{path}/{f}" for f in os.listdir(path) if f.endswith(".arrow")]
        os.link(max(parts, key=os.path.getsize), f"{path}/{name}")
    assert arrow_ipc.read_arrow(spark, path).count() > 2
    arrow_ipc.write_arrow(df, path)
    assert arrow_ipc.read_arrow(spark, path).count() == 2
    arrow_ipc.write_arrow(df.limit(0), f"{path}-empty")
    assert arrow_ipc.read_arrow(spark, f"{path}-empty").schema == df.schema
    assert arrow_ipc.read_arrow(spark, f"{path}-empty").count() == 0
    arrow_ipc.write_arrow(df, path, "append")
    assert arrow_ipc.read_arrow(spark, path).count() == 4


def test_shards(spark, tmp_path):
    source, first, second = (str(tmp_path / name) for name in ("s", "one", "two"))
    spark.range(45).select("id", F.concat(F.lit("È [x] "), "id").alias("text")).coalesce(1).write.parquet(source)
    shards.write_shards(shards.shard_by_file(spark.read.parquet(source), 20), first)
    assert sorted(current_parts(spark, first)) == ["shard=0", "shard=1", "shard=2"]
    shards.normalize_table(spark, first, second)
    schema = T.StructType().add("id", "long").add("text", "string").add("absent", "double").add("shard", "long")
    rows = shards.read_shards(spark, second, schema).collect()
    assert {(r.id, r.text, r.absent, r.shard) for r in rows} == {(i, f"E {i}", None, i // 20) for i in range(45)}
    with pytest.raises(ValueError):
        shards.normalize_table(spark, source, source + "/")
    with pytest.raises(FileNotFoundError):
        shards.read_shards(spark, str(tmp_path / "none"))

    change = spark.createDataFrame([(99, "new", 1)], "id long, text string, shard long")
    shards.replace_shards(change, second)
    counts = {r.shard: r["count"] for r in read_current(spark, second).groupBy("shard").count().collect()}
    assert counts == {0: 20, 1: 1, 2: 5}

    no_text = str(tmp_path / "plain")
    spark.range(3).write.parquet(no_text)
    shards.normalize_table(spark, no_text, str(tmp_path / "copy"))
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 3

    export = str(tmp_path / "export")
    shards.write_reader_export(read_current(spark, first), export, 2)
    counts = {r.reader: r["count"] for r in spark.read.parquet(export).groupBy("reader").count().collect()}
    assert counts == {0: 25, 1: 20}


def test_whole_numbers_widen_on_read(spark, tmp_path):
    spark.createDataFrame([(1, 1.5)], "i int, d float").write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([(2.5, 2**40, "x")], "d double, i bigint, e string").write.parquet(str(tmp_path / "b"))
    schema = T.StructType().add("i", "long").add("d", "double")
    rows = shards.read_shards(spark, [str(tmp_path / "a"), str(tmp_path / "b")], schema).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 1.5), (2**40, 2.5)]


def utterance_rows(spark):
    rows = [("a", 0.2, "train"), ("b", 0.5, "train"), ("c", 30.0, "train"), ("d", 30.5, "train"), ("e", 0.1, "test"), ("f", 1.0, None), ("g", 1.0, "dev")]
    df = spark.createDataFrame(rows, "utt_id string, duration double, split string")
    audio = F.struct(F.lit(b"x").alias("bytes"), F.col("utt_id").alias("path"))
    return conform(with_fillers(df.withColumns({"audio": audio, "text": F.concat(F.lit("É-"), "utt_id")})))


def test_prepare_and_read_for_training(spark, tmp_path):
    source, out = str(tmp_path / "s"), str(tmp_path / "out")
    utterance_rows(spark).write.parquet(source)
    prepare(spark, source, out)
    rows = read_current(spark, out).select("utt_id", "text", "split").collect()
    assert {tuple(r) for r in rows} == {
        ("a", "E a", "train"), ("b", "E b", "train"), ("c", "E c", "train"), ("e", "E e", "test"),
    }
    prepare(spark, source, out, filter_by_duration=True)
    assert {r.utt_id for r in read_current(spark, out).collect()} == {"b", "c", "e"}
    train = read_for_training(spark, out, "train", transform=lambda df: df.select("utt_id", F.upper("text").alias("t")))
    assert {tuple(r) for r in train.collect()} == {("b", "E B"), ("c", "E C")}


def test_map_rows(spark):
    schema = T.StructType().add("id", "long").add("double", "long")
    out = map_rows(spark.range(10), lambda r: {"id": r["id"], "double": 2 * r["id"]} if r["id"] > 6 else None, schema)
    assert sorted(tuple(r) for r in out.collect()) == [(7, 14), (8, 16), (9, 18)]


def test_table_to_shards(spark, tmp_path):
    source, out = str(tmp_path / "t.parquet"), str(tmp_path / "dataset")
    utterance_rows(spark).coalesce(1).write.parquet(source)
    table_to_shards(spark, source, out, rows_per_shard=3)
    rows = read_dataset(spark, out, ["YODAS"]).select("utt_id", "shard").collect()
    assert {tuple(r) for r in rows} == {(u, i // 3) for i, u in enumerate("abcdefg")}


def test_script_names(spark, tmp_path):
    path = tmp_path / "run.sh"
    path.write_text(
        "#!/bin/sh\npython doasr_home.py /home/docker/clip_01.wav\npython doasr_home.py\t /home/docker/c-2.wav > x\n"
        "python doasr_home.py /home/docker/two words.wav\necho /home/docker/clip_03.wav\npython doasr_home.py /home/docker/clip_01.wav\n"
    )
    names = sorted(r.name for r in transcripts.read_script_names(spark, str(path)).collect())
    assert names == ["c-2.wav", "clip_01.wav", "clip_01.wav"]


def lines_of(folder):
    parts = sorted(name for name in os.listdir(folder) if name.startswith("part-"))
    return [line for part in parts for line in open(f"{folder}/{part}", encoding="utf-8").read().splitlines()]


def test_evaluate(spark, tmp_path):
    script, refs, out = tmp_path / "run.sh", tmp_path / "refs.csv", str(tmp_path / "out")
    script.write_text("".join(f"python doasr_home.py /home/docker/{n}.wav\n" for n in ("b", "a", "gone")))
    refs.write_text("path,sentence,up_votes\na.mp3,Ciao bella!,5\nb.mp3,Perché no?,9\nb2.mp3,x,9\na.mp3,old,4\n", encoding="utf-8")
    hyps = spark.createDataFrame([("a.wav", "Ciao (eh) bello"), ("b.wav", "Perche no")], "name string, hyp string")
    row = evaluate(spark, str(script), str(refs), hyps, out).first()
    assert (row.n_pairs, row.edits, row.ref_words, row.wer) == (2, 1, 4, 0.25)
    assert lines_of(f"{out}/hyp") == ["Ciao bello (a)", "Perche no (b)"]
    assert lines_of(f"{out}/ref") == ["Ciao bella (a)", "Perche no (b)"]
    with pytest.raises(MissingReference):
        evaluate(spark, str(script), str(refs), hyps.union(spark.createDataFrame([("gone.wav", "x")], hyps.schema)), out)


def test_jobs_fail_on_missing_columns(spark, tmp_path):
    rows = spark.createDataFrame([("x", "train")], "text string, split string")
    rows.write.parquet(f"{tmp_path}/a")
    with pytest.raises(ValueError, match="duration"):
        prepare(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    with pytest.raises(ValueError, match="duration"):
        materialise_splits(spark, [f"{tmp_path}/a"], f"{tmp_path}/b")
    rows.drop("split").withColumn("duration", F.lit(1.0)).write.parquet(f"{tmp_path}/c")
    with pytest.raises(ValueError, match="split"):
        prepare(spark, f"{tmp_path}/c", f"{tmp_path}/b")


def test_shards_of_an_earlier_cut_go(spark, tmp_path):
    source, out, labelled = (str(tmp_path / name) for name in ("t", "d", "l"))
    rows = spark.range(100).select(F.lit("x").alias("text"), F.lit(1.0).alias("duration"))
    as_utterances(rows).coalesce(1).write.parquet(source)
    for rows_per_shard in (10, 40):
        table_to_shards(spark, source, out, "N", rows_per_shard)
        table_to_shards(spark, source, out, "other", 50)
        label_splits(spark, out, labelled, ["N"])
        # no row has a path; exact samples all the same
        found = {r.shard: (r.n, r.t) for r in read_dataset(spark, labelled, ["N"]).groupBy("shard").agg(
            F.count("*").alias("n"), F.sum((F.col("split") == "test").cast("int")).alias("t")).collect()}
        sizes = [rows_per_shard] * (100 // rows_per_shard) + ([20] if rows_per_shard == 40 else [])
        assert found == {k: (n, max(1, int(n * 0.048))) for k, n in enumerate(sizes)}
    assert read_dataset(spark, out).count() == 200


def test_last_reference_of_a_file(spark, tmp_path):
    (tmp_path / "script.sh").write_text("python doasr_home.py /home/docker/a.wav\n")
    lines = ["path,sentence,up_votes", "a.mp3,first,9", "a.mp3,second,9", "a.mp3,third,1"]
    (tmp_path / "refs.csv").write_text("\n".join(lines) + "\n")
    hyps = spark.createDataFrame([("a.wav", "second")], "name string, hyp string")
    for multi_line in (True, False):
        total = evaluate(spark, f"{tmp_path}/script.sh", f"{tmp_path}/refs.csv", hyps, f"{tmp_path}/out", multi_line=multi_line)
        assert (total.first().n_pairs, total.first().edits) == (1, 0)
    lines = read_transcripts(spark, f"{tmp_path}/out").collect()
    assert sorted((r.side, r.place, r.line) for r in lines) == [("hyp", 0, "second (a)"), ("ref", 0, "second (a)")]


def test_lines_are_cut_by_short_keys(spark):
    """What the driver samples to cut ranges holds no whole text; the order is that of whole texts all the same."""
    rng = random.Random(3)
    rows = [(f"u{rng.randrange(5)}", "same start of a text " * 2 + str(rng.randrange(40)), str(rng.randrange(9))) for _ in range(300)]
    rows += [("u1", None, "x"), (None, "y", None)]
    ordered = transcripts.in_line_order(spark.createDataFrame(rows, "utt_id string, hyp string, ref string"), "utt_id", "hyp", "ref")
    text = ordered._jdf.queryExecution().executedPlan().toString()
    cut = re.search(r"rangepartitioning\((.*)\), REPARTITION", text)[1]
    assert not re.search(r"\b(hyp|ref)#\d+ ASC", cut)
    assert [tuple(r) for r in ordered.collect()] == sorted(rows, key=lambda row: [(v is not None, v or "") for v in row])

import os
import random
import struct
import wave

import pandas as pd
import pytest
from pyspark.sql import functions as F

from parlato.functions.wav import header_info, seconds, wav_info
from parlato.sources.versions import read_current
from parlato.plans.create import audio_to_shards, label_splits, materialise_splits, read_dataset
from parlato.schema import UTTERANCE
from parlato.sources import audio
from parlato.sources.audio import BAD_AUDIO, BAD_TRANSCRIPT, NO_TRANSCRIPT, build_utterances
from parlato.streaming.ingest import ingest_audio, open_rejects

LIST_CHUNK = b"LIST" + struct.pack("<I", 5) + b"hello\0"


def wav(frames, rate=16000, channels=1, width=2, before=b"", kind=1, claimed=None):
    data = b"\0" * (frames * channels * width)
    block = channels * width
    layout = struct.pack("<IHHIIHH", 16, kind, channels, rate, rate * block, block, 8 * width)
    size = struct.pack("<I", len(data) if claimed is None else claimed)
    body = b"WAVE" + b"fmt " + layout + before + b"data" + size + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


def write_wave(path, frames, rate=16000, channels=1):
    with wave.open(str(path), "wb") as out:
        out.setnchannels(channels)
        out.setsampwidth(2)
        out.setframerate(rate)
        out.writeframes(b"\0\0" * channels * frames)


WIDE = (
    b"RF64" + b"\xff" * 4 + b"WAVE" + b"ds64" + struct.pack("<IQQQI", 28, 0, 200, 100, 0) + b"fmt "
    + struct.pack("<IHHIIHH", 16, 1, 1, 16000, 32000, 2, 16) + b"data" + b"\xff" * 4 + b"\0" * 200
)
EXTENSIBLE = (
    b"RIFF\0\0\0\0WAVEfmt " + struct.pack("<IHHIIHH", 40, 0xFFFE, 2, 48000, 192000, 4, 16) + b"\0" * 24
    + b"data" + struct.pack("<I", 400) + b"\0" * 400
)
BIG_ENDIAN = (
    b"RIFX" + struct.pack(">I", 243) + b"WAVE" + b"LIST" + struct.pack(">I", 5) + b"hello\0" + b"fmt "
    + struct.pack(">IHHIIHH", 16, 1, 2, 22050, 88200, 4, 16) + b"data" + struct.pack(">I", 200) + b"\0" * 200
)

HEADERS = {
    "big-endian": (BIG_ENDIAN, (50, 22050)),
    "big-endian, cut off": (BIG_ENDIAN[:-100], (25, 22050)),
    "big-endian, wrong tag": (b"RIFF" + BIG_ENDIAN[4:], None),
    "plain": (wav(24000), (24000, 16000)),
    "stereo": (wav(1000, 48000, 2), (1000, 48000)),
    "chunk before the samples": (wav(100, before=LIST_CHUNK), (100, 16000)),
    "many chunks": (wav(100, before=LIST_CHUNK * 50), (100, 16000)),
    "cut off": (wav(1000)[:-500], (750, 16000)),
    "float": (wav(10, width=4, kind=3), (10, 16000)),
    "extensible": (EXTENSIBLE, (100, 48000)),
    "64 bit": (WIDE, (100, 16000)),
    "no samples": (wav(0), (0, 16000)),
    "compressed": (wav(10, kind=2), None),
    "rate of zero": (wav(10, rate=0), None),
    "too short": (wav(10)[:20], None),
    "empty": (b"", None),
    "text": (b"hello world " * 10, None),
    "null": (None, None),
}


def test_wav_headers(spark):
    rows = [(name, content) for name, (content, _) in HEADERS.items()]
    df = spark.createDataFrame(rows, "name string, content binary")
    got = {r.name: r.info and tuple(r.info) for r in df.select("name", wav_info(F.col("content")).alias("info")).collect()}
    assert got == {name: info for name, (_, info) in HEADERS.items()}


def test_durations_of_real_files(spark, tmp_path):
    for name, frames, rate, channels in (("a", 24000, 16000, 1), ("b", 48000, 48000, 2), ("c", 10, 16000, 1)):
        write_wave(tmp_path / f"{name}.wav", frames, rate, channels)
    df = spark.read.format("binaryFile").load(str(tmp_path)).select("path", seconds(wav_info(F.col("content"))).alias("s"))
    assert {os.path.basename(r.path): r.s for r in df.collect()} == {"a.wav": 1.5, "b.wav": 1.0, "c.wav": 0.000625}


@pytest.fixture
def corpus(tmp_path):
    # a folder name without the word "test", which counts in paths
    base = tmp_path.parent.parent / f"corp-{os.urandom(6).hex()}"
    files = {
        "FL/a b.wav": (wav(16000), " caffè\r\nbello \n".encode()),
        "FL/sub/deep.wav": (wav(8000), b"deep"),
        "FL/test/t.wav": (wav(800), b"in test"),
        "FL/contest.wav": (wav(800), b"substring"),
        "FL/empty text.wav": (wav(800), b""),
        "FL/bad.wav": (wav(800), b"\xff\xfe"),
        "FL/lone.wav": (wav(800), None),
        "FL/zero.wav": (b"", b"hi"),
        "FL/noise.wav": (b"noise" * 20, b"hi"),
        "FL/UPPER.WAV": (wav(800), b"upper"),
        "FL/_hidden.wav": (wav(800), b"under"),
        "FL/.dots/.x.wav": (wav(1600), b"dot"),
        "FL/late data.wav": (wav(160, before=b"LIST" + (200_000).to_bytes(4, "little") + bytes(200_000)), b"late"),
        "VX/x.y.wav": (wav(160, before=LIST_CHUNK), b"dots"),
        "other/o.wav": (wav(800), b"not asked for"),
    }
    for name, (audio, text) in files.items():
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(audio)
        if text is not None:
            path.with_suffix(".txt").write_bytes(text)
    return base


def test_build_utterances(spark, corpus):
    rows, skipped = build_utterances(spark, f"{corpus}/", ["FL", "VX"])
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in UTTERANCE]
    below = len(str(corpus)) + 1
    prefix = "test" if "test" in str(corpus).lower() else "train"
    got = {r.path[below:]: tuple(r)[1:] for r in rows.select("audio.path", "text", "duration", "split", "OG_corpus").collect()}
    assert got == {
        "FL/a b.wav": ("caffè\nbello", 1.0, prefix, "FL"),
        "FL/sub/deep.wav": ("deep", 0.5, prefix, "sub"),
        "FL/test/t.wav": ("in test", 0.05, "test", "test"),
        "FL/contest.wav": ("substring", 0.05, "test", "FL"),
        "FL/empty text.wav": ("", 0.05, prefix, "FL"),
        "VX/x.y.wav": ("dots", 0.01, prefix, "VX"),
        "FL/_hidden.wav": ("under", 0.05, prefix, "FL"),
        "FL/.dots/.x.wav": ("dot", 0.1, prefix, ".dots"),
        "FL/late data.wav": ("late", 0.01, prefix, "FL"),
    }
    assert {r.path[below:]: r.reason for r in skipped.collect()} == {
        "FL/bad.wav": BAD_TRANSCRIPT,
        "FL/lone.wav": NO_TRANSCRIPT,
        "FL/zero.wav": BAD_AUDIO,
        "FL/noise.wav": BAD_AUDIO,
    }
    one = rows.filter(F.col("text") == "deep").first()
    assert one.audio.bytes == (corpus / "FL/sub/deep.wav").read_bytes()
    assert (one.utt_id, one.lang, one.original_audio_offset) == ("None", "None", 0.0)
    strict, _ = build_utterances(spark, str(corpus), ["VX"], strict=True)
    assert strict.first().utt_id is None


def test_audio_to_train_and_test(spark, tmp_path):
    base = tmp_path / "c"
    for name, count in (("AA", 25), ("BB", 7)):
        (base / name).mkdir(parents=True)
        for i in range(count):
            (base / name / f"{i:03}.wav").write_bytes(wav(1600 * (i + 1)))
            (base / name / f"{i:03}.txt").write_text(f"clip {i}")
    dataset, labelled, final = (str(tmp_path / d) for d in ("dataset", "labelled", "final"))
    assert audio_to_shards(spark, str(base), dataset, ["AA", "BB"], rows_per_shard=10).count() == 0

    sizes = {(r.name, r.shard): r["count"] for r in read_dataset(spark, dataset).groupBy("name", "shard").count().collect()}
    assert sizes == {("AA", 0): 10, ("AA", 1): 10, ("AA", 2): 5, ("BB", 0): 7}
    first = read_dataset(spark, dataset, ["AA"]).filter("shard = 0").select("text").collect()
    assert {r.text for r in first} == {f"clip {i}" for i in range(10)}

    label_splits(spark, dataset, labelled, ["AA", "BB"], fraction=0.2)
    rows = read_dataset(spark, labelled).groupBy("name", "shard", "split").count().collect()
    assert {(r.name, r.shard): r["count"] for r in rows if r.split == "test"} == {
        ("AA", 0): 2, ("AA", 1): 2, ("AA", 2): 1, ("BB", 0): 1,
    }
    with pytest.raises(FileNotFoundError):
        label_splits(spark, dataset, labelled, ["CC"])

    materialise_splits(spark, [labelled], final, max_seconds=2.0)
    out = read_current(spark, final)
    assert out.count() == 20 + 7
    assert {r.split for r in out.select("split").distinct().collect()} == {"train", "test"}
    assert out.filter("duration > 2.0").count() == 0


def test_incremental_ingest(spark, tmp_path):
    base, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    base.mkdir()

    def arrive(name):
        (base / f"{name}.txt").write_text(name)
        (base / f"{name}.wav").write_bytes(wav(16000))

    for name in "abc":
        arrive(name)
    (base / "lone.wav").write_bytes(wav(10))
    ingest_audio(spark, str(base), out, state, files_per_batch=2).awaitTermination()
    assert {r.text for r in spark.read.parquet(f"{out}/utterances").select("text").collect()} == set("abc")
    arrive("d")
    ingest_audio(spark, str(base), out, state).awaitTermination()
    rows = spark.read.parquet(f"{out}/utterances")
    assert sorted(r.text for r in rows.select("text").collect()) == list("abcd")
    assert rows.first().audio.path.startswith(str(base))
    assert [r.reason for r in spark.read.parquet(f"{out}/rejects").collect()] == [NO_TRANSCRIPT]
    # the transcript of a recording that was rejected, and an empty recording
    (base / "lone.txt").write_text("found")
    (base / "none.wav").write_bytes(b"")
    (base / "none.txt").write_text("x")
    ingest_audio(spark, str(base), out, state).awaitTermination()
    assert sorted(r.text for r in spark.read.parquet(f"{out}/utterances").select("text").collect()) == ["a", "b", "c", "d", "found"]
    assert [(r.path.rsplit("/", 1)[1], r.reason) for r in open_rejects(spark, out).collect()] == [("none.wav", BAD_AUDIO)]


def test_hidden_recordings_and_replaced_files(spark, tmp_path):
    base, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    (base / "sub").mkdir(parents=True)
    for name in ("a", "_b", ".c", "sub/_d"):
        (base / f"{name}.wav").write_bytes(wav(16000))
        (base / f"{name}.txt").write_text(name)
    (base / "_lone.wav").write_bytes(wav(10))
    (base / "broken.wav").write_bytes(b"RIFF")
    (base / "broken.txt").write_text("x")
    ingest_audio(spark, str(base), out, state).awaitTermination()

    def stored():
        return sorted(r.text for r in spark.read.parquet(f"{out}/utterances").select("text").collect())

    def left():
        return {r.path.rsplit("/", 1)[1]: r.reason for r in open_rejects(spark, out).collect()}

    assert stored() == [".c", "_b", "a", "sub/_d"]
    assert left() == {"_lone.wav": NO_TRANSCRIPT, "broken.wav": BAD_AUDIO}
    # a sound recording in place of the broken one, another text for a stored one, the missing transcript
    (base / "broken.wav").write_bytes(wav(100))
    (base / "a.txt").write_text("other")
    (base / "_lone.txt").write_text("found")
    ingest_audio(spark, str(base), out, state).awaitTermination()
    assert stored() == [".c", "_b", "a", "found", "sub/_d", "x"]
    assert left() == {}
    # a run without new files, and a folder that never had any
    ingest_audio(spark, str(base), out, state).awaitTermination()
    assert len(stored()) == 6
    (tmp_path / "none").mkdir()
    ingest_audio(spark, str(tmp_path / "none"), str(tmp_path / "o"), str(tmp_path / "s")).awaitTermination()


def test_a_batch_reads_no_earlier_output(spark, tmp_path, monkeypatch):
    from parlato.streaming import ingest

    base, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    base.mkdir()

    def never(*_):
        raise AssertionError("history was read")

    monkeypatch.setattr(ingest, "_not_stored", never)
    for name in "abcd":
        (base / f"{name}.wav").write_bytes(wav(100))
        ingest_audio(spark, str(base), out, state).awaitTermination()
        (base / f"{name}.txt").write_text(name)
    ingest_audio(spark, str(base), out, state, files_per_batch=1).awaitTermination()
    assert sorted(r.text for r in spark.read.parquet(f"{out}/utterances").select("text").collect()) == list("abcd")


def test_state_has_no_more_parts_than_a_batch_needs(spark, tmp_path):
    base, state = tmp_path / "in", tmp_path / "state"
    base.mkdir()
    for name in "ab":
        (base / f"{name}.wav").write_bytes(wav(100))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        ingest_audio(spark, str(base), str(tmp_path / "out"), str(state), files_per_batch=1500).awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    parts = [name for name in os.listdir(state / "state" / "0") if name.isdigit()]
    assert len(parts) == spark.sparkContext.defaultParallelism


def test_a_pair_is_read_in_one_pass(spark, tmp_path, monkeypatch):
    """Heads do not go through a second task's Python; what comes out is bounded batch by batch."""
    seen = []
    monkeypatch.setattr(audio, "staged", lambda df, label: seen.append(df) or df)
    (tmp_path / "a.wav").write_bytes(wav(100))
    (tmp_path / "a.txt").write_text("ciao")
    pairs = spark.createDataFrame([(f"{tmp_path}/a.wav", 244, f"{tmp_path}/a.txt"), (f"{tmp_path}/a.wav", 244, None)], "path string, size long, text_path string")
    assert [r.text for r in audio.check_pairs(pairs, str(tmp_path)).collect()] == ["ciao", None]
    assert seen[0]._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_a_batch_takes_few_jobs_and_few_groups(spark, tmp_path):
    base, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    base.mkdir()
    for i in range(40):
        (base / f"{i:02}.wav").write_bytes(wav(100))
    (base / "40.wav").write_bytes(wav(100))
    (base / "40.txt").write_text("40")

    def run():
        query = ingest_audio(spark, str(base), out, state, files_per_batch=25)
        query.awaitTermination()
        return query.recentProgress, spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId))

    progress, jobs = run()
    # no batch without files, three writes a batch, and the stems that wait share groups
    assert len(progress) == 2 and sum(p.numInputRows for p in progress) == 42
    assert len(jobs) <= 3 * len(progress)
    assert sum(op.numRowsUpdated for p in progress for op in p.stateOperators) <= 4
    assert spark.read.parquet(f"{out}/rejects").count() == 40
    for i in range(0, 40, 2):
        (base / f"{i:02}.txt").write_text(f"{i:02}")
    run()
    assert sorted(r.text for r in spark.read.parquet(f"{out}/utterances").select("text").collect()) == [*(f"{i:02}" for i in range(0, 40, 2)), "40"]
    assert {r.path.rsplit("/", 1)[1] for r in open_rejects(spark, out).collect()} == {f"{i:02}.wav" for i in range(1, 40, 2)}
    log = spark.read.schema("stem string, home string").parquet(f"{out}/arrivals")
    assert log.where("home is null").count() == 0
    assert log.distinct().count() == log.select("stem").distinct().count() == 41


def test_files_that_go_before_their_batch(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.wav").write_bytes(wav(100))
    (tmp_path / "a.txt").write_text("ciao")
    names = [(f"{tmp_path}/{w}.wav", 1, t and f"{tmp_path}/{t}.txt", True) for w, t in (("a", "a"), ("b", "b"), ("gone", "a"), ("b", None))]
    pairs = spark.createDataFrame(names, "path string, size long, text_path string, again boolean")
    rows = audio.check_heads(pairs, str(tmp_path), missing=True).collect()
    assert [(r.path[-5:], r.text, r.reason, r["size"], r.again) for r in rows] == [
        ("a.wav", "ciao", None, 244, True), ("b.wav", None, NO_TRANSCRIPT, 244, True), ("b.wav", None, NO_TRANSCRIPT, 244, True),
    ]


def test_headers_in_python_are_read_as_in_expressions(spark):
    rand, made = random.Random(11), []
    for _ in range(1500):
        kind = rand.choice([b"RIFF", b"RIFF", b"RF64", b"RIFX", b"RIFL"])
        order = "big" if kind == b"RIFX" else "little"

        def number(value, size, order=order):
            return value.to_bytes(size, order)

        content = kind + number(36, 4) + rand.choice([b"WAVE"] * 9 + [b"AVI "])
        for tag in rand.choice([["fmt ", "data"], ["LIST", "fmt ", "data"], ["fmt ", "fact", "data"], ["ds64", "fmt ", "data"], ["LIST"] * 20 + ["fmt ", "data"], ["data", "fmt "]]):
            body = bytes(rand.randrange(9))
            if tag == "fmt ":
                body = number(rand.choice([1, 3, 85, 0xFFFE]), 2) + number(1, 2) + number(rand.choice([0, 100, 100, 44100]), 4) + number(100, 4) + number(rand.choice([0, 1, 3, 4]), 2) + number(8, 2)
            elif tag == "ds64":
                body = number(9, 8) + number(rand.choice([5, 10**6, 2**40]), 8)
            elif tag == "fact":
                body = number(rand.choice([0, 7]), 4)
            size = rand.choice([len(body)] * 40 + [0, 7, 2**31, 2**32 - 1])
            content += tag.encode() + number(size, 4) + body + bytes(len(body) % 2)
        content = content[: rand.choice([len(content)] * 4 + [rand.randrange(len(content))])]
        made.append((content, len(content) + rand.choice([0, 0, 1000, 2**33])))
    rows = spark.createDataFrame(made, "content binary, total long").select("*", wav_info(F.col("content"), F.col("total")).alias("info")).collect()
    assert sum(r.info is not None for r in rows) > 200
    for r in rows:
        assert header_info(bytes(r.content), r.total) == (r.info and tuple(r.info))


class _State:
    def __init__(self):
        self.get, self.exists, self.hasTimedOut, self.due = None, False, False, None

    def update(self, value):
        self.get, self.exists = value, True

    def remove(self):
        self.get, self.exists = None, False

    def setTimeoutDuration(self, ms):
        self.due = ms


def test_patience():
    from parlato.streaming.ingest import matched

    run, state = matched(5000), _State()
    files = pd.DataFrame({"path": ["x.wav"], "size": [3], "again": [False]})
    assert list(run(("x",), iter([files]), state)) == [] and state.due == 5000
    state.hasTimedOut = True
    (late,) = run(("x",), iter([]), state)
    assert late.iloc[0].tolist() == ["x.wav", 3, None, False]
    state.hasTimedOut = False
    (both,) = run(("x",), iter([files.assign(path="x.txt")]), state)
    assert both.iloc[0].tolist() == ["x.wav", 3, "x.txt", False] and not state.exists


def test_patience_of_stems_that_share_a_home():
    from parlato.streaming.ingest import matched

    state, now = _State(), [1000]
    run = matched(5000, lambda _: now[0])

    def arrive(*names):
        files = pd.DataFrame({"path": [*names], "size": [3] * len(names), "again": [False] * len(names)})
        return [tuple(r) for made in run(("home",), iter([files] if names else []), state) for r in made.itertuples(index=False)]

    assert arrive("in/a.wav", "in/b.wav", "in/b.txt", "in/c.txt") == [("in/b.wav", 3, "in/b.txt", False)]
    assert state.due == 5000
    now[0] = 4000
    # what comes to one stem leaves the time of the others as it is
    assert arrive("in/d.wav", "in/.wav") == [] and state.due == 2000
    now[0], state.hasTimedOut = 6001, True
    assert arrive() == [("in/a.wav", 3, None, False)] and state.due == 2999
    state.hasTimedOut = False
    assert arrive("in/c.wav", "in/a.txt") == [("in/c.wav", 3, "in/c.txt", False), ("in/a.wav", 3, "in/a.txt", False)]
    # stems that are due while files of others come
    now[0] = 9001
    assert arrive("in/e.txt") == [("in/d.wav", 3, None, False), ("in/.wav", 3, None, False)]
    assert arrive("in/d.wav", "in/d.txt", "in/e.wav") == [("in/d.wav", 3, "in/d.txt", False), ("in/e.wav", 3, "in/e.txt", False)]
    assert [w[0] for w in state.get[0]] == ["in/.wav"]

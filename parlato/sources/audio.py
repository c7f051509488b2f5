"""Audio corpora on disk: find recordings, pair them with transcripts, build utterances."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlato.functions.text import parent_name, path_stem, split_from_path, strip_ws
from parlato.functions.wav import header_info, seconds, wav_info
from parlato.schema import UTTERANCE, conform, with_fillers
from parlato.session import staged
from parlato.sources.listing import BATCH_BYTES, Files, Place, list_files, read_files, with_suffix

NO_TRANSCRIPT = "transcript not found"
BAD_TRANSCRIPT = "transcript is not UTF-8"
BAD_AUDIO = "audio header not readable"

# A header is looked for in this many bytes; recordings whose samples start later are read whole.
HEADER_BYTES = 64 << 10

CHECKED = T.StructType(
    [
        T.StructField("path", T.StringType()),
        *[UTTERANCE[name] for name in ("text", "duration", "split", "OG_corpus")],
        T.StructField("reason", T.StringType()),
    ]
)


def pair(audio: DataFrame, texts: DataFrame, split_match: str = "anywhere") -> DataFrame:
    """One row per recording: its utterance columns and ``reason``, null if it is sound.

    Both inputs hold ``path, content``. A transcript has the recording's path with
    the last suffix changed to ``.txt``; one without a recording is ignored. The
    header is read before the join, and audio bytes cross the network once.
    """
    sidecar = texts.select(
        path_stem(F.col("path")).alias("stem"),
        F.col("content").cast("string").alias("transcript"),
    )
    heads = audio.select(
        path_stem(F.col("path")).alias("stem"),
        "path",
        "content",
        seconds(wav_info(F.col("content"))).alias("duration"),
    )
    joined = heads.join(sidecar, "stem", "left")
    return joined.select(
        F.struct(F.col("content").alias("bytes"), F.col("path").alias("path")).alias("audio"), *_described(split_match)
    )


def _described(split_match: str) -> list[Column]:
    """Utterance columns and ``reason`` out of ``path, transcript, duration``."""
    valid = F.is_valid_utf8("transcript")
    # text files are read with every line ending turned into a line feed
    text = strip_ws(F.regexp_replace("transcript", r"\r\n?", "\n"))
    return [
        F.when(valid, text).alias("text"),
        F.col("duration"),
        split_from_path(F.col("path"), split_match).alias("split"),
        parent_name(F.col("path")).alias("OG_corpus"),
        F.when(F.col("transcript").isNull(), NO_TRANSCRIPT)
        .when(~valid, BAD_TRANSCRIPT)
        .when(F.col("duration").isNull(), BAD_AUDIO)
        .alias("reason"),
    ]


def check_pairs(pairs: DataFrame, corpus_dir: str, split_match: str = "anywhere") -> DataFrame:
    """:data:`CHECKED` rows of recordings ``path, size, text_path``, without their audio, stored.

    The task that checks a pair reads its transcript and the head of its recording.
    """
    done = staged(check_heads(pairs.select("path", "size", "text_path"), corpus_dir, split_match), "checked")
    if not done.where("late is not null").isEmpty():
        done = check_whole(done, corpus_dir, split_match)
    return done.select(*CHECKED.names)


def check_heads(pairs: DataFrame, corpus_dir: str, split_match: str = "anywhere", missing: bool = False) -> DataFrame:
    """:data:`CHECKED` columns from the heads of recordings ``path, size, text_path``, with what else ``pairs`` has.

    ``late`` has the path where the samples start later, for :func:`check_whole`, and ``transcript`` the text of these. With
    ``missing``, files may have gone: such recordings are left out, and ``size`` is taken anew. Heads stay in the task that
    reads them.
    """
    place = Place(pairs.sparkSession, corpus_dir)
    more = [c for c in pairs.columns if c not in ("path", "size", "text_path")]
    pairs = pairs.select("path", "size", "text_path", *more)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(place)
        for batch in batches:
            paths, sizes, texts = (batch.column(k).to_pylist() for k in range(3))
            if missing:
                sizes, there = files.sizes(paths), files.sizes(texts)
                texts = [None if size is None else text for text, size in zip(texts, there, strict=True)]
                kept = [k for k, size in enumerate(sizes) if size is not None]
                batch = batch.take(pa.array(kept, pa.int64()))
                paths, sizes, texts = ([column[k] for k in kept] for column in (paths, sizes, texts))
                batch = batch.set_column(1, batch.schema.field(1), pa.array(sizes, pa.int64()))
            start, held, size = 0, [], 0
            for k, (path, total, text) in enumerate(zip(paths, sizes, texts, strict=True)):
                head, raw = files.content(path, HEADER_BYTES), files.content(text)
                info = None if head is None else header_info(head, total)
                late = head is not None and not info and total > HEADER_BYTES and head[:4] in (b"RIFF", b"RF64")
                held.append((info and info[0] / info[1], path if late else None, raw))
                size += len(raw or b"")
                if size >= BATCH_BYTES or k == batch.num_rows - 1:
                    made = [pa.array(c, kind) for c, kind in zip(zip(*held, strict=True), (pa.float64(), pa.string(), pa.binary()), strict=True)]
                    yield pa.RecordBatch.from_arrays([*batch.slice(start, len(held)).columns, *made], [*batch.schema.names, "duration", "late", "raw"])
                    start, held, size = k + 1, [], 0

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema)
    heads = pairs.mapInArrow(look, f"{kinds}, duration double, late string, raw binary")
    heads = heads.withColumn("transcript", F.col("raw").cast("string"))
    kept = F.when(F.col("late").isNotNull(), F.col("transcript")).alias("transcript")
    return heads.select("path", *_described(split_match), "late", kept, "size", *more)


def check_whole(done: DataFrame, corpus_dir: str, split_match: str = "anywhere") -> DataFrame:
    """The stored rows of :func:`check_heads` with those checked that are ``late``, by their whole recordings, stored."""
    more = [c for c in done.columns if c not in (*CHECKED.names, "late", "transcript")]
    whole = read_files(done.where("late is not null").drop("duration"), corpus_dir, "whole", "late")
    whole = whole.withColumn("duration", seconds(wav_info(F.col("whole"))))
    again = whole.select("path", *_described(split_match), *more)
    return staged(done.where("late is null").select(*CHECKED.names, *more).unionByName(again), "checked")


def checked_files(spark: SparkSession, corpus_dir: str, names: Sequence[str], split_match: str = "anywhere") -> DataFrame:
    """:func:`check_pairs` of every recording below ``corpus_dir/name``.

    Folders are listed in tasks, and recordings and transcripts meet as paths.
    Recordings named ``*.wav``, letter case included, count whatever their size
    and first character.
    """
    files = list_files(spark, corpus_dir, names)
    stem = path_stem(F.col("path")).alias("stem")
    texts = with_suffix(files, ".txt").select(stem, F.col("path").alias("text_path"))
    pairs = with_suffix(files, ".wav").select(stem, "path", "size").join(texts, "stem", "left")
    return check_pairs(pairs, corpus_dir, split_match)


def with_audio(rows: DataFrame, corpus_dir: str) -> DataFrame:
    """``rows`` with ``audio`` in place of ``path``: each recording is read once, in the task that has its row."""
    read = read_files(rows, corpus_dir)
    audio = F.struct(F.col("content").alias("bytes"), "path").alias("audio")
    return read.select(audio, *[c for c in rows.columns if c != "path"])


def accepted(paired: DataFrame, strict: bool = False) -> DataFrame:
    """The sound recordings in the utterance schema."""
    return conform(with_fillers(paired.filter(F.col("reason").isNull()), strict))


def rejects(paired: DataFrame) -> DataFrame:
    """``path, reason`` of the recordings that were skipped."""
    return paired.filter(F.col("reason").isNotNull()).select(F.col("audio.path").alias("path"), "reason")


def build_utterances(
    spark: SparkSession, corpus_dir: str, names: Sequence[str], split_match: str = "anywhere", strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Utterances and rejects of the named datasets below ``corpus_dir``."""
    checked = checked_files(spark, corpus_dir, names, split_match)
    sound = with_audio(checked.where("reason is null").drop("reason"), corpus_dir)
    return conform(with_fillers(sound, strict)), checked.where("reason is not null").select("path", "reason")

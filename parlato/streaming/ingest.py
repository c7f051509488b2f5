"""Incremental ingest: new recordings become utterances, new rows become prepared rows."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from parlato.functions.text import path_stem
from parlato.schema import UTTERANCE, conform, with_fillers
from parlato.session import staged
from parlato.sources.audio import CHECKED, check_heads, check_whole, with_audio
from parlato.sources.listing import list_files, with_suffix

PARTITIONS = "spark.sql.shuffle.partitions"
# Files of a batch that one part of the state takes.
FILES_PER_PART = 500
# Files that share a home: each group of the state costs Python some milliseconds, whatever it holds.
FILES_PER_HOME = 50
# Rejects of a batch that one file takes, and bytes of recordings.
REJECTS_PER_FILE = 100_000
BYTES_PER_FILE = 32 << 20

LOG = "path string, size long, modified long, stem string, again boolean, home string"
PAIRED = "path string, size long, text_path string, again boolean"
# What state keeps of the stems of a home until both their files are there: whether the recording has been reported, or when it is to be.
WAITING = "waiting array<struct<stem:string,path:string,size:long,text_path:string,reported:boolean,due:long>>"
# the suffix that path_stem takes off
_SUFFIX = re.compile(r"(?<=[^/])\.[^./]+\Z")


def note_arrivals(spark: SparkSession, corpus_dir: str, log: str, files_per_batch: int) -> int:
    """Append the recordings and transcripts that ``log`` does not have yet to it; gives their number.

    The folder is listed in tasks, hidden and empty files included. A file that has been
    replaced since counts as new, and its partner comes with it. Some dozens of stems that come first in the same run share a
    home, which all their later files have too. Files of one home lie in one file of the log, each of
    which holds about ``files_per_batch``.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(log)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    found = list_files(spark, corpus_dir, [""])
    stem = path_stem(F.col("path")).alias("stem")
    found = staged(with_suffix(found, ".wav").unionByName(with_suffix(found, ".txt")).select("*", stem), "found")
    known = spark.read.schema(LOG).parquet(log)
    new = found.join(known, ["path", "modified"], "left_anti")
    replaced = new.join(known, "path", "left_semi").select("stem").distinct().withColumn("again", F.lit(True))
    again = F.coalesce("again", F.lit(False)).alias("again")
    once = new.join(replaced, "stem", "left").where("again is null")
    both = found.join(replaced, "stem")
    rows = once.unionByName(both).select("path", "size", "modified", "stem", again)
    rows = rows.join(known.select("stem", "home").dropDuplicates(["stem"]), "stem", "left")
    rows = staged(rows, "arrivals")
    count = rows.count()
    if count:
        files, homes = -(-count // files_per_batch), -(-count // min(FILES_PER_HOME, files_per_batch))
        place = F.pmod(F.xxhash64(F.coalesce("home", "stem")), F.lit(homes))
        rows = rows.withColumn("place", place).withColumn("home", F.coalesce("home", F.concat(F.lit(f"{uuid.uuid4().hex}-"), "place")))
        # neighbouring homes share a file of the log, and each file has as many
        rows = rows.repartitionById(files, F.floor(F.col("place") * files / homes).cast("int")).select(*known.columns)
        rows.write.mode("append").parquet(log)
    else:
        # a batch without files, which takes up what has waited long enough
        spark.createDataFrame([], LOG).write.mode("append").parquet(log)
    return count


def _wall_clock(_: GroupState) -> int:
    return int(time.time() * 1000)


def matched(patience_ms: int, clock: Callable[[GroupState], int] = _wall_clock) -> Callable:
    """The state function of a home.

    Gives the recording and transcript of a stem, once both have come; the recording
    alone if the transcript stays away. ``clock`` tells the milliseconds.
    """

    def run(key: tuple[str], arrived: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting = {stem: tuple(rest) for stem, *rest in state.get[0]} if state.exists else {}
        came: dict[str, list] = {}
        for rows in arrived:
            for name, length, more in zip(rows["path"], rows["size"], rows["again"], strict=True):
                came.setdefault(_SUFFIX.sub("", name), []).append((name, int(length), bool(more)))
        now = clock(state) if patience_ms else 0
        ready = []
        if patience_ms:
            dues = [due for *_, due in waiting.values() if due is not None]
            # a state that has timed out has a stem that is due
            moment = max([now, *([min(dues) + 1] if dues and state.hasTimedOut else [])])
            for stem, (path, size, text, _, due) in waiting.items():
                if due is not None and due < moment and stem not in came:
                    ready.append((path, size, text, False))
                    waiting[stem] = (path, size, text, True, None)
        for stem, files in came.items():
            path, size, text, reported, _ = waiting.pop(stem, (None, None, None, False, None))
            for name, length, _ in files:
                if name.endswith(".wav"):
                    path, size, reported = name, length, False
                else:
                    text = name
            again = any(more for *_, more in files)
            late = path is not None and not reported
            if path is not None and text is not None:
                ready.append((path, size, text, again))
            elif late and not patience_ms:
                ready.append((path, size, text, again))
                waiting[stem] = (path, size, text, True, None)
            else:
                waiting[stem] = (path, size, text, reported, now + patience_ms if late else None)
        if waiting:
            state.update(([(stem, *rest) for stem, rest in waiting.items()],))
            dues = [due for *_, due in waiting.values() if due is not None]
            if dues:
                state.setTimeoutDuration(max(1, min(dues) - now))
        else:
            state.remove()
        if ready:
            yield pd.DataFrame(ready, columns=["path", "size", "text_path", "again"])

    return run


def ingest_audio(
    spark: SparkSession,
    corpus_dir: str,
    output: str,
    checkpoint: str,
    split_match: str = "anywhere",
    files_per_batch: int = 100_000,
    patience_ms: int = 0,
) -> StreamingQuery:
    """Turn the recordings that have arrived below ``corpus_dir`` into rows of ``output/utterances``.

    Lists the folder once, then runs until all new files are done and stops; started again, it takes up new
    files only. Recordings and transcripts arrive in any order, hidden and empty files
    included. New files are noted in ``output/arrivals``, which is what is streamed: paths
    only. The first of a recording and its transcript waits in state with the
    stems of its home, a few dozen at most, so a batch costs what arrives in it, however long the stream has run. A
    recording that waits longer than ``patience_ms`` is rejected, and taken up when its
    transcript comes. Each batch writes its own folder, and replaces it when it is
    replayed after a failure. Skipped recordings go to ``output/rejects``;
    :func:`open_rejects` leaves out those taken up since. A file that is replaced makes its recording be looked at
    again, and be stored unless it was.
    """
    log = f"{output}/arrivals"
    note_arrivals(spark, corpus_dir, log, files_per_batch)
    arriving = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(log)
    timeout = GroupStateTimeout.ProcessingTimeTimeout if patience_ms else GroupStateTimeout.NoTimeout
    meet = matched(patience_ms, GroupState.getCurrentProcessingTimeMs)
    paired = arriving.select("home", "path", "size", "again").groupBy("home").applyInPandasWithState(meet, PAIRED, WAITING, "append", timeout)
    # part of the stream, so that its expressions are made once and not for each batch
    looked = check_heads(paired, corpus_dir, split_match, missing=True)

    def store(found: DataFrame, batch_id: int) -> None:
        seen = Observation()
        counts = [F.count(F.when(F.col("again"), 1)).alias("again"), F.count("late").alias("late"), F.sum("size").alias("size")]
        # state moves on each time that this is evaluated
        checked = staged(found.observe(seen, *counts), "checked")
        if seen.get["again"]:
            earlier = _not_stored(checked.where("again"), f"{output}/utterances", batch_id)
            checked = staged(checked.where("not again").unionByName(earlier), "checked")
        if seen.get["late"]:
            checked = check_whole(checked, corpus_dir, split_match)
        sound = checked.where("reason is null").select(*CHECKED.names).drop("reason")
        sound = with_audio(sound.coalesce(1 + (seen.get["size"] or 0) // BYTES_PER_FILE), corpus_dir)
        skipped = checked.where("reason is not null").select("path", "reason").coalesce(-(-files_per_batch // REJECTS_PER_FILE))
        # side by side: most of the time of a small batch goes by between tasks
        with ThreadPoolExecutor(1) as beside:
            rejected = beside.submit(inheritable_thread_target(spark)(write), skipped, f"{output}/rejects/batch={batch_id}")
            write(conform(with_fillers(sound)), f"{output}/utterances/batch={batch_id}")
            rejected.result()

    def write(rows: DataFrame, folder: str) -> None:
        rows.write.mode("overwrite").parquet(folder)

    writer = looked.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    # the stream takes the session's settings when it starts; a checkpoint that exists keeps the number it began with
    before = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, state_parts(spark, files_per_batch))
    try:
        return writer.start()
    finally:
        spark.conf.set(PARTITIONS, before)


def state_parts(spark: SparkSession, files_per_batch: int) -> int:
    """Parts of the state: each batch loads and stores all of them, so there are no more than its files and the cluster's cores need."""
    needed = max(spark.sparkContext.defaultParallelism, -(-files_per_batch // FILES_PER_PART))
    return min(int(spark.conf.get(PARTITIONS)), needed)


def _not_stored(pairs: DataFrame, utterances: str, batch_id: int) -> DataFrame:
    """Recordings that no earlier batch has stored; the batch's own folder is of a run that failed."""
    if batch_id == 0:
        return pairs
    stored = pairs.sparkSession.read.schema(T.StructType([*UTTERANCE.fields, T.StructField("batch", T.LongType())])).parquet(utterances)
    earlier = stored.where(F.col("batch") < batch_id).select(F.col("audio.path").alias("path"))
    return pairs.join(earlier, "path", "left_anti")


def open_rejects(spark: SparkSession, output: str) -> DataFrame:
    """``path, reason`` of the recordings that no batch has taken up: the reason of the last batch that saw them."""
    seen = spark.read.schema("path string, reason string, batch long").parquet(f"{output}/rejects")
    last = seen.groupBy("path").agg(F.max_by("reason", "batch").alias("reason"))
    taken = spark.read.schema(UTTERANCE).parquet(f"{output}/utterances").select(F.col("audio.path").alias("path"))
    return last.join(taken, "path", "left_anti")


def stream_table(
    spark: SparkSession, source: str, schema: T.StructType, glob: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    """Parquet files of a folder as a stream, in the order in which they arrive."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )


def append_stream(rows: DataFrame, output: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append a stateless stream to ``output``, each input row exactly once, and stop when it is used up."""
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(output)

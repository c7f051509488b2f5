"""Building a dataset: audio or tables to shards, test labels, train and test tables.

Shards lie at ``name=<dataset name>/shard=<number>/`` below the folders of the dataset's
versions, see :mod:`parlato.sources.versions`; a plain folder of that layout can be read too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlato.operators.filters import MAX_SECONDS, at_most, known_splits, relabel_corpus
from parlato.operators.numbering import number_by_file, number_by_key, shard_of
from parlato.operators.sampling import SEED, TEST_FRACTION, assign_split
from parlato.operators.union import union_shards
from parlato.schema import UTTERANCE, conform, require_columns, with_fillers
from parlato.sources.audio import checked_files, with_audio
from parlato.sources.shards import ROWS_PER_AUDIO_SHARD, ROWS_PER_TABLE_SHARD, write_splits
from parlato.sources.versions import current_parts, publish, read_current

# The datasets built by default, and the one that comes as a table.
DATASETS = (
    "APASCI",
    "FLEURS",
    "LABLITA",
    "LIBRISPEECH",
    "SPEECON",
    "VOXFORGE",
    "VOXPOPULI",
    "CLIPS_LETTO",
)
TABLE_DATASET = "YODAS"

STORED = T.StructType(
    [*UTTERANCE.fields, T.StructField("name", T.StringType()), T.StructField("shard", T.LongType())]
)


def audio_to_shards(
    spark: SparkSession,
    corpus_dir: str,
    dataset_dir: str,
    names: Sequence[str] = DATASETS,
    rows_per_shard: int = ROWS_PER_AUDIO_SHARD,
    split_match: str = "anywhere",
) -> DataFrame:
    """Write all named corpora as shards of exactly ``rows_per_shard`` rows, the last of each maybe short.

    Rows are numbered in path order and go to their shard's task as paths; that
    task reads each recording, once, and writes it. Returns the rejects.
    """
    checked = checked_files(spark, corpus_dir, names, split_match)
    below = F.substring("path", F.lit(len(corpus_dir.rstrip("/")) + 2), F.length("path"))
    rows = with_fillers(checked.filter(F.col("reason").isNull())).withColumn("name", F.split_part(below, F.lit("/"), F.lit(1)))
    numbered = number_by_key(rows.drop("reason"), ["name", "path"], "n")
    # one row per dataset name, as many as the caller listed
    starts = F.broadcast(numbered.groupBy("name").agg(F.min("n").alias("start")))
    placed = numbered.join(starts, "name").withColumn("shard", shard_of(F.col("n") - F.col("start"), rows_per_shard))
    dealt = placed.drop("start").repartition("name", "shard").sortWithinPartitions("name", "shard", "n").drop("n")
    rows = with_audio(dealt, corpus_dir).select(*UTTERANCE.names, "name", "shard")
    _publish(rows, dataset_dir, names)
    return checked.filter(F.col("reason").isNotNull()).select("path", "reason")


def table_to_shards(
    spark: SparkSession,
    file_path: str,
    dataset_dir: str,
    name: str = TABLE_DATASET,
    rows_per_shard: int = ROWS_PER_TABLE_SHARD,
) -> None:
    """Cut a Parquet table into contiguous shards in stored order; no row is moved.

    Replaces all earlier shards of ``name``, whatever their number.
    """
    numbered = number_by_file(spark.read.parquet(file_path), "n")
    sharded = numbered.withColumn("shard", shard_of(F.col("n"), rows_per_shard)).drop("n")
    _publish(sharded.withColumn("name", F.lit(name)), dataset_dir, [name])


def _publish(rows: DataFrame, dataset_dir: str, names: Sequence[str]) -> None:
    """A version in which the shards of ``names`` are those of ``rows``, whatever there was of them; other names stay."""
    publish(
        rows.sparkSession,
        dataset_dir,
        lambda folder: rows.write.partitionBy("name", "shard").parquet(folder),
        whole=False,
        expected=tuple(f"name={name}" for name in names),
    )


def read_dataset(
    spark: SparkSession, dataset_dir: str, names: Sequence[str] | None = None, schema: T.StructType = STORED, **place: str
) -> DataFrame:
    """The current shards of ``names``, or all, with the utterance schema plus ``name, shard``.

    ``FileNotFoundError`` if one of ``names`` has no shard. ``file`` and ``row`` are those of
    :func:`parlato.sources.versions.read_current`.
    """
    df = read_current(spark, dataset_dir, schema, None if names is None else [f"name={name}" for name in names], **place)
    if names is None:
        return df
    files = df.inputFiles()
    for name in names:
        if not any(f"/name={name}/" in file for file in files):
            raise FileNotFoundError(f"no shards of {name} in {dataset_dir}")
    return df.filter(F.col("name").isin(*names))


def label_splits(
    spark: SparkSession,
    dataset_dir: str,
    target: str,
    names: Sequence[str],
    key: str = "audio.path",
    fraction: float = TEST_FRACTION,
    seed: int = SEED,
    tag: str = "YODAS",
    corpus: str = "yodas_granary",
) -> None:
    """New versions of the shards of ``names`` with test labels, under ``target``, which may be ``dataset_dir``.

    Shards whose path holds ``tag`` get ``corpus`` as their corpus name. Rows
    without a key, or with one that repeats, are told apart by their place in the
    stored shards, so that every shard has its exact number of test rows.
    """
    if target.rstrip("/") == dataset_dir.rstrip("/") and current_parts(spark, dataset_dir) is None:
        raise ValueError("plain shards cannot be rewritten onto themselves; give a new path")
    stored = read_dataset(spark, dataset_dir, names, file="__file", row="__row")
    rows = relabel_corpus(stored, F.col("__file"), tag, corpus)
    labelled = assign_split(rows, key, ["name", "shard"], fraction, seed, tie=F.concat_ws(":", "__file", "__row"))
    _publish(labelled.drop("__file", "__row"), target, names)


def materialise_splits(
    spark: SparkSession, dataset_dirs: Sequence[str], target: str, split_col: str = "split", max_seconds: float = MAX_SECONDS
) -> None:
    """One train and one test table of all shards in ``dataset_dirs``, long recordings left out.

    ``ValueError`` if a stored dataset lacks ``duration`` or ``split_col``, which
    would read as null and leave no row.
    """
    for folder in dataset_dirs:
        require_columns(read_current(spark, folder), ["duration", split_col])
    schema = STORED if split_col in STORED.names else T.StructType([*STORED.fields, T.StructField(split_col, T.StringType())])
    parts = [read_dataset(spark, folder, schema=schema).drop("name", "shard") for folder in dataset_dirs]
    rows = known_splits(at_most(union_shards(parts), max_seconds), split_col)
    write_splits(rows, target, split_col)


def as_utterances(df: DataFrame, strict: bool = False) -> DataFrame:
    """A table with some of the utterance columns, brought to the full schema."""
    return conform(with_fillers(df, strict))

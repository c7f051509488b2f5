"""Reference transcripts for named recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlato.functions.text import swap_suffix, without_suffix
from parlato.schema import require_columns


class MissingReference(ValueError):
    """A named recording has no reference transcript."""


class DuplicateReference(ValueError):
    """A path has several reference transcripts and no order to choose by."""


def last_reference(refs: DataFrame, order: str | None = None, on_duplicate: str = "error") -> DataFrame:
    """``path, sentence`` with one row per path: the one with the highest ``order``.

    Without ``order`` there is no last row, so repeated paths raise;
    ``on_duplicate="ignore"`` skips that check for input known to be unique.
    """
    require_columns(refs, ["path", "sentence"])
    if order is not None:
        last = F.max_by(F.struct("sentence"), F.col(order))["sentence"]
        return refs.groupBy("path").agg(last.alias("sentence"))
    if on_duplicate == "error":
        repeated = refs.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1").limit(3).collect()
        if repeated:
            raise DuplicateReference(f"several sentences for {[row.path for row in repeated]}; pass order")
    return refs.select("path", "sentence")


def keep_present(names: DataFrame, files: DataFrame, name: str = "name") -> DataFrame:
    """Names that have a row in ``files``; repeated names stay repeated."""
    return names.join(files.select(name), name, "left_semi")


def absent(names: DataFrame, files: DataFrame, name: str = "name") -> DataFrame:
    """Names without a row in ``files``."""
    return names.join(files.select(name), name, "left_anti")


def with_references(
    names: DataFrame,
    refs: DataFrame,
    name: str = "name",
    audio_suffix: str = ".wav",
    ref_suffix: str = ".mp3",
    on_missing: str = "error",
) -> DataFrame:
    """Names with their ``sentence`` and ``utt_id``, the key being the name with its suffix changed.

    ``refs`` has one row per path. A name without a reference raises, or goes with
    ``on_missing="drop"``.
    """
    keyed = names.withColumn("path", swap_suffix(F.col(name), audio_suffix, ref_suffix))
    if on_missing == "error":
        lost = keyed.join(refs, "path", "left_anti").select("path").limit(3).collect()
        if lost:
            raise MissingReference(f"no reference for {[row.path for row in lost]}")
    elif on_missing != "drop":
        raise ValueError(f"on_missing must be 'error' or 'drop', not {on_missing!r}")
    return keyed.join(refs, "path").withColumn("utt_id", without_suffix(F.col(name), audio_suffix))

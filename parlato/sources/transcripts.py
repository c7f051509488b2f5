"""Name lists out of scripts, transcript files for scoring tools."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlato.functions.text import WS, transcript_line
from parlato.operators.numbering import number_by_block
from parlato.session import staged
from parlato.sources.tables import stored_order

# The program and folder by which a script line names the recording that it transcribes.
SCRIPT_PROGRAM, SCRIPT_FOLDER = "doasr_home.py", "/home/docker/"
SCRIPT_CALL = rf"{re.escape(SCRIPT_PROGRAM)}[{WS}]+{SCRIPT_FOLDER}([A-Za-z0-9_\-]+\.wav)"

# Characters of a text that ranges of lines are cut by, where they have one key.
CUT_CHARS = 16


def names_in_lines(lines: DataFrame, line: str = "value", pattern: str = SCRIPT_CALL) -> DataFrame:
    """``name``: the first match of each line. Other lines go, repeated names stay."""
    name = F.regexp_extract(F.col(line), pattern, 1)
    return lines.select(name.alias("name")).filter(F.col("name") != "")


def read_script_names(spark: SparkSession, path: str, pattern: str = SCRIPT_CALL) -> DataFrame:
    return names_in_lines(spark.read.text(path), pattern=pattern)


def transcript_lines(df: DataFrame, text: str, utt_id: str = "utt_id") -> DataFrame:
    return df.select(transcript_line(F.col(text), F.col(utt_id)).alias("value"))


def in_line_order(stored: DataFrame, utt_id: str, hyp: str, ref: str) -> DataFrame:
    """``stored`` in the order of ``utt_id, hyp, ref``.

    Ranges are cut by the key and the first characters of ``hyp``: the driver gets a
    sample of what cuts them, and whole texts would be most of it. Rows with equal cuts share a range.
    """
    return stored.repartitionByRange(utt_id, F.substring(hyp, 1, CUT_CHARS)).sortWithinPartitions(utt_id, hyp, ref)


def write_transcripts(df: DataFrame, path: str, hyp: str = "hyp", ref: str = "ref", utt_id: str = "utt_id") -> None:
    """``path/hyp`` and ``path/ref``: text folders whose lines belong together one by one.

    ``df`` is computed once and stored; each side sorts what is stored.
    """
    stored = staged(df.select(utt_id, hyp, ref), "transcripts")
    for side, column in (("hyp", hyp), ("ref", ref)):
        in_order = in_line_order(stored, utt_id, hyp, ref)
        transcript_lines(in_order, column, utt_id).write.mode("overwrite").text(f"{path.rstrip('/')}/{side}")


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """``side, place, line`` of both folders of :func:`write_transcripts`, places from 0 in the order of the lines."""
    sides = []
    for side in ("hyp", "ref"):
        lines = spark.read.text(f"{path.rstrip('/')}/{side}").select(F.col("value").alias("line"), stored_order().alias("at"))
        numbered = number_by_block(staged(lines, "lines"), "at", "place")
        sides.append(numbered.select(F.lit(side).alias("side"), "place", "line"))
    return sides[0].unionByName(sides[1])

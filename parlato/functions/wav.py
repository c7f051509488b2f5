"""Sample counts and rates out of WAV file bytes, by built-in expressions.

A plan that reads headers also carries whole recordings, so no row of it should
pass through a Python worker.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from parlato.functions.text import _bind

# Sample formats whose frames all have the same number of bytes
# (integer PCM, float, A-law, mu-law, and the extensible wrapper around them).
FIXED_SIZE_FORMATS = (0x0001, 0x0003, 0x0006, 0x0007, 0xFFFE)

# Other formats state their frames in a chunk of their own.

# Nearly every file has its samples within this many chunks. The rest are walked
# again, with a step for each chunk that the file could hold.
_USUAL_CHUNKS = 16
# No writer makes more chunks than this before the samples.
MOST_CHUNKS = 100_000

_STATE = "struct<at:bigint,rate:bigint,block:bigint,wide:bigint,held:bigint,frames:bigint,done:boolean>"


def _bytes_at(content: Column, offset: Column, size: int) -> Column:
    return F.hex(F.substring(content, (offset + 1).cast("int"), F.lit(size)))


def _number_at(content: Column, offset: Column, size: int, big_endian: Column) -> Column:
    """Unsigned integer at a byte offset."""
    digits = _bytes_at(content, offset, size)
    backwards = F.regexp_replace(F.reverse(digits), "(.)(.)", "$2$1")
    return F.conv(F.when(big_endian, digits).otherwise(backwards), 16, 10).cast("long")


def _tag(name: str) -> Column:
    return F.lit(name.encode().hex().upper())


def _state(at, rate, block, wide, held, frames, done) -> Column:
    fields = {"at": at, "rate": rate, "block": block, "wide": wide, "held": held, "frames": frames, "done": done}
    return F.struct(*[column.alias(name) for name, column in fields.items()]).cast(_STATE)


def _step(content: Column, total: Column, big_endian: Column, seen: Column) -> Column:
    """Read the chunk at ``seen.at`` and move past it; ``done`` once the samples are found."""
    at = seen["at"]
    body = at + 8

    def number(offset: Column, n_bytes: int) -> Column:
        return _number_at(content, offset, n_bytes, big_endian)

    def read(tag: Column) -> Column:
        size = number(at + 4, 4)
        is_format, is_data, is_wide = tag == _tag("fmt "), tag == _tag("data"), tag == _tag("ds64")
        fixed = number(body, 2).isin(*FIXED_SIZE_FORMATS)
        # a 64-bit file keeps the true size of its samples in an earlier chunk
        stored = F.when(size == 0xFFFFFFFF, F.coalesce(seen["wide"], size)).otherwise(size)
        # a header that promises more than the file holds counts what is there
        held = F.least(stored, total - body)
        return _state(
            body + size + F.pmod(size, F.lit(2)),
            F.when(is_format, number(body + 4, 4)).otherwise(seen["rate"]),
            F.when(is_format, F.when(fixed, number(body + 12, 2))).otherwise(seen["block"]),
            F.when(is_wide, number(body + 8, 8)).otherwise(seen["wide"]),
            F.when(is_data, held).otherwise(seen["held"]),
            F.when(tag == _tag("fact"), number(body, 4)).otherwise(seen["frames"]),
            is_data,
        )

    past_end = _state(at, seen["rate"], seen["block"], seen["wide"], seen["held"], seen["frames"], F.lit(True))
    return (
        F.when(seen["done"], seen)
        .when(body > F.length(content), past_end)
        .otherwise(_bind(_bytes_at(content, at, 4), read))
    )


def _walk(content: Column, total: Column, big_endian: Column, steps: Column) -> Column:
    nothing = F.lit(None)
    start = _state(F.lit(12), nothing, nothing, nothing, nothing, nothing, F.lit(False))
    return F.aggregate(F.sequence(F.lit(1), steps), start, lambda seen, _: _step(content, total, big_endian, seen))


def _info(content: Column, total: Column) -> Column:
    kind = _bytes_at(content, F.lit(0), 4)
    is_wave = kind.isin("RIFF".encode().hex().upper(), "RF64".encode().hex().upper(), "RIFX".encode().hex().upper()) & (
        _bytes_at(content, F.lit(8), 4) == _tag("WAVE")
    )
    # the first tag tells the order of bytes in all numbers
    big_endian = kind == _tag("RIFX")

    def info(seen: Column) -> Column:
        frames = F.coalesce(F.floor(seen["held"] / F.nullif(seen["block"], F.lit(0))), seen["frames"])
        usable = (seen["rate"] > 0) & seen["held"].isNotNull() & frames.isNotNull()
        return F.when(usable, F.struct(frames.cast("long").alias("frames"), seen["rate"].alias("samplerate")))

    all_chunks = F.least(F.floor(F.length(content) / 8), F.lit(MOST_CHUNKS)).cast("int") + 1
    usual = _walk(content, total, big_endian, F.lit(_USUAL_CHUNKS))
    found = _bind(usual, lambda seen: F.when(seen["done"], seen).otherwise(_walk(content, total, big_endian, all_chunks)))
    return F.when(is_wave, _bind(found, info))


def wav_info(content: Column, total: Column | None = None) -> Column:
    """Struct of ``frames`` and ``samplerate``, null where the bytes are not a readable WAV.

    ``content`` may be the beginning of a file of ``total`` bytes. A compressed
    format counts the frames that its ``fact`` chunk states.
    """
    # bound once: every look at a column would copy the whole recording out of its row
    return _bind(content, lambda c: _info(c, F.length(c) if total is None else total))


def seconds(info: Column) -> Column:
    """Duration of :func:`wav_info`'s result."""
    return _bind(info, lambda i: i["frames"] / i["samplerate"])


def header_info(content: bytes, total: int) -> tuple[int, int] | None:
    """:func:`wav_info` of one file's first bytes, for tasks that read files themselves."""
    kind = content[:4]
    if kind not in (b"RIFF", b"RF64", b"RIFX") or content[8:12] != b"WAVE":
        return None
    order = "big" if kind == b"RIFX" else "little"

    def number(offset: int, size: int) -> int | None:
        part = content[offset : offset + size]
        return int.from_bytes(part, order) if part else None

    at, rate, block, wide, frames = 12, None, None, None, None
    for _ in range(max(_USUAL_CHUNKS, min(len(content) // 8, MOST_CHUNKS) + 1)):
        body = at + 8
        if body > len(content):
            return None
        tag, size = content[at : at + 4], number(at + 4, 4)
        if tag == b"data":
            stored = wide if size == 0xFFFFFFFF and wide is not None else size
            held = min(stored, total - body)
            frames = math.floor(held / block) if block else frames
            return (frames, rate) if rate and frames is not None else None
        if tag == b"fmt ":
            rate = number(body + 4, 4)
            block = number(body + 12, 2) if number(body, 2) in FIXED_SIZE_FORMATS else None
        elif tag == b"ds64":
            wide = number(body + 8, 8)
        elif tag == b"fact":
            frames = number(body, 4)
        at = body + size + size % 2
    return None

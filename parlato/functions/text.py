"""Transcript normalisation and string helpers, all as built-in expressions.

The normaliser never leaves the JVM, so it can sit in a plan that carries audio
bytes without sending rows through a Python worker.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that transcripts are trimmed of and split on,
# as the inside of a character class. Wider than Java's own \s. Single characters
# below 256 are one table look-up for Java, so they are not written as ranges.
WS = (
    r"\t\n\x0B\f\r\x1C\x1D\x1E\x1F \x85\xA0\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}-\x{2029}\x{202F}\x{205F}\x{3000}"
)

# Letters and numbers of Unicode 14.0 to 15.1, which a Java 17
# runtime still reports as unassigned (first and last code point, hexadecimal).
RECENT_LETTERS = """
870-887 889-88E 8B5-8B5 8C8-8C9 C5D-C5D CDD-CDD 170D-170D 171F-171F 1B4C-1B4C
2C2F-2C2F 2C5F-2C5F 9FFD-9FFF A7C0-A7C1 A7D0-A7D1 A7D3-A7D3 A7D5-A7D9 A7F2-A7F4
10570-1057A 1057C-1058A 1058C-10592 10594-10595 10597-105A1 105A3-105B1
105B3-105B9 105BB-105BC 10780-10785 10787-107B0 107B2-107BA 10F70-10F81
11071-11072 11075-11075 1123F-11240 11740-11746 11AB0-11ABF 11F02-11F02
11F04-11F10 11F12-11F33 11F50-11F59 12F90-12FF0 1342F-1342F 13441-13446
16A70-16ABE 16AC0-16AC9 1AFF0-1AFF3 1AFF5-1AFFB 1AFFD-1AFFE 1B11F-1B122
1B132-1B132 1B155-1B155 1D2C0-1D2D3 1DF00-1DF1E 1DF25-1DF2A 1E030-1E06D
1E290-1E2AD 1E4D0-1E4EB 1E4F0-1E4F9 1E7E0-1E7E6 1E7E8-1E7EB 1E7ED-1E7EE
1E7F0-1E7FE 2A6DE-2A6DF 2B735-2B739 2EBF0-2EE5D 31350-323AF
"""

# Annotation brackets, in the order in which they are removed.
BRACKETS = [("[", "]"), ("(", ")"), ("{", "}"), ("<", ">")]

_HANGUL = range(0xAC00, 0xD7A4)


def _not_a_word() -> str:
    """A run of anything but letters and numbers, white space included.

    Code points outside the blocks that hold recent letters skip the long table.
    """
    recent = "".join(
        rf"\x{{{first}}}-\x{{{last}}}" for first, last in (pair.split("-") for pair in RECENT_LETTERS.split())
    )
    settled = r"\x{0}-\x{86F}\x{2000}-\x{2BFF}\x{3000}-\x{9FFC}"
    return rf"[[^\p{{L}}\p{{N}}]&&[{settled}[^{recent}]]]+"


def _bind(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once per row, however often ``then`` uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


@lru_cache(maxsize=1)
def _base_letters() -> tuple[str, str, dict[str, str]]:
    """Letters that lose their accents: one-to-one as two aligned strings, the rest as a dict."""
    plain, accented, longer = [], [], {}
    for code in range(0x80, 0x110000):
        letter = chr(code)
        if code in _HANGUL or unicodedata.category(letter)[0] not in "LN":
            continue
        parts = unicodedata.normalize("NFD", letter)
        if parts == letter:
            continue
        base = "".join(part for part in parts if unicodedata.category(part) != "Mn")
        if len(base) == 1:
            accented.append(letter)
            plain.append(base)
        else:
            longer[letter] = base
    return "".join(accented), "".join(plain), longer


def _decompose(text: Column) -> Column:
    """Take apart Hangul syllables and the few letters that become several letters."""
    _, _, longer = _base_letters()
    parts = F.str_to_map(F.lit(",".join(f"{letter}:{base}" for letter, base in longer.items())))

    def jamo(first: int, count: int, index: Column) -> Column:
        letters = F.lit("".join(chr(first + i) for i in range(count)))
        return F.substring(letters, index.cast("int") + 1, F.lit(1))

    def syllable(at: Column) -> Column:
        tail = at % 28
        last = F.when(tail == 0, "").otherwise(jamo(0x11A7, 28, tail))
        return F.concat(jamo(0x1100, 19, F.floor(at / 588)), jamo(0x1161, 21, F.floor(at % 588 / 28)), last)

    def expand(char: Column) -> Column:
        at = F.ascii(char) - _HANGUL.start
        is_hangul = at.between(0, len(_HANGUL) - 1)
        return F.when(is_hangul, syllable(at)).otherwise(F.coalesce(F.try_element_at(parts, char), char))

    return F.array_join(F.transform(F.split(text, ""), expand), "")


def strip_ws(text: Column) -> Column:
    """Trim white space of every kind at both ends."""
    return F.regexp_replace(text, rf"^[{WS}]+|[{WS}]+\z", "")


def collapse_ws(text: Column) -> Column:
    """Every run of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(text, f"[{WS}]+", " "))


def drop_annotations(text: Column) -> Column:
    """Bracketed notes to spaces, one kind after the other, never across a line feed."""

    def clean(t: Column) -> Column:
        has_any, cleaned = F.lit(False), t
        for start, end in BRACKETS:
            has_any = has_any | F.contains(t, F.lit(start))
            cleaned = F.regexp_replace(cleaned, rf"\{start}[^\{end}\n]*+\{end}", " ")
        return F.when(has_any, cleaned).otherwise(t)

    return _bind(text, clean)


def fold_accents(text: Column) -> Column:
    """Replace each precomposed letter with its letters minus combining marks.

    For text of letters, numbers and white space, as :func:`normalize` leaves it
    at this point. Stray combining marks are not touched.
    """
    accented, plain, longer = _base_letters()
    needs_more = rf"[\x{{{_HANGUL.start:X}}}-\x{{{_HANGUL.stop - 1:X}}}{''.join(longer)}]"

    def rest(t: Column) -> Column:
        return F.when(~_is_ascii(t) & t.rlike(needs_more), _decompose(t)).otherwise(t)

    return _bind(text, lambda t: F.when(_is_ascii(t), t).otherwise(_bind(F.translate(t, accented, plain), rest)))


def normalize(text: Column, lowercase: bool = False) -> Column:
    """A transcript as it is compared: words of letters and numbers, one space between.

    Null becomes the empty string. Case is kept unless ``lowercase``. Marks that
    are not part of a precomposed letter count as punctuation and become spaces.
    """
    text = F.coalesce(text, F.lit(""))
    if lowercase:
        text = F.lower(text)
    # letters never fold to white space, so runs can be closed up before folding
    spaced = F.trim(F.regexp_replace(drop_annotations(text), _not_a_word(), " "))
    return fold_accents(spaced)


def normalize_each(texts: Column, lowercase: bool = False) -> Column:
    """:func:`normalize` over an array of strings."""
    return F.transform(texts, lambda text: normalize(text, lowercase))


def words(text: Column) -> Column:
    """The words that scoring counts: split at spaces, at runs of white space and at both ends.

    A lone tab or line feed inside the text stays inside its word.
    """
    border = rf"[{WS}](?:[{WS}]+|\z|(?<= )|(?<=\A[{WS}]))"
    # normalised text seldom needs the pattern, and splitting at one character is far cheaper
    pieces = F.when(text.rlike("[^ -~]|  "), F.split(text, border)).otherwise(F.split(text, " "))
    return F.array_remove(pieces, "")


def without_suffix(name: Column, suffix: str) -> Column:
    """``name`` minus a literal ending, if it has it."""
    return F.when(F.endswith(name, F.lit(suffix)), F.substring(name, F.lit(1), F.length(name) - len(suffix))).otherwise(
        name
    )


def swap_suffix(name: Column, old: str, new: str) -> Column:
    """``a.wav`` to ``a.mp3``: drop ``old`` if present, then append ``new``."""
    return F.concat(without_suffix(name, old), F.lit(new))


def path_stem(path: Column) -> Column:
    """``path`` minus its last suffix; a leading dot of the file name is not a suffix."""
    return F.regexp_replace(path, r"(?<=[^/])\.[^./]+\z", "")


def parent_name(path: Column) -> Column:
    """Name of the directory that holds ``path``; null for a bare file name."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def split_from_path(path: Column, match: str = "anywhere") -> Column:
    """``test`` if the lower-cased path holds that word, else ``train``.

    ``anywhere`` also hits ``latest/`` and ``contest.wav``; ``segment`` asks for
    a directory or file stem that is exactly ``test``.
    """
    if match == "anywhere":
        hit = F.lower(path).contains("test")
    elif match == "segment":
        hit = F.lower(path).rlike(r"(?:^|/)test(?:/|\.[^/]*\z|\z)")
    else:
        raise ValueError(f"match must be 'anywhere' or 'segment', not {match!r}")
    return F.when(hit, "test").otherwise("train")


def transcript_line(text: Column, utt_id: Column) -> Column:
    """One line of a hypothesis or reference file."""
    return F.format_string("%s (%s)", text, utt_id)

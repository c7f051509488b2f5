"""BPE encoding and decoding by a tokenization automaton."""

from __future__ import annotations

import json
import re
from array import array
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlato.llm.common import slices, table

# Words, and runs of them, whose encodings a generation of kept results holds.
KEPT_WORDS = 120_000
KEPT_LENGTH = 64
# A pattern whose classes all stand inside brackets.
LISTED = re.compile(r"^(?:[^\\\[]|\\s|\[(?:[^\]\\]|\\[sp](?:\{[LN]\})?)*\])*$")
# Rows, and bytes of their texts, whose results a worker holds at a time; a longer text is encoded alone.
SLICE_ROWS, SLICE_BYTES = 500, 4 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 ones for themselves, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in own}
    spare = 0x100
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


class Automaton:
    """The automaton whose paths are the correct tokenizations, one arc a token.

    It starts with one state and a loop for each letter. Each merge ``a b -> c``,
    in order, puts in one gadget, provided ``b`` can follow ``a`` at that time:
    wherever ``a`` leaves a state an arc ``c`` leaves it too; ``c`` leads to a copy of the state after ``b``; and the state after
    ``a`` loses its arc ``b``. All arcs of one label lead to one state, so the
    state is named by the last token read. ``left``, ``right``, ``time`` and ``removed`` keep
    the gadgets, which tell for any two tokens whether the second may follow; a matrix of
    transitions would have a cell for every two of them.

    A word has exactly one path from start to end that spells it.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        self.ids, self.suffix = vocabulary, suffix
        self.tokens = {i: t for t, i in vocabulary.items()}
        self.removed: dict[tuple[int, int], int] = {}
        top = max(vocabulary.values(), default=-1) + 1
        self.left, self.right, self.time = [-1] * top, [-1] * top, [-1] * top
        made = {a + b for a, b in merges}
        arcs = {i for t, i in vocabulary.items() if t not in made}
        for time, (a, b) in enumerate(merges):
            x, y, z = vocabulary[a], vocabulary[b], vocabulary[a + b]
            # earlier merges may keep the two from ever meeting
            if x in arcs and y in arcs and self._arc(x, y, time):
                self.removed[x, y] = time
                self.left[z], self.right[z], self.time[z] = x, y, time
                arcs.add(z)
        # letters lead from node to node; 0 and 1 hold the arc that ends there, inside a word or at its end
        self.spelling: dict = {}
        for token, label in vocabulary.items():
            if label not in arcs:
                continue
            node = self.spelling
            for letter in token.removesuffix(suffix):
                node = node.setdefault(letter, {})
            node[int(token.endswith(suffix))] = label

    def _arc(self, state: int, label: int, time: float) -> bool:
        """Whether the gadgets before ``time`` left an arc ``label`` out of the state after token ``state``."""
        while True:
            if self.removed.get((state, label), time) < time:
                return False
            made, entered = self.time[label], self.time[state]
            if made == entered == -1:
                return True
            if made >= entered:  # the arc was put beside that of its left part, after the removal
                label, time = self.left[label], made + 1
            else:  # the state was copied from that after its right part, before the removal
                state, time = self.right[state], entered

    def _spelled(self, word: str, at: int) -> list[tuple[int, int]]:
        """End and label of the arcs that spell the word from ``at`` on, shortest first."""
        node, out, last = self.spelling, [], len(word) - 1
        for end in range(at, last):
            node = node.get(word[end])
            if node is None:
                return out
            label = node.get(0)
            if label is not None:
                out.append((end + 1, label))
        node = node.get(word[last])
        if node is not None and (label := node.get(1)) is not None:
            out.append((last + 1, label))
        return out

    def encode(self, word: str) -> list[int]:
        """Token ids of one pre-split word in byte letters: the labels of its path.

        The longest arc that the table allows is followed first. Each beginning of
        the word that is a word without end has one path too, so a place is
        reached in one state only: one that leads nowhere is never tried again.
        """
        if not word:
            return []
        n, spelled = len(word), self._spelled
        path: list[int] = []
        todo, places, dead = [spelled(word, 0)], [0], set()
        while todo:
            arcs = todo[-1]
            while arcs:
                end, label = arcs.pop()
                if end not in dead and (not path or self._arc(path[-1], label, float("inf"))):
                    path.append(label)
                    if end == n:
                        return path
                    todo.append(spelled(word, end))
                    places.append(end)
                    break
            else:
                todo.pop()
                dead.add(places.pop())
                if path:
                    path.pop()
        raise ValueError(f"no path spells {word!r}")

    def decode(self, labels: list[int]) -> str:
        """The arcs' labels, one after the other, with a space between."""
        return " ".join([self.tokens[i] for i in labels])


class Tables:
    """An automaton as arrays: the tree of its labels' spellings by byte, and its gadgets by token.

    Words walk it side by side, each one arc a step.
    """

    # Bytes of the words that walk side by side; longer ones go alone.
    LONGEST = 48
    # Words that do so at a time, of like length.
    STRIP = 1 << 14

    def __init__(self, automaton: Automaton, letters: list[str]) -> None:
        byte = {letter: b for b, letter in enumerate(letters)}
        keys, ends = array("q"), array("q", [-1, -1])
        todo = deque([automaton.spelling])
        number = 0
        while todo:
            for letter, below in todo.popleft().items():
                if isinstance(letter, int):
                    ends[2 * number + letter] = below
                elif letter in byte:
                    keys.append(number << 8 | byte[letter])
                    todo.append(below)
                    ends.extend((-1, -1))
            number += 1
        # the nodes are numbered in the order of their keys' coming, from 1 on
        order = np.argsort(keys)
        self.keys = np.array(keys, np.int64)[order]
        self.child = order + 1
        self.ends = np.array(ends, np.int64).reshape(-1, 2)
        self.width = len(automaton.time)
        self.left, self.right, self.time = (np.array(x, np.int64) for x in (automaton.left, automaton.right, automaton.time))
        pairs = sorted((x * self.width + y, t) for (x, y), t in automaton.removed.items())
        self.removed = np.array([p for p, _ in pairs] or [-1], np.int64)
        self.removed_at = np.array([t for _, t in pairs] or [0], np.int64)

    def follows(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Whether an arc ``label`` leaves the state after token ``state``, as :meth:`Automaton._arc` tells."""
        out = np.zeros(len(state), bool)
        at, time = np.arange(len(state)), np.full(len(state), np.iinfo(np.int64).max)
        while len(at):
            key = state * self.width + label
            place = np.minimum(np.searchsorted(self.removed, key), len(self.removed) - 1)
            open_ = (self.removed[place] != key) | (self.removed_at[place] >= time)
            made, entered = self.time[label], self.time[state]
            done = open_ & (made < 0) & (entered < 0)
            out[at[done]] = True
            rest = open_ & ~done
            by_label = (made >= entered)[rest]
            at, state, label, made, entered = at[rest], state[rest], label[rest], made[rest], entered[rest]
            time = np.where(by_label, made + 1, entered)
            state, label = np.where(by_label, state, self.right[state]), np.where(by_label, self.left[label], label)
        return out

    def _longest(self, flat: np.ndarray, start: np.ndarray, end: np.ndarray, limit: np.ndarray, dead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length and label of the longest arc from ``start`` that is shorter than ``limit`` and ends where a word may go on."""
        length, label = np.zeros(len(start), np.int64), np.full(len(start), -1)
        at, node, depth = np.arange(len(start)), np.zeros(len(start), np.int64), 0
        if not len(self.keys):
            return length, label
        while True:
            more = (depth + 1 < limit[at]) & (start[at] + depth < end[at])
            at, node = at[more], node[more]
            if not len(at):
                return length, label
            place = start[at] + depth
            key = node << 8 | flat[place]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[found] == key
            at, node, place = at[there], self.child[found[there]], place[there]
            depth += 1
            last = place + 1 == end[at]
            name = self.ends[node, last.astype(np.int64)]
            good = (name >= 0) & (last | ~dead[np.minimum(place + 1, len(dead) - 1)])
            length[at[good]] = depth
            label[at[good]] = name[good]

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """The labels of each word's path; words must not be empty nor longer than ``LONGEST``.

        As :meth:`Automaton.encode`, all words at once: each takes its longest arc that
        may follow, or a shorter one next time, or goes back by one arc.
        """
        size = np.array(list(map(len, words)), np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        end = np.cumsum(size)
        first = end - size
        dead = np.zeros(len(flat) + 1, bool)
        far = self.LONGEST + 2
        labels = np.zeros((len(words), int(size.max(initial=0)) + 1), np.int32)
        lengths = np.zeros(labels.shape, np.int8)
        depth, at, limit = np.zeros(len(words), np.int64), first.copy(), np.full(len(words), far)
        active = np.arange(len(words))
        while len(active):
            length, label = self._longest(flat, at[active], end[active], limit[active], dead)
            none = length == 0
            back = active[none]
            if len(back):
                if (depth[back] == 0).any():
                    raise ValueError(f"no path spells {words[back[depth[back] == 0][0]]!r}")
                dead[at[back]] = True
                depth[back] -= 1
                limit[back] = lengths[back, depth[back]]
                at[back] -= limit[back]
            go, length, label = active[~none], length[~none], label[~none]
            fits = depth[go] == 0
            later = np.flatnonzero(~fits)
            fits[later] = self.follows(labels[go[later], depth[go[later]] - 1], label[later])
            limit[go[~fits]] = length[~fits]
            go, length, label = go[fits], length[fits], label[fits]
            labels[go, depth[go]], lengths[go, depth[go]] = label, length
            depth[go] += 1
            at[go] += length
            limit[go] = far
            active = active[at[active] < end[active]]
        path = labels[np.arange(labels.shape[1]) < depth[:, None]].tolist()
        last = np.cumsum(depth).tolist()
        return [path[a:b] for a, b in zip([0, *last], last, strict=False)]


class Kept:
    """Results by key; of two generations of keys the older goes when the younger is full."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def known(self, keys: Iterable) -> dict:
        return {key: found for key in keys if (found := self.young.get(key) or self.old.get(key))}

    def keep(self, results: dict) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young |= results


class Encoder:
    """Whole texts to ids and back, as the tokenizer file says.

    Special tokens are found in the text as it is. What is between them is cut
    at white space, which no token crosses, so each run is composed (NFC), put in
    lower case and cut by the file's pattern on its own. Runs of characters below
    U+0250, where all of this is plain, are cut here; for others the file's own
    normaliser and splitter of the ``tokenizers`` library are asked. Of some texts
    each run and word is encoded once; those that several places have are kept.
    """

    PLAIN = re.compile("[\x21-\u012f\u0131-\u024f]*")
    # control characters that only Python's split takes for white space
    CONTROLS = re.compile("[\x1c-\x1f]")

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model = held["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.automaton.tokens |= {i: t for t, i in self.special.items()}
        pattern = held["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        # the same for ASCII in lower case, where the classes of letters and digits are short
        self.low_pattern = re.compile(pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")) if LISTED.search(pattern) else self.pattern
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, names))})") if names else None
        del held, model, merges
        self.names = {i: str(i) for i in self.automaton.tokens}
        self.letters = byte_letters()
        self.bytes_of = {letter: b for b, letter in enumerate(self.letters)}
        self.tables = Tables(self.automaton, self.letters)
        self.runs, self.words = Kept(KEPT_WORDS), Kept(KEPT_WORDS)

    def _cut(self, run: str) -> list[bytes]:
        """The words of a run."""
        if run.isascii() and run.isprintable():
            return list(map(str.encode, self.low_pattern.findall(run.lower())))
        if self.PLAIN.fullmatch(run):
            return list(map(str.encode, self.pattern.findall(run.lower())))
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(run))
        return [bytes([self.bytes_of[letter] for letter in word]) for word, _ in found]

    @staticmethod
    def _joined(found: list[tuple[int, str, str]]) -> tuple[int, str, str]:
        if len(found) == 1:
            return found[0]
        n = [f[0] for f in found]
        if 0 in n:
            found = [f for f in found if f[0]]
        return sum(n), " ".join([f[1] for f in found]), " ".join([f[2] for f in found])

    @staticmethod
    def _looked_up(keys: set, kept: Kept, make: Callable[[list], dict]) -> dict:
        look = kept.known(keys)
        look |= make(list(keys.difference(look)))
        kept.keep({key: found for key, found in look.items() if len(key) <= KEPT_LENGTH})
        return look

    def _words(self, words: list[bytes]) -> dict[bytes, tuple[int, str, str]]:
        short = sorted([w for w in words if 0 < len(w) <= Tables.LONGEST], key=len)
        made = {}
        for k in range(0, len(short), Tables.STRIP):
            part = short[k : k + Tables.STRIP]
            made |= zip(part, map(self._told, self.tables.encode(part)), strict=True)
        for word in words:
            if word not in made:
                made[word] = self._told(self.automaton.encode("".join([self.letters[b] for b in word])))
        return made

    def _told(self, path: list[int]) -> tuple[int, str, str]:
        return len(path), " ".join([self.names[i] for i in path]), self.automaton.decode(path)

    def _runs(self, runs: list[str]) -> dict[str, tuple[int, str, str]]:
        cut = [self._cut(run) for run in runs]
        look = self._looked_up(set(chain.from_iterable(cut)), self.words, self._words)
        return {run: self._joined([look[w] for w in words]) for run, words in zip(runs, cut, strict=True)}

    def encode(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Number of tokens, their ids joined by spaces, and the decoded text of each text."""
        places: list[list] = []
        whole = {n: (1, str(n), content) for content, n in self.special.items()}
        for text in texts:
            mine: list = []
            for k, part in enumerate(self.cut.split(text) if text and self.cut else [text or ""]):
                if k % 2:
                    # a number can't be a run
                    mine.append(self.special[part])
                else:
                    mine += [part] if self.CONTROLS.search(part) else part.split()
            places.append(mine)
        runs = set(chain.from_iterable(places)).difference(whole)
        look = self._looked_up(runs, self.runs, self._runs) | whole
        return [self._joined([look[r] for r in mine]) for mine in places]


class Shared:
    """An encoder that a worker builds once and keeps from task to task, being part of a broadcast value."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.encoder: Encoder | None = None

    def get(self) -> Encoder:
        if self.encoder is None:
            self.encoder = Encoder(self.path)
        return self.encoder


def encoded(docs: DataFrame, text: str, path: str) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` (decimal, joined by spaces) and ``decoded``.

    ``path`` names a tokenizer file that every worker can open. Null and empty
    texts have no tokens. Columns of the three names are replaced. A worker holds
    the results of ``SLICE_ROWS`` rows at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Shared(path))
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_tokens", "ids", "decoded")])
    place = docs.columns.index(text)
    schema = T.StructType(
        [*docs.schema, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.StringType()), T.StructField("decoded", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value.get()
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False)
            for cut in slices(sizes, SLICE_ROWS, SLICE_BYTES):
                part = batch.slice(cut.start, cut.stop - cut.start)
                made = encoder.encode(part.column(place).to_pylist())
                n, ids, decoded = zip(*made, strict=True)
                columns = [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], schema.names)

    return docs.mapInArrow(run, schema)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = encoded(docs, "text", vocabulary_path())
    return made.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )

"""Secret scans: fixed patterns, and a character convolutional network over other candidates."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlato.llm.common import stage, table

# The base patterns, in the order of their kinds, and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "model")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# A candidate is a run of token characters this long that is not all letters in the case of an ordinary word.
LEAST = 12
CONTEXT = 24
# Findings of each class that the network learns from, at most; chosen by hash.
SAMPLE = 4000
RECALL = 0.99
# Characters of the longest window that the network learns from; it scores all.
LEARNED = 1000
# Characters, with their contexts, that the network looks at in one go.
STRIP = 1 << 13
# Width of the bins in which the network's outputs are counted.
BIN = 1 / 256

_RUN = bytes(49 if chr(b) in "+/_.=-" or chr(b).isalnum() and b < 128 else 48 for b in range(256))
_HEX = bytes(49 if chr(b) in "0123456789abcdef" else 48 for b in range(256))


def base_spans(text: str, raw: bytes) -> list[tuple[str, int, int]]:
    """``kind, start, end`` of the base patterns' matches, in code points; ``raw`` is the text in UTF-8.

    Each pattern runs over the whole text if a byte search finds that it can match at all.
    """
    found = []
    low = raw.lower()
    if any(word in low for word in WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if b"AKIA" in raw:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    if b"1" * 16 in raw.translate(_HEX):
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def runs(raw: bytes) -> Iterator[tuple[int, int]]:
    """Byte spans of the maximal runs of at least ``LEAST`` token characters."""
    marks = raw.translate(_RUN)
    at = marks.find(b"1" * LEAST)
    while at >= 0:
        end = marks.find(b"0", at)
        end = len(marks) if end < 0 else end
        yield at, end
        at = marks.find(b"1" * LEAST, end)


class Found(NamedTuple):
    """Findings of one text. ``base`` are spans as text; the lists tell of candidates: where, whether a base
    pattern found them (1), nothing did (0) or their label is unsure (-1), and their text with its context."""

    n_assign: int
    n_access: int
    n_hex: int
    base: list[str]
    starts: list[int]
    ends: list[int]
    labels: list[int]
    windows: list[str]


def scan(text: str | None) -> Found:
    """Base spans and candidates of a whole text; null is empty.

    A window is the left context, the candidate and the right context, parted by
    line breaks. Numbers that only the hex pattern takes teach nothing.
    """
    if not text:
        return Found(0, 0, 0, [], [], [], [], [])
    raw = text.encode("utf-8")
    base = base_spans(text, raw)
    starts, ends, labels, windows = [], [], [], []
    for a, b in runs(raw):
        run = raw[a:b]
        if run.isalpha() and (run.islower() or run.isupper() or run[1:].islower()):
            continue
        at = a if len(raw) == len(text) else len(raw[:a].decode("utf-8"))
        end = at + len(run)
        meets = [kind for kind, s, e in base if s < end and at < e]
        sure = any(kind != "hex" for kind in meets) or any(c in run for c in b"abcdef")
        starts.append(at)
        ends.append(end)
        labels.append((1 if sure else -1) if meets else 0)
        around = text[max(0, at - CONTEXT) : at], text[at:end], text[end : end + CONTEXT]
        windows.append("\n".join([x.replace("\n", " ") for x in around]))
    n = {kind: sum(k == kind for k, _, _ in base) for kind in KINDS}
    base.sort(key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    return Found(n["assign"], n["access"], n["hex"], [f"{k}:{s}:{e}" for k, s, e in base], starts, ends, labels, windows)


def coded(windows: list[str]) -> np.ndarray:
    """Character codes, 0 for padding; the candidate's characters are in the upper half of the alphabet."""
    length = max(map(len, windows), default=0) + WIDTH
    out = np.zeros((len(windows), length), np.int64)
    for row, window in enumerate(windows):
        left, run, right = window.split("\n")
        codes = np.frombuffer(f"{left}{run}{right}".encode("latin-1", "replace"), np.uint8) % 128
        codes = codes.astype(np.int64)
        codes[len(left) : len(left) + len(run)] += 128
        out[row, : len(codes)] = codes
    return out


WIDTH, DEPTH, FILTERS = 5, 8, 32


class Network:
    """Characters to vectors, one convolution, the maximum over places, one output; trained with Adam."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.letters = rng.normal(0, 0.3, (256, DEPTH))
        self.filters = rng.normal(0, (WIDTH * DEPTH) ** -0.5, (WIDTH * DEPTH, FILTERS))
        self.shift = np.zeros(FILTERS)
        self.output = rng.normal(0, FILTERS**-0.5, FILTERS)
        self.bias = np.zeros(1)
        # logistic calibration, and the least probability by place
        self.scale = (1.0, 0.0)
        self.thresholds = {True: 1.0, False: 1.0}

    def _patches(self, codes: np.ndarray) -> np.ndarray:
        places = np.arange(codes.shape[1] - WIDTH + 1)[:, None] + np.arange(WIDTH)
        return self.letters[codes[:, places]].reshape(len(codes), len(places), WIDTH * DEPTH)

    def _forward(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        maps = self._patches(codes) @ self.filters
        best = maps.argmax(axis=1)
        pooled = np.maximum(np.take_along_axis(maps, best[:, None, :], 1)[:, 0] + self.shift, 0)
        return pooled @ self.output + self.bias[0], pooled, best

    def _best(self, codes: np.ndarray) -> np.ndarray:
        """The maximum of each filter over all places, some places at a time."""
        step = max(1, STRIP // len(codes))
        out = np.full((len(codes), FILTERS), -np.inf)
        for k in range(0, codes.shape[1] - WIDTH + 1, step):
            np.maximum(out, (self._patches(codes[:, k : k + step + WIDTH - 1]) @ self.filters).max(axis=1), out=out)
        return out

    def logits(self, windows: list[str]) -> np.ndarray:
        """Outputs for all windows, in batches of like length so that a long candidate stands alone."""
        out = np.zeros(len(windows))
        order = sorted(range(len(windows)), key=lambda k: len(windows[k]))
        while order:
            longest = len(windows[order[-1]]) + WIDTH
            part = order[-max(1, STRIP // longest) :]
            del order[-len(part) :]
            pooled = np.maximum(self._best(coded([windows[k] for k in part])) + self.shift, 0)
            out[part] = pooled @ self.output + self.bias[0]
        return out

    def fit(self, windows: list[str], labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01) -> None:
        rng = np.random.default_rng(11)
        weights = [self.letters, self.filters, self.shift, self.output, self.bias]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for k in range(0, len(order), batch):
                rows = order[k : k + batch]
                codes = coded([windows[r] for r in rows])
                logit, pooled, best = self._forward(codes)
                error = (1 / (1 + np.exp(-logit)) - labels[rows]) / len(rows)
                back = np.where(pooled > 0, error[:, None] * self.output, 0.0)
                # only the place of each maximum passes the error on
                at = codes[np.arange(len(rows))[:, None, None], best[:, :, None] + np.arange(WIDTH)]
                patch = self.letters[at].reshape(len(rows), FILTERS, WIDTH * DEPTH)
                letters = np.zeros_like(self.letters)
                np.add.at(letters, at, (back[:, :, None] * self.filters.T).reshape(*at.shape, DEPTH))
                slopes = [
                    letters,
                    np.einsum("bf,bfp->pf", back, patch),
                    back.sum(axis=0),
                    error @ pooled,
                    np.array([error.sum()]),
                ]
                step += 1
                for w, g, m, v in zip(weights, slopes, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def calibrate(self, counts: pd.DataFrame) -> None:
        """Fit a logistic curve to the outputs for findings, then the thresholds.

        ``counts`` has ``label, keyed, bin, n``: findings by place and by output in bins of
        ``BIN``. A threshold is the highest bin edge that still keeps ``RECALL`` of the
        true findings; after an equals sign or colon it is one of its own.
        """
        logit, labels = (counts["bin"].to_numpy(np.float64) + 0.5) * BIN, counts["label"].to_numpy()
        times = counts["n"].to_numpy(np.float64)
        mean = float(np.average(logit, weights=times))
        a = 1 / max(float(np.sqrt(np.average((logit - mean) ** 2, weights=times))), 1e-3)
        b = -a * mean
        # targets drawn in by one finding a class keep the curve from becoming a step
        n, total = times[labels == 1].sum(), times.sum()
        target = np.where(labels == 1, (n + 1) / (n + 2), 1 / (total - n + 2))
        # shares, as sums over many findings would drown what keeps the matrix regular
        times = times / total
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))
            w, d = times * (p * (1 - p) + 1e-9), times * (p - target)
            hessian = np.array([[(w * logit * logit).sum(), (w * logit).sum()], [(w * logit).sum(), w.sum()]]) + 1e-9 * np.eye(2)
            move = np.linalg.solve(hessian, [(d * logit).sum(), d.sum()])
            # short steps: between well parted classes the curve is flat
            move *= min(1.0, 1.0 / max(np.abs(move).max(), 1e-12))
            a, b = a - move[0], b - move[1]
            if np.abs(move).max() < 1e-6:
                break
        self.scale = (float(a), float(b))
        true = counts[counts["label"] == 1]
        for place in (True, False):
            # a place without findings takes the threshold of all
            mine = true[true["keyed"] == place] if (true["keyed"] == place).any() else true
            mine = mine.groupby("bin")["n"].sum().sort_index(ascending=a < 0)  # most probable first
            if len(mine):
                above = mine.cumsum()
                last = above.index[int(np.argmax(above.to_numpy() >= RECALL * mine.sum()))]
                self.thresholds[place] = float(self._curve(np.array([last, last + 1]) * BIN).min())

    def _curve(self, logit: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))

    def probabilities(self, windows: list[str]) -> np.ndarray:
        return self._curve(self.logits(windows))


def is_keyed(window: str) -> bool:
    """Whether the candidate stands right after an equals sign or a colon."""
    return window.split("\n", 1)[0].rstrip(" \"'").endswith(("=", ":"))


FOUND = (
    "n_assign long, n_access long, n_hex long, base array<string>, starts array<int>, ends array<int>,"
    " labels array<int>, windows array<string>"
)


def findings(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` without its text, with a column ``found`` of each text's findings."""

    @F.pandas_udf(FOUND)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scan(t) for t in texts], columns=Found._fields)

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (text, "found")]
    return docs.select(*kept, run(F.col(text)).alias("found"))


def train(found: DataFrame, sample: int = SAMPLE) -> Network | None:
    """A network learned from findings of base patterns and from candidates that none of them takes.

    Up to ``sample`` distinct windows of each class of up to ``LEARNED`` characters, those of the smallest hash,
    reach the driver and are learned from. Calibration and thresholds come from
    all findings, scored in tasks and counted by output. Without findings of both
    classes there is no network.
    """
    rows = found.select(F.explode(F.arrays_zip("found.labels", "found.windows")).alias("x"))
    rows = rows.select(F.col("x.labels").alias("label"), F.col("x.windows").alias("window")).where("label >= 0")
    rows = rows.groupBy("label", "window").agg(F.count("*").alias("n"))
    by_hash = stage(rows.withColumn("h", F.md5("window")), "secret-windows")
    learned = by_hash.where(F.length("window") <= LEARNED)
    counts = {r["label"]: r["n"] for r in learned.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = []
    for k in (0, 1):
        # hashes are even, so a range of them holds the smallest with some to spare
        share = min(1.0, 2 * sample / max(counts.get(k, 0), 1))
        mine = learned.where((F.col("label") == k) & (F.col("h") <= f"{int(share * (16**8 - 1)):08x}g"))
        parts.append(mine.orderBy("h").limit(sample).toPandas())
    if not all(map(len, parts)):
        return None
    rows = pd.concat(parts).sort_values("h")
    network = Network()
    network.fit(rows["window"].tolist(), rows["label"].to_numpy(np.float64))
    network.calibrate(output_counts(by_hash, network))
    return network


def output_counts(windows: DataFrame, network: Network) -> pd.DataFrame:
    """``label, keyed, bin, n`` for ``label, window, n``: how many findings have an output in each bin of ``BIN``."""
    sent = windows.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("keyed boolean, bin long")
    def scored(values: pd.Series) -> pd.DataFrame:
        mine = values.tolist()
        # far outputs are as good as certain, and would make bins without end
        bins = np.floor(np.clip(sent.value.logits(mine), -100, 100) / BIN).astype(np.int64)
        return pd.DataFrame({"keyed": [is_keyed(w) for w in mine], "bin": bins})

    rows = windows.select("label", "n", scored("window").alias("x"))
    return rows.groupBy("label", "x.keyed", "x.bin").agg(F.sum("n").alias("n")).orderBy("label", "keyed", "bin").toPandas()


def with_spans(found: DataFrame, network: Network | None) -> DataFrame:
    """``found`` with ``spans``: base spans and those the network adds, as ``kind:start:end`` in order.

    A candidate that a base span meets is not added again.
    """
    sent = found.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("array<string>")
    def run(values: pd.DataFrame) -> pd.Series:
        columns = [values[c] for c in ("base", "starts", "ends", "labels", "windows")]
        return pd.Series(all_spans(list(zip(*columns, strict=True)), sent.value))

    return found.withColumn("spans", run("found"))


def all_spans(rows: list[tuple], network: Network | None) -> list[list[str]]:
    """Spans in order for rows of base spans, starts, ends, labels and windows."""
    spans = [list(base) for base, *_ in rows]
    if network is not None:
        flat = [
            (row, s, e, w)
            for row, (_, starts, ends, labels, windows) in enumerate(rows)
            for s, e, k, w in zip(starts, ends, labels, windows, strict=True)
            if k == 0
        ]
        for (row, s, e, w), p in zip(flat, network.probabilities([w for *_, w in flat]), strict=True):
            if p >= network.thresholds[is_keyed(w)]:
                spans[row].append(f"model:{s}:{e}")
    return [sorted(x, key=_place) for x in spans]


def without(text: str, spans: list[str], mark: str) -> str:
    """``text`` with each span, or run of spans that overlap, replaced by ``mark``."""
    out, at = [], 0
    for _, start, end in (s.split(":") for s in spans):
        if int(start) >= at:
            out += [text[at : int(start)], mark]
        at = max(at, int(end))
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; null texts stay null, no row is left out.

    One pass over the texts gathers what the network learns from, a second one
    scans, scores and replaces.
    """
    network = train(stage(findings(docs.select(text), text), "secrets"))
    sent = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        found = [scan(t) for t in texts]
        spans = all_spans([f[3:] for f in found], sent.value)
        return pd.Series([without(t, s, mark) if s else t for t, s in zip(texts, spans, strict=True)], dtype=object)

    return docs.withColumn(text, run(F.col(text)))


def _place(span: str) -> tuple[int, int, int]:
    kind, start, end = span.split(":")
    return int(start), KINDS.index(kind), int(end)


def find_secrets(docs: DataFrame, text: str) -> tuple[DataFrame, Network | None]:
    """``docs`` without its text, with ``found`` and ``spans``, and the network that added spans.

    Texts are scanned whole and once; findings are stored, and both training and
    scoring read them. A null or empty text has no findings, an empty table no
    rows and no network. Rows that repeat are scanned each.
    """
    found = stage(findings(docs, text), "secrets")
    network = train(found)
    return with_spans(found, network), network


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return found.select(
        "doc_id",
        "found.n_assign",
        "found.n_access",
        "found.n_hex",
        F.sha2(F.array_join("found.base", ","), 256).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"),
    )

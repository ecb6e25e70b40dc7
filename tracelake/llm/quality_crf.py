"""Quality classifier: a linear-chain conditional random field labels lines good or bad; documents get a weighted mean."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import as_bytes, byte_slices, ship
from tracelake.llm.words import LOWER, SPACE, hash_spans

#: Bounds of the sample a model is fitted on: labelled rows, and lines in a row of one of them. So the driver gets at most
#: a million lines of 17 features in single precision; none of this bounds scoring.
SAMPLE_DOCS = 4000
SAMPLE_LINES = 250
SLICE = 2 << 20

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".,;:'\"?-()",
    "bang": b"!",
    "mark": b"#$%&*|<>{}[]\\/=+~^_@`",
}
_MASKS = {k: np.isin(np.arange(256), np.frombuffer(v, np.uint8)) for k, v in _CLASSES.items()}
_MASKS["wide"] = np.arange(256) >= 128
_MASKS["lead"] = np.arange(256) >= 192

NAMES = [
    "empty", "log_bytes", "short", "upper", "digit", "stop", "bang", "mark", "wide", "word_length", "long_words",
    "repeats", "some_repeats", "some_upper", "some_bang", "some_mark", "same_line",
]
WIDTH = len(NAMES)


@dataclass
class Lines:
    x: np.ndarray  #: (lines, WIDTH) features of each line
    size: np.ndarray  #: bytes of each line
    first: np.ndarray  #: per text, its first line; one more entry at the end


def line_features(texts: list[bytes]) -> Lines:
    """Features of all lines of the texts (split at line feeds, so a text has one line at least)."""
    joined = b"\n".join(texts) + b"\n"
    buf = np.frombuffer(joined, np.uint8)
    ends = np.flatnonzero(buf == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = ends - starts
    n = len(ends)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return (total[ends] - total[starts]).astype(np.float64)

    got = {k: count(m[buf]) for k, m in _MASKS.items()}
    low = LOWER[buf]
    inside = ~SPACE[buf]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    ws, we = edge[0::2], edge[1::2]
    line_of = np.searchsorted(ends, ws)
    words = np.bincount(line_of, minlength=n).astype(np.float64)
    h = hash_spans(low, inside, ws, we)
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (line_of[1:] == line_of[:-1])
    repeats = np.bincount(line_of, weights=again, minlength=n)
    body = np.bincount(line_of, weights=(h >> np.uint64(11)).astype(np.float64), minlength=n)

    chars = np.maximum(size - (got["wide"] - got["lead"]), 1)
    letters = np.maximum(got["upper"] + got["lower"] + got["lead"], 1)
    some = np.maximum(words, 1)
    upper, bang, mark = got["upper"] / letters, got["bang"] / some, got["mark"] / some
    share = repeats / some
    text_first = np.concatenate([[0], np.cumsum([t.count(b"\n") + 1 for t in texts])]).astype(np.int64)
    same = np.zeros(n)
    same[1:] = (body[1:] == body[:-1]) & (words[1:] > 0)
    same[text_first[:-1]] = 0
    length = (chars - words) / some
    x = np.stack(
        [
            words == 0, np.log1p(size) / 5, size < 40, upper, got["digit"] / chars, got["stop"] / some, np.minimum(bang, 2),
            np.minimum(mark, 4) / 2, got["wide"] / np.maximum(size, 1), np.minimum(length, 20) / 10, length > 9, share,
            share > 0.2, upper > 0.4, bang > 0.2, mark > 0.3, same,
        ],
        axis=1,
    ).astype(np.float64)
    return Lines(x, size, text_first)


def with_neighbours(lines: Lines) -> np.ndarray:
    """Own, previous and next line's features, flags for the ends of a text, and a constant."""
    x, first = lines.x, lines.first
    n = len(x)
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    head, tail = first[:-1], first[1:] - 1
    before[head], after[tail] = 0, 0
    ends = np.zeros((n, 3))
    ends[head, 0], ends[tail, 1], ends[:, 2] = 1, 1, 1
    return np.concatenate([x, before, after, ends], axis=1)


@dataclass
class Crf:
    """weights: log odds of "good" per feature; trans[a, b]: score of label b after a (0 bad, 1 good)."""

    weights: np.ndarray
    trans: np.ndarray

    def marginals(self, emit: np.ndarray, first: np.ndarray, pairs: bool = False):
        """P(good) of every line by forward-backward; with ``pairs`` also summed pair marginals and log Z per text.

        Texts advance together: step t handles line t of all texts that have one.
        """
        count = np.diff(first)
        order = np.argsort(-count, kind="stable")
        count, head = count[order], first[:-1][order]
        alive = np.searchsorted(-count, -np.arange(int(count.max(initial=0))), side="left")
        unary = np.stack([np.zeros_like(emit), emit], axis=1)
        t = self.trans
        fwd = np.empty_like(unary)
        for step, k in enumerate(alive):
            at = head[:k] + step
            if step:
                prev = fwd[at - 1]
                fwd[at] = unary[at] + np.logaddexp(prev[:, :1] + t[0], prev[:, 1:] + t[1])
            else:
                fwd[at] = unary[at]
        bwd = np.zeros_like(unary)
        sums = np.zeros((2, 2))
        total = np.empty(len(count))
        last = head + count - 1
        total[:] = np.logaddexp(fwd[last, 0], fwd[last, 1])
        for step in range(len(alive) - 1, 0, -1):
            k = alive[step]
            at = head[:k] + step
            right = unary[at] + bwd[at]
            bwd[at - 1] = np.stack([np.logaddexp(t[a, 0] + right[:, 0], t[a, 1] + right[:, 1]) for a in (0, 1)], axis=1)
            if pairs:
                for a in (0, 1):
                    for b in (0, 1):
                        sums[a, b] += np.exp(fwd[at - 1, a] + t[a, b] + right[:, b] - total[:k]).sum()
        both = fwd + bwd
        good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
        return (good, sums, total.sum()) if pairs else good


def fit(x: np.ndarray, first: np.ndarray, labels: np.ndarray, penalty: float = 1.0, steps: int = 150) -> Crf:
    """Maximise the regularised log likelihood of line labels (each line has its document's) with Adam; deterministic."""
    y = np.repeat(labels.astype(float), np.diff(first))
    n_lines = max(len(y), 1)
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    inner = np.ones(len(y), bool)
    inner[first[:-1]] = False
    seen = np.zeros((2, 2))
    pos = np.flatnonzero(inner)
    np.add.at(seen, (y[pos - 1].astype(int), y[pos].astype(int)), 1)
    for step in range(1, steps + 1):
        crf = Crf(theta[:-4], theta[-4:].reshape(2, 2))
        good, sums, _ = crf.marginals(x @ crf.weights, first, pairs=True)
        grad = np.concatenate([x.T @ (y - good), (seen - sums).ravel()]) - penalty * theta
        grad /= n_lines
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Crf(theta[:-4], theta[-4:].reshape(2, 2))


def score_texts(crf: Crf, texts: list[bytes]) -> np.ndarray:
    """Quality of each text: mean P(good) of its lines weighted by their bytes (a text without bytes: plain mean)."""
    lines = line_features(texts)
    good = crf.marginals(with_neighbours(lines) @ crf.weights, lines.first)
    weight = lines.size.astype(float)
    cut = lines.first[:-1]
    empty = np.add.reduceat(weight, cut) == 0
    weight[np.repeat(empty, np.diff(lines.first))] = 1
    return np.clip(np.add.reduceat(weight * good, cut) / np.add.reduceat(weight, cut), 0, 1)


def line_span(text: bytes, h: int, most: int) -> bytes:
    """The text, or ``most`` of its lines in a row that begin where ``h`` says."""
    n = text.count(b"\n") + 1
    if n <= most:
        return text
    lines = text.split(b"\n")
    at = h % (n - most + 1)
    return b"\n".join(lines[at : at + most])


def held_out(id_col: str | Column = "doc_id", folds: int = 5, fold: int = 0) -> Column:
    """Is a row's crc32(id as text) mod ``folds`` the fold that learning leaves out? A null id counts as empty text."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % folds == fold


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES,
) -> Crf:
    """Fit on the labelled documents (label 0 or 1, id not null) of the ``sample_docs`` smallest id hashes.

    That bound, and ``sample_lines`` lines of a document, are the only limits, and of fitting only. A longer document is
    learned from by a span of so many lines that begins where its text's hash says. Rows that share an id count towards
    the bound, too. The ids of the sample are broadcast (at most ``sample_docs``); line features are made in tasks and
    gathered on the driver. Without any label, or with one class only, the model scores every line alike.
    """
    ship(docs.sparkSession)
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    marked = marked.select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("__y")).distinct()
    pick = marked.orderBy(F.xxhash64("__id"), "__id", "__y").limit(sample_docs)
    src = docs.select(F.col(id_col).alias("__id"), as_bytes(text_col).alias("text")).join(F.broadcast(pick), "__id")
    src = src.withColumn("h", F.xxhash64("text"))

    @F.arrow_udf("binary")
    def features(text: pa.Array, h: pa.Array) -> pa.Array:
        out, at = [], 0
        for part in byte_slices(text, SLICE):
            spans = [line_span(t, n, sample_lines) for t, n in zip(part.to_pylist(), h.slice(at, len(part)).to_pylist(), strict=True)]
            at += len(part)
            lines = line_features(spans)
            out += [lines.x[a:b].astype("<f4").tobytes() for a, b in zip(lines.first, lines.first[1:], strict=False)]
        return pa.array(out, pa.binary())

    found = src.select("__id", "__y", "h", features("text", "h").alias("x"))
    rows = found.orderBy(F.xxhash64("__id"), "__id", "__y", "h").limit(sample_docs).collect()
    if not rows or len({r["__y"] for r in rows}) < 2:
        level = rows[0]["__y"] if rows else 0.5
        weights = np.zeros(3 * WIDTH + 3)
        weights[-1] = np.log((level + 0.01) / (1.01 - level))
        return Crf(weights, np.zeros((2, 2)))
    rows.sort(key=lambda r: (r["__id"], r["__y"], r["h"]))
    parts = [np.frombuffer(bytes(r["x"]), "<f4").reshape(-1, WIDTH).astype(float) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    x = with_neighbours(Lines(np.concatenate(parts), np.zeros(first[-1], np.int64), first))
    return fit(x, first, np.array([r["__y"] for r in rows]))


def scorer(crf: Crf):
    """Arrow UDF: UTF-8 bytes -> quality score from 0 to 1 (a few kilobytes of model travel with it)."""

    @F.arrow_udf("double")
    def run(text: pa.Array) -> pa.Array:
        out = [score_texts(crf, part.to_pylist()) for part in byte_slices(text, SLICE)]
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return run.asNondeterministic()


def quality(docs: DataFrame, crf: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) per row; null text counts as empty, predicted is 1 from 0.3 on."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), scorer(crf)(as_bytes(text_col)).alias("score"))
    return src.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, crf: Crf, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """Rows of ``docs`` whose score is at least ``least``, with their columns."""
    ship(docs.sparkSession)
    return docs.withColumn("__score", scorer(crf)(as_bytes(text_col))).where(F.col("__score") >= least).select(*docs.columns)

"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad.  A line's features are its length,
character classes, word repetition and shape, in steps, for itself and for
the lines before and after.  The field has weights for features and for
pairs of neighbouring states; forward-backward gives each line's marginal.
The length-weighted mean of the lines' P(good) is the document's quality,
and a logistic curve turns it into the probability of label 1.

Training takes a bounded sample of labelled rows (``SAMPLE`` per label, by
hash of the id; of several texts of one id the smallest).  Labels name documents, not lines: lines start with their
document's label, and after a first fit the lines of bad documents that look
good become good (at least one stays bad), and the field is fitted again.
The driver holds the sample's line features, not its text.

Defined cases: null, empty and blank texts have no line and get the score of
quality 0; one line is a chain of one; very long texts are scored whole, a
chunk of at most ``CHUNK`` bytes of short texts or one long text at a time;
repeated rows are scored each; without labels the score is 0.5 times quality.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.llm.common import list_array, store, table, utf8
from tabprep.llm.language import fold
from tabprep.llm.toxicity import sampled_ids

SAMPLE, CHUNK, STATES = 2500, 1 << 20, 2
#: Character classes of a byte.
UPPER, LOWER, DIGIT, SPACE, STOP, PIPE, SYMBOL, OTHER = range(8)
_CLASS = np.full(256, SYMBOL, np.uint8)
_CLASS[ord("A"):ord("Z") + 1] = UPPER
_CLASS[ord("a"):ord("z") + 1] = LOWER
_CLASS[ord("0"):ord("9") + 1] = DIGIT
_CLASS[[9, 11, 12, 13, 32]] = SPACE
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = STOP
_CLASS[[ord(c) for c in "|"]] = PIPE
_CLASS[0x80:] = OTHER
#: Steps that cut each measure; its features are one-hot cells.
CUTS = {
    "length": [8, 20, 40, 80, 160, 320, 640, 1280, 2560],
    "upper": [0.005, 0.02, 0.05, 0.15, 0.4, 0.7],
    "digit": [0.001, 0.02, 0.1, 0.3],
    "space": [0.05, 0.1, 0.14, 0.18, 0.25, 0.4],
    "stop": [0.002, 0.01, 0.02, 0.04, 0.08, 0.2],
    "pipe": [0.0001, 0.01, 0.05],
    "symbol": [0.0001, 0.01, 0.05, 0.15, 0.3],
    "other": [0.0001, 0.02, 0.1, 0.3],
    "distinct": [0.2, 0.4, 0.6, 0.75, 0.85, 0.92, 0.97],
    "repeat": [0.001, 0.02, 0.1, 0.3, 0.6],
    "words": [1, 2, 3, 5, 10, 20, 40, 100, 300],
    "word length": [2, 3, 4, 5, 6, 7, 9, 15],
    "ends": [0.5],
    "starts": [0.5],
}
_WIDTH = [len(c) + 1 for c in CUTS.values()]
_BASE = np.cumsum([0, *_WIDTH])
PER_LINE = len(CUTS)
N_FEATURES = int(_BASE[-1])


def lines_of(text: bytes) -> list[bytes]:
    """Lines that are not blank."""
    return [x for x in text.split(b"\n") if x and not x.isspace()]


def line_features(lines: list[bytes]) -> np.ndarray:
    """(lines x PER_LINE) feature numbers of the lines themselves."""
    if not lines:
        return np.zeros((0, PER_LINE), np.int16)
    size = np.array([len(x) for x in lines])
    start = np.cumsum(size) - size
    kind = _CLASS[np.frombuffer(b"".join(lines), np.uint8)]
    share = np.stack([np.add.reduceat((kind == k).astype(np.int32), start) for k in range(8)], axis=1) / size[:, None]
    words = np.zeros((len(lines), 4))
    for i, x in enumerate(lines):
        w = x.split()
        n = len(w)
        words[i] = n, len(set(w)) / n if n else 1.0, sum(map(bytes.__eq__, w, w[1:])) / n if n else 0.0, len(x) / max(n, 1)
    last = np.array([x.rstrip()[-1:] in b".!?" and x.rstrip() != b"" for x in lines])
    first = share[:, 0] * 0 + (kind[start] == UPPER)
    measures = [size, share[:, UPPER], share[:, DIGIT], share[:, SPACE], share[:, STOP], share[:, PIPE], share[:, SYMBOL],
                share[:, OTHER], words[:, 1], words[:, 2], words[:, 0], words[:, 3], last, first]
    return np.stack([b + np.searchsorted(c, m, "right") for m, c, b in zip(measures, CUTS.values(), _BASE)],
                    axis=1).astype(np.int16)


def emissions(features: np.ndarray, lengths: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Score of the good state of each line: own features and those of its neighbours.

    ``weights``: 3 x (N_FEATURES + 1): own, previous, next line; the last
    column stands for a missing neighbour (own: the offset).
    """
    own = weights[0][features].sum(axis=1) + weights[0][-1]
    ends = np.cumsum(lengths)
    ends, firsts = ends[lengths > 0], (ends - lengths)[lengths > 0]
    for side, at_edge in ((1, firsts), (2, ends - 1)):
        part = weights[side][features].sum(axis=1)
        moved = np.roll(part, 1 if side == 1 else -1)
        moved[at_edge] = weights[side][-1]
        own = own + moved
    return own


def forward_backward(score: np.ndarray, lengths: np.ndarray, pair: np.ndarray):
    """P(good) of each line, and P(state pair) of each two neighbouring lines (by the later one's place).

    All documents advance together, longest first, so a step is one operation
    on those that still have a line; messages are normalised at each step.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    size = lengths[order]
    live = [int(np.searchsorted(-size, -t, "left")) for t in range(int(size[0]) if len(size) else 0)]
    emit = np.stack([np.exp(-np.logaddexp(0, score)), np.exp(-np.logaddexp(0, -score))], axis=1)
    alpha, beta, move = np.zeros((len(score), 2)), np.ones((len(score), 2)), np.exp(pair)
    for t, n in enumerate(live):
        at = starts[:n] + t
        a = emit[at] * (alpha[at - 1] @ move if t else 1.0)
        alpha[at] = a / np.maximum(a.sum(axis=1, keepdims=True), 1e-300)
    for t in range(len(live) - 2, -1, -1):
        at = starts[:live[t + 1]] + t
        b = (emit[at + 1] * beta[at + 1]) @ move.T
        beta[at] = b / np.maximum(b.sum(axis=1, keepdims=True), 1e-300)
    p = alpha * beta
    p /= np.maximum(p.sum(axis=1, keepdims=True), 1e-300)
    first = np.zeros(len(score), bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    later = np.flatnonzero(~first)
    both = alpha[later - 1][:, :, None] * move * (emit[later] * beta[later])[:, None, :]
    both /= np.maximum(both.sum(axis=(1, 2), keepdims=True), 1e-300)
    return p[:, 1], both


def _gradient(theta: np.ndarray, features: np.ndarray, lengths: np.ndarray, state: np.ndarray, weight: np.ndarray,
              l2: float) -> np.ndarray:
    """Gradient of ``l2 / 2 |theta|^2`` less the documents' log P(states), each times its weight, per weighted line."""
    w, pair = theta[:-4].reshape(3, -1), theta[-4:].reshape(2, 2)
    line_weight = np.repeat(weight, lengths)
    total = max(line_weight.sum(), 1e-300)
    ends = np.cumsum(lengths)
    last, first = (ends - 1)[lengths > 0], (ends - lengths)[lengths > 0]
    later = np.delete(np.arange(len(state)), first)
    p, both = forward_backward(emissions(features, lengths, w), lengths, pair)
    err = (p - state) * line_weight / total
    before, after = np.roll(err, -1), np.roll(err, 1)  # a line is the previous one of the next, and so on
    before[last] = 0
    after[first] = 0
    g = np.zeros((3, N_FEATURES + 1))
    for k, e in enumerate((err, before, after)):
        g[k, :-1] = np.bincount(features.ravel(), np.repeat(e, PER_LINE), N_FEATURES)
    g[0, -1], g[1, -1], g[2, -1] = err.sum(), err[first].sum(), err[last].sum()
    pairs = (both * line_weight[later, None, None]).sum(axis=0)
    np.subtract.at(pairs, (state[later - 1], state[later]), line_weight[later])
    return np.concatenate([g.ravel(), pairs.ravel() / total]) + l2 * theta


def train_field(features: np.ndarray, lengths: np.ndarray, state: np.ndarray, weight: np.ndarray, rounds: int = 60,
                rate: float = 0.1, l2: float = 2e-4, start=None):
    """Weights (3 x features) and pair scores by Adam on the conditional likelihood of the states,
    every document with its weight in the lines' and the pairs' part alike."""
    theta = np.zeros(3 * (N_FEATURES + 1) + 4) if start is None else start.copy()
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        grad = _gradient(theta, features, lengths, state, weight, l2)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
    return theta


def document_quality(features, sizes, lengths, theta) -> np.ndarray:
    """Length-weighted mean of the lines' P(good); 0 without lines."""
    if not len(features):
        return np.zeros(len(lengths))
    p, _ = forward_backward(emissions(features, lengths, theta[:-4].reshape(3, -1)), lengths, theta[-4:].reshape(2, 2))
    doc = np.repeat(np.arange(len(lengths)), lengths)
    return np.bincount(doc, p * sizes, len(lengths)) / np.maximum(np.bincount(doc, sizes, len(lengths)), 1)


def _curve(quality: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(label 1) over the log odds of quality, by Newton steps."""
    x = np.stack([_odds(quality), np.ones(len(quality))], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (weight * (p * (1 - p) + 1e-6))[:, None]).T @ x + 1e-3 * np.eye(2)
        b = b - np.linalg.solve(h, x.T @ (weight * (p - label)) + 1e-3 * (b - [1.0, 0.0]))
    return float(b[0]), float(b[1])


def _odds(q: np.ndarray) -> np.ndarray:
    q = np.clip(q, 1e-4, 1 - 1e-4)
    return np.log(q / (1 - q))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
        sample: int = SAMPLE):
    """(field weights, (slope, offset)) from a bounded sample of the labelled rows."""
    notes = labels.where(qcol(key).isNotNull() & qcol(label).isNotNull()).groupBy(
        qcol(key).cast("long").alias("_id")).agg(F.min(qcol(label)).cast("int").alias("note"))
    total = {r["note"]: r["count"] for r in notes.groupBy("note").count().collect()}
    ids = store(sampled_ids(notes, sample, "quality-sample"), "quality-sample")
    train = docs.select(qcol(key).cast("long").alias("_id"), utf8(qcol(text)).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [lines_of(body.as_py()) for body in batch.column(0)]
            yield pa.RecordBatch.from_arrays([
                batch.column(2), batch.column(1), list_array([line_features(x).ravel() for x in lines], pa.int16()),
                list_array([np.array([len(y) for y in x], np.int64) for x in lines], pa.int32())],
                ["_id", "note", "features", "sizes"])

    # a text an id, so the sample bounds rows, whatever repeats
    texts = train.join(F.broadcast(ids), "_id").groupBy("_id", "note").agg(F.min("body").alias("body"))
    rows = texts.select("body", "note", "_id").mapInArrow(
        run, "_id long, note int, features array<smallint>, sizes array<int>").orderBy("_id").toArrow()
    note = rows.column("note").to_numpy().astype(np.int64)
    flat = lambda name: rows.column(name).combine_chunks().flatten().to_numpy()
    if not len(note):
        return None
    features, sizes = flat("features").reshape(-1, PER_LINE).astype(np.int64), flat("sizes").astype(float)
    lengths = rows.column("sizes").combine_chunks().value_lengths().to_numpy().astype(np.int64)
    has = lengths > 0
    weight = np.array([total[k] / max(1, (note == k).sum()) for k in note])  # as common as in all labelled rows
    weight = weight / weight.mean()
    doc = np.repeat(np.arange(len(note)), lengths)
    state = note[doc]
    even = 1 / np.maximum(lengths, 1)  # each document counts alike, by its lines
    theta = train_field(features, lengths, state, even)
    p, _ = forward_backward(emissions(features, lengths, theta[:-4].reshape(3, -1)), lengths, theta[-4:].reshape(2, 2))
    # lines of bad documents that look good become good, but for the worst one
    worst = np.zeros(len(p), bool)
    order = np.lexsort((p, doc))
    worst[order[np.concatenate([[True], doc[order][1:] != doc[order][:-1]])]] = True
    state = np.where((state == 0) & (p > 0.5) & ~worst, 1, state)
    theta = train_field(features, lengths, state, even, start=theta)
    quality = document_quality(features, sizes, lengths, theta)
    return theta, _curve(quality[has], note[has], weight[has])


def score(docs: DataFrame, model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, score, line_quality) of every whole text."""

    def chunked(column) -> Iterator[list[list[bytes]]]:
        held, lines = 0, []
        for body in column:
            lines.append(lines_of(body.as_py()))
            held += sum(map(len, lines[-1]))
            if held >= CHUNK:
                yield lines
                held, lines = 0, []
        if lines:
            yield lines

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.zeros(0)]
            for lines in chunked(batch.column(1)):
                flat = [x for own in lines for x in own]
                sizes = np.array([len(x) for x in flat], float)
                lengths = np.array([len(x) for x in lines])
                parts.append(document_quality(line_features(flat).astype(np.int64), sizes, lengths, model[0])
                             if model else np.array([float(n > 0) for n in lengths]))
            q = np.concatenate(parts)
            slope, offset = model[1] if model else (1.0, 0.0)
            out = 1 / (1 + np.exp(-np.clip(slope * _odds(q) + offset, -30, 30))) if model else 0.5 * q
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out), pa.array(q)], [key, "score", "line_quality"])

    rows = docs.select(qcol(key), utf8(qcol(text)).alias("body"))
    return rows.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, score double, line_quality double")


def op4_line_crf_quality(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    model = fit(docs.where(fold("doc_id", 5) != 0), labels)
    return score(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                                     (F.col("score") >= 0.3).cast("int").alias("predicted"), "line_quality")

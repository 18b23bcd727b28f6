"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line's score is linear in thresholds of its
own measures (letters, symbols, capitals, repetition, length, copies of the line in the
text) and in those of the lines before and after it; neighbouring labels share
transition scores. Forward-backward gives each line's probability of being good, and
their mean weighted by line length, calibrated, is the document's score.

Labels come by document, so training alternates: fit the field, then let the lines of
bad documents that look good become good -- all but the worst line, which keeps the document's label.
Training uses a bounded sample; scoring reads every line of every text.
"""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm import common, labelled

TRAIN_DOCS = 3000
#: Lines of the sample at most, over whole documents: those that would exceed it are left out. Scoring has no such bound.
TRAIN_LINES = 200_000
FOLDS, HELD_OUT = 5, 0
CUT = 0.3

_CLASSES = (
    bytes(range(ord("A"), ord("Z") + 1)),
    bytes(range(ord("a"), ord("z") + 1)) + bytes(range(128, 256)),
    b"0123456789",
    b"#$%&*+/<=>@[\\]^_`{|}~",
    b"!?",
    b".,;:'\"()-",
)
_DOUBLED = re.compile(r"([^\w\s])\1").findall
_STEPS = (0.02, 0.08, 0.2, 0.4, 0.7)
_MEASURES = 14


def line_measures(line: str, copies: int) -> list[float]:
    """Numbers between 0 and 1 that describe one line, which the text has ``copies`` times."""
    data = line.encode("utf-8", "replace")
    n = len(data)
    if not n:
        return [0.0] * (_MEASURES - 1) + [1.0]
    words = line.split()
    w = len(words) or 1
    upper, lower, digit, symbol, shout, stop = (n - len(data.translate(None, c)) for c in _CLASSES)
    lasts = "".join([x[-1] for x in words]).encode("utf-8", "replace")
    odd_ends = len(lasts) - len(lasts.translate(None, _CLASSES[3] + _CLASSES[4]))
    three = len(set(zip(words, words[1:], words[2:]))) / (w - 2) if w > 2 else 1.0
    return [
        upper / max(upper + lower, 1), digit / n, symbol / n * 2, shout / n * 2, stop / n,
        len(_DOUBLED(line)) / w,
        odd_ends / w,
        data.count(b"|") / w,
        sum(map(operator.eq, words, words[1:])) / w,
        1 - len(set(words)) / w,
        1 - three,
        min(n / w / 25, 1.0),
        min(math.log1p(n) / 10, 1.0),
        1 - 1 / copies,
    ]


def text_measures(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(measures, lengths) of all lines of a text; a text without characters is one empty line."""
    lines = text.split("\n")
    copies = Counter(lines)
    return (np.array([line_measures(x, copies[x]) for x in lines], dtype=np.float32),
            np.array([len(x) + 1 for x in lines], dtype=np.float64))


def _expand(measures: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Features of lines: thresholds of their own measures, of the line before and of the line
    after (zero beyond the text's ends), whether it equals them in length and words, and ends."""
    steps = np.array(_STEPS, dtype=np.float32)
    own = (measures[:, :, None] > steps).reshape(len(measures), -1).astype(np.float32)
    first = np.zeros(len(own), dtype=bool)
    first[starts] = True
    last = np.roll(first, -1)
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[last] = 0, 0
    change = np.abs(measures - np.roll(measures, 1, axis=0)).max(axis=1) < 1e-6
    same_before = change & ~first
    same_after = np.roll(change, -1) & ~last
    return np.hstack([own, before, after, measures,
                      np.column_stack([first, last, same_before, same_after, np.ones(len(own))]).astype(np.float32)])


def marginals(unary: list[float], stay: tuple[float, float, float, float]) -> list[float]:
    """Probability of label 1 for each line of a chain, by forward-backward in log odds.

    ``unary``: scores of label 1; ``stay``: transition scores (00, 01, 10, 11).
    """
    t00, t01, t10, t11 = stay
    n = len(unary)

    def message(odds: float, a00: float, a01: float, a10: float, a11: float) -> float:
        # log of what reaches 1 over what reaches 0, from a neighbour with these log odds
        return _add(a01, odds + a11) - _add(a00, odds + a10)

    forward = [0.0] * n
    at = 0.0
    for i in range(n):
        forward[i] = at = unary[i] + (message(at, t00, t01, t10, t11) if i else 0.0)
    out = [0.0] * n
    back = 0.0
    for i in range(n - 1, -1, -1):
        out[i] = _sigmoid(forward[i] + back)
        back = message(unary[i] + back, t00, t10, t01, t11)
    return out


def _add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b - a > -40 else a


def _sigmoid(x: float) -> float:
    if x >= 0:
        return 1 / (1 + math.exp(-min(x, 700)))
    e = math.exp(max(x, -700))
    return e / (1 + e)


@dataclass
class Model:
    """Weights of the field (label 1 is bad) and of the calibration."""

    weights: np.ndarray
    stay: tuple[float, float, float, float]
    slope: float
    offset: float

    def good_share(self, texts: list[str]) -> list[float]:
        """Length-weighted mean probability of good lines, for each text."""
        read = [text_measures(t) for t in texts]
        starts = np.cumsum([0] + [len(n) for _, n in read])
        out = []
        x = _expand(np.concatenate([m for m, _ in read]), starts[:-1]) if read else None
        for k, (_, lengths) in enumerate(read):
            bad = marginals((x[starts[k]: starts[k + 1]] @ self.weights).tolist(), self.stay)
            out.append(1 - float(np.dot(bad, lengths) / lengths.sum()))
        return out

    def scores(self, texts: list[str]) -> list[float]:
        return [_sigmoid(self.slope * _logit(g) + self.offset) for g in self.good_share(texts)]


def _logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))


def _chain_pass(unary: np.ndarray, mask: np.ndarray, trans: np.ndarray):
    """Batched forward-backward over padded chains: (log partition sum, P(label 1), pair counts)."""
    d, t = unary.shape
    emit = np.stack([np.zeros_like(unary), unary], axis=2)
    alpha = np.empty((d, t, 2))
    alpha[:, 0] = emit[:, 0]
    for i in range(1, t):
        step = np.logaddexp(alpha[:, i - 1, :1] + trans[0], alpha[:, i - 1, 1:] + trans[1]) + emit[:, i]
        alpha[:, i] = np.where(mask[:, i, None], step, alpha[:, i - 1])
    beta = np.zeros((d, t, 2))
    for i in range(t - 2, -1, -1):
        into = emit[:, i + 1] + beta[:, i + 1]
        step = np.logaddexp(into[:, :1] + trans[:, 0], into[:, 1:] + trans[:, 1])
        beta[:, i] = np.where(mask[:, i + 1, None], step, 0)
    total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    one = np.exp(np.minimum(alpha[:, :, 1] + beta[:, :, 1] - total[:, None], 0)) * mask
    pairs = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            p = np.exp(alpha[:, :-1, a] + trans[a, b] + emit[:, 1:, b] + beta[:, 1:, b] - total[:, None])
            pairs[a, b] = (p * mask[:, 1:]).sum()
    return total.sum(), one, pairs


@dataclass
class _Chains:
    """Documents of similar length: their rows, and their lines as padded places."""
    docs: np.ndarray
    lines: np.ndarray
    mask: np.ndarray


def _by_length(starts: np.ndarray) -> list[_Chains]:
    """All documents, in groups within a power of two of lines, so that few long ones do not pad the others."""
    sizes = np.diff(starts)
    power = np.ceil(np.log2(np.maximum(sizes, 8))).astype(int)
    out = []
    for b in np.unique(power):
        docs = np.flatnonzero(power == b)
        places = np.arange(sizes[docs].max())
        out.append(_Chains(docs, np.minimum(starts[docs, None] + places, starts[docs + 1, None] - 1), places < sizes[docs, None]))
    return out


def _fit_field(x, chains: list[_Chains], weights, trans, labels: list[np.ndarray], share, rounds: int, penalty: float = 0.3):
    """Adam on the penalised conditional likelihood; ``labels`` are those of the chains' places."""
    n = sum(c.mask.sum() for c in chains)
    seen = np.zeros((2, 2))
    for c, y in zip(chains, labels):
        for a in (0, 1):
            for b in (0, 1):
                seen[a, b] += ((y[:, :-1] == a) & (y[:, 1:] == b) & c.mask[:, 1:]).sum()
    m1, m2 = np.zeros(len(weights)), np.zeros(len(weights))
    p1, p2 = np.zeros((2, 2)), np.zeros((2, 2))
    for k in range(1, rounds + 1):
        unary = x @ weights
        per_line, pairs = np.zeros(len(x)), np.zeros((2, 2))
        for c, y in zip(chains, labels):
            _, one, both = _chain_pass(np.where(c.mask, unary[c.lines], 0), c.mask, trans)
            pairs += both
            per_line[c.lines[c.mask]] += (y - one)[c.mask]
        grad = x.T @ per_line / n - penalty * weights / n
        grad_t = (seen - pairs) / n - penalty * trans / n
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        p1, p2 = 0.9 * p1 + 0.1 * grad_t, 0.99 * p2 + 0.01 * grad_t**2
        rate = share / math.sqrt(k / 20 + 1)
        weights = weights + rate * (m1 / (1 - 0.9**k)) / (np.sqrt(m2 / (1 - 0.99**k)) + 1e-8)
        trans = trans + rate * (p1 / (1 - 0.9**k)) / (np.sqrt(p2 / (1 - 0.99**k)) + 1e-8)
    return weights, trans


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> Model:
    """From ``(y, measures, lengths)`` of sampled documents; y is 1 for good documents.

    Without both classes the model scores every text by the (smoothed) share of good ones.
    """
    good = sum(y for y, _, _ in rows)
    prior = math.log((good + 1) / (len(rows) - good + 1))
    columns = _expand(np.zeros((1, _MEASURES), np.float32), np.array([0])).shape[1]
    if not rows or good in (0, len(rows)):
        return Model(np.zeros(columns, np.float32), (0.0, 0.0, 0.0, 0.0), 0.0, prior)
    starts = np.cumsum([0] + [len(n) for _, _, n in rows])
    x = _expand(np.concatenate([m for _, m, _ in rows]), starts[:-1]).astype(np.float64)
    chains = _by_length(starts)
    bad_doc = np.array([1 - y for y, _, _ in rows])
    all_lengths = np.concatenate([n for _, _, n in rows])
    labels = [np.where(c.mask, bad_doc[c.docs, None], 0) for c in chains]
    weights, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    share = np.zeros(len(rows))
    for rounds in (80, 60, 60):
        weights, trans = _fit_field(x, chains, weights, trans, labels, 0.1, rounds)
        unary = x @ weights
        labels = []
        for c in chains:
            _, one, _ = _chain_pass(np.where(c.mask, unary[c.lines], 0), c.mask, trans)
            lengths, bad = all_lengths[c.lines], bad_doc[c.docs]
            worst = np.where(c.mask, one * np.sqrt(lengths), -1).argmax(axis=1)
            y = np.where(c.mask & (bad[:, None] == 1) & (one > 0.5), 1, 0)
            y[np.flatnonzero(bad), worst[np.flatnonzero(bad)]] = 1
            labels.append(y)
            share[c.docs] = 1 - (one * lengths * c.mask).sum(axis=1) / (lengths * c.mask).sum(axis=1)
    slope, offset = _calibrate(np.array([_logit(g) for g in share]), 1 - bad_doc)
    flat = tuple(float(v) for v in trans.reshape(-1))
    return Model(weights.astype(np.float32), flat, slope, offset)


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on one number, by Newton steps with a light penalty."""
    beta = np.array([1.0, 0.0])
    design = np.column_stack([z, np.ones(len(z))])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (y - p) - 1.0 * (beta - [1.0, 0.0])
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hess, grad), -2, 2)
    return max(float(beta[0]), 0.0), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS, max_lines: int = TRAIN_LINES) -> Model:
    """Fit on at most ``limit`` documents outside the held-out fold, each with all its lines and ``max_lines`` in all: in
    the sample's order, documents that would exceed them are left out. Measures are taken in tasks; the
    driver gets one small row a sampled document and ``_MEASURES`` numbers a line."""
    common.ship_package(docs.sparkSession)
    sample = common.cut(labelled.training_sample(docs, labels, "quality", FOLDS, HELD_OUT, limit))
    lines = F.size(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"))
    chosen, room = set(), max_lines
    for r in sorted(sample.select(F.xxhash64("doc_id").alias("h"), "doc_id", lines.alias("n")).collect()):
        if r.n <= room:
            chosen.add(r.doc_id)
            room -= r.n
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("m", pa.binary()), ("n", pa.binary())])

    def run(batches):
        for batch in batches:
            for part, found in common.texts(batch):
                ids, ys = part.column("doc_id").to_pylist(), part.column("y").to_pylist()
                taken = [(i, y, *text_measures(t)) for i, y, t in zip(ids, ys, found) if i in chosen]
                yield common.out_batch(schema, [i for i, _, _, _ in taken], [y for _, y, _, _ in taken],
                                       [m.tobytes() for _, _, m, _ in taken], [n.tobytes() for _, _, _, n in taken])

    rows = sample.select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y int, m binary, n binary").collect()
    rows.sort(key=lambda r: r.doc_id)
    return fit([(r.y, np.frombuffer(r.m, np.float32).reshape(-1, _MEASURES), np.frombuffer(r.n, np.float64))
                for r in rows])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: better) appended; columns of that name are replaced.

    A null text scores as an empty one. The columns of ``docs`` pass through the tasks unread.
    """
    common.ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some hundred numbers

    @F.pandas_udf("double")
    def scored(text):
        import pandas as pd
        values = [t or "" for t in text.tolist()]
        out: list[float] = []
        for at in range(0, len(values), 256):
            out += shared.value.scores(values[at: at + 256])
        return pd.Series(out, dtype="float64")

    return docs.withColumn("score", scored(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out`` (fold 0 of 5 by crc32 of the id), ``score``,
    ``predicted`` (1 if ``score >= 0.3``).

    Null and empty texts are one empty line and get that line's score. A null id is in no fold:
    ``held_out`` is false. Repeated rows keep their rows. Without labels of both classes all texts get the
    smoothed share of good ones. An empty table gives no row.
    """
    model = train(docs, labels)
    return score(docs.select(F.col("doc_id").cast("long"), "text"), model).select(
        "doc_id", F.coalesce(labelled.fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their own columns."""
    model = train(docs, labels)
    own = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    return score(own, model).where(F.col("score") >= CUT).select("row.*")

"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  A line's score is linear in its own features and those of the
lines before and after it; neighbouring states have learned transition scores.  The field is
trained on lines that carry their document's label.  A document's quality is the mean of the
lines' forward-backward marginals, weighted by their length."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import chosen_by_hash, lowered, ship, slices, span_hashes, text_bytes, word_spans
from barwright.llm.language import held_out

FEATURES = [
    "length", "upper", "symbols", "bars", "exclaims", "digits", "marks", "word_length",
    "short_words", "same_as_before", "new_words", "repeated_line", "ends_sentence", "blank",
]
CHUNK = 64  # lines of a training sequence; longer documents give several


def _is(chars: str) -> np.ndarray:
    out = np.zeros(256, np.int32)
    out[[ord(c) for c in chars]] = 1
    return out


_UPPER = _is("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER + _is("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _is("0123456789")
_SYMBOL = _is("#$%&*+/<=>@[\\]^_{}~")
_BAR, _EXCLAIM, _MARK = _is("|"), _is("!"), _is(".,;:?'\"()-")


def line_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, their lengths in bytes, and the first line of each row.  A line
    feed parts lines; an empty text has no line."""
    feeds = np.flatnonzero(data == 10)
    rows = bounds[:-1][np.diff(bounds) > 0]
    starts = np.union1d(rows, feeds[feeds + 1 < len(data)] + 1)
    ends = np.append(starts[1:], len(data))
    ends = ends - ((ends > starts) & (data[ends - 1] == 10)) if len(starts) else ends
    size = (ends - starts).astype(np.float64)

    def count(table: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int32)
        np.cumsum(table[data], out=sums[1:])
        return (sums[ends] - sums[starts]).astype(np.float64)

    ws, we = word_spans(data, bounds)
    words = span_hashes(lowered(data), ws, we)
    line = np.searchsorted(starts, ws, "right") - 1
    n = np.bincount(line, minlength=len(starts)).astype(np.float64)
    per_word = lambda x: np.bincount(line, x, len(starts)) / np.maximum(n, 1)
    same = np.zeros(len(ws))
    same[1:] = (words[1:] == words[:-1]) & (line[1:] == line[:-1])
    new = ~pd.Series(words ^ (line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))).duplicated().to_numpy()
    row = np.searchsorted(bounds, starts, "right") - 1
    whole = span_hashes(data, starts, ends) ^ (row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    letters = count(_LETTER)
    safe = np.maximum(size, 1)
    last = data[np.maximum(ends - 1, 0)] if len(data) else np.empty(0, np.uint8)
    out = np.stack([
        np.log1p(size), count(_UPPER) / np.maximum(letters, 1), count(_SYMBOL) / safe, count(_BAR) / safe,
        count(_EXCLAIM) / safe, count(_DIGIT) / safe, count(_MARK) / safe,
        per_word((we - ws).astype(np.float64)), per_word(((we - ws) <= 3).astype(np.float64)),
        per_word(same), per_word(new.astype(np.float64)),
        pd.Series(whole).duplicated(keep=False).to_numpy().astype(np.float64),
        _is(".?")[last].astype(np.float64), (n == 0).astype(np.float64),
    ], axis=1) if len(starts) else np.empty((0, len(FEATURES)))
    return out, size, np.searchsorted(starts, bounds)


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after in the same row (zeros where there is
    none), and a constant."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    edge = first[:-1][np.diff(first) > 0]
    before[edge] = 0
    after[edge[1:] - 1] = 0
    return np.concatenate([x, before, after, np.ones((len(x), 1))], axis=1)


def marginals(score: np.ndarray, first: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over the chains ``first[i] .. first[i + 1]``, all chains at once:
    chance of a good line, and the expected transitions.  ``score`` is that of good less that
    of bad; ``change`` holds the transition scores (from, to)."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    length, begin = length[order], first[:-1][order]
    own = np.stack([np.ones(len(score)), np.exp(np.clip(score, -30, 30))], axis=1)
    step = np.exp(change)
    forward, backward = np.empty_like(own), np.ones_like(own)
    longest = int(length.max(initial=0))
    alive = np.searchsorted(-length, -np.arange(longest), "left")  # chains with a line t
    now = None
    for t in range(longest):
        at = begin[: alive[t]] + t
        now = own[at] if t == 0 else own[at] * (now[: alive[t]] @ step)
        now = now / now.sum(axis=1, keepdims=True)
        forward[at] = now
    for t in range(longest - 2, -1, -1):
        at = begin[: alive[t + 1]] + t
        now = (own[at + 1] * backward[at + 1]) @ step.T
        backward[at] = now / now.sum(axis=1, keepdims=True)
    both = forward * backward
    good = both[:, 1] / both.sum(axis=1)
    inner = np.setdiff1d(np.arange(len(score)), first[:-1][np.diff(first) > 0], assume_unique=True)
    pair = forward[inner - 1][:, :, None] * step * (own[inner] * backward[inner])[:, None, :]
    return good, (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    change: np.ndarray

    def line_scores(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return with_neighbours(np.clip((x - self.mean) / self.scale, -4, 4), first) @ self.weights


def fit(x: np.ndarray, first: np.ndarray, label: np.ndarray, rate: float, rounds: int = 200, ridge: float = 1e-3) -> Model:
    """Maximum likelihood by gradient steps with momentum and per-weight scale.  The sample
    holds both labels alike; weights give them back their share (``rate`` of label 1), so a
    line that says nothing scores like the corpus."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    model = Model(mean, scale, np.zeros(3 * x.shape[1] + 1), np.zeros((2, 2)))
    inputs = with_neighbours(np.clip((x - mean) / scale, -4, 4), first)
    chain = np.repeat(np.arange(len(label)), np.diff(first))
    y = label[chain].astype(np.float64)
    weight = np.where(y == 1, rate / max(1, (y == 1).sum()), (1 - rate) / max(1, (y == 0).sum()))
    inner = np.ones(len(y), bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    seen = np.array([[(inner & (y == 0)).sum(), 0.0], [0.0, (inner & (y == 1)).sum()]])
    theta = np.zeros(len(model.weights) + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, rounds + 1):
        good, pairs = marginals(inputs @ theta[:-4], first, theta[-4:].reshape(2, 2))
        grad = np.append(inputs.T @ (weight * (y - good)), (seen - pairs).ravel() / max(1, len(y))) - ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + 0.05 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    model.weights, model.change = theta[:-4], theta[-4:].reshape(2, 2)
    return model


def train(docs: DataFrame, labels: DataFrame, per_label: int = 1200) -> Model | None:
    """Fit on labelled documents outside the held-out fold: at most ``per_label`` of either
    label, chosen by a hash of doc_id, with all their lines.  Null ids, labels and texts are
    left out; None if a label is missing, as nothing can be learned then."""
    ship(docs.sparkSession)
    able = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = able.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rate = known.agg(F.avg("quality")).first()[0] or 0.0
    chosen = chosen_by_hash(known, "quality", per_label)

    def lines(batches):
        for part in slices(batches):
            x, _, first = line_features(*text_bytes(part.column("text")))
            n = np.diff(first)
            row = np.repeat(np.arange(len(n)), n)
            out = {name: pa.array(x[:, i]) for i, name in enumerate(FEATURES)}
            out |= {"doc_id": part.column("doc_id").take(pa.array(row)), "quality": part.column("quality").take(pa.array(row)), "line": pa.array(np.arange(len(row)) - first[row])}
            yield pa.RecordBatch.from_pydict(out)

    texts = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    schema = ", ".join(f"{n} double" for n in FEATURES) + ", doc_id long, quality int, line long"
    rows = texts.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"), "text").mapInArrow(lines, schema).toPandas()
    if rows["quality"].nunique() < 2:
        return None
    rows["chunk"] = rows["line"] // CHUNK
    rows = rows.sort_values(["doc_id", "line"], kind="stable").reset_index(drop=True)
    chain = (rows["doc_id"].ne(rows["doc_id"].shift()) | rows["chunk"].ne(rows["chunk"].shift())).to_numpy()
    first = np.append(np.flatnonzero(chain), len(rows))
    return fit(rows[FEATURES].to_numpy(), first, rows["quality"].to_numpy()[first[:-1]], float(rate))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` but one named score, with ``score`` added, between 0 and 1.

    Null, empty and blank texts have no line to speak for them: 0.  Without a model every
    other text scores 0.5.  Only ``text`` is an input."""
    ship(docs.sparkSession)
    docs = docs.drop("score")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in docs.schema.fields)}, score double"

    def rate(batches):
        for part in slices(batches):
            x, size, first = line_features(*text_bytes(part.column("text")))
            if model is None:
                good = np.full(len(x), 0.5)
            else:
                good, _ = marginals(model.line_scores(x, first), first, model.change)
            size = np.where(x[:, FEATURES.index("blank")] > 0, 0.0, size)
            row = np.repeat(np.arange(part.num_rows), np.diff(first))
            total = np.bincount(row, size, part.num_rows)
            value = np.bincount(row, size * good, part.num_rows) / np.maximum(total, 1)
            out = {n: part.column(i) for i, n in enumerate(part.schema.names)}
            yield pa.RecordBatch.from_pydict(out | {"score": pa.array(np.clip(value, 0, 1))})

    return docs.mapInArrow(rate, schema)

"""Toxicity from confirmed toxic texts and unlabelled ones (non-negative PU learning).

The classifier is linear over hashed words and word beginnings, log(1 + count) each, and the
number of words.  With g the score, l a loss and p the share of toxic texts, the risk of labelled
training is written without negatives:

    p * E_toxic[l(g)]  +  ( E_all[l(-g)] - p * E_toxic[l(-g)] )

The bracket estimates the loss on clean texts, which cannot be negative; where the sample makes
it so, the model has begun to fit single unlabelled texts, and the step goes the other way.  Only
labels of toxic texts are used (and the share of such labels, unless ``prior`` is given)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import mix, ship, slices, span_hashes, staged
from barwright.llm.language import words_of

BEGINNINGS = (4, 5, 6, 7)  # characters


def held_out(doc_id: Column) -> Column:
    """The fold kept for measuring: remainder 0 of crc32(doc_id as text) by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and 64-bit key of every word and word beginning, and the words of each row."""
    points, starts, ends, rows = words_of(texts)
    keys, of = [mix(span_hashes(points, starts, ends))], [rows]
    for n in BEGINNINGS:
        long = ends - starts >= n
        keys.append(mix(span_hashes(points, starts[long], starts[long] + n) ^ np.uint64(n)))
        of.append(rows[long])
    return np.concatenate(of), np.concatenate(keys).view(np.int64), np.bincount(rows, minlength=len(texts))


@dataclass
class Model:
    keys: np.ndarray  # sorted
    weights: np.ndarray
    bias: float
    per_length: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        row, key, words = features(texts)
        place, known = located(self.keys, key)
        cells, counts = np.unique(row[known] * max(1, len(self.keys)) + place[known], return_counts=True)
        size = max(1, len(self.keys))
        own = np.bincount(cells // size, np.log1p(counts) * self.weights[cells % size], len(texts)) if len(cells) else np.zeros(len(texts))
        return sigmoid(own + self.bias + self.per_length * length_of(words))


def located(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return place, keys[place] == key


def length_of(words: np.ndarray) -> np.ndarray:
    return np.log1p(words) / 5


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


# --- sample --------------------------------------------------------------------------


def _some(ids: DataFrame, n: int) -> DataFrame:
    """At most n ids, those with the smallest hash.  Ids beyond twice the expected border of the
    hash are dropped where they are, so the ordering sees a few thousand."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    total = ids.count()
    return ids.withColumn("__place", place).where(F.col("__place") * total <= 2.0 * n + 50).orderBy("__place", "doc_id").limit(n).drop("__place")


def sample(docs: DataFrame, labels: DataFrame, toxic: int, unlabelled: int) -> DataFrame:
    """Whole texts of at most ``toxic`` confirmed toxic documents and of ``unlabelled`` others,
    whatever their labels, outside the held-out fold; written once (label 1 and 0)."""
    train = F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    confirmed = _some(labels.where(train & (F.col("toxic") == 1)).select("doc_id").distinct(), toxic).withColumn("label", F.lit(1))
    texts = docs.where(train & F.col("text").isNotNull()).select("doc_id", "text")
    others = _some(texts.select("doc_id").distinct(), unlabelled).withColumn("label", F.lit(0))
    # At most ``toxic + unlabelled`` rows of two numbers.
    return staged(texts.join(F.broadcast(confirmed.unionByName(others)), "doc_id"), "sample")


def frequent(rows: DataFrame, least: int, ratio: float, limit: int) -> np.ndarray:
    """Keys in at least ``least`` toxic texts and ``ratio`` times as common there as among the
    unlabelled ones; of more than ``limit`` those in most toxic texts."""

    def count(batches):
        for part in slices(batches):
            row, key, _ = features(part.column("text").to_pylist())
            label = np.asarray(part.column("label"))[row]
            seen = pd.DataFrame({"row": row, "key": key, "label": label}).drop_duplicates(["row", "key"])
            both = pd.crosstab(seen["key"], seen["label"]).reindex(columns=[0, 1], fill_value=0)
            yield pa.RecordBatch.from_pydict({"key": pa.array(both.index.to_numpy(np.int64)), "n": pa.array(both[1].to_numpy(np.int64)), "u": pa.array(both[0].to_numpy(np.int64))})

    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    held = rows.select("label", "text").mapInArrow(count, "key long, n long, u long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("u").alias("u"))
    share = F.col("n") / sizes.get(1, 1) >= ratio * (F.col("u") + 1) / (sizes.get(0, 0) + 1)
    kept = held.where((F.col("n") >= least) & share).orderBy(F.col("n").desc(), "key").limit(limit).select("key")
    return np.sort(np.array([r.key for r in kept.collect()], np.int64))


def cells(rows: DataFrame, keys: np.ndarray) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The sample for the fit: per text its label and length, and the counts of its kept keys."""

    def count(batches):
        for part in slices(batches):
            row, key, words = features(part.column("text").to_pylist())
            place, known = located(keys, key)
            size = max(1, len(keys))
            cell, n = np.unique(row[known] * size + place[known], return_counts=True)
            edges = np.searchsorted(cell, np.arange(part.num_rows + 1) * size).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "label": part.column("label"), "words": pa.array(words.astype(np.int64)),
                "place": pa.ListArray.from_arrays(pa.array(edges), pa.array((cell % size).astype(np.int32))),
                "n": pa.ListArray.from_arrays(pa.array(edges), pa.array(n.astype(np.int32))),
            })

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, label int, words long, place array<int>, n array<int>"
    out = rows.select("doc_id", F.col("label").cast("int"), "text").mapInArrow(count, schema).toPandas()
    out["hash"] = [hash(tuple(p)) for p in out["place"]]
    out = out.sort_values(["label", "doc_id", "words", "hash"], kind="stable").reset_index(drop=True)
    place, n = ([np.asarray(x, np.int64) for x in out[c]] for c in ("place", "n"))
    return out[["label", "words"]], pd.DataFrame({
        "row": np.repeat(np.arange(len(out)), [len(p) for p in place]),
        "place": np.concatenate([*place, np.empty(0, np.int64)]),
        "value": np.log1p(np.concatenate([*n, np.empty(0, np.int64)])),
    })


# --- fit ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Loss:
    """Loss of a clean text by its score, its slope, and the slope of that of a toxic text."""

    clean: Callable[[np.ndarray], np.ndarray]
    clean_slope: Callable[[np.ndarray], np.ndarray]
    toxic_slope: Callable[[np.ndarray], np.ndarray]


LOGISTIC = Loss(lambda g: np.logaddexp(0, g), sigmoid, lambda g: -sigmoid(-g))
BOUNDED = Loss(sigmoid, lambda g: sigmoid(g) * sigmoid(-g), lambda g: -sigmoid(g) * sigmoid(-g))


def risk_gradient(toxic: np.ndarray, unlabelled: np.ndarray, prior: float, loss: Loss) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the non-negative risk by the scores of toxic and unlabelled texts."""
    clean = loss.clean(unlabelled).mean() - prior * loss.clean(toxic).mean()
    up, down = loss.clean_slope(unlabelled) / len(unlabelled), prior * loss.clean_slope(toxic) / len(toxic)
    if clean < 0:
        return down, -up
    return prior * loss.toxic_slope(toxic) / len(toxic) - down, up


def fit(texts: pd.DataFrame, entries: pd.DataFrame, size: int, prior: float, rounds: int = 100, ridge: float = 1e-4) -> np.ndarray:
    """Weights of the keys, then the constant and the length, by steps over the whole sample
    with momentum and per-weight scale: ``rounds`` with the logistic loss, then as many with a
    bounded one, on which confirmed texts that show no sign have little pull."""
    row, place, value = (entries[c].to_numpy() for c in ("row", "place", "value"))
    length = length_of(texts["words"].to_numpy())
    toxic = texts["label"].to_numpy() == 1
    theta = np.zeros(size + 2)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, 2 * rounds + 1):
        g = np.bincount(row, theta[place] * value, len(texts)) + theta[-2] + theta[-1] * length
        slope = np.empty(len(texts))
        slope[toxic], slope[~toxic] = risk_gradient(g[toxic], g[~toxic], prior, LOGISTIC if step <= rounds else BOUNDED)
        grad = np.bincount(place, value * slope[row], len(theta))
        grad[-2:] += slope.sum(), float(slope @ length)
        grad[:-2] += ridge * theta[:-2]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta


def train(
    docs: DataFrame, labels: DataFrame, prior: float | None = None, toxic: int = 2000, unlabelled: int = 6000,
    least: int = 5, ratio: float = 2.0, limit: int = 20_000,
) -> Model | None:
    """Learn from a bounded sample of whole texts: at most ``toxic`` confirmed and ``unlabelled``
    other ones, chosen by a hash of doc_id outside the held-out fold, and at most ``limit`` keys.

    Null ids, texts and labels are left out; a doc_id with several labels counts as toxic if one
    of them is 1.  None if there is no toxic or no other text to learn from."""
    ship(docs.sparkSession)
    able = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    if prior is None:
        prior = able.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).agg(F.avg("toxic")).first()[0]
    if not prior:
        return None
    rows = sample(docs, labels, toxic, unlabelled)
    keys = frequent(rows, least, ratio, limit)
    texts, entries = cells(rows, keys)
    if texts["label"].nunique() < 2:
        return None
    theta = fit(texts, entries, len(keys), min(float(prior), 0.95))
    return Model(keys, theta[:-2], float(theta[-2]), float(theta[-1]))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` but one named score, with ``score`` added, between 0 and 1.

    Every row is scored by its whole text and nothing else, so repeated rows score alike.  Null
    and empty texts, and texts without a letter, score as a text without words; without a
    model everything scores 0.  An empty table stays empty."""
    ship(docs.sparkSession)
    docs = docs.drop("score")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in docs.schema.fields)}, score double"

    def rate(batches):
        for part in slices(batches):
            value = np.zeros(part.num_rows) if model is None else model.scores(part.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({n: part.column(i) for i, n in enumerate(part.schema.names)} | {"score": pa.array(value)})

    return docs.mapInArrow(rate, schema)

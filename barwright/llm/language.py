"""Language identification, words first.

A word that the training texts have scores by its log frequency in each language.  An unseen
word backs off: at each of its characters the longest known n-gram that starts there (four
characters down to one) scores, and the word gets the mean.  Words are runs of letters,
lower-cased."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import chosen_by_hash, ship, slices, span_hashes

ORDERS = (4, 3, 2, 1)
UNKNOWN = "und"
_LETTERS: list[np.ndarray] = []


def held_out(doc_id: Column) -> Column:
    """The fold kept for measuring: remainder 2 of crc32(doc_id as text) by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, starts and ends of their words, and each word's
    row."""
    low = [(t or "").lower() for t in texts]
    points = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = letters()[points]
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    rows = np.cumsum([len(t) + 1 for t in low])
    return points, starts, ends, np.searchsorted(rows, starts, "right")


@dataclass
class Model:
    languages: list[str]
    word_keys: np.ndarray  # sorted hashes
    word_scores: np.ndarray  # rows of log frequencies, centred over the languages
    gram_keys: dict[int, np.ndarray]
    gram_scores: dict[int, np.ndarray]


def _scores(counts: pd.DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and centred log frequencies from columns key, lang, n."""
    wide = counts.pivot_table(index="key", columns="lang", values="n", aggfunc="sum", fill_value=0)
    wide = wide.reindex(columns=languages, fill_value=0).sort_index()
    value = wide.to_numpy(np.float64)
    logs = np.log(value + 0.5) - np.log(value.sum(axis=0) + 0.5 * max(1, len(value)))
    return wide.index.to_numpy(np.uint64), (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32)


def train(docs: DataFrame, per_language: int = 600, min_count: int = 2) -> Model:
    """Word and n-gram tables from the texts with a language outside the held-out fold.  At
    most ``per_language`` documents of a language are read, chosen by a hash of doc_id, whole
    texts each; that bound is what keeps the model small.

    A null text, language or doc_id is not learned from.  Without any such text the model
    knows no language."""
    ship(docs.sparkSession)
    able = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    able = able.where(~held_out(F.col("doc_id")))
    chosen = chosen_by_hash(able.select("doc_id", "lang").distinct(), "lang", per_language)

    def count(batches):
        for part in slices(batches):
            lang = np.asarray(part.column("lang").to_pylist(), object)
            points, starts, ends, row = words_of(part.column("text").to_pylist())
            text = points.tobytes().decode("utf-32-le", "surrogatepass")
            words = [text[a:b] for a, b in zip(starts, ends, strict=True)]
            got = pd.DataFrame({"lang": lang[row], "word": words}).value_counts(["lang", "word"]).reset_index(name="n")
            yield pa.RecordBatch.from_pandas(got.astype({"n": "int64"}), preserve_index=False, schema=schema)

    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
    texts = able.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")
    words = texts.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = words.toPandas()  # bounded by per_language texts of each language
    languages = sorted(counts["lang"].unique())
    spelled = counts["word"].tolist()
    points, starts, ends, _ = words_of(spelled)
    if not len(starts):
        return Model([], np.empty(0, np.uint64), np.empty((0, 0)), {}, {})
    # A lower-cased word is one run of letters again.
    length = ends - starts
    counts["key"] = span_hashes(points, starts, ends)
    total = counts.groupby("key")["n"].transform("sum")
    word_keys, word_scores = _scores(counts[total >= min_count], languages)
    gram_keys, gram_scores = {}, {}
    for n in ORDERS:
        at = np.concatenate([starts[length >= n + i] + i for i in range(int(length.max()) - n + 1)] or [starts[:0]])
        of = np.concatenate([np.flatnonzero(length >= n + i) for i in range(int(length.max()) - n + 1)] or [starts[:0]])
        grams = pd.DataFrame({"key": span_hashes(points, at, at + n), "lang": counts["lang"].to_numpy()[of], "n": counts["n"].to_numpy()[of]})
        grams = grams.groupby(["key", "lang"], as_index=False)["n"].sum()
        gram_keys[n], gram_scores[n] = _scores(grams, languages) if len(grams) else (np.empty(0, np.uint64), np.empty((0, len(languages))))
    return Model(languages, word_keys, word_scores, gram_keys, gram_scores)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


def _unseen(model: Model, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Scores of unseen words by the longest known n-gram at each of their characters."""
    length = ends - starts
    word = np.repeat(np.arange(len(starts)), length)
    at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + starts[word]
    out = np.zeros((len(at), len(model.languages)), np.float32)
    open_ = np.arange(len(at))
    for n in ORDERS:
        fits = open_[at[open_] + n <= ends[word[open_]]]
        place, known = _find(model.gram_keys[n], span_hashes(points, at[fits], at[fits] + n))
        out[fits[known]] = model.gram_scores[n][place[known]]
        done = np.zeros(len(at), bool)
        done[fits[known]] = True
        open_ = open_[~done[open_]]
    return np.add.reduceat(out, np.cumsum(length) - length) / length[:, None]


def scored(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    found = np.full(len(texts), UNKNOWN, object)
    score = np.zeros(len(texts))
    points, starts, ends, row = words_of(texts)
    if not len(starts) or not model.languages:
        return found.tolist(), score
    code, distinct = pd.factorize(span_hashes(points, starts, ends))
    example = np.empty(len(distinct), np.int64)
    example[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    place, known = _find(model.word_keys, distinct)
    value = np.zeros((len(distinct), len(model.languages)), np.float32)
    value[known] = model.word_scores[place[known]]
    new = example[~known]
    if len(new):
        value[~known] = _unseen(model, points, starts[new], ends[new])
    has = np.zeros(len(texts), bool)
    has[row] = True
    sums = np.stack([np.bincount(row, value[code, i], len(texts)) for i in range(len(model.languages))], axis=1)
    sums -= sums.max(axis=1, keepdims=True)
    chance = np.exp(sums) / np.exp(sums).sum(axis=1, keepdims=True)
    best = chance.argmax(axis=1)
    found[has] = np.asarray(model.languages, object)[best[has]]
    score[has] = chance[np.arange(len(texts)), best][has]
    return found.tolist(), score


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` but any named lang_pred or score, with these two added.

    Null texts and texts without a letter are ``und`` with score 0; so is every text if the
    model knows no language.  Ties go to the alphabetically first language.  Only ``text`` is
    an input of the prediction."""
    ship(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in docs.schema.fields)}, lang_pred string, score double"

    def predict(batches):
        for part in slices(batches):
            found, score = scored(model, part.column("text").to_pylist())
            out = {n: part.column(i) for i, n in enumerate(part.schema.names)}
            yield pa.RecordBatch.from_pydict(out | {"lang_pred": pa.array(found, pa.string()), "score": pa.array(score)})

    return docs.mapInArrow(predict, schema)

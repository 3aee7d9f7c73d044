"""Licence scan: a trained classifier of paragraphs, confirmed by templates.

Features of a paragraph are the word n-grams (one to three words) of the templates that hold
a marker, a template word outside everyday language.  Softmax regression over them gives each
licence family and the class ``unknown`` a score; a temperature, fitted on held-out variants,
calibrates the scores.  A predicted family is confirmed where one of its templates is found in
the paragraph word pair by word pair.

Training runs on the driver over variants of the templates and a bounded number of corpus
paragraphs.  The scan itself uses DataFrame expressions only; a paragraph without a marker has
no feature, so it is unknown and is left where it is."""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.common import staged
from barwright.llm.licence_texts import TEMPLATES, UNRELATED

UNKNOWN = "unknown"
WORD = r"[^\p{L}\p{N}]+"
# Everyday words of the templates; n-grams without any other word are no features.
COMMON = set(
    "a above all also and any are as at be but by can for free from have in is it may met no not of on or other our"
    " part person possible that the their this to under use via was we with without you your late later either"
    " found file form following provided purpose work project program text to extent mit fee any 1 2 3 4 0 v"
    " example corporation document library version copy".split()
) - {"mit"}


def words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def grams(found: list[str]) -> set[str]:
    return {" ".join(found[i : i + n]) for n in (1, 2, 3) for i in range(len(found) - n + 1)}


@dataclass
class Model:
    classes: list[str]
    markers: list[str]
    weights: dict[str, list[float]]  # n-gram: score of each class
    bias: list[float]
    temperature: float


def _variants(text: str, dice: random.Random, filler: list[str], n: int) -> list[str]:
    """Wordings of a template: cut, extended and damaged ones."""
    found, out = words(text), [text]
    for _ in range(n):
        kept = [w for w in found if dice.random() > 0.08] or found
        before = dice.choices(filler, k=dice.choice((0, 0, 2, 6)))
        after = dice.choices(filler, k=dice.choice((0, 0, 2, 6)))
        out.append(" ".join([*before, *kept, *after]))
    return out


def train(docs: DataFrame, corpus_paragraphs: int = 600, seed: int = 7) -> Model:
    """Fit on variants of the templates, the unrelated prose and at most ``corpus_paragraphs``
    paragraphs of the corpus without a licence word, of 40 to 600 characters, chosen by hash.
    An empty corpus only leaves these out."""
    dice = random.Random(seed)
    markers = sorted({w for t in TEMPLATES.values() for x in t for w in words(x)} - COMMON)
    lines = docs.select(F.explode(F.split("text", "\n")).alias("p")).where(F.length("p").between(40, 600))
    lines = lines.where(~F.lower("p").rlike(r"licen[sc]|copyright|public domain|rights reserved|spdx|cc by|gpl"))
    # Lines that cannot be among the chosen ones are dropped where they are.
    place = F.pmod(F.xxhash64("p"), F.lit(1 << 40)) / float(1 << 40)
    near = lines.where(place * lines.count() <= 4.0 * corpus_paragraphs).dropDuplicates(["p"])
    chosen = near.orderBy(F.xxhash64("p"), "p").limit(corpus_paragraphs)
    plain = [r["p"] for r in chosen.collect()]
    filler = [w for p in plain[:100] for w in words(p)] or words(" ".join(UNRELATED))
    rows: list[tuple[str, str]] = [(UNKNOWN, p) for p in plain]
    rows += [(UNKNOWN, v) for p in UNRELATED for v in _variants(p, dice, filler, 8)]
    for family, texts in TEMPLATES.items():
        rows += [(family, v) for t in texts for v in _variants(t, dice, filler, 24)]
    vocabulary = sorted({g for t in TEMPLATES.values() for x in t for g in grams(words(x)) if set(g.split()) - COMMON})
    column = {g: i for i, g in enumerate(vocabulary)}
    classes = [UNKNOWN, *TEMPLATES]
    x = np.zeros((len(rows), len(vocabulary)))
    for i, (_, text) in enumerate(rows):
        x[i, [column[g] for g in grams(words(text)) if g in column]] = 1
    y = np.array([classes.index(c) for c, _ in rows])
    fold = np.array([dice.random() < 0.2 for _ in rows])
    w, b = _softmax_fit(x[~fold], y[~fold], len(classes))
    temperature = min(np.arange(0.2, 3.01, 0.1), key=lambda t: _loss((x[fold] @ w + b) / t, y[fold]))
    w[np.abs(w) < 0.02] = 0.0
    return Model(classes, markers, {g: w[i].tolist() for g, i in column.items() if w[i].any()}, b.tolist(), float(temperature))


def _loss(score: np.ndarray, y: np.ndarray) -> float:
    score = score - score.max(axis=1, keepdims=True)
    return float((np.log(np.exp(score).sum(axis=1)) - score[np.arange(len(y)), y]).mean())


def _softmax_fit(x: np.ndarray, y: np.ndarray, classes: int, rounds: int = 400, rate: float = 0.5, shrink: float = 2e-4):
    """Gradient descent with momentum and soft thresholding, which keeps the weights sparse."""
    w, b = np.zeros((x.shape[1], classes)), np.zeros(classes)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    one = np.eye(classes)[y]
    for _ in range(rounds):
        score = x @ w + b
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        vw = 0.9 * vw + x.T @ (p - one) / len(y)
        vb = 0.9 * vb + (p - one).mean(axis=0)
        w, b = w - rate * vw, b - rate * vb
        w = np.sign(w) * np.maximum(np.abs(w) - rate * shrink, 0)
    return w, b


# --- scanning -----------------------------------------------------------------------


def _words(line: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(line), F.lit(""))), WORD), lambda w: w != "")


def _gram_column(found: str) -> Column:
    """Distinct n-grams of an array of words."""
    n = F.size(found)

    def joined(k: int) -> Column:
        at = F.when(n >= k, F.sequence(F.lit(1), n - k + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.concat_ws(" ", F.slice(found, i, k)))

    return F.array_distinct(F.concat(joined(1), joined(2), joined(3)))


def _table(spark, names: str, rows: list[str]) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({names})")


def scan(docs: DataFrame, model: Model, threshold: float = 0.8, template_share: float = 0.8) -> DataFrame:
    """Licence paragraphs: doc_id, paragraph (first line, from 0), lines, family, probability,
    template_share (best share of a template's word pairs found in the paragraph), confirmed.

    A line is a paragraph, and so are lines in a row that hold markers (with at most one line without
    between two of them and after the last, and no blank line), as a notice wrapped over several lines
    has them.  The
    longer paragraph is reported where a template confirms it or none of its lines is reported by
    itself, else its lines are.  Families below ``threshold`` are not reported: they are
    unknown.  Null and empty texts have no paragraph; texts of any length are scanned whole; an
    empty table gives no row.  Equal rows (id and text) are reported once; rows without doc_id are
    scanned like others.  A tie goes to the family named first.  Other columns are not read."""
    spark = docs.sparkSession
    split = F.split("text", "\n")
    pairs_of_lines = F.arrays_zip(split.alias("line"), F.slice(split, F.lit(2), F.greatest(F.size(split), F.lit(1))).alias("next"))
    lines = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.posexplode(pairs_of_lines).alias("paragraph", "l"))
    lines = lines.select("doc_id", "mark", "paragraph", _words("l.line").alias("words"), F.col("l.next").alias("next"))
    markers = F.array(*[F.lit(m) for m in model.markers])
    marked = lines.where(F.arrays_overlap("words", markers)).withColumn("next", _words("next"))
    # A following line with a marker is a row of its own.
    marked = marked.withColumn("next", F.when(~F.arrays_overlap("next", markers), F.col("next")))
    # One exchange for the copies and for the order of a text's lines.
    marked = marked.repartition("doc_id", "mark").dropDuplicates(["doc_id", "mark", "paragraph"])
    order = Window.partitionBy("doc_id", "mark").orderBy("paragraph")
    gap = F.col("paragraph") - F.lag("paragraph").over(order)
    empty = F.size("next") == 0
    apart = F.coalesce((gap > 2) | ((gap == 2) & F.lag(empty).over(order)), F.lit(True))
    marked = marked.withColumn("apart", apart.cast("int"))
    follows = F.coalesce((F.lead("paragraph").over(order) == F.col("paragraph") + 1) & (F.lead("apart").over(order) == 0), F.lit(False))
    marked = marked.withColumn("run", F.sum("apart").over(order)).withColumn("follows", follows)
    # Few lines hold a marker; written first, since they are read for scores and templates.
    marked = staged(marked.select("doc_id", "mark", "paragraph", "run", "words", F.when(~F.col("follows"), F.col("next")).alias("next")), "marked")
    part = F.struct("paragraph", "words", "next")
    joined = marked.groupBy("doc_id", "mark", "run").agg(F.array_sort(F.collect_list(part)).alias("p")).where(F.size("p") > 1)
    all_words = F.flatten(F.transform("p", lambda x: F.concat(x["words"], F.coalesce(x["next"], F.array().cast("array<string>")))))
    first_line, end = F.get("p.paragraph", F.lit(0)), F.element_at("p", -1)
    count = end["paragraph"] - first_line + 1 + (F.size(end["next"]) > 0).cast("int")
    joined = joined.select("doc_id", "mark", "run", first_line.alias("paragraph"), count.alias("lines"), all_words.alias("words"))
    marked = marked.select("doc_id", "mark", "run", "paragraph", F.lit(1).alias("lines"), "words").unionByName(joined)
    weight_rows = [f"('{g}', array({', '.join(f'{v:.6f}D' for v in w)}))" for g, w in model.weights.items()]
    weights = F.broadcast(_table(spark, "gram, w", weight_rows))  # a fixed vocabulary: that of the templates
    key = ["doc_id", "mark", "run", "paragraph", "lines"]
    hits = marked.select(*key, F.explode_outer(_gram_column("words")).alias("gram")).join(weights, "gram")
    sums = hits.groupBy(*key).agg(*[F.sum(F.get("w", F.lit(i))).alias(f"s{i}") for i in range(len(model.classes))])
    score = F.array(*[(F.col(f"s{i}") + b) / model.temperature for i, b in enumerate(model.bias)])
    scored = sums.select(*key, score.alias("score")).withColumn("top", F.array_max("score"))
    total = F.aggregate("score", F.lit(0.0), lambda acc, v: acc + F.exp(v - F.col("top")))
    best = F.array_position("score", F.col("top")).cast("int")
    names = F.array(*[F.lit(c) for c in model.classes])
    found = scored.select(*key, F.element_at(names, best).alias("family"), (1.0 / total).alias("probability"))
    found = found.where((F.col("family") != UNKNOWN) & (F.col("probability") >= threshold))
    pairs = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - 1, F.lit(1))), lambda i: F.concat_ws(" ", F.slice("words", i, 2))))
    texts = marked.select(*[F.col(c).alias(f"m_{c}") for c in key], pairs.alias("pairs"))
    same = (
        found["doc_id"].eqNullSafe(texts["m_doc_id"]) & found["mark"].eqNullSafe(texts["m_mark"]) & (found["paragraph"] == texts["m_paragraph"])
        & (found["lines"] == texts["m_lines"])
    )
    template_rows = []
    for family, wordings in TEMPLATES.items():
        for t in wordings:
            w = words(t)
            own = {" ".join(w[i : i + 2]) for i in range(max(1, len(w) - 1))}
            quoted = ", ".join(f"'{p}'" for p in sorted(own))
            template_rows.append(f"('{family}', array({quoted}))")
    templates = F.broadcast(_table(spark, "family, template", template_rows))  # the fixed list
    compared = found.join(texts, same).join(templates, "family")
    share = F.size(F.array_intersect("template", "pairs")) / F.size("template")
    out = compared.groupBy(*key, "family", "probability").agg(F.max(share).alias("template_share"))
    run = Window.partitionBy("doc_id", "mark", "run")
    whole = F.col("lines") > 1
    confirmed = F.max((whole & (F.col("template_share") >= template_share)).cast("int")).over(run) == 1
    alone = F.max((~whole).cast("int")).over(run) == 0
    out = out.withColumns({"__whole": confirmed | alone}).where(F.col("__whole") == whole)
    return out.select(
        "doc_id", "paragraph", "lines", "family", F.round("probability", 6).alias("probability"), "template_share",
        (F.col("template_share") >= template_share).alias("confirmed"),
    )

"""Quality scores from a linear model on n-gram indicators scaled by naive Bayes log-count ratios.

A text becomes the set of its 1- to 3-grams over token shapes (plain, capitalised, upper-case, repeated word, number,
line end, and punctuation as it stands), each also marked when it is frequent in the text, and its common words.
Each indicator is scaled by the log ratio of its smoothed counts in the two classes; an L1-loss support vector machine
is fitted to the scaled rows by dual coordinate descent, and its margin becomes a probability by Platt scaling.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import linear
from .common import bounded_sample, id_bucket, per_row

TOKEN = re.compile(r"\w+|[^\w\s]+|\n")
FREQUENT = (4, 16)
CACHED_TOKENS = 200_000


def shape(token: str) -> str:
    if token == "\n":
        return "<nl>"
    if not (token[0].isalnum() or token[0] == "_"):
        return token[:3]
    if token.isdigit():
        return "<num>"
    if len(token) > 1 and token.isupper():
        return "<upper>"
    return "<title>" if token[0].isupper() else "<low>"


class Featuriser:
    """features(text): set of strings. Shapes of tokens are kept, in a bounded cache."""

    def __init__(self):
        self.cache: dict[str, tuple[str, str]] = {}

    def __getstate__(self):
        return {}

    def __setstate__(self, state):
        self.__init__()

    def features(self, text: str) -> set[str]:
        cache, shapes, words, last = self.cache, [], set(), ""
        for token in TOKEN.findall(text):
            known = cache.get(token)
            if known is None:
                if len(cache) >= CACHED_TOKENS:
                    cache.clear()
                known = cache[token] = (shape(token), token.lower() if token[0].isalpha() else "")
            word = known[1]
            if word:
                shapes.append("<same>" if word == last else known[0])
                last = word
                words.add(word)
            else:
                shapes.append(known[0])
        out = set(words)
        for n, grams in enumerate((shapes, zip(shapes, shapes[1:]), zip(shapes, shapes[1:], shapes[2:])), 1):
            for gram, times in Counter(grams).items():
                name = gram if n == 1 else " ".join(gram)
                out.add(f"{n} {name}")
                for least in FREQUENT:
                    if times >= least:
                        out.add(f"{n} {name} x{least}")
        return out


class QualityModel:
    """weights: of features; score(text) is the probability of label 1."""

    def __init__(self, weights: dict[str, float], bias: float, scale: tuple[float, float]):
        self.weights, self.bias, self.scale, self.maker = weights, bias, scale, Featuriser()

    def score(self, text: str | None) -> float:
        get = self.weights.get
        margin = self.bias + math.fsum(get(f, 0.0) for f in self.maker.features(text or ""))  # the same in whatever order
        return linear.sigmoid(self.scale[0] * margin + self.scale[1])


def log_count_ratios(rows: linear.Rows, y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    p, q = alpha + rows.gather((y > 0).astype(float)), alpha + rows.gather((y <= 0).astype(float))
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_coordinate_descent(rows: linear.Rows, scale: np.ndarray, y: np.ndarray, c: float = 0.1, rounds: int = 12, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss machine on rows whose columns are scaled; one dual variable is set at a time."""
    n, w, bias = len(rows), np.zeros(rows.width), 0.0
    dual, sign = np.zeros(n), np.where(y > 0, 1.0, -1.0)
    square = np.array([(scale[rows.row(i)] ** 2).sum() for i in range(n)]) + 1.0
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(n):
            at = rows.row(i)
            x = scale[at]
            slope = sign[i] * (w[at] @ x + bias) - 1
            new = min(max(dual[i] - slope / square[i], 0.0), c)
            if (step := (new - dual[i]) * sign[i]) != 0:
                w[at] += step * x
                bias += step
                dual[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4 * c:
            break
    return w, bias


def fit_texts(texts: list[str], y: list[int], least: int = 5) -> QualityModel:
    maker, labels = Featuriser(), np.array(y)
    if len(set(y)) < 2:
        share = float(np.mean(labels > 0)) if len(y) else 0.5
        return QualityModel({}, float(np.log((share + 0.01) / (1.01 - share))), (1.0, 0.0))
    index = linear.Index()
    for t in texts:
        index.add(maker.features(t))
    names, rows = index.kept(index.frequent(min(least, max(1, len(texts) // 20))))
    ratios = log_count_ratios(rows, labels)
    w, bias = dual_coordinate_descent(rows, ratios, labels)
    final = w * ratios
    scale = linear.calibrate(rows.times(final) + bias, labels)
    keep = np.abs(final) > 1e-9
    return QualityModel({f: float(final[k]) for k, f in enumerate(names) if keep[k]}, bias, scale)


def fit(docs: DataFrame, labels: DataFrame, label: str, per_class: int = 1500) -> QualityModel:
    """Learns from at most per_class documents of each label; they are chosen from the labels alone, before a text is read.

    A document with several labels counts with its largest.
    """
    one = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias(label))
    found = bounded_sample(one, docs, "doc_id", label, per_class)
    return fit_texts([x[2] for x in found], [int(x[0]) for x in found])


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score of every row; a null text counts as an empty one."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(per_row(lambda k, t: (k, sent.value.score(t)), schema), "doc_id long, score double")


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labelled rows whose id bucket modulo 5 isn't 0.

    Null and empty texts get the score of a text without features; very long ones are scored whole, one at a time;
    repeated rows each give a row, with or without a doc_id (one without has no label); equal texts tie in their scores;
    an empty table gives none; without labels the score is 0.5. Other columns are never read.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = fit(docs, labels.where(id_bucket("doc_id", 5) != 0), "quality")
    found = score(docs, model)
    return found.select("doc_id", (id_bucket("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))

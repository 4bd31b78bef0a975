"""Toxicity scores from a logistic model whose scores must not move when identity terms are swapped.

A text becomes the set of the prefixes of its words (and the words themselves, marked as whole). The loss is the
logistic loss on labelled texts plus a penalty: for labelled texts that name an identity group, each term is swapped
for another of its set, and the squared change of the margin is charged. Terms that go along with toxic labels only by
chance so get no weight, and neutral mentions of a group are not held against a text. Corpora name groups that no list
has: further sets are learnt from the labelled texts, words that are about as usual as each other and say nothing of the
label (neutral_sets), so that there are counterfactuals whatever the language.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import linear
from .common import bounded_sample, id_bucket, per_row

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 6, 7, 8)
CACHED_WORDS = 300_000
#: Marks a feature that two different words of a text have.
AGAIN = " x2"
#: Fixed word lists: terms that may stand for each other in a sentence without changing what it says of people.
IDENTITY_TERMS = (
    ("muslim", "jewish", "christian", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "jews", "christians", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "african", "european", "latino", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("immigrant", "refugee", "native", "foreigner"),
    ("disabled", "blind", "deaf", "autistic"),
    ("musulman", "juif", "chrétien", "bouddhiste"),
    ("femme", "homme", "fille", "garçon"),
    ("muslime", "jude", "christ", "buddhist"),
    ("frau", "mann", "mädchen", "junge"),
    ("musulmán", "judío", "cristiano", "budista"),
    ("mujer", "hombre", "chica", "chico"),
)


def word_features(word: str) -> tuple[str, ...]:
    return (*(word[:n] for n in PREFIXES if len(word) >= n), word + "$")


def features(text: str) -> set[str]:
    once: set[str] = set()
    again: set[str] = set()
    for word in set(WORD.findall(text.lower())):
        found = word_features(word)
        again.update(f for f in found if f in once)
        once.update(found)
    return once.union(f + AGAIN for f in again)


def swapped(text: str, groups: tuple[tuple[str, ...], ...], at_most: int = 3) -> list[str]:
    """Counterfactual texts: each identity term moved to another of its group, by the same number of places."""
    if not groups:
        return []
    place = {w: (g, i) for g in groups for i, w in enumerate(g)}
    if place.keys().isdisjoint(WORD.findall(text.lower())):
        return []

    def moved(step: int) -> str:
        def other(m: re.Match) -> str:
            if (found := place.get(m[0].lower())) is None:
                return m[0]
            group, i = found
            return group[(i + step) % len(group)]

        return WORD.sub(other, text)

    return [moved(step) for step in range(1, at_most + 1)]


def neutral_sets(texts: list[str], labels: np.ndarray, sets: int = 60, size: int = 4, least: float = 0.01, most: float = 0.25, evidence: float = 1.0) -> tuple[tuple[str, ...], ...]:
    """Sets of words that may stand for each other: of those in `least` to `most` of the texts, whose share of label 1 is that of
    all texts but for chance (log-likelihood ratio of `evidence` at most), the most usual ones, like beside like; ties by word.
    """
    index = linear.Index()
    for t in texts:
        index.add(set(WORD.findall(t.lower())))
    names, rows = index.kept(index.frequent(max(3, int(least * len(texts)))))
    ones, others = rows.gather(labels), rows.gather(1 - labels)
    ratio = log_likelihood(ones, max(labels.sum(), 1.0), others, max((1 - labels).sum(), 1.0))
    held = ones + others
    fit = [k for k in np.flatnonzero((ratio <= evidence) & (held <= most * len(texts))).tolist() if len(names[k]) >= PREFIXES[0]]
    fit = sorted(fit, key=lambda k: (-held[k], names[k]))[: sets * size]
    words = [names[k] for k in fit]
    return tuple(tuple(words[k : k + size]) for k in range(0, len(words) - size + 1, size))


def swap_change(model: ToxicityModel, texts: list[str], groups: tuple[tuple[str, ...], ...]) -> tuple[int, float]:
    """How many counterfactual pairs texts give (one for each text with a term), and the mean change of the margin by a swap."""
    pairs = [(t, other) for t in texts for other in swapped(t, groups, 1)]
    return len(pairs), float(np.mean([abs(model.margin(a) - model.margin(b)) for a, b in pairs])) if pairs else 0.0


class ToxicityModel:
    """score(text): probability of label 1. Features without weight are dropped, so most words cost one look-up."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.cache: dict[str, tuple[str, ...]] = {}

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias}

    def __setstate__(self, state):
        self.__init__(**state)

    def margin(self, text: str | None) -> float:
        cache, weights, found, again = self.cache, self.weights, set(), set()
        for word in set(WORD.findall((text or "").lower())):
            known = cache.get(word)
            if known is None:
                if len(cache) >= CACHED_WORDS:
                    cache.clear()
                known = cache[word] = tuple(f for f in word_features(word) if f in weights or f + AGAIN in weights)
            for f in known:
                (again if f in found else found).add(f)
        return self.bias + sum(weights.get(f, 0.0) for f in sorted(found)) + sum(weights.get(f + AGAIN, 0.0) for f in sorted(again))

    def score(self, text: str | None) -> float:
        return linear.sigmoid(self.margin(text))


def log_likelihood(a: np.ndarray, n: float, b: np.ndarray, m: float) -> np.ndarray:
    """Twice the log-likelihood ratio of two rates a / n and b / m against one common rate."""

    def part(k, of, rate):
        return k * np.log(np.maximum(rate, 1e-12)) + (of - k) * np.log(np.maximum(1 - rate, 1e-12))

    common = (a + b) / (n + m)
    return 2 * (part(a, n, a / n) + part(b, m, b / m) - part(a, n, common) - part(b, m, common))


def fit_texts(texts: list[str], y: list[int], groups=IDENTITY_TERMS, penalty: float = 5.0, ridge: float = 1e-4, rounds: int = 300, share: float = 0.3, least: int = 3, weak: float = 9.0, strong: float = 30.0) -> ToxicityModel:
    """Full-batch Adam steps; label 1 has that share of the loss. penalty: of squared changes of the margin.

    groups: sets of terms that may stand for each other; without any there are no counterfactuals, else those of
    neutral_sets count as well.
    """
    texts, y = zip(*dict(zip(texts, y, strict=True)).items(), strict=True) if texts else ((), ())  # copies count once
    labels = np.array(y, float)
    if len(set(y)) < 2:
        share = float(labels.mean()) if len(y) else 0.0
        return ToxicityModel({}, float(np.log((share + 0.01) / (1.01 - share))))
    index = linear.Index()
    for t in texts:
        index.add(features(t))
    flags = index.frequent(min(least, max(1, len(texts) // 20)))
    names, rows = index.kept(flags)
    # What a feature counts for grows with the evidence that it tells the classes apart (its log-likelihood ratio);
    # what may well be chance, given that so many features are tried, is left out.
    evidence = log_likelihood(rows.gather(labels), labels.sum(), rows.gather(1 - labels), (1 - labels).sum())
    identity = {f for g in groups for w in g for f in word_features(w)}
    chosen = (evidence >= weak) | np.array([f in identity for f in names], bool)
    flags[np.flatnonzero(flags)[~chosen]] = False
    value = np.where(evidence >= weak, np.minimum(1.0, evidence / strong), 0.3)[chosen]
    names, rows = index.kept(flags)
    del index
    place = {f: k for k, f in enumerate(names)}

    def known(text: str) -> set[int]:
        return {place[f] for f in features(text) if f in place}

    # Of a counterfactual pair only what the two texts don't share changes the margin.
    learnt = neutral_sets(list(texts), labels) if groups else ()
    pairs = []
    for some, at_most in ((groups, 3), (learnt, 1)):
        for t in texts:
            if others := swapped(t, some, at_most):
                mine = known(t)
                pairs += [(np.array(sorted(mine - other)), np.array(sorted(other - mine))) for other in map(known, others)]
    was, now = (linear.Rows([x[k] for x in pairs], len(place)) for k in range(2))
    weight = np.where(labels > 0, share / labels.sum(), (1 - share) / (1 - labels).sum())
    w, bias = np.zeros(len(names)), np.zeros(1)
    mean, square = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for r in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(rows.times(value * w) + bias, -30, 30)))
        g = weight * (p - labels)
        grad = value * rows.gather(g) + ridge * w
        if pairs:
            change = (was.times(value * w) - now.times(value * w)) * (2 * penalty / len(pairs))
            grad += value * (was.gather(change) - now.gather(change))
        grad = np.append(grad, g.sum())
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        step = 0.1 * min(1.0, 2 - 2 * r / rounds) * (mean / (1 - 0.9**r)) / (np.sqrt(square / (1 - 0.99**r)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    w = w * value
    keep = np.abs(w) > 1e-4
    return ToxicityModel({f: float(w[k]) for k, f in enumerate(names) if keep[k]}, float(bias[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 1500, **options) -> ToxicityModel:
    """Learns from at most per_class documents of each label; they are chosen from the labels alone, before a text is read.

    A document with several labels counts with its largest.
    """
    one = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias(label))
    found = bounded_sample(one, docs, "doc_id", label, per_class)
    return fit_texts([x[2] for x in found], [int(x[0]) for x in found], **options)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score of every row; a null text counts as an empty one."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(per_row(lambda k, t: (k, sent.value.score(t)), schema), "doc_id long, score double")


def labelled(spark, sf_dir: str) -> DataFrame:
    """The labels to learn from: those whose id bucket modulo 4 isn't 2."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(id_bucket("doc_id", 4) != 2)


def keep_harmless(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """The rows of docs, with all their columns, whose score is below the threshold; decided row by row, without a shuffle.

    A null text counts as an empty one; equal rows share their fate and each stays.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            keep = [sent.value.score(t.as_py()) < threshold for t in batch.column(batch.schema.get_field_index("text"))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labelled rows whose id bucket modulo 4 isn't 2.

    Null and empty texts get the score of a text without features; very long ones are scored whole, one at a time;
    repeated rows each give a row, with or without a doc_id (one without has no label); equal texts tie in their scores;
    an empty table gives none; without labels the score is about 0. Other columns are never read.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = score(docs, fit(docs, labelled(spark, sf_dir)))
    return found.select("doc_id", (id_bucket("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))

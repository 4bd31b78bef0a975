"""Mixing sources to target weights: token weights are raked to source, language and topic marginals.

The tokens of each cell (source, language, topic) are summed over all documents. Iterative proportional fitting then
scales the cells until their shares have the target marginals; a document is kept with its cell's calibrated
probability, decided by a hash of its id, so the same at any partitioning. Cells, not documents, take part in the
fitting; they are as many as there are combinations, whatever the size of the corpus.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import staged

DIMENSIONS = ("source", "lang", "topic")
#: Target shares are the natural shares to this power, made to sum to one: below 1 evens out large and small.
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 0.9}
#: Cells up to this many are fitted in the driver's memory (some 100 bytes each); beyond it Spark fits them.
DRIVER_CELLS = 1_000_000
BUDGET = 0.5
SEED = 17


def tokens_of(text: Column) -> Column:
    """Words, counted by the white space between them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse subject for corpora without a topic column: the first of these fixed kinds whose sign the text has."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(F.length(F.trim(t)) == 0, "empty")
        .when(F.contains(t, F.lit("License")) | F.contains(t, F.lit("Copyright")), "legal")
        .when(F.contains(t, F.lit(" | ")), "table")
        .when(F.contains(t, F.lit("!! ")), "loud")
        .when(F.contains(t, F.lit("@")) | F.contains(t, F.lit("http")), "contact")
        .when(F.length(t) < 1000, "short prose")
        .otherwise("prose")
    )


def tempered(tokens: dict, power: float) -> dict:
    """Target shares from token sums."""
    raised = {k: max(v, 0) ** power if v > 0 else 0.0 for k, v in tokens.items()}
    total = sum(raised.values()) or 1.0
    return {k: v / total for k, v in raised.items()}


def rake(tokens: np.ndarray, places: list[np.ndarray], targets: list[np.ndarray], rounds: int = 200, close: float = 1e-9) -> np.ndarray:
    """Cell weights w such that the shares w * tokens have the target marginals.

    places: for each dimension the value of each cell, as a number; targets: the share of each value. Iterative
    proportional fitting: each dimension in turn scales the cells of a value to its target.
    """
    shares = tokens / max(tokens.sum(), 1e-300)
    for _ in range(rounds):
        worst = 0.0
        for place, target in zip(places, targets, strict=True):
            now = np.bincount(place, shares, len(target))
            factor = np.divide(target, now, out=np.ones_like(target), where=now > 0)
            worst = max(worst, float(np.abs(now - target)[now > 0].max(initial=0)))
            shares = shares * factor[place]
        if worst < close:
            break
    return np.divide(shares, tokens, out=np.zeros_like(shares), where=tokens > 0)


def probabilities(tokens: np.ndarray, weights: np.ndarray, budget: float) -> np.ndarray:
    """min(1, c * weight) for the c at which the expected number of tokens is the budget's share of all."""
    wanted, low, high = budget * tokens.sum(), 0.0, 1.0
    expected = lambda c: float((np.minimum(1.0, c * weights) * tokens).sum())
    positive = weights[weights > 0]
    if not len(positive):
        return np.ones_like(weights)
    high = 1 / positive.min()
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if expected(mid) < wanted else (low, mid)
    return np.minimum(1.0, high * weights)


def rake_in_spark(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = 200, close: float = 1e-9) -> DataFrame:
    """The same fitting, with the same end, for any number of cells: cells (the dimensions, tokens) gain a weight."""
    total = cells.agg(F.sum("tokens")).first()[0] or 1.0
    now = cells.withColumn("share", F.col("tokens") / total)
    for _ in range(rounds):
        worst = 0.0
        for d, target in targets.items():
            sums = staged(now.groupBy(d).agg(F.sum("share").alias("now")).join(target, d), "mixing-sums")
            worst = max(worst, sums.where("now > 0").agg(F.max(F.abs(F.col("now") - F.col("target")))).first()[0] or 0.0)
            factor = sums.select(d, F.when(F.col("now") > 0, F.col("target") / F.col("now")).otherwise(1.0).alias("factor"))
            now = now.join(factor, d).withColumn("share", F.col("share") * F.col("factor")).drop("factor")
        now = staged(now, "mixing-cells")
        if worst < close:
            break
    return now.withColumn("weight", F.when(F.col("tokens") > 0, F.col("share") / F.col("tokens")).otherwise(0.0)).drop("share")


def targets_in_spark(cells: DataFrame, d: str, given: dict | None) -> DataFrame:
    """The target of each value of a dimension of cells; values that aren't given have their natural share."""
    sums = cells.groupBy(d).agg(F.sum("tokens").alias("tokens"))
    if given:
        whole = sums.agg(F.sum("tokens")).first()[0] or 1.0
        own = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in given.items()], f"{d} string, given double")
        raised = sums.join(own, d, "left").select(d, F.coalesce("given", F.col("tokens") / whole).alias("target"))
    else:
        raised = sums.select(d, F.pow("tokens", F.lit(TEMPER[d])).alias("target"))
    raised = staged(raised, "mixing-targets")
    whole = raised.agg(F.sum("target")).first()[0] or 1.0
    return raised.withColumn("target", F.col("target") / whole)


def calibrate(cells: DataFrame, targets: dict[str, dict] | None = None, budget: float = BUDGET, driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """cells (source, lang, topic, tokens, docs) with their weight and probability.

    targets: for a dimension the share of each value; values without one get their natural share, and those that are
    missing altogether the tempered natural shares.
    """
    spark = cells.sparkSession
    sums = {d: {r[0]: float(r[1]) for r in cells.groupBy(d).agg(F.sum("tokens")).collect()} for d in DIMENSIONS} if cells.count() <= driver_cells else None
    if sums is None:
        cells = staged(cells, "mixing-all-cells")
        made = {d: targets_in_spark(cells, d, (targets or {}).get(d)) for d in DIMENSIONS}
        fitted = staged(rake_in_spark(cells, made), "mixing-weights")
        wanted = budget * (fitted.agg(F.sum("tokens")).first()[0] or 0)
        least = fitted.where("weight > 0").agg(F.min("weight")).first()[0]
        if least is None:
            return fitted.withColumn("prob", F.lit(1.0))
        low, high = 0.0, 1 / least
        for _ in range(200):
            mid = (low + high) / 2
            if mid in (low, high):
                break
            got = fitted.agg(F.sum(F.least(F.lit(1.0), F.col("weight") * mid) * F.col("tokens"))).first()[0] or 0
            low, high = (mid, high) if got < wanted else (low, mid)
        # Documents without tokens weigh nothing and stay.
        return fitted.withColumn("prob", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("weight") * high)).otherwise(1.0))
    rows = sorted((tuple(r) for r in cells.select(*DIMENSIONS, "tokens").collect()), key=lambda r: r[:3])
    tokens = np.array([r[3] for r in rows], float)
    places, wanted = [], []
    for k, d in enumerate(DIMENSIONS):
        values = sorted({r[k] for r in rows})
        natural = tempered(sums[d], 1.0)
        given = (targets or {}).get(d)
        share = {v: given.get(v, natural[v]) for v in values} if given else tempered(sums[d], TEMPER[d])
        whole = sum(share.values()) or 1.0
        number = {v: n for n, v in enumerate(values)}
        places.append(np.array([number[r[k]] for r in rows], np.int64))
        wanted.append(np.array([share[v] / whole for v in values]))
    weights = rake(tokens, places, wanted) if rows else tokens
    prob = probabilities(tokens, weights, budget) if rows else tokens
    prob = np.where(tokens > 0, prob, 1.0)  # documents without tokens weigh nothing and stay
    table = [(*r[:3], float(w), float(p)) for r, w, p in zip(rows, weights, prob, strict=True)]
    return spark.createDataFrame(table, "source string, lang string, topic string, weight double, prob double")


def described(docs: DataFrame) -> list[Column]:
    """The dimensions and tokens of a row with text, source and lang; a null source or language counts as an empty one."""
    return [
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        topic_of(F.col("text")).alias("topic"),
        tokens_of(F.col("text")).alias("n_tokens"),
    ]


def chance(doc_id: str, seed: int) -> Column:
    """A number from 0 to 1 that the id alone decides."""
    return F.xxhash64(F.lit(seed), F.coalesce(F.col(doc_id).cast("long"), F.lit(-1))).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)


def fitted_cells(rows: DataFrame, targets: dict[str, dict] | None = None, budget: float = BUDGET) -> DataFrame:
    """source, lang, topic, weight and prob of the cells of rows (the dimensions, n_tokens)."""
    cells = staged(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "mixing-cells")  # so texts are read once for all sums
    return calibrate(cells, targets, budget).select(*DIMENSIONS, "weight", "prob")


def mix(docs: DataFrame, targets: dict[str, dict] | None = None, budget: float = BUDGET, seed: int = SEED) -> DataFrame:
    """doc_id, the dimensions, tokens, weight, prob and sampled of every row of docs (doc_id, text, source, lang)."""
    rows = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *described(docs)), "mixing-documents")  # narrow: texts are read once
    # Cells are small beside documents; Spark broadcasts them if their size is below its threshold and else splits hot ones.
    return rows.join(fitted_cells(rows, targets, budget), list(DIMENSIONS)).select(
        "doc_id", *DIMENSIONS, "n_tokens", "weight", "prob", (chance("doc_id", seed) < F.col("prob")).alias("sampled")
    )


def keep_sampled(docs: DataFrame, targets: dict[str, dict] | None = None, budget: float = BUDGET, seed: int = SEED) -> DataFrame:
    """The sampled rows of docs, with all their columns; rows without tokens stay, and rows of one doc_id in one cell share their fate."""
    cells = fitted_cells(docs.select(*described(docs)), targets, budget).select(*DIMENSIONS, "prob")
    # All columns of docs travel as one, so none can be taken for one of the operator's own.
    rows = docs.select(F.struct("*").alias("row"), *described(docs)[: len(DIMENSIONS)])
    return rows.join(cells, list(DIMENSIONS)).where(chance("row.doc_id", seed) < F.col("prob")).select("row.*")


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """Sampling probability of every document at the default targets and a budget of half of all tokens.

    Null texts are empty: they have no tokens, weigh nothing and are kept. Null sources and languages count as
    empty ones. Rows repeated with one doc_id, and all rows without one, share their fate if they share a cell. Cells
    tie in nothing: each has its own weight. Very long texts count with all their words, as one row. An empty table
    gives none. Other columns are never read.
    """
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang"))

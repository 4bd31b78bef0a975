"""Benchmark decontamination: an inverted index of test items, asked with every passage of every document.

Each item is weighted by BM25, divided by the score it gives itself, so one threshold means the same for all items. The
postings of a term are in blocks of items, each with the largest impact in it. A passage is a window of words; windows
whose terms can't reach the threshold by their largest impacts, or in no block by its block maxima, are passed over for
whole documents at a time; the rest run block-max WAND, which returns every item at or above the threshold. What it
returns is verified: of the item's question, and of its answer, half of the words at least must be in shingles that the
document has as well, of five words of the item or of the side (of all its words if it is shorter).
Items are grouped by length, so that windows fit them, and split into shards of bounded size, so an index that is sent
to the executors stays below a proven bound however many items there are; every shard is asked with every passage.
Shards weigh words by the statistics of all items of their length, so the scores are the same however many there are.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WORD = re.compile(r"\w+")
K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.5
SHINGLE = 5
#: Windows are half as long again as the longest item of their group, and start each half of that item's length, so an
#: item lies in one of them whole.
REACH = 1.5
BLOCK_ITEMS = 4
#: At most so many words of items are in one index (some 300 bytes each), so one index stays below about 150 MB.
SHARD_WORDS = 500_000


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words before and after an answer mark, a question mark or, without either, the start of the last quarter."""
    m = re.search(r"\b(?:answer|réponse|antwort|respuesta)\s*:", text, re.I) or re.search(r"\?(?=.*\w)", text, re.S)
    if m:
        q, a = words_of(text[: m.end()]), words_of(text[m.end() :])
        if q and a:
            return q, a
    w = words_of(text)
    cut = len(w) - len(w) // 4
    return w[:cut], w[cut:]


def shingles(words: list[str], size: int = SHINGLE) -> set[tuple[str, ...]]:
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


class Statistics(NamedTuple):
    """What BM25 and the windows take from all items of a level: their number, mean and greatest length, and in how many a word is."""

    n: int
    average: float
    longest: int
    df: dict[str, int]


class BlockMaxIndex:
    """BM25 postings of items, in blocks with their largest impacts; of a shard's items by the statistics of all."""

    def __init__(self, items: list[tuple[int, str]], every: Statistics | None = None):
        parts = [(key, words, question_and_answer(text)) for key, text in items if (words := words_of(text))]
        parts.sort(key=lambda x: (len(x[1]), x[0]))  # items of like length share blocks, so block maxima are tight
        self.keys = [x[0] for x in parts]
        self.sides = [x[2] for x in parts]
        if every is None:
            lengths = [len(x[1]) for x in parts]
            every = Statistics(len(parts), sum(lengths) / max(1, len(parts)), max(lengths, default=1), Counter(w for _, words, _ in parts for w in set(words)))
        n, average, self.longest = every.n, every.average, every.longest
        df = {w: every.df[w] for _, words, _ in parts for w in words}
        idf = {w: math.log(1 + (n - d + 0.5) / (d + 0.5)) for w, d in df.items()}
        self.term = {w: k for k, w in enumerate(sorted(df))}
        self.items: list[list[int]] = [[] for _ in self.term]
        self.impacts: list[list[float]] = [[] for _ in self.term]
        for place, (_, words, _) in enumerate(parts):
            impact = {w: idf[w] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / average)) for w, tf in Counter(words).items()}
            whole = sum(impact.values())
            for w, x in impact.items():
                self.items[self.term[w]].append(place)
                self.impacts[self.term[w]].append(x / whole)
        self.blocks = -(-len(parts) // BLOCK_ITEMS)
        self.most = np.array([0.0, *(max(x) for x in self.impacts)])  # 0: a word that no item has
        self.block_most: list[dict[int, float]] = []
        for places, impacts in zip(self.items, self.impacts, strict=True):
            most: dict[int, float] = {}
            for p, x in zip(places, impacts, strict=True):
                most[p // BLOCK_ITEMS] = max(most.get(p // BLOCK_ITEMS, 0.0), x)
            self.block_most.append(most)
        # The block maxima once more as arrays: those of term t are at bounds[t]:bounds[t + 1].
        self.bounds = np.cumsum([0, *map(len, self.block_most)])
        self.block_of = np.array([b for most in self.block_most for b in most], np.int64)
        self.block_value = np.array([x for most in self.block_most for x in most.values()])

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """(place of an item, score) of every item at or above the threshold, for distinct terms: block-max WAND."""
        cursors = [[0, t] for t in terms]
        found, slack = [], threshold - 1e-9
        items, impacts, most = self.items, self.impacts, self.most
        while cursors:
            cursors.sort(key=lambda c: items[c[1]][c[0]])
            reach, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                reach += most[c[1] + 1]
                if reach >= slack:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = items[cursors[pivot][1]][cursors[pivot][0]]
            while pivot + 1 < len(cursors) and items[cursors[pivot + 1][1]][cursors[pivot + 1][0]] == item:
                pivot += 1
            block = item // BLOCK_ITEMS
            if sum(self.block_most[c[1]].get(block, 0.0) for c in cursors[: pivot + 1]) >= slack:
                values = []
                for c in cursors[: pivot + 1]:
                    self.advance(c, item)
                    if c[0] < len(items[c[1]]) and items[c[1]][c[0]] == item:
                        values.append(impacts[c[1]][c[0]])
                        c[0] += 1
                score = math.fsum(values)  # the same in whatever order
                if score >= slack:
                    found.append((item, score))
            else:  # no item of this block can do; the next one to look at is in a later block or where another list begins
                to = (block + 1) * BLOCK_ITEMS
                if pivot + 1 < len(cursors):
                    to = min(to, items[cursors[pivot + 1][1]][cursors[pivot + 1][0]])
                for c in cursors[: pivot + 1]:
                    self.advance(c, max(to, item + 1))
            cursors = [c for c in cursors if c[0] < len(items[c[1]])]
        return found

    def advance(self, cursor: list[int], item: int) -> None:
        places = self.items[cursor[1]]
        at, step = cursor[0], 1
        while at + step < len(places) and places[at + step] < item:
            at += step
            step *= 2
        while at < len(places) and places[at] < item:
            at += 1
        cursor[0] = at

    def windows(self, terms: np.ndarray) -> list[np.ndarray]:
        """The distinct terms of each window that can reach the threshold, by the largest impacts of its terms and then in some block."""
        step = max(1, self.longest // 2)
        width = max(int(REACH * self.longest), step) + 1
        known = np.flatnonzero(terms)
        words, at = terms[known], known
        if not len(known):
            return []
        # A word counts in a window where it comes up first: its last place before is left of the window.
        order = np.argsort(words, kind="stable")
        before = np.full(len(words), -1)
        again = words[order[1:]] == words[order[:-1]]
        before[order[1:][again]] = at[order[:-1][again]]
        value = self.most[words]
        starts = np.arange(0, max(1, len(terms) - width + step), step)
        # Each word adds its impact to the windows from after its last place to itself: a difference array over windows.
        first = np.maximum(np.maximum((at - width) // step + 1, before // step + 1), 0)
        last = np.minimum(at // step, len(starts) - 1)
        real = first <= last
        first, last, value = first[real], last[real], value[real]
        change = np.bincount(first, value, len(starts) + 1) - np.bincount(last + 1, value, len(starts) + 1)
        out, need = [], THRESHOLD - 1e-6
        for w in np.flatnonzero(np.cumsum(change[:-1]) >= need).tolist():
            inside = np.unique(words[np.searchsorted(at, w * step) : np.searchsorted(at, w * step + width)]) - 1
            sizes = self.bounds[inside + 1] - self.bounds[inside]
            flat = np.repeat(self.bounds[inside] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            if np.bincount(self.block_of[flat], self.block_value[flat]).max() >= need:
                out.append(inside)
        return out

    def leaks(self, text: str) -> list[tuple[int, float, float, float]]:
        """(item, best score, overlap of its question, overlap of its answer) of every verified item."""
        words = words_of(text)
        if not words or not self.keys:
            return []
        terms = np.fromiter(map(self.term.get, words, repeat(-1)), np.int64, len(words)) + 1
        best: dict[int, float] = {}
        for inside in self.windows(terms):
            for item, score in self.search(inside.tolist(), THRESHOLD):
                best[item] = max(best.get(item, 0.0), score)
        out = []
        text_shingles: dict[int, set] = {}
        for item, score in sorted(best.items()):
            question, answer = self.sides[item]
            own = question + answer
            covered = [False] * len(own)
            for begin, part in ((0, own), (0, question), (len(question), answer)):
                size = min(SHINGLE, len(part))
                if size and size not in text_shingles:
                    text_shingles[size] = shingles(words, size)
                for k in range(len(part) - size + 1 if size else 0):
                    if tuple(part[k : k + size]) in text_shingles[size]:
                        covered[begin + k : begin + k + size] = [True] * size
            shares = [sum(part) / len(part) if part else 1.0 for part in (covered[: len(question)], covered[len(question) :])]
            if min(shares) >= OVERLAP:
                out.append((self.keys[item], min(1.0, score), *shares))
        return out


def indexes(benchmark: DataFrame):
    """The indexes of benchmark (item_id, text) one after the other; only one shard's texts are here at a time."""
    from pyspark.sql import Window

    rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    sized = rows.withColumn("n", F.greatest(F.lit(1), F.regexp_count("text", F.lit(r"\w+"))))
    level = F.when(F.col("n") <= 64, 0).otherwise(F.ceil(F.log(4.0, F.col("n") / 64)))
    # Shards by summed words: the running sum over 256 hashed parts is bounded work for each, and small beside documents.
    part = F.pmod(F.xxhash64("item_id"), F.lit(256))
    run = F.sum("n").over(Window.partitionBy("level", "part").orderBy("item_id", "text"))
    few = sized.agg(F.sum("n")).first()[0] or 0
    if few <= SHARD_WORDS:
        placed = sized.withColumn("level", level).withColumn("part", F.lit(0)).withColumn("piece", F.lit(0))
    else:
        placed = sized.withColumn("level", level).withColumn("part", part).withColumn("piece", F.floor(run / SHARD_WORDS))
    every, words = (None, None) if few <= SHARD_WORDS else statistics(placed)
    for key in placed.select("level", "part", "piece").distinct().orderBy("level", "part", "piece").collect():
        here = (F.col("level") == key["level"]) & (F.col("part") == key["part"]) & (F.col("piece") == key["piece"])
        mine = sorted((r["item_id"], r["text"]) for r in placed.where(here).select("item_id", "text").distinct().collect())
        if every is None:
            yield BlockMaxIndex(mine)
        elif key["level"] in every:
            yield BlockMaxIndex(mine, Statistics(*every[key["level"]], {r["word"]: r["df"] for r in words.where(here).select("word", "df").collect()}))


def statistics(placed: DataFrame) -> tuple[dict[int, tuple[int, float, int]], DataFrame]:
    """For each level of placed (level, part, piece, item_id, text) its items, their mean and greatest length; and the words
    of each shard with the number of the level's items that have them (level, part, piece, word, df)."""
    from .common import staged

    names = ("level", "part", "piece")
    schema = pa.schema([*((n, pa.int64()) for n in names), ("size", pa.int64()), ("words", pa.list_(pa.string()))])

    def run(batches):
        for batch in batches:
            found = [words_of(t.as_py()) for t in batch.column(batch.schema.get_field_index("text"))]
            own = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*own, pa.array(map(len, found), pa.int64()), pa.array([sorted(set(x)) for x in found], pa.list_(pa.string()))], schema=schema)

    single = placed.select(*(F.col(n).cast("long").alias(n) for n in names), "item_id", "text").distinct()
    items = staged(single.mapInArrow(run, "level long, part long, piece long, size long, words array<string>").where("size > 0"), "items")
    sums = items.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"), F.max("size").alias("longest")).collect()
    held = items.select(*names, F.explode("words").alias("word")).groupBy(*names, "word").agg(F.count(F.lit(1)).alias("own"))
    held = staged(held, "shard-words")
    df = held.groupBy("level", "word").agg(F.sum("own").alias("df"))
    return {r["level"]: (r["n"], r["size"] / r["n"], r["longest"]) for r in sums}, staged(held.join(df, ["level", "word"]), "item-words")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: a row for each row of docs and item that it holds."""
    from .common import blocks

    spark = docs.sparkSession
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])
    out_type = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    rows, found = docs.select(F.col("doc_id").cast("long"), "text"), None
    for index in indexes(benchmark):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for ids, texts in blocks(batches):
                hits = [(k, *x) for k, t in zip(ids, texts, strict=True) for x in sent.value.leaks(t or "")]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*hits, strict=True) if hits else [[]] * 5, schema, strict=True)], schema=schema)

        one = rows.mapInArrow(run, out_type)
        found = one if found is None else found.unionByName(one)
    return found if found is not None else spark.createDataFrame([], out_type)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that hold no test item; decided row by row, without a shuffle.

    Null and empty texts hold none, null and empty items are in none; equal rows share their fate and each stays.
    """
    spark = docs.sparkSession
    for index in indexes(benchmark):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for batch in batches:
                keep = [not sent.value.leaks(t.as_py() or "") for t in batch.column(batch.schema.get_field_index("text"))]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document and test item it holds.

    Null and empty texts hold nothing and items without words are in no document; an item listed twice with one text
    counts once; repeated documents, and those without a doc_id, each give their rows; items that tie in a document all
    have a row. Very long texts are asked whole, window by window. With an empty table on either side there are no rows.
    Other columns are never read.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))

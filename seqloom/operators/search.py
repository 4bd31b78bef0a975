"""Homology search: peptides against peptides, or nucleotides in six frames against peptides, as a table of hits.

1. Seeds are runs of letters of a reduced alphabet; sequences that share one are candidates. A seed that many subjects
   have is dealt to blocks of them, so no task gets all rows of it.
2. On each diagonal with a seed the best ungapped segment is found; it has to reach a score.
3. Around those diagonals a local alignment with affine gaps is made in a band, many pairs at a time.

Scores, bits and e-values are those of the usual statistics of gapped local alignments.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions import sequences
from ..sources.staging import staged
from . import hits

# Substitution scores of BLOSUM62, below the diagonal, by the order of the letters.
LETTERS = "ARNDCQEGHILKMFPSTWYV"
BLOSUM62 = """
4
-1 5
-2 0 6
-2 -2 1 6
0 -3 -3 -3 9
-1 1 0 0 -3 5
-1 0 0 2 -4 2 5
0 -2 0 -1 -3 -2 -2 6
-2 0 1 -1 -3 0 0 -2 8
-1 -3 -3 -3 -1 -3 -3 -4 -3 4
-1 -2 -3 -4 -1 -2 -3 -4 -3 2 4
-1 2 0 -1 -3 1 1 -2 -1 -3 -2 5
-1 -1 -2 -3 -1 0 -2 -3 -2 1 2 -1 5
-2 -3 -3 -3 -2 -3 -3 -3 -1 0 0 -3 0 6
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4 7
1 -1 1 0 -1 0 0 0 -1 -2 -2 0 -1 -2 -1 4
0 -1 0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1 1 5
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1 1 -4 -3 -2 11
-2 -2 -2 -3 -2 -1 -2 -3 2 -1 -1 -2 -1 3 -3 -2 -2 2 7
0 -3 -3 -3 -1 -2 -2 -3 -3 3 1 -2 1 -1 -2 -2 0 -3 -1 4
"""
# Statistics of these scores with gaps of 11 and 1 a letter, and what a letter outside of the twenty and a stop score.
LAMBDA, K, OPEN, EXTEND, OTHER, STOP = 0.267, 0.041, 11, 1, -1, -4
# Letters that replace each other often (Murphy and others, 2000, ten groups).
GROUPS = ("LVIM", "C", "A", "G", "ST", "P", "FYW", "EDNQ", "KR", "H")
#: Rows of a subject's seed that meet a query's in one task, about.
BLOCK = 20_000
#: Seeds of the queries are broadcast up to so many.
SENT = 500_000
#: Cells of a batch of bands that are filled at once.
CELLS = 20_000
NEVER = -(1 << 20)


@dataclass(frozen=True)
class Search:
    """Shorter seeds and a lower score of segments find weaker hits, at a cost.

    seed: letters of a seed. kinds: different groups that a seed has at least, fewer are of low complexity and no seed.
    seeds: seeds that a pair shares at least. segment: score of an ungapped segment. band: diagonals on either side."""

    seed: int = 5
    kinds: int = 3
    seeds: int = 1
    segment: int = 22
    band: int = 48
    evalue: float = 1e-10


def score_table() -> np.ndarray:
    """Scores by letter codes: the twenty, another letter, a stop, and one that never matches."""
    n = len(LETTERS)
    table = np.full((n + 3, n + 3), OTHER, np.int64)
    for i, line in enumerate(BLOSUM62.split("\n")[1:-1]):
        table[i, : i + 1] = table[: i + 1, i] = [int(x) for x in line.split()]
    table[n + 1], table[:, n + 1] = STOP, STOP
    table[n + 2], table[:, n + 2] = NEVER, NEVER
    return table


SCORES = score_table()
PAD = len(LETTERS) + 2
_CODES = np.full(256, len(LETTERS), np.uint8)
_CODES[ord("*")] = len(LETTERS) + 1
for _i, _a in enumerate(LETTERS):
    _CODES[ord(_a)] = _CODES[ord(_a.lower())] = _i


def codes_of(seq: str) -> np.ndarray:
    return _CODES[np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)]


_RED = np.full(len(LETTERS) + 3, len(GROUPS), np.int64)
for _i, _g in enumerate(GROUPS):
    for _a in _g:
        _RED[LETTERS.index(_a)] = _i


#: Places of a table by which most seeds that no query has are left out at once.
SIEVE = 1 << 22


def window_numbers(groups: np.ndarray, size: int) -> np.ndarray:
    """Each run of so many groups as a number; beyond 18 letters they run over, and then tell nearly all runs apart."""
    n = max(0, len(groups) - size + 1)
    keys = np.zeros(n, np.int64)
    for i in range(size):
        keys = keys * (len(GROUPS) + 1) + groups[i : i + n]
    return keys


def good_windows(groups: np.ndarray, size: int, kinds: int) -> np.ndarray:
    """Which runs are seeds: of letters of the groups only, and not of low complexity."""
    windows = np.lib.stride_tricks.sliding_window_view(groups, size)
    return (windows < len(GROUPS)).all(1) & (sum((windows == g).any(1).astype(int) for g in range(len(GROUPS))) >= kinds)


def among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of x are among numbers in order."""
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x if len(ordered) else np.zeros(len(x), bool)


def seed_numbers(seq: str, size: int, kinds: int, wanted: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """The distinct seeds of a sequence as numbers; wanted: of these only, a sieve and the numbers in order."""
    groups = _RED[codes_of(seq)]
    keys = window_numbers(groups, size)
    if not len(keys):
        return keys
    if wanted is None:
        return np.unique(keys[good_windows(groups, size, kinds)])
    sieve, numbers = wanted
    keys = keys[sieve[keys & (SIEVE - 1)]]
    return np.unique(keys[among(keys, numbers)])


def seeds_of(rows: DataFrame, name: str, options: Search, wanted: np.ndarray | None = None) -> DataFrame:
    """name, seed: the distinct seeds of sequences (name, seq); wanted: of these only."""

    def run(batches):
        sought = None
        if wanted is not None:
            sought = np.zeros(SIEVE, bool), wanted
            sought[0][wanted & (SIEVE - 1)] = True
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                found = [seed_numbers(x.as_py(), options.seed, options.kinds, sought) for x in part["seq"]]
                at = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
                yield pa.RecordBatch.from_arrays([part[name].take(at), pa.array(np.concatenate(found))], names=[name, "seed"])

    return rows.select(name, "seq").where("seq is not null").mapInArrow(run, f"{name} {rows.schema[name].dataType.simpleString()}, seed long")


def candidates(queries: DataFrame, subjects: DataFrame, options: Search) -> DataFrame:
    """q, s: queries (q, seq) and subjects (s, seq) that share seeds."""
    asked = staged(seeds_of(queries, "q", options), "query-seeds")
    wanted = staged(asked.select("seed").distinct(), "seeds")
    if wanted.count() <= SENT:  # subjects' seeds that no query has then never leave their task
        held = seeds_of(subjects, "s", options, np.sort(wanted.toPandas()["seed"].to_numpy(np.int64)))
    else:
        held = seeds_of(subjects, "s", options).join(wanted, "seed", "left_semi")
    held = staged(held, "subject-seeds")
    sizes = held.groupBy("seed").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    asked = asked.join(sizes, "seed").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    held = held.join(sizes, "seed").withColumn("block", F.pmod(F.xxhash64("s"), F.col("blocks")).cast("int")).drop("blocks")
    shared = asked.join(held, ["seed", "block"]).groupBy("q", "s").agg(F.count(F.lit(1)).alias("n"))
    return shared.where(F.col("n") >= options.seeds).select("q", "s")


def seed_diagonals(q: np.ndarray, s: np.ndarray, options: Search) -> np.ndarray:
    """The diagonals (place in the subject less place in the query) on which the sequences share a seed."""
    k = options.seed
    if min(len(q), len(s)) < k:
        return np.zeros(0, np.int64)
    groups, b = _RED[q], window_numbers(_RED[s], k)
    a, good = window_numbers(groups, k), np.flatnonzero(good_windows(groups, k, options.kinds))
    order = np.flatnonzero(among(b, np.unique(a[good])))  # the subject's places with a seed of the query
    order = order[np.argsort(b[order], kind="stable")]
    lo, hi = np.searchsorted(b[order], a[good], "left"), np.searchsorted(b[order], a[good], "right")
    at = np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange((hi - lo).sum())
    return np.unique(order[at] - np.repeat(good, hi - lo))


def best_segment(q: np.ndarray, s: np.ndarray, diagonal: int) -> int:
    """The best score of an ungapped segment of a diagonal."""
    lo, hi = max(0, -diagonal), min(len(q), len(s) - diagonal)
    run = np.concatenate([[0], np.cumsum(SCORES[q[lo:hi], s[lo + diagonal : hi + diagonal]])])
    return int((run - np.minimum.accumulate(run)).max())


def bands(q: np.ndarray, s: np.ndarray, options: Search) -> list[int]:
    """Lowest diagonals of the bands to align in: each good diagonal has `band` of them on either side, near ones share a band."""
    good = [d for d in seed_diagonals(q, s, options).tolist() if best_segment(q, s, d) >= options.segment]
    out: list[int] = []
    for d in good:
        if not out or d > out[-1] + 2 * options.band:
            out.append(d - options.band)
    return out


ONE = 1 << 32  # what is above it and what is below it are counted in one number


def align(pairs: list[tuple[np.ndarray, np.ndarray, int]], width: int) -> list[tuple[int, int, int, int, int, int, int]]:
    """The best local alignment of each (query, subject, lowest diagonal) in a band of so many diagonals.

    Gives score, first and last places (from 0) in the query and in the subject, identical letters and columns; all
    pairs are filled row by row together. Column b of row i is place i + lowest + b of the subject.
    """
    n, rows = len(pairs), max(len(q) for q, _, _ in pairs)
    low = np.array([d for _, _, d in pairs])
    query = np.full((n, rows), PAD, np.uint8)
    subject = np.full((n, rows + width + 1), PAD, np.uint8)  # in band coordinates: place j is at j - lowest
    for p, (q, s, d) in enumerate(pairs):
        query[p, : len(q)] = q
        a, b = max(0, d), min(len(s), d + rows + width)
        if b > a:
            subject[p, a - d : b - d] = s[a:b]
    place = np.arange(width)
    score, vertical = np.zeros((n, width + 1), np.int64), np.full((n, width + 1), NEVER, np.int64)
    begin, stat = np.zeros((n, width + 1), np.int64), np.zeros((n, width + 1), np.int64)
    v_begin, v_stat = begin.copy(), stat.copy()
    best = np.zeros((n, 6), np.int64)  # score, row, column, begin, stat, -
    every = np.arange(n)
    for i in range(rows):
        letter, other = query[:, i, None], subject[:, i : i + width]
        here = (np.int64(i) * ONE + low[:, None] + i + place) + (1 << 31)  # kept above zero below the line
        fresh = score[:, :width] <= 0
        diagonal = score[:, :width] + SCORES[letter, other]
        d_begin = np.where(fresh, here, begin[:, :width])
        d_stat = np.where(fresh, 0, stat[:, :width]) + 1 + ONE * (letter == other)
        # A gap in the subject comes from the row above, one column to the right.
        opened, longer = score[:, 1:] - OPEN - EXTEND, vertical[:, 1:] - EXTEND
        new = opened >= longer
        gap = np.where(new, opened, longer)
        g_begin, g_stat = np.where(new, begin[:, 1:], v_begin[:, 1:]), np.where(new, stat[:, 1:], v_stat[:, 1:]) + 1
        take = diagonal >= gap
        top = np.where(take, diagonal, gap)
        t_begin, t_stat = np.where(take, d_begin, g_begin), np.where(take, d_stat, g_stat)
        top = np.maximum(top, 0)
        # A gap in the query comes from the left: the best column before, by a running maximum.
        lifted = top + EXTEND * place
        most = np.maximum.accumulate(lifted, 1)
        where = np.maximum.accumulate(np.where(lifted == most, place, 0), 1)
        left, at = np.full_like(top, NEVER), np.zeros_like(where)
        left[:, 1:] = most[:, :-1] - OPEN - EXTEND * place[1:]
        at[:, 1:] = where[:, :-1]
        side = left > top
        score[:, :width] = np.where(side, left, top)
        begin[:, :width] = np.where(side, np.take_along_axis(t_begin, at, 1), t_begin)
        stat[:, :width] = np.where(side, np.take_along_axis(t_stat, at, 1) + (place - at), t_stat)
        vertical[:, :width], v_begin[:, :width], v_stat[:, :width] = gap, g_begin, g_stat
        column = score[:, :width].argmax(1)
        found = score[every, column]
        better = found > best[:, 0]
        if better.any():
            c = column[better]
            best[better] = np.stack([found[better], np.full(better.sum(), i), c, begin[better, c], stat[better, c], c], 1)
    out = []
    for p, (value, row, column, start, stats, _) in enumerate(best.tolist()):
        out.append((value, start // ONE, row, start % ONE - (1 << 31), row + int(low[p]) + column, stats // ONE, stats % ONE))
    return out


def extended(pairs: list[tuple], options: Search) -> list[tuple]:
    """The best alignment of each (query, subject) of codes that has a good segment: place of the pair and what align() gives."""
    work = [(n, q, s, low) for n, (q, s) in enumerate(pairs) for low in bands(q, s, options)]
    width = 4 * options.band + 1  # the diagonals that share a band, and those on either side
    work.sort(key=lambda x: len(x[1]))
    best: dict[int, tuple] = {}
    step = max(1, CELLS // width)
    for at in range(0, len(work), step):
        part = work[at : at + step]
        for (n, *_), found in zip(part, align([x[1:] for x in part], width), strict=True):
            if n not in best or found[0] > best[n][0]:
                best[n] = found
    return sorted(best.items())


def bits(score):
    return (LAMBDA * score - math.log(K)) / math.log(2)


def found_in(pairs: DataFrame, options: Search, letters: int) -> DataFrame:
    """Alignments of pairs (q, s, qlen, qseq, sseq) within the e-value; letters: of all subjects together."""

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.slice(start, 512)
                texts = [(codes_of(a.as_py()), codes_of(b.as_py())) for a, b in zip(part["qseq"], part["sseq"], strict=True)]
                rows = []
                for n, (score, q0, q1, s0, s1, same, columns) in extended(texts, options):
                    value = len(texts[n][0]) * letters * 2.0 ** -bits(score)
                    if value <= options.evalue:
                        rows.append((n, columns, 100.0 * same / columns, q0 + 1, q1 + 1, s0 + 1, s1 + 1, value, round(bits(score), 1), score))
                at = pa.array([r[0] for r in rows], pa.int64())
                kinds = [pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int32()]
                yield pa.RecordBatch.from_arrays([part["q"].take(at), part["s"].take(at), *(pa.array([r[c + 1] for r in rows], kind) for c, kind in enumerate(kinds))], names=["q", "s", "length", "pident", "qstart", "qend", "sstart", "send", "evalue", "bitscore", "score"])

    q, s = (pairs.schema[c].dataType.simpleString() for c in "qs")
    return pairs.select("q", "s", "qseq", "sseq").mapInArrow(run, f"q {q}, s {s}, length int, pident double, qstart int, qend int, sstart int, send int, evalue double, bitscore double, score int")


def _searched(queries: DataFrame, subjects: DataFrame, options: Search) -> DataFrame:
    letters = subjects.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0))).first()[0]
    pairs = staged(candidates(queries, subjects, options), "search-pairs")
    # Dealt out by pair, so a sequence that meets very many is the work of many tasks.
    both = pairs.join(queries.withColumnRenamed("seq", "qseq"), "q").join(subjects.withColumnRenamed("seq", "sseq"), "s")
    return found_in(both.hint("rebalance"), options, letters)


def search_peptides(queries: DataFrame, subjects: DataFrame, options: Search = Search(), most: int | None = 1) -> DataFrame:  # noqa: B008
    """Hits of peptides (id, seq) on peptides (id, seq): the columns of a protein hit table and ord; `most` best of each query.

    One hit, the best alignment, for each pair. Places count from one. Null and short sequences have none.
    """
    own = [x.where("seq is not null").select(F.col("id").alias(n), "seq") for x, n in ((queries, "q"), (subjects, "s"))]
    found = _searched(*own, options).withColumnsRenamed({"q": "qseqid", "s": "sseqid"}).withColumn("ord", F.xxhash64("sseqid"))
    return hits.keep_hits(found, options.evalue, most=most).drop("score")


def six_frames(queries: DataFrame, code: int) -> DataFrame:
    """id, qframe (1 to 3, and -1 to -3 on the other strand), letters (nucleotides) and seq (translated) of each frame of records (id, seq)."""
    frames = queries.select("id", F.length("seq").alias("letters"), F.posexplode(sequences.six_translated(F.col("seq"), code)).alias("at", "seq"))
    return frames.select("id", F.when(F.col("at") < 3, F.col("at") + 1).otherwise(2 - F.col("at")).alias("qframe"), "letters", "seq")


def search_translated(queries: DataFrame, subjects: DataFrame, options: Search = Search(), most: int | None = 1, code: int = 1) -> DataFrame:  # noqa: B008
    """Hits of nucleotides (id, seq), translated in six frames, on peptides (id, seq): the columns of a nucleotide hit table and ord.

    One hit, that of the best frame, for each pair. Places on the query are those of its nucleotides, the first one
    greater than the last on the other strand.
    """
    framed = six_frames(queries.where("seq is not null"), code).select(F.struct("id", "qframe", "letters").alias("q"), "seq")
    found = _searched(framed, subjects.where("seq is not null").select(F.col("id").alias("s"), "seq"), options)
    ahead, letters = F.abs("q.qframe"), F.col("q.letters")
    first, last = ahead + 3 * (F.col("qstart") - 1), ahead + 3 * F.col("qend") - 1
    forward = F.col("q.qframe") > 0
    placed = found.select(
        F.col("q.id").alias("qseqid"), F.col("s").alias("sseqid"), "length", "pident", F.when(forward, first).otherwise(letters + 1 - first).alias("qstart"), F.when(forward, last).otherwise(letters + 1 - last).alias("qend"),
        "sstart", "send", "evalue", "bitscore", F.col("q.qframe").alias("qframe"), "score",
    )
    others = [c for c in placed.columns if c not in ("qseqid", "sseqid")]
    best = placed.groupBy("qseqid", "sseqid").agg(F.max_by(F.struct(*others), F.struct("score", "qframe")).alias("h")).select("qseqid", "sseqid", "h.*")
    return hits.keep_hits(best.withColumn("ord", F.xxhash64("sseqid")), options.evalue, most=most).drop("score")

"""Profile search: sequences against profile hidden Markov models, by Viterbi and forward scores.

A profile has match, insert and delete states for each of its nodes and emission scores against a background. An
alignment is local: it may begin in any match state and end in any, with letters of the background before and after it
(a single hit). Sequences go through all profiles in batches, row by row of the table together; nothing is joined, so a
family or a profile with very many hits is as even as the sequences are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .search import LAMBDA, LETTERS, SCORES, codes_of

#: How often the letters (in the order of LETTERS) come up in proteins, in percent, as Robinson and Robinson (1991) counted them.
BACKGROUND = np.array([7.805, 5.129, 4.487, 5.364, 1.925, 4.264, 6.295, 7.377, 2.199, 5.142, 9.019, 5.744, 2.243, 3.856, 5.203, 7.120, 5.841, 1.330, 3.216, 6.441]) / 100
BACKGROUND = BACKGROUND / BACKGROUND.sum()
#: Fixed value: the order of the letters in files of profiles.
FILE_LETTERS = "ACDEFGHIKLMNPQRSTVWY"
#: Profiles are sent to tasks in shards of about so many nodes; each shard is a pass over the sequences.
SHARD = 200_000
#: Cells that are filled at once.
CELLS = 200_000
LOW = -1e30
#: Where the tail of forward scores in bits starts for a profile without fitted values; profiles of 30 to 300 letters against
#: random sequences of 60 to 600 gave -5.4 to -3.0 at the highest twentieth.
TAIL = -3.5


@dataclass
class Profile:
    """name; match (nodes x 23) and insert emissions and moves (nodes x 7: m-m, m-i, m-d, i-m, i-i, d-m, d-d) as natural log-odds;
    mu and rate of the exponential tail of forward scores (bits), for e-values."""

    name: str
    match: np.ndarray
    insert: np.ndarray
    moves: np.ndarray
    mu: float
    rate: float = math.log(2)

    @property
    def size(self) -> int:
        return len(self.match)


def widened(odds: np.ndarray) -> np.ndarray:
    """Log-odds of the twenty letters, with those of another letter (none either way) and of stops and pads (impossible)."""
    return np.concatenate([odds, np.zeros((len(odds), 1)), np.full((len(odds), 2), LOW)], 1)


def of_sequence(name: str, seq: str, open_gap: float = 0.02, extend_gap: float = 0.4) -> Profile:
    """A profile of a single sequence: what replaces each letter as the substitution scores have it, and one rate of gaps."""
    codes = codes_of(seq)
    codes = codes[codes < 20]
    odds = LAMBDA * SCORES[:20, :20]
    odds = odds - np.log((BACKGROUND * np.exp(odds)).sum(1, keepdims=True))  # each row is a distribution
    moves = np.log([1 - 2 * open_gap, open_gap, open_gap, 1 - extend_gap, extend_gap, 1 - extend_gap, extend_gap])
    n = len(codes)
    return Profile(name, widened(odds[codes]), widened(np.zeros((n, 20))), np.tile(moves, (n, 1)), TAIL)


def parse_profiles(text: str) -> list[Profile]:
    """The profiles of a text in the plain format of version 3: negative natural logarithms, * for impossible, // at the end of each."""
    found = []
    order = [FILE_LETTERS.index(a) for a in LETTERS]
    number = lambda x: LOW if x == "*" else -float(x)
    for part in text.split("\n//"):
        lines = [x for x in part.splitlines() if x.strip()]
        head = {x.split()[0]: x.split(None, 1)[1].strip() for x in lines if len(x.split()) > 1 and not x.startswith(" ")}
        if "NAME" not in head:
            continue
        stats = {tuple(x.split()[1:3]): [float(v) for v in x.split()[3:5]] for x in lines if x.startswith("STATS")}
        body = [x.split() for x in lines[next(i for i, x in enumerate(lines) if x.startswith("HMM ")) + 2 :]]
        if body[0][0] == "COMPO":
            body = body[1:]
        body = body[2:]  # node 0: its insert emissions and moves
        rows = [body[i : i + 3] for i in range(0, len(body) - 2, 3)]
        log_background = np.log(BACKGROUND)
        match = np.array([[number(r[0][1:21][k]) for k in order] for r in rows]) - log_background
        insert = np.array([[number(r[1][:20][k]) for k in order] for r in rows]) - log_background
        mu, rate = stats.get(("LOCAL", "FORWARD"), (TAIL, math.log(2)))
        found.append(Profile(head["NAME"], widened(np.maximum(match, LOW)), widened(np.maximum(insert, LOW)), np.array([[number(x) for x in r[2][:7]] for r in rows]), mu, rate))
    return found


def read_profiles(spark: SparkSession, path: str) -> list[Profile]:
    """The profiles of a file, or of all files of a folder; read by Spark, kept by the driver as search_profiles sends them on."""
    rows = spark.read.text(path, wholetext=True).select("value").collect()
    return sorted((p for r in rows for p in parse_profiles(r[0])), key=lambda p: p.name)


def _tables(profile: Profile, codes: np.ndarray):
    """Entry and length scores: every node is as good a start, letters outside of the alignment are of the background."""
    m, n = profile.size, (codes < 22).sum(1).astype(float)
    # The chance to go on and to leave the letters before and after an alignment, against that of the background alone.
    outside = 2 * np.log(2 / (n + 2)) + np.log(n + 1) + n * np.log((n + 1) / (n + 2))
    return -math.log(m * (m + 1) / 2), outside


def scores(profile: Profile, codes: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows of letter codes (padded): the score in nats, and first and last places (from 0) of the best alignment.

    whole: the forward score, of all alignments together (places are then 0); else that of the best one (Viterbi).
    An alignment may end at any node; rows without letters score LOW.
    """
    n, width = codes.shape
    m = profile.size
    join = np.logaddexp if whole else np.maximum
    enter, outside = _tables(profile, codes)
    mm, mi, md, im, ii, dm, dd = profile.moves.T
    chain = np.concatenate([[0.0], np.cumsum(np.maximum(dd[:-1], -1e6))])  # cost of going on deleting up to each node
    match = np.full((n, m), LOW)
    insert, delete = match.copy(), match.copy()
    total, first, last = np.full(n, LOW), np.zeros(n, np.int64), np.zeros(n, np.int64)
    begin = [np.zeros((n, m), np.int64) for _ in range(3)]  # of the match, insert and delete states
    every, node = np.arange(n), np.arange(m)
    for i in range(width):
        before = [np.full((n, m), LOW) for _ in range(3)]
        before[0][:, 1:] = match[:, :-1] + mm[:-1]
        before[1][:, 1:] = insert[:, :-1] + im[:-1]
        before[2][:, 1:] = delete[:, :-1] + dm[:-1]
        ways = np.stack([np.full((n, m), enter), *before])
        emitted = profile.match[:, codes[:, i]].T
        new = np.maximum((np.logaddexp.reduce(ways) if whole else ways.max(0)) + emitted, LOW)
        held = np.maximum(join(match + mi, insert + ii) + profile.insert[:, codes[:, i]].T, LOW)
        if not whole:
            best = ways.argmax(0)
            shifted = [np.concatenate([np.zeros((n, 1), np.int64), b[:, :-1]], 1) for b in begin]
            starts = np.choose(best, [np.full((n, m), i), *shifted])
            held_begin = np.where(match + mi >= insert + ii, begin[0], begin[1])
        # Delete states follow one another within a row: a running best (or sum) once the chain's cost is taken out.
        opened = np.full((n, m), LOW)
        opened[:, 1:] = new[:, :-1] + md[:-1]
        lifted = opened - chain
        run = (np.logaddexp if whole else np.maximum).accumulate(lifted, 1)
        gone = np.maximum(run + chain, LOW)
        if not whole:
            source = np.maximum.accumulate(np.where(lifted == run, node, 0), 1)
            from_match = np.concatenate([np.zeros((n, 1), np.int64), starts[:, :-1]], 1)
            begin = [starts, held_begin, np.take_along_axis(from_match, source, 1)]
        match, insert, delete = new, held, gone
        if whole:
            total = np.logaddexp(total, np.logaddexp.reduce(match, 1))
        else:
            at = match.argmax(1)
            found = match[every, at]
            better = found > total
            total, last = np.where(better, found, total), np.where(better, i, last)
            first = np.where(better, begin[0][every, at], first)
    return np.where(total > LOW / 2, total + outside, LOW), first, last


def best_segments(profile: Profile, codes: np.ndarray) -> np.ndarray:
    """The best score in nats of an alignment without gaps, for rows of letter codes."""
    run, best = np.zeros((len(codes), profile.size)), np.zeros(len(codes))
    for i in range(codes.shape[1]):
        moved = np.zeros_like(run)
        moved[:, 1:] = run[:, :-1]
        run = np.maximum(moved + profile.match[:, codes[:, i]].T, 0)
        best = np.maximum(best, run.max(1))
    return best


def _batches(texts: list[np.ndarray], nodes: int):
    """Places of texts in batches of like length, each within CELLS, as padded rows."""
    order = sorted(range(len(texts)), key=lambda k: len(texts[k]))
    step = max(1, CELLS // max(1, nodes))
    for at in range(0, len(order), step):
        part = order[at : at + step]
        rows = np.full((len(part), max(1, max(len(texts[k]) for k in part))), 22, np.uint8)
        for r, k in enumerate(part):
            rows[r, : len(texts[k])] = texts[k]
        yield np.array(part), rows


#: Texts that are searched at once.
BATCH = 2048


def search_profiles(sequences: DataFrame, profiles: list[Profile], evalue: float = 1e-10, segment: float = 2.0) -> DataFrame:
    """target, profile, evalue, score (forward, in bits), viterbi (bits), from_aa and to_aa (from one) of peptides (id, seq) that profiles find.

    E-values are of the number of sequences searched. A sequence whose best segment without gaps is below `segment` bits
    isn't aligned in full; LOW aligns all. Null and empty sequences are found by none; of one id with several rows each
    gives its own. Equal sequences are searched once. The profiles are sent in shards of SHARD nodes, so what is broadcast is bounded however many they are.
    """
    rows = sequences.where("seq is not null").select(F.col("id").alias("target"), "seq")
    count, distinct = rows.agg(F.count(F.lit(1)), F.count_distinct("seq")).first()
    # Few bytes, but much work for each text: dealt to all cores, in batches that are worth a call each.
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-distinct // BATCH))
    texts = rows.select("seq").distinct().repartition(tasks, "seq")
    shards: list[list[Profile]] = [[]]
    for p in profiles:
        if shards[-1] and sum(x.size for x in shards[-1]) + p.size > SHARD:
            shards.append([])
        if p.size:
            shards[-1].append(p)
    names = ["seq", "profile", "evalue", "score", "viterbi", "from_aa", "to_aa"]
    bit = math.log(2)
    found = None
    for shard in shards:
        sent = rows.sparkSession.sparkContext.broadcast(shard)

        def run(batches, sent=sent):
            for batch in batches:
                for start in range(0, len(batch), BATCH):
                    part = batch.slice(start, BATCH)
                    texts = [codes_of(x.as_py()) for x in part["seq"]]
                    hits = []
                    for p in sent.value:
                        for at, codes in _batches(texts, p.size):
                            good = np.flatnonzero(best_segments(p, codes) >= segment * bit)
                            if not len(good):
                                continue
                            codes, at = codes[good], at[good]
                            best, first, last = scores(p, codes, False)
                            score = scores(p, codes, True)[0] / bit
                            value = count * np.exp(np.minimum(0, -p.rate * (score - p.mu)))
                            hits += [(at[k], p.name, value[k], score[k], best[k] / bit, first[k] + 1, last[k] + 1) for k in np.flatnonzero((value <= evalue) & (best > LOW / 2))]
                    columns = [part["seq"].take(pa.array([h[0] for h in hits], pa.int64()))]
                    columns += [pa.array([h[c] for h in hits], t) for c, t in ((1, pa.string()), (2, pa.float64()), (3, pa.float64()), (4, pa.float64()), (5, pa.int32()), (6, pa.int32()))]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        one = texts.mapInArrow(run, "seq string, profile string, evalue double, score double, viterbi double, from_aa int, to_aa int")
        found = one if found is None else found.unionByName(one)
    return rows.join(found, "seq").select("target", *names[1:])

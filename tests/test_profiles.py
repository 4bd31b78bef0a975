"""Profile search against a listing of all paths, and its parts."""

import math
import random

import numpy as np
import pytest

from seqloom.operators import hits, profiles
from seqloom.operators.search import LETTERS, codes_of


def random_profile(rng, nodes):
    odds = np.array([[rng.uniform(-2, 2) for _ in range(20)] for _ in range(nodes)])
    move = lambda k: np.log(np.array(x := [rng.uniform(0.1, 1) for _ in range(k)]) / sum(x))
    moves = np.array([np.concatenate([move(3), move(2), move(2)]) for _ in range(nodes)])
    return profiles.Profile("p", profiles.widened(odds), profiles.widened(odds[::-1] / 2), moves, 0.0)


def every_path(p, codes):
    """Log scores, starts and ends of all local alignments, one path after the other."""
    out = []

    def go(state, k, i, score, start):  # letters up to i are used
        if state == "m":
            out.append((score, start, i))
        mm, mi, md, im, ii, dm, dd = p.moves[k]
        onward = {"m": (mm, mi, md), "i": (im, ii, None), "d": (dm, None, dd)}[state]
        if k + 1 < p.size and i + 1 < len(codes):
            go("m", k + 1, i + 1, score + onward[0] + p.match[k + 1, codes[i + 1]], start)
        if onward[1] is not None and i + 1 < len(codes):
            go("i", k, i + 1, score + onward[1] + p.insert[k, codes[i + 1]], start)
        if onward[2] is not None and k + 1 < p.size:
            go("d", k + 1, i, score + onward[2], start)

    enter = -math.log(p.size * (p.size + 1) / 2)
    for i in range(len(codes)):
        for k in range(p.size):
            go("m", k, i, enter + p.match[k, codes[i]], i)
    return out


@pytest.mark.parametrize("nodes", [1, 2, 3, 4])
def test_scores_equal_a_listing_of_all_paths(nodes):
    rng = random.Random(nodes)
    p = random_profile(rng, nodes)
    texts = ["".join(rng.choice(LETTERS) for _ in range(n)) for n in (1, 2, 3, 5, 5)]
    rows = np.full((len(texts), 7), 22, np.uint8)
    for r, t in zip(rows, texts):
        r[: len(t)] = codes_of(t)
    outside = profiles._tables(p, rows)[1]
    (best, first, last), (total, _, _) = profiles.scores(p, rows, False), profiles.scores(p, rows, True)
    for n, t in enumerate(texts):
        paths = every_path(p, codes_of(t))
        top = max(x[0] for x in paths)
        assert math.isclose(best[n] - outside[n], top) and (first[n], last[n]) in {x[1:] for x in paths if math.isclose(x[0], top)}
        assert math.isclose(total[n] - outside[n], np.logaddexp.reduce([x[0] for x in paths]))
        alone = profiles.scores(p, rows[n : n + 1, : len(t)], True)[0][0]
        assert math.isclose(alone, total[n])


def test_a_profile_of_a_sequence_is_a_distribution():
    p = profiles.of_sequence("x", "MKWVTF*X")
    assert p.size == 6 and np.allclose((np.exp(p.match[:, :20]) * profiles.BACKGROUND).sum(1), 1) and np.allclose(np.exp(p.moves[:, :3]).sum(1), 1)


FILE = """HMMER3/f [3.1b2]
NAME  fam{n}
LENG  2
STATS LOCAL MSV       -9.9014  0.70957
STATS LOCAL VITERBI  -10.7224  0.70957
STATS LOCAL FORWARD   -4.1637  0.70957
HMM          A        C        D        E
            m->m     m->i     m->d     i->m     i->i     d->m     d->d
  COMPO   {twenty}
          {twenty}
          0.1 4.0 5.0 0.6 0.7 0.0 *
      1   {twenty} 1 m - - -
          {twenty}
          0.2 3.0 3.5 0.6 0.7 0.5 0.9
      2   {twenty} 2 m - - -
          {twenty}
          0.3 3.0 * 0.6 0.7 0.0 *
//
"""


def test_profiles_are_read(spark, tmp_path):
    twenty = " ".join(f"{2 + k / 10:.1f}" for k in range(20))
    (tmp_path / "a.hmm").write_text("".join(FILE.format(n=n, twenty=twenty) for n in (2, 1)))
    found = profiles.read_profiles(spark, str(tmp_path))
    assert [p.name for p in found] == ["fam1", "fam2"] and (found[0].mu, found[0].rate, found[0].size) == (-4.1637, 0.70957, 2)
    assert math.isclose(found[0].match[0, LETTERS.index("C")], -2.1 - math.log(profiles.BACKGROUND[LETTERS.index("C")]))
    assert found[0].moves[0].tolist() == [-0.2, -3.0, -3.5, -0.6, -0.7, -0.5, -0.9] and found[0].moves[1][2] == profiles.LOW


def test_search_finds_families_and_feeds_the_slices(spark, monkeypatch):
    rng = random.Random(3)
    base = ["".join(rng.choice(LETTERS) for _ in range(90)) for _ in range(3)]
    noise = lambda n: "".join(rng.choice(LETTERS) for _ in range(n))
    changed = lambda s: "".join(rng.choice(LETTERS) if rng.random() < 0.3 else c for c in s)
    rows = [(f"r{k}|RF1", noise(20) + changed(base[k % 3])[:40] + noise(3) + changed(base[k % 3])[42:] + noise(15)) for k in range(12)]
    rows += [(f"x{k}|RF2", noise(120)) for k in range(20)] + [("none", None), ("empty", ""), ("stop", "*" * 50), ("r0|RF1", rows[0][1])]
    data = spark.createDataFrame(rows, "id string, seq string")
    models = [profiles.of_sequence(f"OG{n}", b) for n, b in enumerate(base)] + [profiles.of_sequence("nothing", "")]
    found = profiles.search_profiles(data, models, 1e-5, segment=profiles.LOW)
    got = sorted(tuple(r) for r in found.collect())
    assert {(t, p) for t, p, *_ in got} == {(f"r{k}|RF1", f"OG{k % 3}") for k in range(12)} and len(got) == 13
    assert all(18 <= r[5] <= 26 and 90 <= r[6] <= 130 and r[3] >= r[4] for r in got)
    assert sorted(tuple(r) for r in profiles.search_profiles(data, models, 1e-5).collect()) == got
    monkeypatch.setattr(profiles, "SHARD", 1)
    monkeypatch.setattr(profiles, "CELLS", 100)
    close = lambda a, b: all(x == y or math.isclose(x, y, rel_tol=1e-9) for x, y in zip(a, b))
    again = sorted(tuple(r) for r in profiles.search_profiles(data, models, 1e-5).collect())
    assert len(again) == len(got) and all(map(close, got, again))
    nucleotides = spark.createDataFrame([(f"r{k}", "ACG" * 140) for k in range(12)], "id string, seq string")
    cut = hits.slice_profile_orfs(nucleotides, found)
    assert {r["id"] for r in cut.collect()} == {f"r{k}" for k in range(12)}
    assert profiles.search_profiles(data.limit(0), models).collect() == profiles.search_profiles(data, []).collect() == []


def test_equal_sequences_are_searched_once(spark):
    rows = [(k, "ACDEFGHIKLMNPQRSTVWY" * 2 if k % 3 else "WYWYWYHHHKKKLLLMMM") for k in range(30)] + [(98, ""), (99, None)]
    frame = spark.createDataFrame(rows, "id long, seq string")
    model = profiles.of_sequence("p", "ACDEFGHIKLMNPQRSTVWY")
    got = profiles.search_profiles(frame, [model], 1e6)
    assert {r["target"] for r in got.collect()} >= {k for k in range(30) if k % 3} and got.where("target in (1, 2)").select("score", "from_aa").distinct().count() == 1
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Aggregate [seq")  # below the search stands the distinct of its texts

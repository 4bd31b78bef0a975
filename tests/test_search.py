"""Homology search against full dynamic programming."""

import math
import random

import numpy as np
import pytest

from seqloom.functions import sequences
from seqloom.operators import search
from seqloom.sources import text_formats as tf

AA = search.LETTERS


def plain_score(a, b):
    """The best local score with affine gaps, by the whole table."""
    code = search.codes_of
    x, y = code(a), code(b)
    never = -(10**9)
    h, v = [0] * (len(y) + 1), [never] * (len(y) + 1)
    best = 0
    for i in range(len(x)):
        before, left = 0, never
        for j in range(1, len(y) + 1):
            v[j] = max(h[j] - search.OPEN - search.EXTEND, v[j] - search.EXTEND)
            left = max(h[j - 1] - search.OPEN - search.EXTEND, left - search.EXTEND)
            now = max(0, before + int(search.SCORES[x[i], y[j - 1]]), v[j], left)
            before, h[j] = h[j], now
            best = max(best, now)
    return best


def mutated(rng, seq, share, gaps):
    out = [rng.choice(AA) if rng.random() < share else c for c in seq]
    for _ in range(gaps):
        at = rng.randrange(len(out))
        out[at : at + rng.randrange(3)] = [rng.choice(AA) for _ in range(rng.randrange(12))]
    return "".join(out)


@pytest.fixture(scope="module")
def peptides():
    rng = random.Random(9)
    base = ["".join(rng.choice(AA) for _ in range(rng.randrange(60, 250))) for _ in range(12)]
    subjects = [(f"s{n}|OG{n}", b) for n, b in enumerate(base)] + [("rep", "A" * 200), ("odd", "ACDX*BZJ" * 12), ("none", None), ("short", "MK")]
    queries = [(f"q{k}", mutated(rng, base[k % 12], rng.choice([0, 0.1, 0.3, 0.5]), rng.randrange(4))) for k in range(40)]
    queries += [("two", base[0][:60] + base[1][:70]), ("low", "A" * 90), ("null", None), ("tiny", "W"), ("empty", "")]
    return queries, subjects


def test_a_table_of_scores():
    assert (search.SCORES == search.SCORES.T).all() and search.SCORES[AA.index("W"), AA.index("W")] == 11 and search.SCORES[AA.index("I"), AA.index("V")] == 3
    assert sorted("".join(search.GROUPS)) == sorted(AA)


def test_hits_equal_full_dynamic_programming(spark, peptides):
    queries, subjects = peptides
    q, s = (spark.createDataFrame(x, "id string, seq string") for x in (queries, subjects))
    letters = sum(len(b or "") for _, b in subjects)
    got = {(r["qseqid"], r["sseqid"]): r for r in search.search_peptides(q, s, search.Search(seed=4, segment=15, evalue=1e-6), most=None).collect()}
    want = {}
    for a, x in queries:
        for b, y in subjects:
            if x and y:
                score = plain_score(x, y)
                if len(x) * letters * 2.0 ** -search.bits(score) <= 1e-6 and len(set(x)) > 2:
                    want[a, b] = score
    assert set(got) == set(want) and len(want) > 30
    text = dict(queries), dict(subjects)
    for key, r in got.items():
        assert r["bitscore"] == round(search.bits(want[key]), 1) and math.isclose(r["evalue"], len(text[0][key[0]]) * letters * 2.0 ** -search.bits(want[key]))
        x, y = text[0][key[0]][r["qstart"] - 1 : r["qend"]], text[1][key[1]][r["sstart"] - 1 : r["send"]]
        assert plain_score(x, y) == want[key] and max(len(x), len(y)) <= r["length"] <= len(x) + len(y)
        assert 0 < r["pident"] <= 100 and round(r["pident"] * r["length"] / 100) <= min(len(x), len(y))
    usual = {(r["qseqid"], r["sseqid"]): r["bitscore"] for r in search.search_peptides(q, s, most=None).collect()}
    strong = {k for k, r in got.items() if r["evalue"] <= 1e-10}
    assert set(usual) <= strong and len(usual) >= 0.95 * len(strong) and all(got[k]["bitscore"] == v for k, v in usual.items())
    (one,) = [r for r in search.search_peptides(q.where("id = 'two'"), s).collect()]
    assert one["sseqid"] == max((("s0|OG0", want["two", "s0|OG0"]), ("s1|OG1", want["two", "s1|OG1"])), key=lambda x: x[1])[0]


def test_blocks_of_a_common_seed(spark, peptides, monkeypatch):
    q, s = (spark.createDataFrame(x, "id string, seq string") for x in peptides)
    rows = lambda: sorted(tuple(r) for r in search.search_peptides(q, s, most=None).collect())
    whole = rows()
    monkeypatch.setattr(search, "BLOCK", 1)
    assert rows() == whole
    monkeypatch.setattr(search, "SENT", 0)
    assert rows() == whole


def test_no_sequences(spark, peptides):
    q, s = (spark.createDataFrame(x, "id string, seq string") for x in peptides)
    assert search.search_peptides(q.limit(0), s).collect() == search.search_peptides(q, s.limit(0)).collect() == []


def test_alignment_batches_of_any_size(peptides):
    queries, subjects = ([search.codes_of(x) for _, x in p if x] for p in peptides)
    pairs = [(a, b, -40) for a in queries[:6] for b in subjects[:4]]
    assert search.align(pairs, 120) == [search.align([p], 120)[0] for p in pairs]


def test_translated_search_gives_places_on_the_nucleotides(spark):
    rng = random.Random(4)
    codon = {}
    for c, a in sequences.code_table(1).items():
        codon.setdefault(a, c)
    peptide = "".join(rng.choice(AA) for _ in range(80))
    cds = "".join(codon[a] for a in peptide)
    back = lambda x: x[::-1].translate(str.maketrans("ACGT", "TGCA"))
    queries = [("ahead", "GGC" + "A" + cds + "TTTT"), ("behind", back("GGCAA" + cds + "TT")), ("other", "ACGT" * 50)]
    q = spark.createDataFrame(queries, "id string, seq string")
    s = spark.createDataFrame([("ref|OG1", peptide), ("x", "W" * 50)], "id string, seq string")
    found = search.search_translated(q, s)
    rows = {r["qseqid"]: r for r in found.collect()}
    assert set(rows) == {"ahead", "behind"} and [c.split()[0] for c in tf.HIT_COLUMNS.split(", ")] == [c for c in found.columns if c != "ord"]
    for name, seq in queries[:2]:
        r = rows[name]
        cut = seq[r["qstart"] - 1 : r["qend"]] if r["qframe"] > 0 else back(seq[r["qend"] - 1 : r["qstart"]])
        assert cut == cds and (r["sstart"], r["send"], r["pident"]) == (1, 80, 100.0)
    assert rows["ahead"]["qframe"] == 2 and rows["behind"]["qframe"] == -3


def test_only_seeds_that_queries_have_are_handed_on():
    rng = np.random.default_rng(3)
    text = lambda n: "".join(rng.choice(list(AA + "Xa"), n))
    query, subject = text(60), text(400)
    subject = subject[:200] + query[10:40] + subject[200:]
    asked = search.seed_numbers(query, 5, 3)
    sieve = np.zeros(search.SIEVE, bool)
    sieve[asked & (search.SIEVE - 1)] = True
    got = search.seed_numbers(subject, 5, 3, (sieve, asked))
    assert len(got) and got.tolist() == np.intersect1d(asked, search.seed_numbers(subject, 5, 3)).tolist()
    assert len(search.seed_numbers("AAC", 5, 3)) == len(search.seed_numbers("AAAAAAAA", 5, 3)) == 0

"""Reference genes in records, against sets of minimisers made letter by letter."""

import random

import pytest

from seqloom.operators import containment, records


def back(seq):
    return seq[::-1].translate(str.maketrans("ACGTacgt", "TGCAtgca"))


def plain_minimisers(seq, k, window):
    def hashed(x):
        if set(x) - set("ACGT"):
            return 2**64 - 1
        v = min(int("".join(str("ACGT".index(c)) for c in y), 4) for y in (x, back(x))) + 1
        v = (v ^ (v >> 31)) * 0x7FB5D329728EA185 % 2**64
        return v ^ (v >> 27)

    seq = seq.upper().replace("U", "T")
    h = [hashed(seq[i : i + k]) for i in range(len(seq) - k + 1)]
    least = [min(h[i : i + window]) for i in range(len(h) - window + 1)] if len(h) > window else h
    return {v for v in least if v != 2**64 - 1}


@pytest.mark.parametrize(("k", "window"), [(3, 2), (11, 5), (31, 10)])
def test_minimisers(k, window):
    rng = random.Random(k)
    for n in (0, 2, 10, 31, 40, 300):
        seq = "".join(rng.choice("ACGTACGTACGTNacu") for _ in range(n))
        got = {int(x) % 2**64 for x in containment.minimisers(seq, k, window)}
        assert got == plain_minimisers(seq, k, window) and set(containment.minimisers(back(seq.upper().replace("U", "T")), k, window).tolist()) == set(containment.minimisers(seq, k, window).tolist())


def test_planted_genes_are_found(spark, monkeypatch):
    rng = random.Random(6)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    genes = {(kingdom, f"{kingdom}{n}"): dna(600) for kingdom in ("bac", "arc", "mito", "euk") for n in range(2)}
    old = lambda s, share: "".join(rng.choice("ACGT") if rng.random() < share else c for c in s)
    planted = {f"r{k}": list(genes)[k % 8] for k in range(16)}
    rows = [(key, dna(300) + (old(genes[of], 0.05) if k % 2 else back(old(genes[of], 0.05))) + dna(500)) for k, (key, of) in enumerate(planted.items())]
    rows += [(f"n{k}", dna(1500)) for k in range(20)] + [("null", None), ("short", "ACG"), ("part", genes["bac", "bac0"][:100] + dna(400)), rows[0]]
    data = spark.createDataFrame(rows, "id string, seq string")
    references = spark.createDataFrame([(*k, s) for k, s in genes.items()] + [("bac", "none", None), ("bac", "tiny", "ACGTACGTACGTAC")], "kingdom string, id string, seq string")
    found = containment.contained(data, references)
    got = sorted(tuple(r) for r in found.collect())
    assert {r[0]: (r[1], r[2]) for r in got} == planted and len(got) == len(planted)
    sets = {k: plain_minimisers(s, 11, 5) for k, s in genes.items()}
    for key, kingdom, reference, share in got:
        mine, ref = plain_minimisers(dict(rows)[key], 11, 5), sets[kingdom, reference]
        assert share == len(mine & ref) / len(ref)
    hit, clean = records.split_by_hits(data, containment.by_kingdom(found, ["bac", "arc", "mito", "euk"]))
    assert {r["id"] for r in hit.collect()} == set(planted) and clean.count() == 23
    monkeypatch.setattr(containment, "SENT", 0)
    assert sorted(tuple(r) for r in containment.contained(data, references).collect()) == got
    assert containment.contained(data.limit(0), references).collect() == containment.contained(data, references.limit(0)).collect() == []

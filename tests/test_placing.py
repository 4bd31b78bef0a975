"""Sequences added to alignments, against a plain search of all ways; placements grafted on trees."""

import json
import random
from functools import cache

import numpy as np
import pytest

from seqloom.operators import placing, trees
from seqloom.operators.search import EXTEND, LETTERS, OPEN, codes_of
from seqloom.plans import modules


def plain_best(seq, scores, filled):
    """The best score by trying, letter by letter and column by column, every way to go on."""
    codes, w = codes_of(seq), len(scores)

    @cache
    def go(i, j, state):
        best = 0.0 if i == len(codes) and state != "skip" else -1e18
        if i < len(codes):
            if j < w:
                best = max(best, scores[j, codes[i]] + go(i + 1, j + 1, "match"))
            best = max(best, -EXTEND - (0 if state == "drop" else OPEN) + go(i + 1, j, "drop"))
            if j < w and state == "start":
                best = max(best, go(i, j + 1, "start"))
            elif j < w:
                best = max(best, -EXTEND * filled[j] - (0 if state == "skip" else OPEN * filled[j]) + go(i, j + 1, "skip"))
        return best

    return go(0, 0, "start")


def scored(seq, places, scores, filled):
    """The score of a given way, where letters that are left out come as early as they can."""
    codes, total, state, j = codes_of(seq), 0.0, "start", 0
    for code, place in zip(codes, places):
        if place < 0:
            total -= EXTEND + (0 if state == "drop" else OPEN)
            state = "drop"
            continue
        while j < place:
            if state != "start":
                total -= EXTEND * filled[j] + (0 if state == "skip" else OPEN * filled[j])
                state = "skip"
            j += 1
        total += scores[j, code]
        state, j = "match", j + 1
    return total


@pytest.mark.parametrize("seed", range(12))
def test_the_best_way_is_found(seed):
    rng = random.Random(seed)
    rows = ["".join(rng.choice("ACDW-") for _ in range(rng.choice([1, 4, 7]))) for _ in range(1)]
    rows += ["".join(rng.choice("ACDW-") for _ in rows[0]) for _ in range(3)]
    cells = [(c, a, sum(r[c] == a for r in rows)) for c in range(len(rows[0])) for a in LETTERS if any(r[c] == a for r in rows)]
    scores, filled = placing.column_scores(len(rows[0]), len(rows), cells)
    for _ in range(6):
        seq = "".join(rng.choice("ACDWX") for _ in range(rng.randrange(1, 8)))
        score, places = placing.fitted(seq, scores, filled)
        assert np.isclose(score, plain_best(seq, scores, filled))
        used = [p for p in places if p >= 0]
        assert used == sorted(set(used)) and (scored(seq, places, scores, filled) <= score + 1e-9)
    assert placing.fitted("", scores, filled) == (0.0, [])


def test_sequences_are_added_without_new_columns(spark):
    base = "MKTAYIAKQRQISFVKSHFSRQ"
    aligned = spark.createDataFrame([("g", "a", base[:10] + "--" + base[10:]), ("g", "b", base[:10] + "WW" + base[10:]), ("g", "c", base[:10] + "--" + base[10:]), ("h", "a", "MK"), ("n", "a", None)], "og string, id string, seq string")
    new = [("g", "same", base), ("g", "with", base[:10] + "WW" + base[10:]), ("g", "more", base[:5] + "PPPPPP" + base[5:]), ("g", "part", base[8:]), ("g", "empty", ""), ("g", "null", None), ("x", "none", base), ("h", "short", "mk-"), ("h", "h2", "W")]
    rows = {r["id"]: r for r in placing.added_to_alignments(spark.createDataFrame(new, "og string, id string, seq string"), aligned).collect()}
    assert set(rows) == {"same", "with", "more", "part", "empty", "short", "h2"}
    assert rows["same"]["aligned"] == base[:10] + "--" + base[10:] and rows["with"]["aligned"] == base[:10] + "WW" + base[10:]
    assert rows["more"]["aligned"] == rows["same"]["aligned"] and rows["more"]["left_out"] == 6
    assert rows["part"]["aligned"] == "-" * 8 + base[8:10] + "--" + base[10:] and rows["empty"]["aligned"] == "-" * 24
    assert rows["short"]["aligned"] == "MK" and all(len(r["aligned"]) == 24 for r in rows.values() if r["og"] == "g")


def file_of(placements):
    fields = ["edge_num", "likelihood", "like_weight_ratio", "distal_length", "pendant_length"]
    tree = "((Bac|b|1|OG1:1{0},Euk|c|1|OG1:2{1}):0.5{2},(Dis|d|1|OG1:1{3},Bac|e|1|OG1:1{4}):0.5{5}){6};"
    return json.dumps({"version": 3, "tree": tree, "fields": fields, "placements": placements, "metadata": {}})


def test_placements_become_leaves(spark, tmp_path):
    row = lambda edge, weight, distal, pendant: [edge, -1.0, weight, distal, pendant]
    placed = [{"p": [row(4, 0.1, 0, 9), row(0, 0.8, 0.75, 0.2)], "n": ["Tax|x|1|OG1"]}, {"p": [row(0, 0.9, 0.25, 0.3)], "nm": [["Tax|y|1|OG1", 1], ["Tax|z|1|OG1", 2]]}]
    (tmp_path / "OG1.x.jplace").write_text(file_of(placed))
    (tmp_path / "OG2.jplace").write_text(file_of([]))
    found = {r["tree_id"]: r["newick"] for r in placing.read_placements(spark, str(tmp_path)).collect()}
    root = trees.parse_newick(found["OG1"])
    leaves = {n.name: n for n in root.leaves()}
    assert set(leaves) == {"Bac|b|1|OG1", "Euk|c|1|OG1", "Dis|d|1|OG1", "Bac|e|1|OG1", "Tax|x|1|OG1", "Tax|y|1|OG1", "Tax|z|1|OG1"}

    def to_root(node):
        return {} if node is None else {node: 0.0} | {n: d + node.dist for n, d in to_root(node.parent).items()}

    def up(node, other):
        """How long the way between two nodes is."""
        one, two = to_root(node), to_root(other)
        return min(one[n] + two[n] for n in one if n in two)

    b, x, y, z, c = (leaves[n] for n in ("Bac|b|1|OG1", "Tax|x|1|OG1", "Tax|y|1|OG1", "Tax|z|1|OG1", "Euk|c|1|OG1"))
    assert [round(up(b, o), 6) for o in (y, z, x, c)] == [0.55, 0.55, 0.95, 3.0] and round(up(x, c), 6) == 0.2 + 0.25 + 2
    assert {n.name for n in trees.parse_newick(found["OG2"]).leaves()} == set(leaves) - {"Tax|x|1|OG1", "Tax|y|1|OG1", "Tax|z|1|OG1"}
    lineages = spark.createDataFrame([("Tax", "Eukaryota", "SAR", "S", "x"), ("Bac", "Bacteria", "P", "G", "y"), ("Euk", "Eukaryota", "O", "M", "z"), ("Dis", "Eukaryota", "D", "E", "w")], "taxon string, domain string, supergroup string, major string, minor string")
    out = modules.contam_by_trees(placing.read_placements(spark, str(tmp_path)), lineages, modules.Contam(taxon="Tax"))
    assert {r["sequence"] for r in out["detail"].collect()} == {"Tax|x|1|OG1", "Tax|y|1|OG1", "Tax|z|1|OG1"}

"""Sequences added to fixed alignments, and placements on trees turned into trees: what a taxon's new sequences need to be
held against gene families that are aligned and have trees already.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .search import EXTEND, LETTERS, OPEN, SCORES, codes_of
from .trees import Node, parse_newick, resolve, to_newick

LOW = -1e18


def columns_of(alignments: DataFrame) -> DataFrame:
    """og, width and counts (of each letter in each column, column by column) of alignments (og, id, seq with - for gaps).

    Columns are counted by tasks as they read, so an alignment of any depth is a row of width times twenty numbers.
    Rows of a family that are shorter than its widest one count as ending in gaps.
    """
    place = F.posexplode(F.split(F.upper("seq"), "")).alias("place", "letter")
    letters = alignments.where("seq is not null").select("og", place).where(F.length("letter") > 0)
    counts = letters.groupBy("og", "place", "letter").agg(F.count(F.lit(1)).alias("n"))
    held = counts.where(F.col("letter").isin(list(LETTERS))).groupBy("og").agg(F.collect_list(F.struct("place", "letter", "n")).alias("cells"))
    sizes = alignments.where("seq is not null").groupBy("og").agg(F.max(F.length("seq")).alias("width"), F.count(F.lit(1)).alias("depth"))
    return sizes.join(held, "og", "left")


def column_scores(width: int, depth: int, cells) -> tuple[np.ndarray, np.ndarray]:
    """Scores of each letter code against each column (its letters' mean), and the share of its rows that have a letter."""
    counts = np.zeros((width, len(LETTERS)))
    for place, letter, n in cells or ():
        counts[place, LETTERS.index(letter)] = n
    filled = counts.sum(1)
    return (counts / np.maximum(filled, 1)[:, None]) @ SCORES[: len(LETTERS)].astype(float), filled / max(1, depth)


def fitted(seq: str, scores: np.ndarray, filled: np.ndarray) -> tuple[float, list[int]]:
    """The best score and the column of each letter of a sequence (-1: left out, as no column may be added).

    A gap costs OPEN and EXTEND a letter. Where columns get no letter the cost is in proportion to how many rows have one;
    columns before the first and after the last letter cost nothing. Memory is in proportion to letters times columns.
    """
    codes = codes_of(seq)
    n, w = len(codes), len(scores)
    extend = np.concatenate([[0.0], np.cumsum(EXTEND * filled)])  # of the first columns
    open_at = np.append(OPEN * filled, 0.0)
    # Columns 0 to w; a state at column j has used columns up to j.
    match, insert, skip = np.full(w + 1, LOW), np.full(w + 1, LOW), np.zeros(w + 1)
    from_match, from_insert = np.zeros((n + 1, w + 1), np.int8), np.zeros((n + 1, w + 1), np.int8)
    skip_to, skip_state = np.zeros((n + 1, w + 1), np.int32), np.zeros((n + 1, w + 1), np.int8)
    skip_to[0] = -1  # nothing has been placed yet
    columns = np.arange(w + 1)
    for i in range(1, n + 1):
        ways = np.stack([match, insert, skip])
        best = ways.argmax(0)
        new = np.full(w + 1, LOW)
        new[1:] = ways.max(0)[:-1] + scores[:, codes[i - 1]]
        from_match[i, 1:] = best[:-1]
        left = np.stack([match - OPEN - EXTEND, insert - EXTEND, skip - OPEN - EXTEND])
        from_insert[i] = left.argmax(0)
        dropped = left.max(0)
        held = np.maximum(new, dropped)
        lifted = held - open_at + extend
        run = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == run, columns, 0))
        over = np.full(w + 1, LOW)
        over[1:] = run[:-1] - extend[1:]
        skip_to[i, 1:] = source[:-1]
        skip_state[i] = (dropped > new)[skip_to[i]]
        match, insert, skip = new, dropped, over
    ends = np.stack([match, insert])
    state, j = np.unravel_index(int(ends.argmax()), ends.shape)
    score = float(ends[state, j]) if n else 0.0
    out, i = [-1] * n, n
    while i > 0:
        if state == 2:
            state, j = int(skip_state[i, j]), int(skip_to[i, j])
        elif state == 0:
            out[i - 1] = int(j) - 1
            state, i, j = int(from_match[i, j]), i - 1, j - 1
        else:
            state, i = int(from_insert[i, j]), i - 1
    return score, out


def added_to_alignments(sequences: DataFrame, alignments: DataFrame) -> DataFrame:
    """og, id, aligned, score and left_out (letters that no column could take) of peptides (og, id, seq), as wide as the alignments (og, id, seq).

    Sequences don't see each other, so each is the same whatever comes with it; families without an alignment and null
    sequences give no row.
    """
    kinds = dict(sequences.dtypes)
    rows = sequences.where("seq is not null").select("og", "id", "seq").join(columns_of(alignments), "og")

    def run(batches):
        known: dict = {}
        for batch in batches:
            for at in range(len(batch)):
                og, key, seq, width, depth, cells = (batch.column(c)[at] for c in ("og", "id", "seq", "width", "depth", "cells"))
                name = og.as_py()
                if name not in known:
                    known.clear()  # rows of a family come together, for the most part
                    known[name] = column_scores(width.as_py(), depth.as_py(), [tuple(c.values()) for c in cells.as_py() or ()])
                text = re.sub(r"[\s\-.*]", "", seq.as_py().upper())
                score, places = fitted(text, *known[name])
                line = ["-"] * width.as_py()
                for letter, place in zip(text, places, strict=True):
                    if place >= 0:
                        line[place] = letter
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((name, og.type), (key.as_py(), key.type), ("".join(line), pa.string()), (score, pa.float64()), (places.count(-1), pa.int32()))], names=["og", "id", "aligned", "score", "left_out"])

    return rows.mapInArrow(run, f"og {kinds['og']}, id {kinds['id']}, aligned string, score double, left_out int")


def numbered_tree(text: str) -> tuple[Node, dict[int, Node]]:
    """A tree whose branches carry numbers in braces, and the node under each branch."""
    edges: dict[int, Node] = {}
    root = parse_newick(re.sub(r"(:[^,(){}\[\];]*)?\{(\d+)\}", lambda m: f"#{m[2]}#{m[1] or ''}", text))
    for node in root.walk():
        if found := re.search(r"#(\d+)#$", node.name):
            node.name = node.name[: found.start()]
            edges[int(found[1])] = node
    return root, edges


def grafted(text: str) -> str:
    """The tree of a placement file (JSON with tree, fields and placements), every placed sequence a leaf where it fits best.

    The best place is that of the largest weight (of the first such). Sequences placed on one branch hang on it in the
    order of their distances; each hangs by its own pendant length.
    """
    data = json.loads(text)
    fields = {name: k for k, name in enumerate(data["fields"])}
    root, edges = numbered_tree(data["tree"])
    held: dict[int, list[tuple[float, float, str]]] = {}
    for entry in data["placements"]:
        best = max(entry["p"], key=lambda p: p[fields["like_weight_ratio"]])
        names = list(entry.get("n", [])) + [x[0] for x in entry.get("nm", [])]
        held.setdefault(int(best[fields["edge_num"]]), []).extend((float(best[fields["distal_length"]]), float(best[fields["pendant_length"]]), n) for n in names)
    for edge, placed in sorted(held.items()):
        below = edges[edge]
        over, length, used = below.parent, below.dist, 0.0
        for distal, pendant, name in sorted(placed):  # from the lower end upwards
            distal = min(max(distal, used), length)
            joint = Node("", length - distal)
            if over is None:
                root = joint
            else:
                over.children[over.children.index(below)] = joint
            joint.parent = over
            below.dist = distal - used
            joint.add(below)
            joint.add(Node(name, pendant))
            below, used = joint, distal
    return to_newick(resolve(root))


def read_placements(spark: SparkSession, path: str) -> DataFrame:
    """tree_id (the file name up to its first point) and newick of placement files, one a family, with the placed sequences as leaves."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("f"), "value")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("tree_id"), pa.array([grafted(x.as_py()) for x in batch.column("value")], pa.string())], names=["tree_id", "newick"])

    return rows.select(F.split_part("f", F.lit("."), F.lit(1)).alias("tree_id"), "value").mapInArrow(run, "tree_id string, newick string")

"""Redundancy: shorter sequences that lie in a longer one at a given identity are folded into it, longest first."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F


def covered(short: str, long: str, identity: float) -> bool:
    """Whether some place of the longer sequence has the whole shorter one with at most (1 - identity) of its letters changed."""
    if short in long:
        return True
    most, n = int((1 - identity) * len(short) + 1e-9), len(short)
    if not most:
        return False
    parts = most + 1  # with so few changes one of the parts is untouched
    for p in range(parts):
        a, b = p * n // parts, (p + 1) * n // parts
        at = long.find(short[a:b]) if b > a else -1
        while at >= 0:
            begin = at - a
            if 0 <= begin <= len(long) - n and sum(x != y for x, y in zip(short, long[begin : begin + n], strict=True)) <= most:
                return True
            at = long.find(short[a:b], at + 1)
    return False


#: Lengths of the k-mers by which kept sequences are found; the longest that fits is used.
SEEDS = (1, 2, 4, 8, 16, 24)


def fold(rows: list[tuple], identity: float, seeds: tuple[int, ...] = SEEDS) -> list[tuple]:
    """(id of the kept one, seq) of each (seq, id), longest first: the first kept one that covers it, or itself.

    With the changes allowed one part of a sequence is untouched, so whatever covers it has every k-mer of some part;
    of each part the k-mer that the fewest kept ones have is looked up.
    """

    def seed(n: int) -> int:
        return max((s for s in seeds if s <= n // (int((1 - identity) * n + 1e-9) + 1)), default=0)

    used = {seed(n) for n in {len(seq) for seq, _ in rows}} - {0}
    kept: list[tuple] = []
    index: dict[str, list[int]] = {}  # by k-mer, the places in kept, in order
    out = []
    for seq, key in sorted(rows, key=lambda r: (-len(r[0]), r[1])):
        n = len(seq)
        parts = int((1 - identity) * n + 1e-9) + 1
        if k := seed(n):
            found: list[list[int]] = []
            for p in range(parts):
                a, b = p * n // parts, (p + 1) * n // parts
                found.append(min((index.get(seq[i : i + k], []) for i in range(a, b - k + 1)), key=len))
            places = found[0] if parts == 1 else sorted(set().union(*found))
        else:
            places = range(len(kept))
        home = next((kept[c][1] for c in places if covered(seq, kept[c][0], identity)), None)
        if home is None:
            home = key
            for s in used:
                for kmer in {seq[i : i + s] for i in range(n - s + 1)}:
                    index.setdefault(kmer, []).append(len(kept))
            kept.append((seq, key))
        out.append((home, seq))
    return out


def collapse(records: DataFrame, identity: float = 0.97, group: str = "og", seed_length: int = 24) -> DataFrame:
    """id and kept_id of every record: within its family, the longest record that covers it and is itself kept (ties by id).

    Equal sequences fold without comparison. In a family the kept ones are indexed by their k-mers, up to seed_length,
    so a record meets only those with a k-mer of its own, however short it is.
    """
    distinct = records.groupBy(group, "seq").agg(F.min("id").alias("id"))
    schema = f"{group} {dict(records.dtypes)[group]}, seq string, kept_id {dict(records.dtypes)['id']}"
    seeds = (*(s for s in SEEDS if s < seed_length), seed_length)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out = fold(list(zip(pdf["seq"], pdf["id"], strict=True)), identity, seeds)
        return pd.DataFrame({group: [pdf[group].iloc[0]] * len(out), "seq": [s for _, s in out], "kept_id": [h for h, _ in out]})

    folded = distinct.groupBy(group).applyInPandas(one, schema)
    return records.select(group, "id", "seq").join(folded, [group, "seq"]).select(group, "id", "kept_id")

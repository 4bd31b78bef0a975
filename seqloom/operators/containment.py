"""Genes of reference sets found in records by shared minimisers, as with the ribosomal genes of four kingdoms.

A minimiser is the k-mer of least hash in a window of some k-mers, the same on both strands. A reference lies in a record
if enough of its minimisers do; nothing is aligned, and a reference that lies in very many records is as even as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import staged

_BASES = np.full(256, 4, np.uint8)
for _i, _a in enumerate("ACGT"):
    _BASES[ord(_a)] = _BASES[ord(_a.lower())] = _i
_BASES[ord("U")] = _BASES[ord("u")] = 3
#: Minimisers of the references are broadcast up to so many.
SENT = 500_000


@dataclass(frozen=True)
class Containment:
    """k: letters of a k-mer, 31 at most. window: k-mers of a window. share: of a reference's minimisers that a record has. least: minimisers that it has at least."""

    k: int = 11
    window: int = 5
    share: float = 0.25
    least: int = 8


def minimisers(seq: str, k: int, window: int) -> np.ndarray:
    """The distinct minimisers of both strands of a sequence; k-mers with other letters than the four are none."""
    bases = _BASES[np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)]
    n = len(bases) - k + 1
    if n < 1:
        return np.zeros(0, np.int64)
    ahead, behind = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for i in range(k):
        part = bases[i : i + n].astype(np.uint64)
        ahead |= (part & np.uint64(3)) << np.uint64(2 * (k - 1 - i))
        behind |= (np.uint64(3) - (part & np.uint64(3))) << np.uint64(2 * i)
    bad = np.convolve(bases == 4, np.ones(k), "valid") > 0.5
    mixed = np.minimum(ahead, behind) + np.uint64(1)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    mixed ^= mixed >> np.uint64(27)
    mixed[bad] = np.uint64(2**64 - 1)
    if n > window:
        mixed = np.lib.stride_tricks.sliding_window_view(mixed, window).min(1)
    return np.unique(mixed[mixed != np.uint64(2**64 - 1)]).view(np.int64)


def with_minimisers(records: DataFrame, options: Containment) -> DataFrame:
    """The records (with seq, which goes) and their minimisers m."""
    kept = [c for c in records.columns if c != "seq"]

    def run(batches):
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1)
                found = minimisers(row.column("seq")[0].as_py() or "", options.k, options.window)
                yield pa.RecordBatch.from_arrays([*(row.column(c) for c in kept), pa.array([found], pa.list_(pa.int64()))], names=[*kept, "m"])

    kinds = dict(records.dtypes)
    return records.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in kept) + ", m array<long>")


def contained(records: DataFrame, references: DataFrame, options: Containment = Containment()) -> DataFrame:  # noqa: B008
    """id, kingdom, reference and share of the references (kingdom, id, seq) that lie in records (id, seq): of each kingdom the one with the largest share, the first of equals.

    References without a minimiser lie in none, as do null and short records. Records repeated with one id count as one.
    """
    known = staged(with_minimisers(references.select("kingdom", F.col("id").alias("reference"), "seq"), options), "references")
    index = known.select("kingdom", "reference", F.size("m").alias("size"), F.explode("m").alias("m"))
    wanted = staged(index.select("m").distinct(), "minimisers")
    if wanted.count() <= SENT:  # those of the records that no reference has then never leave their task
        wanted = F.broadcast(wanted)
    own = with_minimisers(records.select("id", "seq"), options).select("id", F.explode("m").alias("m")).join(wanted, "m", "left_semi").distinct()
    met = own.join(index, "m").groupBy("id", "kingdom", "reference").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    good = met.where((F.col("n") >= options.least) & (F.col("n") >= F.col("size") * options.share)).withColumn("share", F.col("n") / F.col("size"))
    best = good.groupBy("id", "kingdom").agg(F.max("share").alias("share"))
    first = good.join(best, ["id", "kingdom", "share"]).groupBy("id", "kingdom", "share").agg(F.min("reference").alias("reference"))
    return first.select("id", "kingdom", "reference", "share")


def by_kingdom(found: DataFrame, kingdoms: list[str]) -> list[DataFrame]:
    """The ids found for each kingdom, as records.split_by_hits and the modules take them."""
    return [found.where(F.col("kingdom") == k).select("id") for k in kingdoms]

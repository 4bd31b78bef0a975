"""Composition statistics of sequences and codon use."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions import sequences


def gc_table(records: DataFrame, code: int = 1) -> DataFrame:
    """Length, GC by codon place and the expected effective number of codons of each record."""
    wide = records.withColumns({"length": F.length("seq").cast("long"), "coverage": sequences.coverage_of(F.col("id")), "_gc": sequences.composition(F.col("seq"), code)})
    wide = wide.withColumns({x: F.col(f"_gc.{x}") for x in sequences.PLACES})
    return wide.withColumn("expected_enc", sequences.expected_enc(F.col("gc3_4fold"))).drop("seq", "_gc")


def null_curve(spark) -> DataFrame:
    """Expected effective number of codons along GC3: 0 to 0.50 in steps of 0.01, and the same values mirrored to 101 rows."""
    s = F.least(F.col("id"), 100 - F.col("id")) / 100.0
    return spark.range(101).select(F.col("id").cast("int").alias("step"), (F.col("id") / 100.0).alias("gc3"), (2.0 + s + 29.0 / (s * s + (1.0 - s) * (1.0 - s))).alias("enc"))


def gc3_steps(records: DataFrame) -> DataFrame:
    """step, sequences: how many sequences have their GC percentage at third places nearest to each whole step (halves go up); those without a codon have none.

    Each task counts what it has read and hands on 101 rows at most.
    """

    def run(batches):
        counts: dict[int, int] = {}
        for batch in batches:
            for seq in batch.column("seq").to_pylist():
                thirds = seq[2 : len(seq) // 3 * 3 : 3]
                if thirds:
                    step = math.floor(100.0 * sum(map(thirds.count, "GCgc")) / len(thirds) + 0.5)
                    counts[step] = counts.get(step, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["step", "sequences"])

    found = records.select("seq").where("seq is not null").mapInArrow(run, "step int, sequences long")
    return found.groupBy("step").agg(F.sum("sequences").alias("sequences"))


def stop_rates(records: DataFrame, code: int = 1) -> DataFrame:
    """In-frame stops of each stop codon of a code over all records: count, codons scanned and rate per thousand."""
    stops = sequences.STOPS.get(code, sequences.STOPS[1])
    sums = records.agg(
        *(F.sum(sequences.stops_in(F.col("seq"), s)).alias(s) for s in stops),
        F.sum((F.length(sequences.scanned(F.col("seq"))) / 3).cast("long")).alias("total_codons"),
    )
    rows = F.explode(F.array(*(F.struct(F.lit(s).alias("stop_codon"), F.col(s).alias("counts")) for s in stops))).alias("r")
    rate = F.when(F.col("total_codons") > 0, 1000.0 * F.col("counts") / F.col("total_codons"))
    return sums.select(rows, "total_codons").select("r.*", "total_codons").withColumn("per_1k", rate)


def looks_like_transcripts(records: DataFrame, code: int = 1, least: float = 1.5) -> bool:
    """Whether some stop codon's rate, rounded to three places, reaches the threshold, so records aren't coding sequences; records without a codon don't."""
    return stop_rates(records, code).agg(F.coalesce(F.max(F.round("per_1k", 3) >= least), F.lit(False))).first()[0]


def codon_counts(records: DataFrame) -> DataFrame:
    """id, codon, n: how often each codon of the four letters comes up in frame."""
    return records.select("id", F.explode(sequences.codons(F.col("seq"))).alias("codon")).where(F.col("codon").rlike("^[ACGT]{3}$")).groupBy("id", "codon").agg(F.count(F.lit(1)).alias("n"))


#: Groups that a task holds before it hands their counts on.
HELD = 10_000


def codon_sums(records: DataFrame, group: str) -> DataFrame:
    """group, codon, n: how often each codon of the four letters comes up in frame; a task hands on 64 rows a group."""

    def run(batches):
        held: dict = {}

        def counts():
            rows = [(g, c, n) for g, sums in held.items() for c, n in zip(sequences.CODONS, sums.tolist(), strict=False) if n]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], names=[group, "codon", "n"])

        for batch in batches:
            for name, seq in zip(batch[group], batch["seq"], strict=True):
                sums = held.setdefault(name.as_py(), np.zeros(65, np.int64))
                sums += np.bincount(sequences.codon_numbers(seq.as_py()), minlength=65)
                if len(held) >= HELD:
                    yield counts()
        yield counts()

    found = records.select(F.col(group).cast("string").alias(group), "seq").where("seq is not null").mapInArrow(run, f"{group} string, codon string, n long")
    return found.groupBy(group, "codon").agg(F.sum("n").alias("n"))


def observed_enc(records: DataFrame, code: int = 1) -> DataFrame:
    """Effective number of codons with the background composition taken out (Novembre 2002), as defined here.

    For each amino acid with k codons seen n times, the chi-square of codon shares against those that the record's base
    composition gives yields F = (X2 + n - k) / (k (n - 1)); F is averaged over amino acids of one degeneracy, a
    missing class counts as 1/k (the three-fold class as the mean of its neighbours), and the result is at most 61.

    Each record is worked out by itself, from the counts of its 64 codons.
    """
    table = sequences.code_table(code)
    acids = np.array([table[c] for c in sequences.CODONS])
    places = np.array([["ACGT".index(x) for x in c] for c in sequences.CODONS])
    of_acid = {a: np.flatnonzero(acids == a) for a in sorted(set(table.values()) - {"*"})}
    degrees = sorted({len(x) for x in of_acid.values()} - {1})

    def numbers(n: np.ndarray, bases: np.ndarray) -> np.ndarray:
        """The result of each row of codon counts and of base counts, nan where there is none."""
        share = bases / bases.sum(1, keepdims=True)
        expected = share[:, places].prod(2)
        f = {}
        for a, own in of_acid.items():
            k, n_aa = len(own), n[:, own].sum(1)
            e = expected[:, own] / expected[:, own].sum(1, keepdims=True)
            x2 = np.where(e > 0, n_aa[:, None] * (n[:, own] / n_aa[:, None] - e) ** 2 / e, 0.0).sum(1)
            value = (x2 + n_aa - k) / (k * (n_aa - 1))
            f[a] = np.where((n_aa > 1) & (value > 0), value, np.nan) if k > 1 else None
        mean, total = {}, np.full(len(n), float(sum(len(x) == 1 for x in of_acid.values())))
        for k in degrees:
            column = np.stack([f[a] for a, own in of_acid.items() if len(own) == k])
            mean[k] = np.nansum(column, 0) / (~np.isnan(column)).sum(0)
        known = lambda k: np.where(np.isnan(mean[k]), 1.0 / k, mean[k]) if k in mean else 1.0 / k
        for k in degrees:
            missing = (known(2) + known(4)) / 2 if k == 3 else 1.0 / k
            total += sum(len(x) == k for x in of_acid.values()) / np.where(np.isnan(mean[k]), missing, mean[k])
        return np.where(np.all([np.isnan(x) for x in mean.values()], 0), np.nan, np.minimum(61.0, total))

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.slice(start, 1024)
                seqs = [x[: len(x) // 3 * 3] for x in part["seq"].to_pylist()]
                n = np.array([np.bincount(sequences.codon_numbers(x), minlength=65)[:64] for x in seqs], np.float64)
                bases = np.array([[x.count(b) for b in "ACGT"] for x in seqs], np.float64)
                with np.errstate(divide="ignore", invalid="ignore"):
                    enc = numbers(n, bases)
                at = pa.array(np.flatnonzero(~np.isnan(enc)))
                yield pa.RecordBatch.from_arrays([part["id"].take(at), pa.array(enc).take(at)], names=["id", "enc"])

    return records.select("id", "seq").where("seq is not null").mapInArrow(run, f"id {dict(records.dtypes)['id']}, enc double")

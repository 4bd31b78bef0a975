"""Alignment hits: thresholds, best and last hits, slices of the sequences they lie on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import names, sequences


def with_cover(hits: DataFrame, queries: DataFrame, subjects: DataFrame) -> DataFrame:
    """Hits with the percentage of the query and of the subject that they cover. queries, subjects: id and length.

    Any hit covers a sequence without letters beyond bounds, as the quotient has it in floating point: infinity.
    """
    q = queries.select(F.col("id").alias("qseqid"), F.col("length").alias("_qlen"))
    s = subjects.select(F.col("id").alias("sseqid"), F.col("length").alias("_slen"))
    share = lambda a, b, n: F.when(F.col(n) == 0, F.lit(float("inf"))).otherwise(100.0 * (F.abs(F.col(b) - F.col(a)) + 1) / F.col(n))
    joined = hits.join(q, "qseqid").join(s, "sseqid")
    return joined.withColumns({"query_cover": share("qstart", "qend", "_qlen"), "subject_cover": share("sstart", "send", "_slen")}).drop("_qlen", "_slen")


def covered(hits: DataFrame, queries: DataFrame, subjects: DataFrame | None, subject_cover: float, query_cover: float) -> DataFrame:
    """Hits with the columns that the thresholds above zero need, worked out where they are missing. queries: id and seq; subjects: id and length.

    ValueError if the lengths of the subjects would be needed and aren't given, as nothing could be left out then.
    """
    missing = [c for c, least in (("subject_cover", subject_cover), ("query_cover", query_cover)) if least > 0 and c not in hits.columns]
    if not missing:
        return hits
    if "subject_cover" in missing and subjects is None:
        raise ValueError("hits have no subject_cover: give the subjects' lengths, or set the threshold to 0")
    lengths = queries.select("id", F.length("seq").alias("length"))
    known = subjects if subjects is not None else hits.select(F.col("sseqid").alias("id"), F.lit(1).alias("length")).distinct()
    found = with_cover(hits.drop(*missing), lengths, known)
    return found.select(*hits.columns, *missing)


def keep_hits(hits: DataFrame, evalue: float = 1e-10, identity: float = 0.0, most: int | None = None, subject_cover: float = 0.0, query_cover: float = 0.0) -> DataFrame:
    """Hits within the thresholds, and of those so many of each query with the best scores (ties by subject, then order).

    A threshold of coverage above zero needs the column of with_cover.
    """
    kept = hits.where((F.col("evalue") <= evalue) & (F.col("pident") >= identity))
    for name, least in (("subject_cover", subject_cover), ("query_cover", query_cover)):
        if least > 0:
            kept = kept.where(F.col(name) >= least)
    if most is None:
        return kept
    order = Window.partitionBy("qseqid").orderBy(F.desc("bitscore"), "sseqid", "ord")
    return kept.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= most).drop("_rank")


def one_hit(hits: DataFrame, best: str = "last") -> DataFrame:
    """One hit of each query: the last reported one ("last") or that of the best score ("bitscore", the first of equals)."""
    others = [c for c in hits.columns if c != "qseqid"]
    by = F.struct("ord") if best == "last" else F.struct("bitscore", -F.col("ord"))
    return hits.groupBy("qseqid").agg(F.max_by(F.struct(*others), by).alias("h")).select("qseqid", "h.*")


def best_in_family(scored: DataFrame, family: str = "og", score: str = "bitscore", order: str = "ord") -> DataFrame:
    """The record of each family with the best score, the first of equals."""
    others = [c for c in scored.columns if c != family]
    return scored.groupBy(family).agg(F.max_by(F.struct(*others), F.struct(score, -F.col(order))).alias("h")).select(family, "h.*")


def slice_orfs(records: DataFrame, hits: DataFrame, delim: str = "|", og_delim: str = "|") -> DataFrame:
    """The part of each record that its hit covers, on the hit's strand and in whole codons, named with the hit's OG."""
    joined = records.join(hits, records["id"] == hits["qseqid"])
    orf = sequences.orf_slice(F.col("seq"), F.col("qstart"), F.col("qend"), F.col("qframe"))
    og = names.og_of(F.col("sseqid"), og_delim)
    order = [records["ord"]] if "ord" in records.columns else []  # the records' order, not that of the hits
    return joined.select("id", og.alias("og"), names.with_og(F.col("id"), og, delim, og_delim).alias("new_id"), "qframe", "bitscore", orf.alias("orf"), *order)


def slice_profile_orfs(records: DataFrame, profile_hits: DataFrame) -> DataFrame:
    """The best profile hit of each record (record|RF<n>), cut from its nucleotides; empty parts go."""
    placed = profile_hits.withColumn("id", F.regexp_extract("target", r"^(.*)\|RF\d$", 1)).withColumn("rf", F.regexp_extract("target", r"\|RF(\d)$", 1).cast("int"))
    best = placed.groupBy("id").agg(F.max_by(F.struct("profile", "rf", "from_aa", "to_aa", "score"), F.struct("score", "profile", "rf")).alias("h")).select("id", "h.*")
    cut = records.join(best, "id").withColumn("orf", sequences.profile_orf_slice(F.col("seq"), F.col("from_aa"), F.col("to_aa"), F.col("rf")))
    return cut.where(F.length("orf") > 0).select("id", F.col("profile").alias("og"), "rf", "score", "orf")

"""The genetic code as alignments show it: what each codon of a query stands against."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import sequences

STOP_CODONS = ("TAA", "TAG", "TGA")


def aligned_codons(records: DataFrame, alignments: DataFrame) -> DataFrame:
    """codon, aa: each pair without gaps of an alignment (id, q_from, q_to, q_frame, q_seq, h_seq) of a record (id, seq).

    The number of query letters before a place of the alignment tells the codon. Frames below zero are on the other
    strand, and either order of the two ends is taken.
    """
    lo, hi = F.least("q_from", "q_to"), F.greatest("q_from", "q_to")
    part = F.substring("seq", lo, hi - lo + 1)
    orf = F.when(F.col("q_frame") < 0, sequences.reverse_complement(part)).otherwise(part)
    joined = records.select("id", "seq").join(alignments, "id").withColumn("codons", sequences.codons(orf))
    # Letters of both rows side by side; without the query's gaps, a place is the number of a codon.
    zipped = F.arrays_zip(F.split("q_seq", "").alias("q"), F.split("h_seq", "").alias("aa"))
    letters = joined.withColumn("letters", F.filter(zipped, lambda x: x["q"].isNotNull() & (x["q"] != "-") & (x["q"] != "")))
    walk = F.transform("letters", lambda x, i: F.struct(F.get("codons", i).alias("codon"), x["aa"].alias("aa")))
    return letters.select(F.explode(walk).alias("p")).select("p.*").where("codon is not null and aa is not null and aa != '-' and aa != ''")


def codon_consensus(pairs: DataFrame, least_share: float = 0.33, rare: float = 1e-4) -> DataFrame:
    """A row for each of the 64 codons with data enough: what it usually stands against, how often, and whether that is standard.

    aa_frequency: how often it stands against its commonest amino acid; aa_count: how often it comes up; total_codons: all codons that do.
    Codons without data are "?" and "Uncertain", stop codons among them "STOP" and "Same". A share below least_share puts the amino acid in lower
    case. A codon with at most the `rare` share of all is left out, or is a standard stop if it is one. Ties go to the
    first amino acid in the alphabet. Codons with other letters than the four count for nothing.
    """
    spark = pairs.sparkSession
    standard = spark.createDataFrame(list(sequences.code_table(1).items()), "codon string, standard string")
    # 64 codons by some twenty letters: the counts are small whatever the pairs are.
    counts = pairs.where(F.col("codon").rlike("^[ACGT]{3}$")).groupBy("codon", "aa").agg(F.count(F.lit(1)).alias("n"))
    per = Window.partitionBy("codon")
    ranked = counts.withColumn("total", F.sum("n").over(per)).withColumn("place", F.row_number().over(per.orderBy(F.desc("n"), "aa")))
    best = ranked.where("place = 1").select("codon", "aa", "n", "total")
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all_codons"))
    rows = standard.join(F.broadcast(best), "codon", "left").withColumn("_", F.lit(1)).join(F.broadcast(whole.withColumn("_", F.lit(1))), "_").drop("_")
    total, stop = F.coalesce("total", F.lit(0)), F.col("codon").isin(*STOP_CODONS)
    share = F.col("n") / F.col("total")
    few = (total > 0) & (total <= F.col("all_codons") * rare)
    letter = F.when(share < least_share, F.lower("aa")).otherwise(F.col("aa"))
    return (
        rows.where(~few | stop)
        .select(
            "codon",
            F.when(stop, "STOP").otherwise(F.col("standard")).alias("standard_aa"),
            F.when(stop & ((total == 0) | few), "STOP").when(total == 0, "?").otherwise(letter).alias("predicted_aa"),
            F.when(stop & ((total == 0) | few), "Same").when(total == 0, "Uncertain").when(F.col("aa") != F.col("standard"), "Reassigned").otherwise("Same").alias("verdict"),
            F.when(stop & few, total).otherwise(F.coalesce("n", F.lit(0))).alias("aa_frequency"),
            total.alias("aa_count"),
            F.col("all_codons").alias("total_codons"),
        )
        .orderBy("standard_aa", "codon")
    )

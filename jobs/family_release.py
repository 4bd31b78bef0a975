"""Releases gene families: peptides near their family's usual length, one representative of each taxon, and a report.

    python -m jobs.family_release --tables DIR --out DIR [--config FILE]

Writes below OUT, each release in a folder of its own:

    peptides/release=R/og=G   the kept peptides
    report/release=R/og=G     one row a family: records read and kept, taxa, lengths
    fasta/release=R/og=G      the kept peptides as FASTA, for aligners

A run replaces the release whole. With `families` in the config only these are made anew, and only their folders are
replaced. A run that broke off is repaired by the next one; equal input gives equal output.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F

from seqloom.operators import families
from seqloom.plans import substrate
from seqloom.sources import sinks
from seqloom.sources.staging import staged

from . import common

log = logging.getLogger("jobs.family_release")
DEFAULTS = {"release": "current", "families": [], "min_prop": 0.33, "max_prop": 2.0, "centre": "median", "least": 4, "fasta": True}
PEPTIDES = "doc_id long, id string, taxon string, length long, representative boolean, seq string, og string"


def representatives(records: DataFrame) -> DataFrame:
    """og and doc_id of the longest record of each taxon of each family, the first of equals. records: og, taxon, doc_id, ord, letters."""
    longest = F.max_by("doc_id", F.struct(F.col("letters"), -F.col("ord"))).alias("doc_id")
    return records.groupBy("og", "taxon").agg(longest).select("og", "doc_id").distinct()


def report_of(records: DataFrame, kept: DataFrame) -> DataFrame:
    """A row for each family that was read; kept is null-free there as well. records: og, taxon and letters; kept: og and length."""
    before = records.groupBy("og").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("taxon").alias("taxa"), F.percentile("letters", F.lit(0.5)).alias("median_length"))
    after = kept.groupBy("og").agg(F.count(F.lit(1)).alias("kept"), F.min("length").alias("shortest"), F.max("length").alias("longest"))
    return before.join(after, "og", "left").withColumn("kept", F.coalesce("kept", F.lit(0)))


def run(spark: SparkSession, tables: str, out: str, config: str | None = None) -> DataFrame:
    """Makes a release and returns its peptides as written: doc_id, id, taxon, length, representative, seq, og.

    Rows without a text or an id are left out; texts without letters are empty peptides and only kept by families of such.
    A taxon that is missing is a taxon of its own.
    """
    o = common.options(spark, config, DEFAULTS)
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    records = substrate.records_of(docs.where("text is not null and doc_id is not null"), substrate.AA_TARGET)
    if o["families"]:
        records = records.where(F.col("og").isin(o["families"]))
    log.info("%s/documents: %d rows; families: %s", tables, docs.count(), o["families"] or "all")
    # What is chosen depends on lengths only, so texts are read for these once and once more to be written.
    lengths = staged(records.select("og", "taxon", "doc_id", "ord", F.length("seq").alias("letters")), "release-lengths")
    sized = families.sized_families(lengths, F.col("letters"), o["min_prop"], o["max_prop"], o["centre"], o["least"])
    small = staged(sized.select("og", "doc_id", "letters", "taxon", "ord"), "release-kept")
    ranges = small.groupBy("og").agg(F.min("letters").alias("_low"), F.max("letters").alias("_high"))  # nothing else of a family lies between
    chosen = representatives(small).withColumn("representative", F.lit(True))
    length = F.length("seq")
    kept = records.join(F.broadcast(ranges), "og").where(length.between(F.col("_low"), F.col("_high"))).withColumn("length", length.cast("long")).join(chosen, ["og", "doc_id"], "left").withColumn("representative", F.coalesce("representative", F.lit(False)))
    folder = {x: f"{out}/{x}/release={o['release']}" for x in ("peptides", "report", "fasta")}
    mode = "dynamic" if o["families"] else "static"
    # Rebalanced, so a family has few files and a large one is the work of several tasks.
    rows = kept.select("doc_id", "id", "taxon", "length", "representative", "seq", "og").hint("rebalance", "og")
    rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("og").parquet(folder["peptides"])
    written = spark.read.schema(PEPTIDES).parquet(folder["peptides"])
    new = written.where(F.col("og").isin(o["families"])) if o["families"] else written
    report_of(lengths, new).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("og").parquet(folder["report"])
    if o["fasta"]:
        sinks.write_family_files(new, folder["fasta"], mode="overwrite", families_only=bool(o["families"]))
    log.info("%s: %d peptides in %d families, %d of them representatives", folder["peptides"], new.count(), new.select("og").distinct().count(), new.where("representative").count())
    return written


if __name__ == "__main__":
    common.command("family_release", __doc__.split("\n", 1)[0], run)

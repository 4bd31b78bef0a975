"""Follows a growing table of sequences: composition of each new record, and codon usage of each taxon so far.

    python -m jobs.codon_watch --tables DIR --out DIR [--config FILE]

Takes the files of documents that it hasn't taken yet (a file stream that ends when they are read; its checkpoint is the
mark) and writes below OUT:

    checkpoint                what was taken
    records/taxon=T/batch=N   composition of each record
    counts/batch=N            codons of each taxon in the batch
    usage/taxon=T             codon, amino acid, n, rate per thousand and relative use among synonyms, over all batches

A batch that is repeated after a failure has its number again and replaces its own folders, so nothing counts twice. The
usage is summed from the counts of all batches, which are few rows, whether or not this run had new files.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from seqloom.functions import sequences
from seqloom.operators import statistics
from seqloom.plans import substrate

from . import common

log = logging.getLogger("jobs.codon_watch")
DEFAULTS = {"files_per_batch": 200, "code": 1}
MEASURES = ["length", "gc", "gc1", "gc2", "gc3", "gc12", "gc3_4fold", "expected_enc"]
RECORDS = "doc_id long, og string, length long, " + ", ".join(f"{m} double" for m in MEASURES[1:]) + ", taxon string, batch long"
COUNTS = "taxon string, codon string, n long, batch long"
USAGE = "codon string, amino_acid string, n long, per_1k double, relative double, taxon string"


def source_of(path: str) -> str:
    """The path as a pattern that only it matches: a table may be a folder of files or a single one, and a stream takes a single one as a pattern only."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def new_records(docs: DataFrame) -> DataFrame:
    """doc_id, id, taxon, og and seq of rows with a text; a missing or blank taxon is Unknown."""
    rows = substrate.records_of(docs.where("text is not null"), substrate.NT_TARGET)
    return rows.withColumn("taxon", F.when(F.trim(F.coalesce("taxon", F.lit(""))) != "", F.col("taxon")).otherwise("Unknown"))


def take(batch: DataFrame, number: int, out: str, code: int) -> int:
    """Writes what a batch of documents gives; returns how many rows it has."""
    if batch.isEmpty():
        return 0
    seen = Observation()
    counted = new_records(batch.observe(seen, F.count(F.lit(1)).alias("rows")))
    measured = statistics.gc_table(counted, code).select("doc_id", "og", *MEASURES, "taxon", F.lit(number).cast("long").alias("batch"))
    replace = lambda rows: rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    replace(measured.hint("rebalance", "taxon")).partitionBy("taxon", "batch").parquet(f"{out}/records")
    counts = statistics.codon_sums(new_records(batch), "taxon").withColumn("batch", F.lit(number).cast("long"))
    replace(counts).partitionBy("batch").parquet(f"{out}/counts")
    return seen.get["rows"]


def usage_of(counts: DataFrame, code: int) -> DataFrame:
    """codon, amino_acid, n, per_1k and relative (n over the mean of its synonyms, unseen ones included) of each taxon."""
    table = sequences.code_table(code)
    sizes = {a: sum(b == a for b in table.values()) for a in table.values()}
    rows = counts.sparkSession.createDataFrame([(c, a, sizes[a]) for c, a in table.items()], "codon string, amino_acid string, synonyms int")
    sums = counts.groupBy("taxon", "codon").agg(F.sum("n").alias("n")).join(F.broadcast(rows), "codon")  # 64 rows
    # 64 rows a taxon at most.
    of_taxon, of_acid = Window.partitionBy("taxon"), Window.partitionBy("taxon", "amino_acid")
    rate, relative = 1000.0 * F.col("n") / F.sum("n").over(of_taxon), 1.0 * F.col("n") * F.col("synonyms") / F.sum("n").over(of_acid)
    return sums.select("codon", "amino_acid", "n", rate.alias("per_1k"), relative.alias("relative"), "taxon")


def run(spark: SparkSession, tables: str, out: str, config: str | None = None) -> DataFrame:
    """Takes what is new in documents and returns the usage as written: codon, amino_acid, n, per_1k, relative, taxon.

    Rows without a text are left out, those of texts shorter than a codon have no codons. A row that comes in two files
    counts twice; a file counts once. An empty table gives an empty usage.
    """
    o = common.options(spark, config, DEFAULTS)
    table = f"{tables}/documents.parquet"
    schema = spark.read.parquet(table).schema
    for name, kind in (("records", RECORDS), ("counts", COUNTS)):  # so that they are there if nothing ever comes
        spark.createDataFrame([], kind).write.mode("append").parquet(f"{out}/{name}")
    taken: dict[int, int] = {}

    def each(batch: DataFrame, number: int) -> None:
        taken[number] = take(batch, number, out, o["code"])

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", o["files_per_batch"]).parquet(source_of(table))
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("%s: %d rows in %d new batches %s", table, sum(taken.values()), len(taken), sorted(taken))
    written = spark.read.schema(RECORDS).parquet(f"{out}/records")
    log.info("%s/records: %d rows new, %d in all", out, written.where(F.col("batch").isin(list(taken))).count(), written.count())
    usage = usage_of(spark.read.schema(COUNTS).parquet(f"{out}/counts"), o["code"])
    usage.write.mode("overwrite").partitionBy("taxon").parquet(f"{out}/usage")
    result = spark.read.schema(USAGE).parquet(f"{out}/usage")
    log.info("%s/usage: %d rows", out, result.count())
    return result


if __name__ == "__main__":
    common.command("codon_watch", __doc__.split("\n", 1)[0], run)

"""Readers of sequence files, hit tables and taxonomies as typed DataFrames; schemas are declared, never inferred."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import names, sequences

#: Fixed layout: columns of a tabular nucleotide hit file; a protein file lacks the last one.
HIT_COLUMNS = "qseqid string, sseqid string, length int, pident double, qstart int, qend int, sstart int, send int, evalue double, bitscore double, qframe int"


def file_position(start: Column, task_row: Column) -> Column:
    """A number that grows from record to record of a file, however it was split: where the record's split starts plus the row's number in its task.

    Splits of a file start a whole split size apart, the last one's length aside, and a task holds no more bytes than that
    unless its one file can't be split, so no task has so many rows that it reaches the next split's numbers.
    """
    return start + task_row.bitwiseAND(F.lit((1 << 33) - 1))


def _with_order(df: DataFrame) -> DataFrame:
    """Rows just read from files, with ord, which grows along each file."""
    return df.withColumn("ord", file_position(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))


def records_at(lines, marker: str, path: str) -> DataFrame:
    """source_file, _start (of the split), value: what stands between markers at the start of a line, marks left out.

    lines: a reader, of a batch or of a stream. Splits of large files are cut at the same places, so files are read in parallel.
    """
    raw = lines.option("lineSep", "\n" + marker).text(path)
    text = F.regexp_replace("value", r"^\s*" + re.escape(marker), "")  # the first one of a file has no line before it
    first = F.col("_metadata.file_block_start")
    rows = raw.select(F.col("_metadata.file_path").alias("source_file"), first.alias("_start"), text.alias("value"))
    return rows.where((F.length(F.trim("value")) > 0) & ~((F.col("_start") == 0) & F.col("value").rlike("^\\s*[;#]")))


def fasta_fields(rows: DataFrame, *more: Column | str) -> DataFrame:
    """source_file, id (the first word of the header), description and seq (its lines joined) of rows with a value."""
    header = F.trim(F.regexp_extract("value", r"^([^\r\n]*)", 1))
    seq = F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s+", "")
    return rows.select("source_file", *more, F.split(header, r"\s+")[0].alias("id"), header.alias("description"), seq.alias("seq"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """source_file, ord, id (the first word of the header), description, seq (its lines joined).

    A record begins at a > that starts a line, so headers may hold more of them; lines may end with CR and LF. ord grows from
    record to record of a file. Records without letters are kept, with an empty seq. Comments (; or #) before the first
    record are left out. Files of any size are read in splits, but for compressed ones that can't be split.
    """
    rows = records_at(spark.read, ">", path).withColumn("ord", file_position(F.col("_start"), F.monotonically_increasing_id()))
    return fasta_fields(rows, "ord")


def read_genbank_cds(spark: SparkSession, path: str) -> DataFrame:
    """source_file, ord, header, locus, protein, seq (what follows the last tag) of a file of coding sequences with tags.

    Records begin at >lcl| at the start of a line; tags may hold any > and may run over several lines.
    """
    rows = records_at(spark.read, ">lcl|", path).withColumn("ord", file_position(F.col("_start"), F.monotonically_increasing_id()))
    header = F.regexp_extract("value", r"(?s)^(.*\])", 1)
    return rows.select(
        "source_file", "ord", header.alias("header"), names.locus_of(header).alias("locus"), names.tag(header, "protein_id").alias("protein"),
        F.regexp_replace(F.regexp_replace("value", r"(?s)^.*\]", ""), r"\s+", "").alias("seq"),
    )


def read_hits(spark: SparkSession, path: str, proteins: bool = False) -> DataFrame:
    """A tabular hit file with the order of its lines."""
    schema = HIT_COLUMNS.removesuffix(", qframe int") if proteins else HIT_COLUMNS
    return _with_order(spark.read.schema(schema).csv(path, sep="\t"))


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    """id, q_from, q_to, q_frame, q_seq, h_seq: the first part of the first hit of each query in an XML report."""
    hsp = "struct<`Hsp_query-from`:int,`Hsp_query-to`:int,`Hsp_query-frame`:int,Hsp_qseq:string,Hsp_hseq:string>"
    schema = f"`Iteration_query-def` string, Iteration_hits struct<Hit:array<struct<Hit_id:string,Hit_hsps:struct<Hsp:array<{hsp}>>>>>"
    rows = spark.read.format("xml").option("rowTag", "Iteration").schema(schema).load(path)
    first = F.col("Iteration_hits.Hit")[0]
    part = F.get(first["Hit_hsps"]["Hsp"], F.lit(0))
    found = rows.where(F.size(F.coalesce("Iteration_hits.Hit", F.array())) > 0).select(F.split("Iteration_query-def", r"\s+")[0].alias("id"), part.alias("h"))
    return found.where("h is not null").select(
        "id", F.col("h.Hsp_query-from").alias("q_from"), F.col("h.Hsp_query-to").alias("q_to"), F.col("h.Hsp_query-frame").alias("q_frame"), F.col("h.Hsp_qseq").alias("q_seq"), F.col("h.Hsp_hseq").alias("h_seq")
    )


def read_profile_table(spark: SparkSession, path: str) -> DataFrame:
    """target, profile, evalue, score of a profile search's table; comment lines are left out."""
    words = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(~F.startswith("value", F.lit("#")) & (F.length(F.trim("value")) > 0))
    return rows.select(words[0].alias("target"), words[2].alias("profile"), words[4].try_cast("double").alias("evalue"), words[5].try_cast("double").alias("score"))


def read_profile_places(spark: SparkSession, path: str) -> DataFrame:
    """target, from_aa, to_aa of the aligned sequences of a Stockholm file; the last line of a name holds."""
    rows = _with_order(spark.read.text(path)).select("ord", F.regexp_extract("value", r"^#=GS\s+(\S+)/(\d+)-(\d+)", 1).alias("target"), F.regexp_extract("value", r"^#=GS\s+\S+/(\d+)-(\d+)", 1).try_cast("int").alias("from_aa"), F.regexp_extract("value", r"^#=GS\s+\S+/(\d+)-(\d+)", 2).try_cast("int").alias("to_aa"))
    return rows.where("target != ''").groupBy("target").agg(F.max_by(F.struct("from_aa", "to_aa"), "ord").alias("p")).select("target", "p.*")


def read_profile_hits(spark: SparkSession, table_path: str, places_path: str) -> DataFrame:
    """Profile hits with their places on the targets."""
    return read_profile_table(spark, table_path).join(read_profile_places(spark, places_path), "target")


def read_rrna(spark: SparkSession, path: str) -> DataFrame:
    """id of the sequences that an rRNA finder's feature lines name (those with a delimiter in them)."""
    rows = spark.read.text(path).where(F.contains("value", F.lit("|")) & ~F.startswith("value", F.lit("#")))
    return rows.select(F.split("value", "\t")[0].alias("id")).distinct()


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    """tree_id (the file name up to its first point) and newick of tree files, one a file."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("f"), F.trim("value").alias("newick"))
    return rows.select(F.split_part("f", F.lit("."), F.lit(1)).alias("tree_id"), "newick")


def read_family_files(spark: SparkSession, path: str) -> DataFrame:
    """Records of one FASTA file for each family, the family (og) from the file name up to its first point."""
    name = F.regexp_extract("source_file", r"([^/]*)$", 1)
    return read_fasta(spark, path).withColumn("og", F.split_part(name, F.lit("."), F.lit(1)))


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """name: the lines of a list, without blanks."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name != ''").distinct()


def read_taxonomy(spark: SparkSession, nodes_path: str, names_path: str) -> DataFrame:
    """tax_id, parent_id, rank, name from a taxonomy dump's node and name files (fields between tab, bar and tab)."""
    cut = lambda: F.split("value", r"\t?\|\t?")
    nodes = spark.read.text(nodes_path).select(cut()[0].cast("long").alias("tax_id"), cut()[1].cast("long").alias("parent_id"), cut()[2].alias("rank"))
    named = spark.read.text(names_path).where(F.trim(cut()[3]) == "scientific name").select(cut()[0].cast("long").alias("tax_id"), cut()[1].alias("name"))
    return nodes.join(named, "tax_id").select("tax_id", F.when(F.col("parent_id") != F.col("tax_id"), F.col("parent_id")).alias("parent_id"), "rank", "name")

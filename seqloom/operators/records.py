"""Selection and renaming of sequence records: filters, isoforms, names, partitions by hit lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import names, sequences
from ..sources.staging import staged


def keep_long(records: DataFrame, least: int = 200) -> DataFrame:
    """Records of at least so many letters."""
    return records.where(F.length("seq") >= least)


def keep_complete(records: DataFrame, prokaryote: bool = False) -> DataFrame:
    """Whole coding sequences, from start to stop codon."""
    return records.where(sequences.is_complete_cds(F.col("seq"), prokaryote))


def keep_in_frame(records: DataFrame) -> DataFrame:
    return records.where(F.length("seq") % 3 == 0)


def keep_without_stops(peptides: DataFrame) -> DataFrame:
    return peptides.where(~F.contains("seq", F.lit("*")))


def of_taxon(records: DataFrame, name: str, column: str = "id") -> DataFrame:
    """Records whose name has the taxon anywhere in it."""
    return records.where(F.contains(column, F.lit(name)))


def listed(records: DataFrame, names_table: DataFrame, column: str) -> DataFrame:
    """Records whose value is in a one-column list."""
    return records.join(names_table.select(F.col(names_table.columns[0]).alias(column)).distinct(), column, "left_semi")


def renumber(records: DataFrame, taxon: Column, order: str = "ord", per: list[str] | None = None, code: Column | None = None, delim: str = "|") -> DataFrame:
    """new_id of transcripts in their order: taxon|[code|]Transcript_<n>_Length_<letters>[_Cov_<coverage>]; the number counts kept records.

    delim stands between the parts. per: columns of a group with numbers of its own. Without one, numbers run through the whole table: row numbers come
    from ranges of the order and the sizes of the ranges before, so no task sees all rows.
    """
    if per:
        numbered = records.withColumn("n", F.row_number().over(Window.partitionBy(*per).orderBy(order)))
    else:
        numbered = row_numbers(records, order)
    cover = sequences.coverage_of(F.col("id"))
    name = F.concat(taxon, F.lit(delim), *([] if code is None else [code, F.lit(delim)]), F.lit("Transcript_"), F.col("n").cast("string"), F.lit("_Length_"), F.length("seq").cast("string"))
    return numbered.withColumn("new_id", F.when(cover.isNotNull(), F.concat(name, F.lit("_Cov_"), F.format_string("%.2f", cover))).otherwise(name))


def row_numbers(records: DataFrame, order: str, out: str = "n") -> DataFrame:
    """Row numbers from 1 in the order of a column, over the whole table.

    Ranges come from a sample that differs from run to run, and small ones may be put together, so they are staged: both
    their sizes and their rows are read from there.
    """
    parts = records.repartitionByRange(order).sortWithinPartitions(order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    parts = staged(parts, "ranges")
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))  # a row for each range
    before = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_size")
    return parts.join(F.broadcast(before), "_part").withColumn(out, F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")


def longest_isoform(records: DataFrame, null_locus: str = "collapse") -> DataFrame:
    """The longest record of each locus, the first of equals. Records without a protein go.

    null_locus: "collapse" takes all records without a locus as one, "keep" keeps each of them.
    """
    own = records.where("protein is not null")
    others = [c for c in own.columns if c != "locus"]
    best = F.max_by(F.struct(*others), F.struct(F.length("seq"), -F.col("ord"))).alias("best")
    if null_locus == "keep":
        kept = own.where("locus is not null").groupBy("locus").agg(best).select("locus", "best.*")
        return kept.unionByName(own.where("locus is null").select("locus", *others))
    return own.groupBy("locus").agg(best).select("locus", "best.*")


def name_table(records: DataFrame, old: str = "id", new: str = "new_id") -> DataFrame:
    """Initial_ID and Updated_Name; of several new names of one id the last in order holds."""
    return records.groupBy(F.col(old).alias("Initial_ID")).agg(F.max_by(F.col(new), F.col("ord")).alias("Updated_Name"))


def split_by_hits(records: DataFrame, hit_lists: list[DataFrame], key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(records in any of the lists, the others), as with ribosomal RNA found for several kingdoms."""
    hits = hit_lists[0].select(key)
    for more in hit_lists[1:]:
        hits = hits.unionByName(more.select(key))
    hits = hits.distinct()
    return records.join(hits, key, "left_semi"), records.join(hits, key, "left_anti")


def rename_by_protein(nucleotides: DataFrame, proteins: DataFrame, delim: str = "|") -> DataFrame:
    """Nucleotide records with the name of the protein that has their id and an OG."""
    named = proteins.select(names.without_og(F.col("id"), delim).alias("id"), F.col("id").alias("new_id"))
    return nucleotides.join(named, "id")


def with_family_data(references: DataFrame, queries: DataFrame) -> DataFrame:
    """Reference records of families that have query records, and the query records."""
    kept = references.join(queries.select("og").distinct(), "og", "left_semi")
    return kept.unionByName(queries)


def bundle(queries: DataFrame, alignments: DataFrame, tree_files: DataFrame | None = None) -> DataFrame:
    """og with the paths of its query file, its alignment and, if given, its tree; families that lack one are left out."""
    out = queries.select("og", F.col("path").alias("query_path")).join(alignments.select("og", F.col("path").alias("alignment_path")), "og")
    return out if tree_files is None else out.join(tree_files.select("og", F.col("path").alias("tree_path")), "og")


def left_out(bundled: DataFrame, *catalogues: DataFrame) -> DataFrame:
    """og and in how many of the file catalogues each family is that isn't in the bundle."""
    every = catalogues[0].select("og").distinct()
    for c in catalogues[1:]:
        every = every.unionByName(c.select("og").distinct())
    return every.groupBy("og").agg(F.count(F.lit(1)).alias("catalogues")).join(bundled.select("og"), "og", "left_anti")


def summary(records: DataFrame, prokaryote: bool = False) -> DataFrame:
    """One row: sequences, complete coding sequences among them, and loci."""
    complete = sequences.is_complete_cds(F.col("seq"), prokaryote)
    return records.agg(F.count(F.lit(1)).alias("sequences"), F.count_if(complete).alias("complete"), F.count_distinct("locus").alias("loci"))

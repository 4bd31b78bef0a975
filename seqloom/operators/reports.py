"""Summary tables of by-catch: frequencies by taxonomic level, tops, roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def distinct_query_frequency(detail: DataFrame, keys: list[str], query: str = "query_seq") -> DataFrame:
    """How many distinct queries each key has; rows with a null key don't count."""
    return detail.dropna(subset=keys).groupBy(*keys).agg(F.count_distinct(query).alias("frequency")).orderBy(*keys[:1], F.desc("frequency"), *keys[1:])


def top(detail: DataFrame, key: str, query: str = "query_seq", most: int = 5) -> DataFrame:
    """The keys with the most distinct queries, ties by name."""
    return distinct_query_frequency(detail, [key], query).orderBy(F.desc("frequency"), key).limit(most)


def frequency(detail: DataFrame, keys: list[str]) -> DataFrame:
    return detail.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("frequency")).orderBy(*keys[:1], F.desc("frequency"), *keys[1:])


def roll_up(detail: DataFrame, levels: list[str], query: str = "query_seq") -> DataFrame:
    """Counts and distinct queries at every level of the taxonomy, from each leaf to all rows; `level` tells how many levels hold."""
    deep = sum((1 - F.grouping(x).cast("int") for x in levels), F.lit(0))
    return detail.rollup(*levels).agg(F.count(F.lit(1)).alias("frequency"), F.count_distinct(query).alias("queries"), deep.alias("level"))


def single_sister_top(detail: DataFrame, sisters: str = "sister_taxa", most: int = 5) -> DataFrame:
    """The commonest sister taxa of rows that have just one."""
    own = detail.where(F.col(sisters).isNotNull() & ~F.contains(sisters, F.lit(";")))
    return own.groupBy(sisters).agg(F.count(F.lit(1)).alias("frequency")).orderBy(F.desc("frequency"), sisters).limit(most)


# The columns of written reports, and which of a table's columns they are.
LINEAGE = {"Domain": "domain", "Major_Group": "supergroup", "Major_Clade": "major", "Minor_Clade": "minor"}
COLUMNS = {
    "stops": {"Stop_Codon": "stop_codon", "Counts": "counts", "Total_Codons": "total_codons", "Frequency_per_1k_Codons": "per_1k"},
    "statistics": {
        "Sequence": "id", "Length": "length", "Coverage": "coverage", "GC-Content": "gc", "GC1": "gc1", "GC2": "gc2", "GC3": "gc3", "GC12": "gc12", "GC3-4-Fold-Degen": "gc3_4fold", "Expected-ENc": "expected_enc", "ENc": "enc",
    },
    "genetic_code": {
        "Codon": "codon", "Standard-Amino-Acid": "standard_aa", "Predicted-Amino-Acid": "predicted_aa", "Same-Different": "verdict", "AA-Frequency": "aa_frequency", "AA-Count": "aa_count", "Total-Codons": "total_codons",
    },
    "kmer_detail": {"Query_Seq": "query_seq", **LINEAGE, "Cluster_Seq": "cluster_seq", "Cluster_Taxon": "cluster_taxon"},
    "tree_detail": {
        "Taxon": "taxon", "Taxon_Sequence": "sequence", "Gene_Family": "tree_id", **LINEAGE, "Num_Sister_Taxa": "n_sister_taxa", "Sister_Taxa": "sister_taxa", "Sister_Sequences": "sister_leaves",
        "Branch_Length": "branch_length", "Median_Branch_Length": "threshold", "Branch_Length_Evaluation": "verdict",
    },
    "ortholog_detail": {
        "Sequence": "sequence", "Number_Unique_Sister_Taxa": "n_sister_taxa", "Branch_Length": "branch_length", "Same_Domain": "same_domain", "Same_Supergroup": "same_supergroup", "Same_Major_Clade": "same_major", "Sister_Taxa": "sister_taxa",
    },
    "orthologs": {"Sequence": "sequence", "Sister_Taxa": "sister_taxa"},
    "names": {"Initial_ID": "Initial_ID", "Updated_Name": "Updated_Name"},
}


def as_report(table: DataFrame, kind: str, centre: str = "median") -> DataFrame:
    """A table with the column names and order of the written report of a kind; centre names the branch length that leaves are held against.

    The coverage of statistics is left out if no sequence has one.
    """
    columns = dict(COLUMNS[kind])
    if kind == "statistics" and table.where("coverage is not null").isEmpty():
        del columns["Coverage"]
    rename = {"Median_Branch_Length": f"{centre.title()}_Branch_Length"}
    return table.select(*(F.col(own).alias(rename.get(name, name)) for name, own in columns.items()))

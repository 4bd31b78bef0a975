"""Writers of sequence, table and tree files. An existing result is kept if asked for, so steps that are done aren't repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_fasta(records: DataFrame, path: str, name: str = "id", mode: str = "errorifexists") -> None:
    """id and seq as FASTA text."""
    records.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col("seq")).alias("value")).write.mode(mode).text(path)


def write_family_files(records: DataFrame, path: str, name: str = "id", mode: str = "errorifexists", families_only: bool = False) -> None:
    """FASTA text in one folder for each family (og). families_only: overwriting leaves families alone that records don't have."""
    rows = records.select("og", F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col("seq")).alias("value")).hint("rebalance", "og")
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic" if families_only else "static").partitionBy("og").text(path)


def write_table(table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A table with tabs and a header line."""
    table.write.mode(mode).option("sep", "\t").csv(path, header=True)


def write_report(table: DataFrame, path: str, kind: str, centre: str = "median", mode: str = "errorifexists") -> None:
    """A result of a module as a report of a kind, with the columns that readers of such files expect."""
    from ..operators import reports

    write_table(reports.as_report(table, kind, centre), path, mode)


def write_six_frames(records: DataFrame, path: str, code: int = 1, mode: str = "errorifexists") -> None:
    """Each record translated in its six frames, as id|RF<n>."""
    from ..functions import sequences

    frames = records.select("id", F.posexplode(sequences.six_translated(F.col("seq"), code)).alias("at", "seq"))
    rows = frames.select(F.concat(F.col("id"), F.lit("|RF"), (F.col("at") + 1).cast("string")).alias("id"), "seq")
    write_fasta(rows, path, mode=mode)


def write_trees(nodes: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Newick text of each tree of a node table, in a folder for each tree."""
    from ..operators import trees

    trees.as_newick(nodes).select("tree_id", F.col("newick").alias("value")).write.mode(mode).partitionBy("tree_id").text(path)

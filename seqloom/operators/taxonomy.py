"""Lineages: from a table of taxonomy nodes, and their reduction to four levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.staging import staged

#: Ranks that stay in a lineage.
RANKS = ("superkingdom", "kingdom", "clade", "phylum", "class", "order", "family", "genus")
#: The major group and clade of lineages that have none of the large groups.
PLACED = {
    "Ancyromonadida": ("Orphan", "Ancyromonadida"),
    "Apusozoa": ("Orphan", "Apusozoa"),
    "Breviata": ("Orphan", "Breviata"),
    "CRuMs": ("Orphan", "CRuMs"),
    "Cryptophyceae": ("Cryptista", "Cryptophyceae"),
    "Meteora": ("Orphan", "Orphan incertae sedis"),
    "Telonemida": ("Orphan", "Telonemida"),
    "Palpitomonas": ("Cryptista", "Cryptista incertae sedis"),
    "Picozoa": ("Orphan", "Orphan incertae sedis"),
    "Microheliella": ("Orphan", "Orphan incertae sedis"),
}
#: Groups of the primary plastids.
PLANTS = ("Viridiplantae", "Rhodophyta", "Rhodelphea", "Glaucocystophyceae")
LEVELS = ("domain", "supergroup", "major", "minor")


def reduce_lineage(q: Column) -> Column:
    """A struct of the four levels of a lineage, root first; four times Unknown where the rules have nothing to say."""
    at = lambda i: F.get(q, F.lit(i))
    last, size = F.get(q, F.size(q) - 1), F.size(q)

    def row(*levels) -> Column:
        return F.struct(*((x if isinstance(x, Column) else F.lit(x)).alias(n) for n, x in zip(LEVELS, levels, strict=True)))

    unknown = row(*["Unknown"] * 4)
    placed = F.create_map(*(x for k, v in PLACED.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    where = F.try_element_at(placed, at(1))
    full = row(at(0), at(1), at(2), at(3))
    eukaryote = (
        F.when(F.array_contains(q, "Opisthokonta"), F.when(at(2) == "Metazoa", row(at(0), at(1), at(2), F.coalesce(at(5), last))).when(size > 3, full).otherwise(unknown))
        .when(at(1).isin(*PLANTS), row(at(0), "Archaeplastida", at(1), F.coalesce(at(2), F.concat(at(1), F.lit(" incertae sedis")))))
        .when(F.array_contains(q, "Sar"), F.when(size > 3, row(at(0), F.upper(at(1)), F.replace(at(2), F.lit("Stramenopiles"), F.lit("Stramenopila")), at(3))).otherwise(unknown))
        .when(at(1).isin(*PLACED), row("Eukaryota", F.get(where, F.lit(0)), F.get(where, F.lit(1)), last))
        .when(size > 3, full)
        .otherwise(unknown)
    )
    prokaryote = (
        F.when(size > 3, full)
        .when(size == 3, row(at(0), at(1), at(2), at(2)))
        .when(size == 2, row(at(0), F.concat(at(0), F.lit(" incertae sedis")), F.concat(at(0), F.lit(" Incertae sedis")), at(1)))
        .otherwise(unknown)
    )
    return F.when(at(0) == "Eukaryota", eukaryote).when(at(0).isin("Bacteria", "Archaea"), prokaryote).otherwise(unknown)


def is_prokaryote(lineage: Column) -> Column:
    return F.coalesce(F.get(lineage, F.lit(0)).isin("Bacteria", "Archaea"), F.lit(False))


def lineages(nodes: DataFrame) -> DataFrame:
    """tax_id, name, lineage (names of the kept ranks, root first) of every node of nodes (tax_id, parent_id, rank, name); a root has no parent."""
    own = F.when(F.col("rank").isin(*RANKS), F.array("name")).otherwise(F.array().cast("array<string>"))
    now = nodes.select("tax_id", "name", F.col("parent_id").alias("up"), own.alias("lineage"))
    for r in range(64):  # the ways are joined end to end: as many rounds as the binary logarithm of the greatest depth
        now = staged(now, "lineages")
        if r > 12 and 2**r > now.count():
            raise ValueError("a node is its own ancestor")
        if now.where("up is not null").isEmpty():
            return now.select("tax_id", "name", F.when(F.size("lineage") > 0, F.col("lineage")).alias("lineage"))
        over = now.select(F.col("tax_id").alias("up"), F.col("up").alias("_up"), F.col("lineage").alias("_lineage"))
        joined = now.where("up is not null").join(over, "up", "left")
        joined = joined.select("tax_id", "name", F.col("_up").alias("up"), F.concat(F.coalesce("_lineage", F.array().cast("array<string>")), "lineage").alias("lineage"))
        now = joined.unionByName(now.where("up is null"))


def look_up(taxa: DataFrame, known: DataFrame) -> DataFrame:
    """taxon with its four levels: by the first two words of the name (parted by _), else by the first word, else Unknown.

    known: name and lineage.
    """
    words = F.split("taxon", "_")
    asked = taxa.select("taxon").distinct().withColumns({"two": F.array_join(F.slice(words, 1, 2), " "), "one": F.get(words, F.lit(0))})
    one, two = known.select(F.col("name").alias("one"), F.col("lineage").alias("l1")), known.select(F.col("name").alias("two"), F.col("lineage").alias("l2"))
    found = asked.join(two, "two", "left").join(one, "one", "left")
    return found.select("taxon", reduce_lineage(F.coalesce("l2", "l1", F.array().cast("array<string>"))).alias("r")).select("taxon", "r.*")

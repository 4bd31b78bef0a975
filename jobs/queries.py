"""The jobs as queries: each runs twice over the whole tables into one new folder and returns the output as it stands then."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from seqloom.functions import sequences
from seqloom.plans.substrate import sql
from seqloom.sources.staging import scratch

from . import codon_watch, family_release


def job1_family_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peptides of every released family."""
    out = scratch(spark, "family-release")
    family_release.run(spark, sf_dir, out)
    return family_release.run(spark, sf_dir, out).select("og", "doc_id", "taxon", "length", "representative", F.md5("seq").alias("seq_md5"))


def job2_codon_watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codon usage of every taxon; the second run finds nothing new."""
    out = scratch(spark, "codon-watch")
    codon_watch.run(spark, sf_dir, out)
    found = codon_watch.run(spark, sf_dir, out)
    return found.select("taxon", "codon", "amino_acid", "n", F.round("per_1k", 6).alias("per_1k"), F.round("relative", 6).alias("relative"))


QUERIES = {f.__name__: f for f in (job1_family_release, job2_codon_watch)}
_CODE = ", ".join(f"('{c}', '{a}')" for c, a in sequences.code_table(1).items())
ORACLES = {
    "job1_family_release": sql(
        "aa",
        "SELECT og, doc_id, taxon, length(seq)::BIGINT AS length, row_number() OVER (PARTITION BY og, taxon ORDER BY length(seq) DESC, ord) = 1 AS representative, md5(seq) AS seq_md5 FROM k "
        "WHERE og IN (SELECT og FROM k GROUP BY og HAVING count(*) >= 4)",
    ).replace(
        " SELECT og, doc_id,",
        ", r AS (SELECT * FROM aa WHERE seq IS NOT NULL AND doc_id IS NOT NULL), f AS (SELECT og, quantile_cont(length(seq), 0.5) AS mid, count(*) AS n FROM r GROUP BY og), "
        "k AS (SELECT r.* FROM r JOIN f ON f.og = r.og WHERE n >= 4 AND length(seq) BETWEEN mid * 0.33::DOUBLE AND mid * 2.0::DOUBLE) SELECT og, doc_id,",
        1,
    ),
    "job2_codon_watch": sql(
        "nt",
        f"SELECT taxon, codon, amino_acid, n, round(1000.0::DOUBLE * n / sum(n) OVER (PARTITION BY taxon), 6) AS per_1k, round(1.0::DOUBLE * n * synonyms / sum(n) OVER (PARTITION BY taxon, amino_acid), 6) AS relative FROM "
        "(SELECT CASE WHEN trim(coalesce(taxon, '')) <> '' THEN taxon ELSE 'Unknown' END AS taxon, codon, count(*)::BIGINT AS n FROM (SELECT taxon, unnest(regexp_extract_all(seq, '...')) AS codon FROM nt) GROUP BY 1, 2) u "
        f"JOIN (SELECT *, count(*) OVER (PARTITION BY amino_acid) AS synonyms FROM (VALUES {_CODE}) v(codon, amino_acid)) c USING (codon)",
    ),
}

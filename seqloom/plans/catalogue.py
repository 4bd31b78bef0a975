"""The catalogue of queries over the driver's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import names, sequences
from ..operators import collapse, containment, families, genetic_code, hits, profiles, records, reports, search, statistics, taxonomy, text_mining, trees
from ..sources import staging, text_formats
from . import substrate
from .substrate import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers a function under its name, with its SQL if it has any."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# Composition and codons

_GC = "CASE WHEN length({0}) > 0 THEN round(100.0::DOUBLE * length(regexp_replace({0}, '[^GC]', '', 'g')) / length({0}), 6) END"
_STATS = (
    "s AS (SELECT doc_id, seq, substr(seq, 1, CAST(length(seq) // 3 * 3 AS BIGINT)) AS cds FROM nt), "
    "t AS (SELECT doc_id, seq, regexp_replace(cds, '(.)(.)(.)', '\\1', 'g') AS one, regexp_replace(cds, '(.)(.)(.)', '\\2', 'g') AS two, regexp_replace(cds, '(.)(.)(.)', '\\3', 'g') AS three, "
    "regexp_replace(cds, '(?:TC|CT|CC|CG|AC|GT|GC|GG)(.)|...', '\\1', 'g') AS four FROM s) "
)


@query(
    sql("nt", "").rstrip() + ", " + _STATS + ", u AS (SELECT doc_id, length(seq)::BIGINT AS length, "
    + ", ".join(f"{_GC.format(c)} AS {n}" for c, n in (("seq", "gc"), ("one", "gc1"), ("two", "gc2"), ("three", "gc3"), ("one || two", "gc12"), ("four", "gc3_4fold")))
    + ", 100.0::DOUBLE * length(regexp_replace(four, '[^GC]', '', 'g')) / nullif(length(four), 0) / 100.0::DOUBLE AS f FROM t) "
    "SELECT doc_id, length, gc, gc1, gc2, gc3, gc12, gc3_4fold, round(2.0::DOUBLE + f + 29.0::DOUBLE / (f * f + (1.0::DOUBLE - f) * (1.0::DOUBLE - f)), 6) AS expected_enc FROM u"
)
def seq_gc_stats(spark, sf_dir):
    """Length, GC by codon place and expected number of codons of every sequence."""
    table = statistics.gc_table(substrate.nt(spark, sf_dir))
    wanted = ["doc_id", "length", "gc", "gc1", "gc2", "gc3", "gc12", "gc3_4fold", "expected_enc"]
    return rounded(table.select(*wanted), *wanted[2:])


@query(
    sql("nt", "").rstrip() + ", " + _STATS + ", w AS (SELECT floor(100.0::DOUBLE * length(regexp_replace(three, '[^GC]', '', 'g')) / length(three) + 0.5::DOUBLE)::INT AS step, count(*)::BIGINT AS sequences FROM t WHERE length(three) > 0 GROUP BY 1) "
    "SELECT i::INT AS step, i / 100.0::DOUBLE AS gc3, round(2.0::DOUBLE + s + 29.0::DOUBLE / (s * s + (1.0::DOUBLE - s) * (1.0::DOUBLE - s)), 6) AS enc, coalesce(sequences, 0) AS sequences "
    "FROM (SELECT i, least(i, 100 - i) / 100.0::DOUBLE AS s FROM range(101) r(i)) c LEFT JOIN w ON w.step = c.i"
)
def enc_null_curve(spark, sf_dir):
    """Expected number of codons along GC3, and how many sequences are at each step of it."""
    found = statistics.gc3_steps(substrate.nt(spark, sf_dir))  # 101 rows
    return rounded(statistics.null_curve(spark), "enc").join(found, "step", "left").withColumn("sequences", F.coalesce("sequences", F.lit(0)))


@query(
    sql("nt", "").rstrip() + ", s AS (SELECT substr(seq, 1, CAST(greatest(0, ceil((length(seq) - 3) / 3.0)) * 3 AS BIGINT)) AS c FROM nt), "
    "n AS (SELECT stop_codon, sum(length(regexp_replace(c, '(' || stop_codon || ')|...', '\\1', 'g')) // 3)::BIGINT AS counts, sum(length(c) // 3)::BIGINT AS total_codons "
    "FROM s, (VALUES ('TGA'), ('TAA'), ('TAG')) v(stop_codon) GROUP BY stop_codon) SELECT stop_codon, counts, total_codons, round(1000.0::DOUBLE * counts / total_codons, 6) AS per_1k FROM n"
)
def inframe_stop_rates(spark, sf_dir):
    """In-frame stops of code 1 over all sequences."""
    return rounded(statistics.stop_rates(substrate.nt(spark, sf_dir)), "per_1k")


@query()
def observed_enc(spark, sf_dir):
    """Effective number of codons of every sequence with the base composition taken out."""
    return rounded(statistics.observed_enc(substrate.nt(spark, sf_dir)), "enc", places=4)


@query(
    sql("nt", "SELECT codon, count(*)::BIGINT AS n, count(DISTINCT doc_id)::BIGINT AS records FROM (SELECT doc_id, unnest(regexp_extract_all(seq, '...')) AS codon FROM nt) GROUP BY codon")
)
def codon_usage(spark, sf_dir):
    """How often each codon comes up in frame, and in how many sequences."""
    rows = statistics.codon_counts(substrate.nt(spark, sf_dir))
    return rows.groupBy("codon").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("records"))


# Records: filters, names, isoforms


@query(
    sql("nt", "").rstrip() + ", k AS (SELECT *, row_number() OVER (ORDER BY ord) AS n FROM nt WHERE length(seq) >= 200) "
    "SELECT doc_id, id, taxon || '|Transcript_' || n || '_Length_' || length(seq) AS new_id FROM k"
)
def min_length_rename(spark, sf_dir):
    """Sequences of at least 200 letters, numbered in their order."""
    kept = records.keep_long(substrate.nt(spark, sf_dir))
    return records.renumber(kept, F.col("taxon")).select("doc_id", "id", "new_id")


@query(
    sql(
        "nt",
        "SELECT doc_id, length(seq)::BIGINT AS length, length(seq) % 3 = 0 AS whole, length(seq) % 3 = 0 AND right(seq, 3) IN ('TGA','TAA','TAG') AND left(seq, 3) = 'ATG' AS complete, "
        "length(seq) % 3 = 0 AND right(seq, 3) IN ('TGA','TAA','TAG') AND left(seq, 3) IN ('ATG','TTG','GTG') AS complete_prok FROM nt",
    )
)
def complete_cds_filter(spark, sf_dir):
    """Which sequences are whole codons and complete coding sequences, for eukaryotes and prokaryotes."""
    seq = F.col("seq")
    return substrate.nt(spark, sf_dir).select(
        "doc_id", F.length(seq).cast("long").alias("length"), (F.length(seq) % 3 == 0).alias("whole"),
        sequences.is_complete_cds(seq).alias("complete"), sequences.is_complete_cds(seq, True).alias("complete_prok"),
    )


_FASTA_LINE = 70


@query(
    sql("nt", "SELECT doc_id, doc_id || ' cds [location=<1..>' || length(coalesce(seq, '')) || '] a->b' AS description, length(coalesce(seq, ''))::BIGINT AS length, md5(coalesce(seq, '')) AS seq_md5 FROM nt")
)
def fasta_round_trip(spark, sf_dir):
    """Sequences written as FASTA with marks inside their headers and lines of both kinds, and read again."""
    rows = substrate.nt(spark, sf_dir).withColumn("seq", F.coalesce("seq", F.lit("")))
    end = F.when(F.col("doc_id") % 2 == 0, F.lit("\r\n")).otherwise(F.lit("\n"))
    header = F.concat(F.lit(">"), F.col("doc_id").cast("string"), F.lit(" cds [location=<1..>"), F.length("seq").cast("string"), F.lit("] a->b"))
    path = staging.scratch(spark, "fasta")
    rows.select(F.concat(header, end, F.regexp_replace("seq", F.lit("(.{%d})" % _FASTA_LINE), F.concat(F.lit("$1"), end))).alias("value")).write.text(path)
    back = text_formats.read_fasta(spark, path)
    return back.select(F.col("id").cast("long").alias("doc_id"), "description", F.length("seq").cast("long").alias("length"), F.md5("seq").alias("seq_md5"))


def _headers(spark, sf_dir):
    docs = substrate.table(spark, sf_dir, "documents")
    locus = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("[locus_tag=L"), (F.col("doc_id") % 97).cast("string"), F.lit("] "))).otherwise("")
    gene = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("[gene=g"), (F.col("doc_id") % 53).cast("string"), F.lit("] "))).otherwise("")
    protein = F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("[protein_id=P"), F.col("doc_id").cast("string"), F.lit("]"))).otherwise("")
    return docs.select("doc_id", F.concat(F.lit("lcl|x "), locus, gene, protein).alias("header"), substrate.sequence_of(F.col("text"), substrate.NT_TARGET).alias("seq"))


_HEADERS = (
    "headers AS (SELECT doc_id, 'lcl|x ' || CASE WHEN doc_id % 3 = 0 THEN '[locus_tag=L' || (doc_id % 97) || '] ' ELSE '' END || CASE WHEN doc_id % 2 = 0 THEN '[gene=g' || (doc_id % 53) || '] ' ELSE '' END "
    "|| CASE WHEN doc_id % 5 <> 0 THEN '[protein_id=P' || doc_id || ']' ELSE '' END AS header FROM documents), "
    "tags AS (SELECT doc_id, coalesce(nullif(regexp_extract(header, '\\[locus_tag=([^\\]]*)\\]', 1), ''), nullif(regexp_extract(header, '\\[gene=([^\\]]*)\\]', 1), '')) AS locus, "
    "nullif(regexp_extract(header, '\\[protein_id=([^\\]]*)\\]', 1), '') AS protein FROM headers)"
)


@query("WITH " + _HEADERS + " SELECT doc_id, locus, protein FROM tags")
def header_tags(spark, sf_dir):
    """Locus and protein of made-up headers."""
    return _headers(spark, sf_dir).select("doc_id", names.locus_of(F.col("header")).alias("locus"), names.tag(F.col("header"), "protein_id").alias("protein"))


@query(
    sql("nt", "").rstrip() + ", " + _HEADERS + ", r AS (SELECT t.*, length(seq) AS n, row_number() OVER (PARTITION BY locus ORDER BY length(seq) DESC, t.doc_id) AS p FROM tags t JOIN nt ON nt.doc_id = t.doc_id WHERE protein IS NOT NULL) "
    "SELECT locus, protein, doc_id AS ord, n::BIGINT AS length FROM r WHERE p = 1"
)
def longest_isoform(spark, sf_dir):
    """The longest sequence of each locus."""
    rows = _headers(spark, sf_dir).select(names.locus_of(F.col("header")).alias("locus"), names.tag(F.col("header"), "protein_id").alias("protein"), F.col("doc_id").alias("ord"), "seq")
    return records.longest_isoform(rows).select("locus", "protein", "ord", F.length("seq").cast("long").alias("length"))


@query(
    sql("nt", "").rstrip() + ", " + _HEADERS + " SELECT count(*)::BIGINT AS sequences, count(*) FILTER (length(seq) % 3 = 0 AND right(seq, 3) IN ('TGA','TAA','TAG') AND left(seq, 3) = 'ATG')::BIGINT AS complete, count(DISTINCT locus)::BIGINT AS loci FROM nt JOIN tags ON tags.doc_id = nt.doc_id"
)
def record_summary(spark, sf_dir):
    """How many sequences, complete ones and loci there are."""
    return records.summary(_headers(spark, sf_dir).select(names.locus_of(F.col("header")).alias("locus"), "seq"))


@query("SELECT 'OG_' || p_partkey AS og, p_name AS query_path, s_name AS alignment_path, c_name AS tree_path FROM part JOIN supplier ON p_partkey = s_suppkey JOIN customer ON c_custkey = p_partkey WHERE c_acctbal > 0")
def path_bundle(spark, sf_dir):
    """Families that three file catalogues have."""
    t = lambda n, key, path: substrate.table(spark, sf_dir, n).select(F.concat(F.lit("OG_"), F.col(key).cast("string")).alias("og"), F.col(path).alias("path"))
    trees_of = substrate.table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.concat(F.lit("OG_"), F.col("c_custkey").cast("string")).alias("og"), F.col("c_name").alias("path"))
    return records.bundle(t("part", "p_partkey", "p_name"), t("supplier", "s_suppkey", "s_name"), trees_of)


@query(
    sql(
        "nt",
        "SELECT doc_id, split_part(id, '|', 1) AS taxon, split_part(id, '|', -1) AS og, array_to_string(string_split(id, '|')[1:2], '|') AS prefix, "
        "'T|c1|' || doc_id AS coded, doc_id || '_|' || og AS packed FROM nt",
    )
)
def split_names(spark, sf_dir):
    """Parts of packed names and names packed anew."""
    key, name = F.col("doc_id").cast("string"), F.col("id")
    return substrate.nt(spark, sf_dir).select(
        "doc_id", names.taxon_of(name).alias("taxon"), names.og_of(name).alias("og"), names.sequence_prefix(name).alias("prefix"),
        names.display_id(F.lit("T"), key, F.lit("c1")).alias("coded"), names.with_og(key, F.col("og"), "_").alias("packed"),
    )


@query(sql("nt", "SELECT taxon AS \"Initial_ID\", max_by(og, ord) AS \"Updated_Name\" FROM nt GROUP BY taxon"))
def name_conversion(spark, sf_dir):
    """The last new name of each old one."""
    return records.name_table(substrate.nt(spark, sf_dir), "taxon", "og")


# Strands, frames, translation

_RC = "reverse(translate({0}, 'ACGT', 'TGCA'))"
_CODE = "code AS (SELECT map(list_transform(range(64), lambda i: substr('TCAG', CAST(i // 16 + 1 AS BIGINT), 1) || substr('TCAG', CAST(i // 4 % 4 + 1 AS BIGINT), 1) || substr('TCAG', CAST(i % 4 + 1 AS BIGINT), 1)), list_transform(range(64), lambda i: substr('" + sequences.GENETIC_CODES[1] + "', CAST(i + 1 AS BIGINT), 1))) AS m)"
_AA = "regexp_replace(array_to_string(list_transform(regexp_extract_all({0}, '...'), lambda c: m[c]), ''), '\\*+$', '')"


@query(sql("nt", f"SELECT doc_id, sha256({_RC.format('seq')}) AS strand_sha256 FROM nt"))
def reverse_complement(spark, sf_dir):
    """The other strand of every sequence, as a digest."""
    return substrate.nt(spark, sf_dir).select("doc_id", F.sha2(sequences.reverse_complement(F.col("seq")), 256).alias("strand_sha256"))


@query(sql("nt", "").rstrip() + f", {_CODE} SELECT doc_id, length({_AA.format('seq')})::BIGINT AS n_aa, sha256({_AA.format('seq')}) AS aa_sha256 FROM nt, code")
def translate_orfs(spark, sf_dir):
    """Every sequence translated, trailing stops cut off."""
    rows = substrate.nt(spark, sf_dir).select("doc_id", sequences.translated(F.col("seq")).alias("aa"))
    return rows.select("doc_id", F.length("aa").cast("long").alias("n_aa"), F.sha2("aa", 256).alias("aa_sha256"))


@query(
    sql("nt", "").rstrip() + f", {_CODE}, f AS (SELECT doc_id, rf::INT AS rf, substr(CASE WHEN rf < 4 THEN seq ELSE {_RC.format('seq')} END, CAST((rf - 1) % 3 + 1 AS BIGINT)) AS s FROM nt, range(1, 7) r(rf)) "
    f"SELECT doc_id, rf, sha256({_AA.format('s')}) AS aa_sha256 FROM f, code"
)
def six_frames(spark, sf_dir):
    """Every sequence translated in its six frames."""
    rows = substrate.nt(spark, sf_dir)
    frames = rows.select("doc_id", F.posexplode(F.coalesce(sequences.six_translated(F.col("seq")), F.array_repeat(F.lit(None).cast("string"), 6))).alias("at", "aa"))
    return frames.select("doc_id", (F.col("at") + 1).alias("rf"), F.sha2("aa", 256).alias("aa_sha256"))


# Hits

_ORF = (
    "joined AS (SELECT h.*, nt.id, nt.seq, CASE WHEN qframe < 0 THEN reverse(translate(substr(seq, least(qstart, qend), greatest(qstart, qend) - least(qstart, qend) + 1), 'ACGT', 'TGCA')) "
    "ELSE substr(seq, least(qstart, qend), greatest(qstart, qend) - least(qstart, qend) + 1) END AS part FROM hits h JOIN nt ON nt.doc_id = h.q_doc)"
)


def _nt_hits(spark, sf_dir):
    rows = substrate.nt(spark, sf_dir)
    found = substrate.hits(spark, sf_dir).join(rows.select(F.col("doc_id").alias("q_doc"), F.col("id").alias("qseqid")), "q_doc")
    return rows, found.drop("q_doc")


@query(sql("nt hits0 hits", "").rstrip() + ", " + _ORF + " SELECT id, ord, split_part(sseqid, '|', -1) AS og, id || '|' || split_part(sseqid, '|', -1) AS new_id, qframe, substr(part, 1, length(part) - length(part) % 3) AS orf FROM joined")
def orf_slice(spark, sf_dir):
    """The part of its sequence that each hit covers."""
    rows, found = _nt_hits(spark, sf_dir)
    joined = hits.slice_orfs(rows.select("id", "seq"), found.withColumn("bitscore", F.col("ord")))
    return joined.select("id", F.col("bitscore").alias("ord"), "og", "new_id", "qframe", "orf")


@query(
    sql("nt hits0 hits", "").rstrip() + ", p AS (SELECT q_doc, split_part(sseqid, '|', -1) AS profile, CAST(1 + ord % 6 AS INT) AS rf, CAST(1 + length % 9 AS INT) AS from_aa, CAST(1 + length % 9 + length AS INT) AS to_aa, bitscore AS score FROM hits), "
    "b AS (SELECT *, row_number() OVER (PARTITION BY q_doc ORDER BY score DESC, profile DESC, rf DESC) AS k FROM p), "
    f"c AS (SELECT nt.id, profile, rf, score, CASE WHEN rf < 4 THEN seq ELSE {_RC.format('seq')} END AS t, greatest(0, from_aa * 3 - CASE WHEN rf < 4 THEN 4 - rf ELSE 7 - rf END) AS lo, to_aa * 3 + CASE WHEN rf < 4 THEN rf - 1 ELSE rf - 4 END AS hi "
    "FROM b JOIN nt ON nt.doc_id = b.q_doc WHERE k = 1) SELECT id, profile AS og, rf, score, substr(t, CAST(lo + 1 AS BIGINT), CAST(greatest(0, hi - lo) AS BIGINT)) AS orf FROM c WHERE length(substr(t, CAST(lo + 1 AS BIGINT), CAST(greatest(0, hi - lo) AS BIGINT))) > 0"
)
def profile_orf_slice(spark, sf_dir):
    """The nucleotides of each sequence's best profile hit."""
    rows, found = _nt_hits(spark, sf_dir)
    rf = (1 + F.col("ord") % 6).cast("int")
    profile = found.select(
        F.concat_ws("|RF", "qseqid", rf.cast("string")).alias("target"), names.og_of(F.col("sseqid")).alias("profile"),
        (1 + F.col("length") % 9).cast("int").alias("from_aa"), (1 + F.col("length") % 9 + F.col("length")).cast("int").alias("to_aa"), F.col("bitscore").alias("score"),
    )
    return hits.slice_profile_orfs(rows.select("id", "seq"), profile)


@query(sql("hits0 hits", "SELECT q_doc, max_by(sseqid, ord) AS sseqid, max(ord) AS ord FROM hits GROUP BY q_doc"))
def last_hit(spark, sf_dir):
    """The last hit of each query."""
    return hits.one_hit(substrate.hits(spark, sf_dir).withColumnRenamed("q_doc", "qseqid")).select(F.col("qseqid").alias("q_doc"), "sseqid", "ord")


@query(
    sql("hits0 hits", "").rstrip() + ", r AS (SELECT *, split_part(sseqid, '|', -1) AS og, row_number() OVER (PARTITION BY split_part(sseqid, '|', -1) ORDER BY bitscore DESC, ord) AS p FROM hits) SELECT og, q_doc, ord, bitscore FROM r WHERE p = 1"
)
def best_hit_per_og(spark, sf_dir):
    """The best hit of each family."""
    rows = substrate.hits(spark, sf_dir).withColumn("og", names.og_of(F.col("sseqid")))
    return hits.best_in_family(rows.select("og", "q_doc", "ord", "bitscore"))


@query(
    sql("hits0 hits", "").rstrip() + ", r AS (SELECT *, row_number() OVER (PARTITION BY q_doc ORDER BY bitscore DESC, sseqid, ord) AS p FROM hits WHERE evalue <= 0.04 AND pident >= 93) SELECT q_doc, sseqid, ord FROM r WHERE p <= 3"
)
def hit_thresholds(spark, sf_dir):
    """Up to three hits of each query within the thresholds."""
    rows = substrate.hits(spark, sf_dir).withColumnRenamed("q_doc", "qseqid")
    return hits.keep_hits(rows, 0.04, 93.0, 3).select(F.col("qseqid").alias("q_doc"), "sseqid", "ord")


@query(
    sql("nt hits0 hits", "").rstrip() + ", c AS (SELECT q_doc, sseqid, hits.ord AS ord, 100.0::DOUBLE * (abs(qend - qstart) + 1) / length(seq) AS query_cover, 100.0::DOUBLE * hits.length / (60 + CAST(split_part(sseqid, '|', 2) AS BIGINT) % 40) AS subject_cover "
    "FROM hits JOIN nt ON nt.doc_id = q_doc) SELECT q_doc, sseqid, ord, round(query_cover, 6) AS query_cover, round(subject_cover, 6) AS subject_cover FROM c WHERE subject_cover >= 60 AND query_cover >= 2"
)
def hit_cover(spark, sf_dir):
    """Hits that cover enough of their query and of their subject."""
    rows = substrate.hits(spark, sf_dir).withColumnRenamed("q_doc", "qseqid").withColumns({"sstart": F.lit(1), "send": F.col("length")})
    queries = substrate.nt(spark, sf_dir).select(F.col("doc_id").alias("id"), F.length("seq").alias("length"))
    subjects = rows.select(F.col("sseqid").alias("id")).distinct().withColumn("length", 60 + F.split_part("id", F.lit("|"), F.lit(2)).cast("long") % 40)
    kept = hits.keep_hits(hits.with_cover(rows, queries, subjects), evalue=1.0, subject_cover=60, query_cover=2)
    return rounded(kept.select(F.col("qseqid").alias("q_doc"), "sseqid", "ord", "query_cover", "subject_cover"), "query_cover", "subject_cover")


# Joins and sets


@query(
    sql("nt", "SELECT doc_id, doc_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY' UNION SELECT s_suppkey FROM supplier WHERE s_acctbal < 0 UNION SELECT p_partkey FROM part WHERE p_size = 7) AS rrna FROM nt")
)
def rrna_partition(spark, sf_dir):
    """Sequences that any of three lists names, and the others."""
    t = lambda n: substrate.table(spark, sf_dir, n)
    lists = [
        t("customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("doc_id")),
        t("supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("doc_id")),
        t("part").where("p_size = 7").select(F.col("p_partkey").alias("doc_id")),
    ]
    found, rest = records.split_by_hits(substrate.nt(spark, sf_dir).select("doc_id"), lists, "doc_id")
    return found.withColumn("rrna", F.lit(True)).unionByName(rest.withColumn("rrna", F.lit(False)))


@query(sql("nt aa", "SELECT nt.doc_id, aa.id AS new_id, sha256(nt.seq) AS seq_sha256 FROM nt JOIN aa ON array_to_string(string_split(nt.id, '|')[1:3], '|') = array_to_string(string_split(aa.id, '|')[1:3], '|')"))
def protein_to_nt_rename(spark, sf_dir):
    """Nucleotide sequences under their proteins' names."""
    own = substrate.nt(spark, sf_dir).select("doc_id", names.without_og(F.col("id")).alias("id"), "seq")
    return records.rename_by_protein(own, substrate.aa(spark, sf_dir).select("id")).select("doc_id", "new_id", F.sha2("seq", 256).alias("seq_sha256"))


@query(
    sql("nt aa", "SELECT doc_id, og, 'ref' AS role FROM aa WHERE og IN (SELECT og FROM nt WHERE taxon = 'fr' AND length(seq) > 4000) UNION ALL SELECT doc_id, og, 'query' FROM nt WHERE taxon = 'fr' AND length(seq) > 4000")
)
def og_semi_join(spark, sf_dir):
    """Reference sequences of the families that have query data, with the queries."""
    ref = substrate.aa(spark, sf_dir).select("doc_id", "og", F.lit("ref").alias("role"))
    asked = substrate.nt(spark, sf_dir).where("taxon = 'fr' AND length(seq) > 4000").select("doc_id", "og", F.lit("query").alias("role"))
    return records.with_family_data(ref, asked)


@query(sql("aa", "SELECT doc_id, taxon, og FROM aa WHERE taxon IN (SELECT lower(left(n_name, 2)) FROM nation UNION SELECT 'en') AND og IN (SELECT 'OG_' || s_suppkey FROM supplier)"))
def whitelist(spark, sf_dir):
    """Sequences of listed taxa and families."""
    taxa = substrate.table(spark, sf_dir, "nation").select(F.lower(F.left("n_name", F.lit(2))).alias("t")).union(spark.range(1).select(F.lit("en")))
    ogs = substrate.table(spark, sf_dir, "supplier").select(F.concat(F.lit("OG_"), F.col("s_suppkey").cast("string")).alias("o"))
    rows = substrate.aa(spark, sf_dir).select("doc_id", "taxon", "og")
    return records.listed(records.listed(rows, taxa, "taxon"), ogs, "og").select("doc_id", "taxon", "og")


# Genetic code


def _alignments(spark, sf_dir):
    """Made-up alignments: each sequence against its own peptides, with gaps and changes by place."""
    rows = substrate.nt(spark, sf_dir)
    aa = sequences.translated(F.col("seq"), strip_stops=False)
    q = F.regexp_replace(aa, "L(.)", "-L$1")
    h = F.regexp_replace(F.regexp_replace(aa, "L(.)", "KM$1"), "S(.)", "-$1")
    whole = F.length("seq") - F.length("seq") % 3
    return rows.select("doc_id", F.col("doc_id").alias("id"), "seq"), rows.select(
        F.col("doc_id").alias("id"), F.lit(1).alias("q_from"), whole.cast("int").alias("q_to"), F.lit(1).alias("q_frame"), q.alias("q_seq"), h.alias("h_seq")
    )


_AAFULL = "array_to_string(list_transform(regexp_extract_all(seq, '...'), lambda c: m[c]), '')"


@query(
    sql("nt", "").rstrip() + f", {_CODE}, a AS (SELECT doc_id, seq, {_AAFULL} AS p FROM nt, code), "
    "b AS (SELECT doc_id, seq, string_split(regexp_replace(p, 'L(.)', '-L\\1', 'g'), '') AS q, string_split(regexp_replace(regexp_replace(p, 'L(.)', 'KM\\1', 'g'), 'S(.)', '-\\1', 'g'), '') AS h FROM a WHERE length(p) > 0), "
    "c AS (SELECT doc_id, seq, unnest(q) AS q, unnest(h) AS h, unnest(range(1, len(q) + 1)) AS i FROM b), "
    "d AS (SELECT *, sum(CASE WHEN q <> '-' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM c WHERE i <= 1000000000), "
    "pairs AS (SELECT substr(seq, CAST(n * 3 - 2 AS BIGINT), 3) AS codon, h AS aa FROM d WHERE q <> '-' AND h <> '-' AND h IS NOT NULL AND q IS NOT NULL), "
    "k AS (SELECT codon, aa, count(*) AS n FROM pairs WHERE length(codon) = 3 GROUP BY codon, aa), "
    "r AS (SELECT *, sum(n) OVER (PARTITION BY codon) AS total, row_number() OVER (PARTITION BY codon ORDER BY n DESC, aa) AS place FROM k), "
    "s AS (SELECT unnest(map_keys(m)) AS codon, unnest(map_values(m)) AS standard FROM code), "
    "t AS (SELECT s.codon, standard, aa, coalesce(n, 0) AS n, coalesce(total, 0) AS total, (SELECT sum(n) FROM k) AS every, s.codon IN ('TAA','TAG','TGA') AS stop FROM s LEFT JOIN r ON r.codon = s.codon AND place = 1), "
    "u AS (SELECT *, total > 0 AND total <= every * 1e-4 AS few FROM t) "
    "SELECT codon, CASE WHEN stop THEN 'STOP' ELSE standard END AS standard_aa, CASE WHEN stop AND (total = 0 OR few) THEN 'STOP' WHEN total = 0 THEN '?' WHEN n::DOUBLE / total < 0.33 THEN lower(aa) ELSE aa END AS predicted_aa, "
    "CASE WHEN stop AND (total = 0 OR few) THEN 'Same' WHEN total = 0 THEN 'Uncertain' WHEN aa <> standard THEN 'Reassigned' ELSE 'Same' END AS verdict, "
    "CASE WHEN stop AND few THEN total ELSE n END::BIGINT AS aa_frequency, total::BIGINT AS aa_count, every::BIGINT AS total_codons FROM u WHERE NOT few OR stop"
)
def codon_consensus(spark, sf_dir):
    """What each codon stands against in alignments of all sequences."""
    rows, aligned = _alignments(spark, sf_dir)
    return genetic_code.codon_consensus(genetic_code.aligned_codons(rows, aligned))


# K-mers, neighbours, clusters

_KMERS = "km AS (SELECT og, id, unnest(list_transform(range(1, greatest(1, length(seq) - 3)), lambda i: substr(seq, CAST(i AS BIGINT), 5))) AS kmer FROM fam WHERE length(seq) >= 5)"


@query(sql("aa", "SELECT og, kmer, count(DISTINCT doc_id)::BIGINT AS df FROM (SELECT og, doc_id, unnest(list_transform(range(1, length(seq) - 3), lambda i: substr(seq, CAST(i AS BIGINT), 5))) AS kmer FROM aa WHERE length(seq) >= 5) GROUP BY og, kmer"))
def kmer_df(spark, sf_dir):
    """In how many sequences of each family each 5-mer is."""
    return text_mining.kmer_document_frequency(substrate.aa(spark, sf_dir))


@query(
    sql("fam", "").rstrip() + ", " + _KMERS + ", tf AS (SELECT og, id, kmer, count(*) AS tf FROM km GROUP BY og, id, kmer), n AS (SELECT og, count(DISTINCT id) AS n FROM fam GROUP BY og), "
    "d AS (SELECT og, kmer, count(*) AS df FROM tf GROUP BY og, kmer HAVING count(*) >= 5), "
    "w AS (SELECT tf.og, id, tf.kmer, tf * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0::DOUBLE) AS raw FROM tf JOIN d ON d.og = tf.og AND d.kmer = tf.kmer JOIN n ON n.og = tf.og) "
    "SELECT og, id, kmer AS term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY og, id)), 6) AS weight FROM w"
)
def kmer_tfidf(spark, sf_dir):
    """TF-IDF of the 5-mers of every family member."""
    return rounded(text_mining.tfidf(substrate.families(spark, sf_dir)), "weight")


_RUNS = (
    "km AS (SELECT og, id, unnest(flatten(list_transform(range(1, 6), lambda n: list_transform(range(1, greatest(1, length(seq) - 2 - n)), "
    "lambda i: array_to_string(list_transform(range(i, i + n), lambda j: substr(seq, CAST(j AS BIGINT), 5)), ' '))))) AS kmer FROM fam WHERE length(seq) >= 5)"
)
_TFIDF = (
    "tf AS (SELECT og, id, kmer, count(*) AS tf FROM km GROUP BY og, id, kmer), n AS (SELECT og, count(DISTINCT id) AS n FROM fam GROUP BY og), "
    "d AS (SELECT og, kmer, count(*) AS df FROM tf GROUP BY og, kmer HAVING count(*) >= 5), "
    "raws AS (SELECT tf.og, id, tf.kmer, tf * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0::DOUBLE) AS raw FROM tf JOIN d ON d.og = tf.og AND d.kmer = tf.kmer JOIN n ON n.og = tf.og), "
    "w AS (SELECT og, id, kmer AS term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY og, id)) AS weight FROM raws)"
)


@query(sql("fam", "").rstrip() + ", " + _RUNS + ", " + _TFIDF + " SELECT og, id, term, round(weight, 6) AS weight FROM w")
def kmer_run_tfidf(spark, sf_dir):
    """TF-IDF of the runs of one to five 5-mers of every family member; kmer_tfidf has single 5-mers."""
    return rounded(text_mining.tfidf(substrate.families(spark, sf_dir), longest=5), "weight")


@query(
    sql("fam", "").rstrip() + ", " + _RUNS + ", " + _TFIDF + ", dots AS (SELECT a.og, a.id, b.id AS other, sum(a.weight * b.weight) AS dot FROM w a JOIN w b ON a.og = b.og AND a.term = b.term AND a.id <> b.id GROUP BY a.og, a.id, b.id), "
    "every AS (SELECT DISTINCT og, id, CASE WHEN (og, id) IN (SELECT og, id FROM w) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS length FROM fam), "
    "pairs AS (SELECT a.og, a.id, b.id AS other, CASE WHEN dot IS NULL THEN a.length + b.length ELSE greatest(0.0::DOUBLE, 2.0::DOUBLE - 2.0::DOUBLE * dot) END AS d2 "
    "FROM every a JOIN every b ON a.og = b.og AND a.id <> b.id LEFT JOIN dots ON dots.og = a.og AND dots.id = a.id AND dots.other = b.id), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY og, id ORDER BY round(d2, 9), other) AS place FROM pairs) SELECT og, id, other, place::INT AS place FROM r WHERE place <= 10"
)
def text_knn_edges(spark, sf_dir):
    """The ten nearest members of each family member by the TF-IDF of its runs of 5-mers."""
    rows = substrate.families(spark, sf_dir)
    return text_mining.nearest_records(*text_mining.tfidf_vectors(rows, longest=5)).select("og", "id", "other", "place")


_NEAR = (
    "p AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: x::DOUBLE) AS vec FROM embeddings), big AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY label) AS n FROM p) WHERE n > {k}), "
    "d AS (SELECT a.label, a.id, b.id AS other, list_sum(list_transform(range(1, 65), lambda i: (a.vec[i] - b.vec[i]) * (a.vec[i] - b.vec[i]))) AS d2 FROM big a JOIN big b ON a.label = b.label AND a.id <> b.id), "
    "e AS (SELECT *, row_number() OVER (PARTITION BY label, id ORDER BY d2, other) AS place FROM d)"
)


@query("WITH " + _NEAR.format(k=10) + " SELECT label, id, other, place::INT AS place FROM e WHERE place <= 10")
def knn_edges(spark, sf_dir):
    """The ten nearest vectors of each vector's label."""
    return text_mining.knn_edges(substrate.points(spark, sf_dir)).select("label", "id", "other", "place")


@query(
    "WITH " + _NEAR.format(k=1) + ", sz AS (SELECT label, least(count(*) - 1, CASE WHEN count(*) >= 20 THEN 20 ELSE greatest(2, count(*) // 2) END) AS k FROM embeddings GROUP BY label HAVING count(*) > 1), "
    "nb AS (SELECT e.label, id, other, sqrt(d2) AS d FROM e JOIN sz ON sz.label = e.label WHERE place <= k), kd AS (SELECT label, id, max(d) AS k FROM nb GROUP BY label, id), "
    "den AS (SELECT nb.label, nb.id, 1.0::DOUBLE / (avg(greatest(d, k)) + 1e-10::DOUBLE) AS lrd FROM nb JOIN kd ON kd.label = nb.label AND kd.id = nb.other GROUP BY nb.label, nb.id) "
    "SELECT nb.label, nb.id, round(avg(o.lrd) / min(m.lrd), 6) AS lof, avg(o.lrd) / min(m.lrd) > 1.5 AS outlier FROM nb JOIN den o ON o.label = nb.label AND o.id = nb.other JOIN den m ON m.label = nb.label AND m.id = nb.id GROUP BY nb.label, nb.id"
)
def lof_outliers(spark, sf_dir):
    """Local outlier factor of each vector within its label."""
    near = families.lof_neighbours(substrate.points(spark, sf_dir), text_mining.knn_edges)
    return rounded(families.lof(near), "lof")


@query()
def ward_clusters(spark, sf_dir):
    """Clusters of the neighbour graph of each label's vectors."""
    points = substrate.points(spark, sf_dir)
    return text_mining.clusters_of_graph(text_mining.knn_edges(points), points, group="label")


_VOTE = (
    "m AS (SELECT label AS cluster, vec_id AS id, 'D' || (vec_id % 2) AS domain, 'S' || (vec_id % 3 // 2) AS supergroup, 'M' || (vec_id % 5 // 4) AS major, 'N' || (vec_id % 7) AS minor FROM embeddings), "
    "l AS (SELECT cluster, 'domain' AS level, domain AS label FROM m UNION ALL SELECT cluster, 'supergroup', supergroup FROM m UNION ALL SELECT cluster, 'major', major FROM m UNION ALL SELECT cluster, 'minor', minor FROM m), "
    "v AS (SELECT cluster, level, label, count(*)::BIGINT AS votes FROM l GROUP BY ALL), t AS (SELECT *, (sum(votes) OVER (PARTITION BY cluster, level))::BIGINT AS total FROM v)"
)


def _members(spark, sf_dir):
    v = F.col("vec_id")
    label = lambda letter, n: F.concat(F.lit(letter), n.cast("int").cast("string"))
    return substrate.table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("cluster"), v.cast("string").alias("id"), label("D", v % 2).alias("domain"), label("S", F.floor(v % 3 / 2)).alias("supergroup"),
        label("M", F.floor(v % 5 / 4)).alias("major"), label("N", v % 7).alias("minor"),
    )


@query("WITH " + _VOTE + " SELECT * FROM t WHERE votes > total * 0.6")
def cluster_vote(spark, sf_dir):
    """Labels that more than 0.6 of a cluster's members have."""
    return text_mining.cluster_votes(_members(spark, sf_dir))


@query(
    "WITH " + _VOTE.split(", l AS")[0] + ", q AS (SELECT cluster, id AS query_seq FROM m WHERE contains(id::VARCHAR, '7')), o AS (SELECT * FROM m WHERE NOT contains(id::VARCHAR, '7')), l AS"
    + _VOTE.split(", l AS")[1].replace("FROM m", "FROM o") + ", won AS (SELECT * FROM t WHERE votes > total * 0.6), c AS (SELECT cluster, bool_or(level = 'major') AS mj, bool_or(level = 'minor') AS mn FROM won GROUP BY cluster) "
    "SELECT query_seq::VARCHAR AS query_seq, o.domain, o.supergroup, CASE WHEN mj THEN o.major ELSE 'No-clear-major-clade' END AS major, CASE WHEN mn THEN o.minor ELSE 'No-clear-minor-clade' END AS minor, o.id::VARCHAR AS cluster_seq, o.id::VARCHAR AS cluster_taxon "
    "FROM o JOIN won g ON g.cluster = o.cluster AND g.level = 'supergroup' AND g.label = o.supergroup JOIN q ON q.cluster = o.cluster JOIN c ON c.cluster = o.cluster"
)
def cluster_by_catch(spark, sf_dir):
    """By-catch rows of clusters that hold members of a query taxon."""
    return text_mining.by_catch(_members(spark, sf_dir), "7")


@query()
def greedy_collapse(spark, sf_dir):
    """Family members folded into longer ones that cover them."""
    return collapse.collapse(substrate.families(spark, sf_dir))


# Search


def passages(spark, sf_dir):
    """The benchmark's items as peptides: id, seq."""
    return substrate.table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("id"), substrate.sequence_of(F.col("text"), substrate.AA_TARGET).alias("seq"))


@query()
def homology_hits(spark, sf_dir):
    """Sequences of documents that hold something like a passage of the benchmark: all hits of each passage."""
    subjects = substrate.aa(spark, sf_dir).select(F.col("doc_id").cast("string").alias("id"), "seq")
    found = search.search_peptides(passages(spark, sf_dir), subjects, search.Search(seed=12, kinds=4, seeds=3, segment=80, evalue=1e-20), most=None)
    return found.select(F.col("qseqid").cast("long").alias("item_id"), F.col("sseqid").cast("long").alias("doc_id"), "length", F.round("pident", 4).alias("pident"), "qstart", "qend", "sstart", "send", "bitscore")


@query()
def genes_in_records(spark, sf_dir):
    """Sequences of documents that hold a passage of the benchmark, the passages being the genes of four sets."""
    passage = substrate.table(spark, sf_dir, "benchmark").select(F.concat(F.lit("set"), (F.col("item_id") % 4).cast("string")).alias("kingdom"), F.col("item_id").alias("id"), substrate.sequence_of(F.col("text"), substrate.NT_TARGET).alias("seq"))
    found = containment.contained(substrate.nt(spark, sf_dir).select(F.col("doc_id").alias("id"), "seq"), passage, containment.Containment(k=21, share=0.5))
    return rounded(found.withColumnsRenamed({"id": "doc_id", "reference": "item_id"}), "share")


@query()
def profile_hits(spark, sf_dir):
    """Peptides that the profile of a family's longest member finds."""
    rows = substrate.families(spark, sf_dir)
    longest = rows.where("og is not null").groupBy("og").agg(F.max_by("seq", F.struct(F.length("seq"), -F.col("id"))).alias("seq")).orderBy("og").collect()  # a row for each brand
    models = [profiles.of_sequence(r["og"], r["seq"] or "") for r in longest]
    return rounded(profiles.search_profiles(rows, models, 1e-3).withColumnRenamed("target", "id").select("id", "profile", "score", "viterbi", "from_aa", "to_aa"), "score", "viterbi", places=4)


# Families


@query(
    sql("aa", "").rstrip() + ", f AS (SELECT og, quantile_cont(length(seq), 0.5) AS mid, count(*) AS n FROM aa GROUP BY og), k AS (SELECT aa.doc_id, aa.og, length(seq)::BIGINT AS length FROM aa JOIN f ON f.og = aa.og WHERE n >= 4 AND length(seq) BETWEEN mid * 0.33::DOUBLE AND mid * 2.0::DOUBLE) "
    "SELECT * FROM k WHERE og IN (SELECT og FROM k GROUP BY og HAVING count(*) >= 4)"
)
def size_filter(spark, sf_dir):
    """Sequences near their family's median length."""
    return families.size_filter(substrate.aa(spark, sf_dir)).select("doc_id", "og", F.length("seq").cast("long").alias("length"))


_DIST = "x AS (SELECT DISTINCT og, seq FROM fam), pairs AS (SELECT a.og, a.seq AS a, b.seq AS b, levenshtein(a.seq, b.seq) AS d FROM x a JOIN x b ON a.og = b.og AND a.seq < b.seq)"
_MED = (
    _DIST + ", c AS (SELECT og, seq, count(*) AS copies FROM fam GROUP BY og, seq), both_ways AS (SELECT og, a AS seq, b AS other, d FROM pairs UNION ALL SELECT og, b, a, d FROM pairs UNION ALL SELECT og, seq, seq, 0 FROM x), "
    "med AS (SELECT w.og, w.seq, quantile_cont(d, 0.5)::DOUBLE AS median FROM (SELECT b.*, unnest(range(copies)) FROM both_ways b JOIN c ON c.og = b.og AND c.seq = b.other) w GROUP BY w.og, w.seq), "
    "medians AS (SELECT fam.og, id, median FROM fam JOIN med ON med.og = fam.og AND med.seq = fam.seq)"
)


@query(sql("fam", "").rstrip() + ", " + _DIST + " SELECT og, a, b, d::INT AS d FROM pairs")
def pairwise_levenshtein(spark, sf_dir):
    """Edit distances of the distinct sequences of each family."""
    return families.distances(substrate.families(spark, sf_dir))


@query(sql("fam", "").rstrip() + ", " + _MED + " SELECT og, id, median FROM medians")
def row_median_distance(spark, sf_dir):
    """Each member's median distance to its family."""
    return families.row_medians(substrate.families(spark, sf_dir))


@query(
    sql("fam", "").rstrip() + ", " + _MED + ", z AS (SELECT *, CASE WHEN stddev_pop(median) OVER (PARTITION BY og) > 0 THEN (median - avg(median) OVER (PARTITION BY og)) / stddev_pop(median) OVER (PARTITION BY og) ELSE 0.0::DOUBLE END AS z FROM medians) "
    "SELECT og, id, median, round(z, 6) AS z, z >= 2.0 AS outlier FROM z"
)
def zscore_outliers(spark, sf_dir):
    """Members far from their family, by z-score."""
    return rounded(families.zscore_outliers(families.row_medians(substrate.families(spark, sf_dir)), 2.0), "z")


@query(
    sql("fam", "").rstrip() + ", " + _MED + ", q AS (SELECT og, quantile_cont(median, 0.25) AS q1, quantile_cont(median, 0.75) AS q3 FROM medians GROUP BY og) "
    "SELECT medians.og, id, median, q1, q3, median < q1 - (q3 - q1) * 1.5 OR median > q3 + (q3 - q1) * 1.5 AS outlier FROM medians JOIN q ON q.og = medians.og"
)
def iqr_outliers(spark, sf_dir):
    """Members far from their family, by quartiles."""
    return families.iqr_outliers(families.row_medians(substrate.families(spark, sf_dir)), 1.5)


@query(
    sql("fam", "").rstrip() + ", " + _MED + ", n AS (SELECT og, least(1.0::DOUBLE, 100.0::DOUBLE / count(*)) AS rate FROM medians GROUP BY og), "
    "u AS (SELECT m.og, median, rate, rep, ('0x' || substr(md5(id || '|' || (rep // 4)), (8 * (rep % 4) + 1)::BIGINT, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM medians m JOIN n ON n.og = m.og, range(100) r(rep)), "
    "p AS (SELECT rate, k, exp(-rate) * pow(rate, k) / factorial(k::INT)::DOUBLE AS term FROM (SELECT DISTINCT rate FROM n), range(15) r(k)), cdf AS (SELECT rate, list(upto ORDER BY k) AS uptos FROM (SELECT rate, k, sum(term) OVER (PARTITION BY rate ORDER BY k) AS upto FROM p) GROUP BY rate), "
    "w AS (SELECT og, rep, median, len(list_filter(uptos, lambda x: u >= x)) AS w FROM u JOIN cdf ON cdf.rate = u.rate), s AS (SELECT og, rep, sum(w) AS n, sum(w * median) AS s, sum(w * median * median) AS q FROM w GROUP BY og, rep HAVING sum(w) > 0), "
    "t AS (SELECT og, avg(s / n) AS mean, avg(sqrt(greatest(0.0::DOUBLE, q / n - (s / n) * (s / n)))) AS dev FROM s GROUP BY og), "
    "z AS (SELECT medians.og, id, median, coalesce(CASE WHEN dev > 0 THEN (median - mean) / dev END, 0.0::DOUBLE) AS z FROM medians LEFT JOIN t ON t.og = medians.og) SELECT og, id, median, round(z, 6) AS z, z >= 2.0 AS outlier FROM z"
)
def bootstrap_outliers(spark, sf_dir):
    """Members far from their family, by resampled mean and deviation."""
    return rounded(families.bootstrap_outliers(families.row_medians(substrate.families(spark, sf_dir)), 2.0), "z")


@query(
    "WITH s AS (SELECT o_orderpriority AS og, o_orderkey AS id, o_totalprice AS v FROM orders), q AS (SELECT og, quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.5) AS b, quantile_cont(v, 0.75) AS c FROM s GROUP BY og) "
    "SELECT s.og, id, round((v - b) / CASE WHEN c - a > 0 THEN c - a ELSE 1 END, 6) AS scaled FROM s JOIN q ON q.og = s.og"
)
def robust_scale(spark, sf_dir):
    """Order totals by their group's median and range."""
    rows = substrate.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("og"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v"))
    return rounded(families.robust_scale(rows, "v", "og").select("og", "id", "scaled"), "scaled")


@query(sql("fam", "SELECT id, og FROM fam WHERE NOT (taxon = 'SMALL' AND length(seq) > 20)"))
def filter_intersection(spark, sf_dir):
    """Family members that two filters together don't take out."""
    rows = substrate.families(spark, sf_dir)
    one, two = rows.where("taxon = 'SMALL'"), rows.where("length(seq) > 20")
    return families.combine_filters(rows, one, two).select("id", "og")


# Reports


@query(sql("detail", "SELECT domain, major_group, count(DISTINCT query_seq)::BIGINT AS frequency FROM detail GROUP BY ALL"))
def distinct_query_freq(spark, sf_dir):
    """Distinct queries by domain and major group."""
    return reports.distinct_query_frequency(substrate.detail(spark, sf_dir), ["domain", "major_group"])


@query(sql("detail", "SELECT major_group, count(DISTINCT query_seq)::BIGINT AS frequency FROM detail GROUP BY ALL ORDER BY frequency DESC, major_group LIMIT 5"))
def top5_groups(spark, sf_dir):
    """The five major groups with the most queries."""
    return reports.top(substrate.detail(spark, sf_dir), "major_group")


@query(sql("detail", "SELECT major_group, major_clade, cluster_taxon, count(*)::BIGINT AS frequency FROM detail GROUP BY ALL"))
def clade_frequency(spark, sf_dir):
    """Rows by group, clade and taxon."""
    return reports.frequency(substrate.detail(spark, sf_dir), ["major_group", "major_clade", "cluster_taxon"])


@query(
    sql("detail", "SELECT domain, major_group, major_clade, count(*)::BIGINT AS frequency, count(DISTINCT query_seq)::BIGINT AS queries, (3 - grouping(domain) - grouping(major_group) - grouping(major_clade))::INT AS level FROM detail GROUP BY ROLLUP (domain, major_group, major_clade)")
)
def taxonomy_rollup(spark, sf_dir):
    """Rows and queries at every level."""
    return reports.roll_up(substrate.detail(spark, sf_dir), ["domain", "major_group", "major_clade"])


@query(
    "WITH s AS (SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ';') AS sister_taxa FROM orders GROUP BY o_custkey) SELECT sister_taxa, count(*)::BIGINT AS frequency FROM s WHERE NOT contains(sister_taxa, ';') GROUP BY sister_taxa ORDER BY frequency DESC, sister_taxa LIMIT 5"
)
def single_sister_top5(spark, sf_dir):
    """The commonest only sisters."""
    rows = substrate.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ";").alias("sister_taxa"))
    return reports.single_sister_top(rows)


# Taxonomy


def _tax_nodes(spark, sf_dir):
    region, nation = substrate.table(spark, sf_dir, "region"), substrate.table(spark, sf_dir, "nation")
    top = spark.createDataFrame([(0, None, "superkingdom", "Eukaryota"), (1, 0, "kingdom", "Sar"), (2, 0, "no rank", "hidden")], "tax_id long, parent_id long, rank string, name string")
    r = region.select((F.col("r_regionkey") + 10).cast("long").alias("tax_id"), (F.col("r_regionkey") % 3).cast("long").alias("parent_id"), F.lit("phylum").alias("rank"), F.col("r_name").alias("name"))
    n = nation.select((F.col("n_nationkey") + 100).cast("long").alias("tax_id"), (F.col("n_regionkey") + 10).cast("long").alias("parent_id"), F.lit("genus").alias("rank"), F.col("n_name").alias("name"))
    return top.unionByName(r).unionByName(n)


_TAX = (
    "WITH RECURSIVE nodes AS (SELECT * FROM (VALUES (0::BIGINT, NULL::BIGINT, 'superkingdom', 'Eukaryota'), (1, 0, 'kingdom', 'Sar'), (2, 0, 'no rank', 'hidden')) v(tax_id, parent_id, rank, name) "
    "UNION ALL SELECT r_regionkey + 10, r_regionkey % 3, 'phylum', r_name FROM region UNION ALL SELECT n_nationkey + 100, n_regionkey + 10, 'genus', n_name FROM nation), "
    "up AS (SELECT tax_id, tax_id AS at_id, 0 AS depth FROM nodes UNION ALL SELECT up.tax_id, n.parent_id, up.depth + 1 FROM up JOIN nodes n ON n.tax_id = up.at_id WHERE n.parent_id IS NOT NULL), "
    "lin AS (SELECT up.tax_id, list(n.name ORDER BY depth DESC) AS l FROM up JOIN nodes n ON n.tax_id = up.at_id WHERE n.rank IN ('superkingdom','kingdom','clade','phylum','class','order','family','genus') GROUP BY up.tax_id)"
)


@query(_TAX + " SELECT nodes.tax_id, name, array_to_string(l, ';') AS lineage FROM nodes LEFT JOIN lin ON lin.tax_id = nodes.tax_id")
def lineage_lookup(spark, sf_dir):
    """The lineage of every taxonomy node."""
    return taxonomy.lineages(_tax_nodes(spark, sf_dir)).select("tax_id", "name", F.array_join("lineage", ";").alias("lineage"))


@query(
    _TAX + " SELECT tax_id, CASE WHEN list_contains(l, 'Sar') THEN CASE WHEN len(l) > 3 THEN l[1] ELSE 'Unknown' END WHEN len(l) > 3 THEN l[1] ELSE 'Unknown' END AS domain, "
    "CASE WHEN list_contains(l, 'Sar') AND len(l) > 3 THEN upper(l[2]) WHEN len(l) > 3 THEN l[2] ELSE 'Unknown' END AS supergroup, CASE WHEN len(l) > 3 THEN l[3] ELSE 'Unknown' END AS major, CASE WHEN len(l) > 3 THEN l[4] ELSE 'Unknown' END AS minor FROM lin"
)
def lineage_reduce(spark, sf_dir):
    """The four levels of every node's lineage."""
    rows = taxonomy.lineages(_tax_nodes(spark, sf_dir)).where("lineage IS NOT NULL")
    return rows.select("tax_id", taxonomy.reduce_lineage(F.col("lineage")).alias("r")).select("tax_id", "r.*")


# Trees


def _tree(spark, sf_dir):
    nodes = substrate.tree(spark, sf_dir)
    return nodes, trees.Forest(nodes)


@query(
    sql("nodes up", "SELECT anc_id AS node_id, min('g' || (n.parent_id % 7)) AS supergroup, count(*)::BIGINT AS leaves, count(DISTINCT taxon)::BIGINT AS taxa FROM up JOIN nodes n ON n.node_id = up.node_id WHERE is_leaf AND depth > 0 GROUP BY anc_id HAVING count(DISTINCT n.parent_id % 7) = 1")
)
def clade_sizes(spark, sf_dir):
    """Inner nodes whose leaves are of one group, a group being several nations."""
    nodes, forest = _tree(spark, sf_dir)
    return trees.clade_sizes(forest, nodes.withColumn("supergroup", F.concat(F.lit("g"), (F.col("parent_id") % 7).cast("string")))).drop("tree_id")


_SIS = (
    "lv AS (SELECT node_id, taxon, taxon AS prefix, supergroup FROM nodes WHERE is_leaf), un AS (SELECT up.anc_id, up.depth, lv.* FROM up JOIN lv ON lv.node_id = up.node_id), "
    "mixed AS (SELECT anc_id FROM un GROUP BY anc_id HAVING count(DISTINCT prefix) > 1), st AS (SELECT node_id, taxon, min_by(un.anc_id, depth) AS stop_id FROM un JOIN mixed ON mixed.anc_id = un.anc_id GROUP BY node_id, taxon), "
    "sis AS (SELECT st.node_id AS leaf, stop_id, un.node_id AS sister, un.taxon AS sister_taxon, un.supergroup FROM st JOIN un ON un.anc_id = st.stop_id AND un.taxon <> st.taxon)"
)


def _sisters(spark, sf_dir):
    nodes, forest = _tree(spark, sf_dir)
    leaves = nodes.where("is_leaf").select("tree_id", "node_id", F.col("taxon").alias("prefix"), "taxon", "supergroup")
    return trees.Sisters(leaves, forest)


@query(sql("nodes up", "").rstrip() + ", " + _SIS + " SELECT leaf, min(stop_id) AS stop_id, count(*)::BIGINT AS sisters, count(DISTINCT sister_taxon)::BIGINT AS sister_taxa FROM sis GROUP BY leaf")
def sister_groups(spark, sf_dir):
    """How many sisters each leaf has, and under which node."""
    return _sisters(spark, sf_dir).counts().drop("tree_id")


@query(
    sql("nodes up", "").rstrip() + ", " + _SIS + " SELECT leaf, CASE WHEN count(DISTINCT supergroup) = 1 THEN min(supergroup) END AS supergroup, CASE WHEN count(DISTINCT sister_taxon) = 1 THEN min(sister_taxon) END AS sister_taxon FROM sis GROUP BY leaf"
)
def sister_unanimity(spark, sf_dir):
    """What all sisters of a leaf agree on."""
    return _sisters(spark, sf_dir).agreed(["supergroup", "taxon"]).drop("tree_id")


@query(
    sql("nodes up", "").rstrip() + ", " + _SIS + " SELECT leaf, count(DISTINCT sister_taxon)::INT AS n_sister_taxa, CASE WHEN count(DISTINCT sister_taxon) > 3 THEN 'More-than-3' ELSE string_agg(DISTINCT sister_taxon, ';' ORDER BY sister_taxon) END AS sister_taxa, "
    "CASE WHEN count(DISTINCT sister_taxon) > 3 THEN 'Too-many-seqs' ELSE array_to_string(list_sort(list(DISTINCT sister)), ';') END AS sister_leaves FROM sis GROUP BY leaf"
)
def sister_lists(spark, sf_dir):
    """The sisters of each leaf as text."""
    return _sisters(spark, sf_dir).lists(3).drop("tree_id")


@query(sql("nodes", "SELECT node_id, round(dist, 6) AS dist, round(quantile_cont(dist, 0.5) OVER (), 6) AS threshold, CASE WHEN dist <= quantile_cont(dist, 0.5) OVER () THEN 'short' ELSE 'long' END AS verdict FROM nodes WHERE is_leaf"))
def branch_eval(spark, sf_dir):
    """Leaves against the median branch length."""
    return rounded(trees.branch_verdicts(substrate.tree(spark, sf_dir)).select("node_id", "dist", "threshold", "verdict"), "dist", "threshold")


@query(
    sql("nodes up", "").rstrip() + ", rd AS (SELECT node_id, max_by(d, depth) AS root_dist FROM up GROUP BY node_id), c AS (SELECT n.parent_id, n.taxon, n.node_id AS id, n.node_id % 4 AS same, n.node_id % 7 AS nst, root_dist FROM nodes n JOIN rd ON rd.node_id = n.node_id WHERE is_leaf), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY parent_id, taxon ORDER BY same DESC, nst DESC, root_dist, id) AS p FROM c) SELECT parent_id, taxon, id, round(root_dist, 6) AS root_dist FROM r WHERE p = 1"
)
def ortholog_pick(spark, sf_dir):
    """The best leaf of each taxon under each node."""
    nodes, forest = _tree(spark, sf_dir)
    far = forest.root_distances().drop("tree_id")
    rows = nodes.where("is_leaf").join(far, "node_id").select("parent_id", "taxon", F.col("node_id").alias("id"), (F.col("node_id") % 4).alias("same"), (F.col("node_id") % 7).alias("n_sister_taxa"), "root_dist")
    return rounded(trees.pick_orthologs(rows, ["parent_id", "taxon"]).select("parent_id", "taxon", "id", "root_dist"), "root_dist")


@query()
def reroot_tree(spark, sf_dir):
    """A tree for each nation, its customers as leaves, read from Newick text and rooted by groups."""
    customer = substrate.table(spark, sf_dir, "customer")
    leaf = F.concat("c_mktsegment", F.lit("|"), F.col("c_custkey").cast("string"), F.lit(":"), F.round(F.abs("c_acctbal") / 10000, 4).cast("string"))
    chain = F.aggregate(F.array_sort(F.collect_list(leaf)), F.lit(""), lambda s, x: F.when(s == "", x).otherwise(F.concat(F.lit("("), s, F.lit(","), x, F.lit("):0.01"))))
    texts = customer.groupBy("c_nationkey", (F.col("c_custkey") % 97).alias("block")).agg(F.concat(chain, F.lit(";")).alias("newick"))
    texts = texts.select(F.concat_ws("-", F.col("c_nationkey").cast("string"), F.col("block").cast("string")).alias("tree_id"), F.concat(F.lit("("), F.expr("substring(newick, 1, length(newick) - 1)"), F.lit(");")).alias("newick"))
    taxa = customer.select(F.col("c_mktsegment").alias("taxon")).distinct().withColumns({"domain": F.lit("Eukaryota"), "supergroup": F.when(F.col("taxon") < "F", "Opisthokonta").otherwise("SAR")})
    return trees.from_newick(texts, taxa)

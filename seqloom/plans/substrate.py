"""Sequence tables made from the driver's tables, the same in Spark and in SQL."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

LETTERS = "abcdefghijklmnopqrstuvwxyz"
NT_TARGET = "ACGTACGTACGTACGTACGTACGTAC"
AA_TARGET = "ACDEFGHIKLMNPQRSTVWYACDEFG"
FAMILIES = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes for each core below which an input is dealt out anew.
SMALL = 64 << 20


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a small input dealt out to all cores, as a file of one row group is one task's work however it is split; those of a large one as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows.repartition(cores) if size <= cores * SMALL else rows


_OTHERS = bytes(set(range(256)) - set(LETTERS.encode()))


def sequence_of(text, target: str):
    """The letters a to z of a text in either case, put into another alphabet; by bytes, as those of other characters are none of these."""
    table = bytes.maketrans(LETTERS.encode(), target.encode())

    def letters(texts: pa.Array) -> pa.Array:
        return pa.array([None if x is None else x.translate(table, _OTHERS) for x in texts.cast(pa.binary()).to_pylist()], pa.binary()).cast(pa.string())

    return F.arrow_udf(letters, "string")(F.lower(text))


def records_of(docs: DataFrame, target: str) -> DataFrame:
    """Sequence records of rows of documents, the letters of their texts put into another alphabet."""
    docs = docs.select("doc_id", "text", "lang", "source")
    og = F.concat(F.lit("OG_"), (F.col("doc_id") % FAMILIES).cast("string"))
    return docs.select(
        "doc_id", F.col("doc_id").alias("ord"), F.concat_ws("|", "lang", "source", F.col("doc_id").cast("string"), og).alias("id"),
        F.col("lang").alias("taxon"), og.alias("og"), sequence_of(F.col("text"), target).alias("seq"),
    )


def nt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nucleotide records: doc_id, ord, id (lang|source|doc_id|OG_n), taxon, og, seq."""
    return records_of(spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")), NT_TARGET)


def aa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peptide records with the same columns."""
    return records_of(spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")), AA_TARGET)


def families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short peptides in families: id, og (brand), taxon (type), seq."""
    part = table(spark, sf_dir, "part")
    name = F.concat_ws(" ", "p_name", "p_type", (F.col("p_size") * 7919).cast("string"))
    letters = F.translate(name, "0123456789", "abcdefghij")
    return part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("og"), F.col("p_type").alias("taxon"), sequence_of(letters, AA_TARGET).alias("seq"))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment hits of nucleotide records, from order lines: an order of their own (ord), queries by part key."""
    line = table(spark, sf_dir, "lineitem")
    start = (F.col("l_linenumber") * 5 + F.col("l_suppkey") % 7 + 1).cast("int")
    end = (start + F.col("l_quantity") * 3 + F.col("l_suppkey") % 3).cast("int")
    forward = F.col("l_suppkey") % 2 == 0
    return line.select(
        F.col("l_partkey").alias("q_doc"), F.concat(F.lit("ref|"), F.col("l_suppkey").cast("string"), F.lit("|OG_"), (F.col("l_suppkey") % FAMILIES).cast("string")).alias("sseqid"),
        F.col("l_quantity").cast("int").alias("length"), (100.0 - F.col("l_discount") * 100.0).alias("pident"),
        F.when(forward, start).otherwise(end).alias("qstart"), F.when(forward, end).otherwise(start).alias("qend"),
        F.when(forward, F.lit(1)).otherwise(-1).alias("qframe"), F.col("l_tax").alias("evalue"), F.col("l_extendedprice").alias("bitscore"),
        (F.col("l_orderkey") * 100000000 + F.col("l_linenumber") * 10000000 + F.col("l_partkey")).alias("ord"),
    )


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A node table: a root, regions, nations and customers as leaves (taxon: market segment); branch lengths from balances."""
    region, nation, customer = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    none = F.lit(None)
    root = spark.range(1).select(F.lit(0).cast("long").alias("node_id"), none.cast("long").alias("parent_id"), F.lit("root").alias("name"), F.lit(0.0).alias("dist"), F.lit(False).alias("is_leaf"), none.cast("string").alias("taxon"), none.cast("string").alias("supergroup"))
    regions = region.select((F.col("r_regionkey") + 1).cast("long").alias("node_id"), F.lit(0).cast("long").alias("parent_id"), F.col("r_name").alias("name"), F.lit(0.5).alias("dist"), F.lit(False).alias("is_leaf"), none.cast("string").alias("taxon"), none.cast("string").alias("supergroup"))
    nations = nation.select((F.col("n_nationkey") + 100).cast("long").alias("node_id"), (F.col("n_regionkey") + 1).cast("long").alias("parent_id"), F.col("n_name").alias("name"), F.lit(0.25).alias("dist"), F.lit(False).alias("is_leaf"), none.cast("string").alias("taxon"), none.cast("string").alias("supergroup"))
    leaves = customer.select((F.col("c_custkey") + 1000).alias("node_id"), (F.col("c_nationkey") + 100).cast("long").alias("parent_id"), F.concat_ws("|", "c_mktsegment", "c_name").alias("name"), (F.abs("c_acctbal") / 10000.0).alias("dist"), F.lit(True).alias("is_leaf"), F.col("c_mktsegment").alias("taxon"), F.substring("c_mktsegment", 1, 1).alias("supergroup"))
    return root.unionByName(regions).unionByName(nations).unionByName(leaves).withColumn("tree_id", F.lit("t"))


def detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By-catch rows: each order is a query's find in a customer's nation and region."""
    orders, customer, nation, region = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        F.col("o_custkey").alias("query_seq"), F.col("r_name").alias("domain"), F.col("n_name").alias("major_group"), F.col("c_mktsegment").alias("major_clade"),
        F.col("o_orderpriority").alias("cluster_taxon"), F.col("o_orderkey").alias("cluster_seq"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors in double precision: id, label, vec."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label", F.transform("embedding", lambda x: x.cast("double")).alias("vec"))


# The same tables in SQL, as common table expressions.
_SEQ = "translate(regexp_replace(lower({text}), '[^a-z]', '', 'g'), '" + LETTERS + "', '{target}')"
_REC = "SELECT doc_id, doc_id AS ord, lang || '|' || source || '|' || doc_id || '|OG_' || (doc_id % 40) AS id, lang AS taxon, 'OG_' || (doc_id % 40) AS og, {seq} AS seq FROM documents"
CTE = {
    "nt": _REC.format(seq=_SEQ.format(text="text", target=NT_TARGET)),
    "aa": _REC.format(seq=_SEQ.format(text="text", target=AA_TARGET)),
    "fam": "SELECT p_partkey AS id, p_brand AS og, p_type AS taxon, "
    + _SEQ.format(text="translate(p_name || ' ' || p_type || ' ' || (p_size * 7919), '0123456789', 'abcdefghij')", target=AA_TARGET)
    + " AS seq FROM part",
    "hits0": "SELECT *, CAST(l_linenumber * 5 + l_suppkey % 7 + 1 AS INT) AS st, CAST(l_linenumber * 5 + l_suppkey % 7 + 1 + l_quantity * 3 + l_suppkey % 3 AS INT) AS en FROM lineitem",
    "hits": "SELECT l_partkey AS q_doc, 'ref|' || l_suppkey || '|OG_' || (l_suppkey % 40) AS sseqid, CAST(l_quantity AS INT) AS length, 100.0::DOUBLE - l_discount * 100.0::DOUBLE AS pident, "
    "CASE WHEN l_suppkey % 2 = 0 THEN st ELSE en END AS qstart, CASE WHEN l_suppkey % 2 = 0 THEN en ELSE st END AS qend, CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE -1 END AS qframe, "
    "l_tax AS evalue, l_extendedprice AS bitscore, l_orderkey * 100000000 + l_linenumber * 10000000 + l_partkey AS ord FROM hits0",
    "nodes": "SELECT 0::BIGINT AS node_id, NULL::BIGINT AS parent_id, 'root' AS name, 0.0::DOUBLE AS dist, false AS is_leaf, NULL::VARCHAR AS taxon, NULL::VARCHAR AS supergroup "
    "UNION ALL SELECT r_regionkey + 1, 0, r_name, 0.5::DOUBLE, false, NULL, NULL FROM region UNION ALL SELECT n_nationkey + 100, n_regionkey + 1, n_name, 0.25::DOUBLE, false, NULL, NULL FROM nation "
    "UNION ALL SELECT c_custkey + 1000, c_nationkey + 100, c_mktsegment || '|' || c_name, abs(c_acctbal) / 10000.0::DOUBLE, true, c_mktsegment, substr(c_mktsegment, 1, 1) FROM customer",
    "up": "SELECT node_id, node_id AS anc_id, 0 AS depth, 0.0::DOUBLE AS d FROM nodes UNION ALL "
    "SELECT up.node_id, n.parent_id, up.depth + 1, up.d + n.dist FROM up JOIN nodes n ON n.node_id = up.anc_id WHERE n.parent_id IS NOT NULL",
    "detail": "SELECT o_custkey AS query_seq, r_name AS domain, n_name AS major_group, c_mktsegment AS major_clade, o_orderpriority AS cluster_taxon, o_orderkey AS cluster_seq "
    "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
}


def sql(names: str, query: str) -> str:
    """A query after the expressions it needs."""
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({CTE[n]})" for n in names.split()) + " " + query

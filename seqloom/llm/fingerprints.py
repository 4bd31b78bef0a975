"""Document fingerprints: every shingle hash below a fixed fraction of the hash range is kept.

A shingle is five words in a row (or all words of a shorter text). Because the threshold is fixed, sketches of any two
texts can be merged by union, and the share of the smaller one that is in the larger one estimates containment, however
unequal the texts are. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import staged

WORDS = 5
#: One hash in so many is kept.
SCALE = 4
NO_ID = -(1 << 63)


def with_sketch(df: DataFrame, text: str, out: str, scale: int = SCALE) -> DataFrame:
    """df and a sorted array of the hashes kept of a text column. The parts are columns of their own, so each is computed once."""
    below = -(1 << 63) + (1 << 64) // scale
    words, hashes = f"{out}_words", f"{out}_hashes"
    h = F.col(hashes)
    shingles = F.transform(F.sequence(F.lit(0), F.size(h) - WORDS), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WORDS))))
    all_of = F.when(F.size(h) >= WORDS, shingles).otherwise(F.array(F.xxhash64(h)))
    return (
        df.withColumn(words, F.filter(F.split(F.col(text), r"\s+"), lambda w: w != ""))
        .withColumn(hashes, F.transform(F.col(words), lambda w: F.xxhash64(w)))
        .withColumn(out, F.when(F.size(hashes) == 0, F.array().cast("array<bigint>")).otherwise(all_of))
        .withColumn(out, F.sort_array(F.array_distinct(F.filter(F.col(out), lambda x: x < below))))
        .drop(words, hashes)
    )


def containment(a: Column, b: Column) -> Column:
    """Share of the smaller sketch that both have; equal sketches have 1, also empty ones, and an empty one else 0."""
    least = F.least(F.size(a), F.size(b))
    return F.when(a == b, F.lit(1.0)).when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda x: F.lower(F.hex(x))), "")


def successors(docs: DataFrame) -> DataFrame:
    """key, tie, copies and the next_key, next_tie of each document, by descending key; the last one's next is the first.

    docs: key, tie, n_chars. The narrow keys are sorted by ranges and written; within a range the next row is found by a window,
    and the first row of each range, a row for each partition, closes the gaps between them.
    """
    order = [F.col("key").desc(), F.col("tie").asc()]
    counted = docs.groupBy("key", "tie").agg(F.count(F.lit(1)).alias("copies"), F.max("n_chars").alias("n_chars"))
    ranged = staged(counted.orderBy(*order).withColumn("part", F.spark_partition_id()), "fingerprint-keys")
    within = Window.partitionBy("part").orderBy(*order)
    linked = ranged.withColumn("next", F.lead(F.struct("key", "tie")).over(within))
    firsts = ranged.groupBy("part").agg(F.max_by(F.struct("key", "tie"), F.struct("key", -F.col("tie").cast("decimal(20,0)"))).alias("first"))
    ranges = Window.orderBy("part")  # over a row for each range
    every = ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gaps = firsts.select("part", F.coalesce(F.lead("first").over(ranges), F.first("first").over(every)).alias("gap"))
    after = F.coalesce("next", "gap")
    return linked.join(F.broadcast(gaps), "part").select("key", "tie", "n_chars", "copies", after["key"].alias("next_key"), after["tie"].alias("next_tie"))


def fingerprint(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """A sketch of every text of docs (doc_id, text) and of the text with its last third exchanged for the next document's start.

    The texts are dealt out once, by key: a document meets its link there to be the next one of another, and only its
    sketch and as many characters as the other needs travel on to meet the other's text, in the same partitioning.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    links = successors(rows.select("key", "tie", F.length("text").alias("n_chars")))
    if not links.where("copies > 1").isEmpty():
        rows = rows.dropDuplicates(["key", "tie"])
    rows = rows.repartition("key", "tie")  # both uses below read this one exchange
    following = rows.withColumnsRenamed({"key": "next_key", "tie": "next_tie", "text": "next_text"})
    nexts = with_sketch(links.join(following, ["next_key", "next_tie"]), "next_text", "next_sketch", scale).select(
        "key", "tie", "n_chars", "copies", "next_sketch", F.expr("substring(next_text, 1, cast(floor(n_chars / 3) as int))").alias("head")
    )
    both = rows.join(nexts, ["key", "tie"]).withColumn(
        "edited", F.expr("concat(substring(text, 1, n_chars - cast(floor(n_chars / 3) as int)), head)")
    )
    both = with_sketch(with_sketch(both, "text", "sketch", scale), "edited", "edited_sketch", scale)
    return both.withColumn("copy", F.explode(F.expr("sequence(1, cast(copies as int))"))).select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op4_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts.

    A null text counts as empty, and the sketch of a text without words is empty, as may be that of a text of few words;
    likeness is told by the sketches alone: 1 for equal ones, two empty ones too, and else 0 with an empty one. Very long
    texts are sketched whole, as one row. Documents of one doc_id follow each other by the hash of their texts;
    rows repeated in full have one next document together and each give a row; rows without a doc_id come last. In a
    table of one document it is its own next. An empty table gives none. Other columns are never read.
    """
    return fingerprint(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

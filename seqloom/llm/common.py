"""What the corpus operators share: staged tables, blocks of rows, bounded samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.staging import scratch, staged  # noqa: F401


def per_row(fn: Callable, schema: pa.Schema) -> Callable:
    """A mapInArrow function which calls fn(*columns of a row) -> tuple, row after row.

    Rows are taken from the batch one at a time, so no more than one text is a Python object at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in schema]
            for row in zip(*batch.columns, strict=True):
                for col, value in zip(cols, fn(*(x.as_py() for x in row)), strict=True):
                    col.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return run


def blocks(batches: Iterator[pa.RecordBatch], chars: int = 400_000) -> Iterator[tuple[list, list]]:
    """(ids, texts) of rows in turn, as many as have about so many characters; a longer text is a block of its own."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(*batch.columns, strict=True):
            ids.append(key.as_py())
            texts.append(text.as_py())
            size += len(texts[-1] or "") + 50
            if size >= chars:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


#: bounded_sample counts hashes in 2^CELL_BITS ranges; with n rows of a value, n / 2^CELL_BITS more than wanted are ranked.
CELL_BITS = 16


def id_bucket(col: str, n: int) -> Column:
    """crc32 of an id written as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % n


#: Code points of a sample's texts for each value at most, and of a single one of them.
SAMPLE_CHARS, TEXT_CHARS = 48_000_000, 3_000_000


def bounded_sample(rows: DataFrame, texts: DataFrame, key: str, by: str, per_class: int, of_value: bool = False) -> list[tuple]:
    """(by, key, text) of per_class rows for each value of by at most: those whose hashed key is least, so the same at any partitioning.

    Rows without a key or a value don't count, repeated ones count once. Hashes are first counted in 2^CELL_BITS ranges for each
    value of by, which tells the range that holds the last one wanted; only rows up to it are ranked, so no task gets
    all rows of a value. A key that comes with several texts gives one of them, that of least hash; of_value: only texts
    that come with the key and the value count, so texts has both columns. The texts of the chosen keys alone reach the
    driver, while their lengths add up to SAMPLE_CHARS for each value; one longer than TEXT_CHARS isn't learnt from.
    """
    from pyspark.sql import Window

    keyed = rows.select(F.col(key).alias("k"), F.col(by).alias("y")).where("k is not null and y is not null").distinct().withColumn("h", F.xxhash64("k"))
    cell = F.shiftright("h", 64 - CELL_BITS)
    # A row for each value of by and range: 2^CELL_BITS of them for a value at most, whatever the rows are.
    upto = Window.partitionBy("y").orderBy("cell")
    counted = keyed.groupBy("y", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.sum("n").over(upto) - F.col("n"))
    last = {r["y"]: r["last"] for r in counted.where(F.col("before") < per_class).groupBy("y").agg(F.max("cell").alias("last")).collect()}
    if not last:
        return []
    near = F.lit(False)
    for y, at in last.items():
        near = near | ((F.col("y") == F.lit(y)) & (cell <= at))
    order = Window.partitionBy("y").orderBy("h", "k")
    chosen = keyed.where(near).withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_class).select("k", "y").collect()
    spark = rows.sparkSession
    small = spark.createDataFrame([tuple(x) for x in chosen], schema=keyed.select("k", "y").schema)
    own = texts.where(F.length("text") <= TEXT_CHARS).select(F.col(key).alias("k"), "text", *([F.col(by).alias("y")] if of_value else []))
    found = own.join(F.broadcast(small), ["k", "y"] if of_value else "k")
    one = found.groupBy("y", "k").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    # per_class rows of a value at most come this far.
    size = F.sum(F.length("text")).over(Window.partitionBy("y").orderBy(F.xxhash64("k"), "k"))
    return sorted((r["y"], r["k"], r["text"]) for r in one.withColumn("size", size).where(F.col("size") <= SAMPLE_CHARS).select("y", "k", "text").collect())

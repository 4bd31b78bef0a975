"""Continuous ingest: new FASTA files of a folder are appended to a table of gene-family records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import names
from ..sources.text_formats import fasta_fields, records_at


def new_records(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """source_file, id, taxon, og, seq of the records of files as they arrive; append-only, without state."""
    rows = fasta_fields(records_at(spark.readStream.option("maxFilesPerTrigger", files_per_batch), ">", folder))
    return rows.select("source_file", "id", names.taxon_of(F.col("id")).alias("taxon"), names.og_of(F.col("id")).alias("og"), "seq")


def append_to(records: DataFrame, table_path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Appends the records to Parquet files; each file is taken once, also after a restart from the checkpoint."""
    writer = records.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", table_path).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()

"""Tables written to the folder that driver and executors share, to cut a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below spark.checkpoint.dir, which driver and executors share.

    Only where that setting is empty and the master is this machine (tests) is a temporary folder taken and kept in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.seqloom.scratch", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="seqloom-")
        spark.conf.set("spark.seqloom.scratch", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share; where that is unset, a session in one
    process gets a local one and a cluster an error."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        there = f"file://{tempfile.mkdtemp(prefix='tendril-')}"
    return f"{there.rstrip('/')}/engine-{uuid.uuid4().hex}/{what}"


def written(df: DataFrame, what: str) -> DataFrame:
    """df as a Parquet table in the shared folder, which ends its lineage."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

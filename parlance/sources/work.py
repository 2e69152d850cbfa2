"""Work tables: what several results need is written once to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to spark.checkpoint.dir and read again. Where that is unset a single machine takes a temporary folder; a cluster has none, which is an error.

    Plans that build on it start from a scan, and a lost executor costs no more than the step after it.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"file://{tempfile.gettempdir()}/parlance-work"
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Incremental refresh: transcripts that change are processed again, and replace what was kept of them.

The file source brings new or replaced files; every micro-batch is processed as a whole and written
over the partitions of its own transcripts, so repeating a batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from parlance.plans.process import process

SCHEMA = "transcript_id string, tu_id int, speaker string, start double, end double, text string"


def refreshed(batch: DataFrame, path: str, config: dict | None = None) -> None:
    """Process a batch of utterances and overwrite the partitions of its transcripts, and of no others."""
    got = process(batch, config)
    for name in ("vert", "summary"):
        got[name].write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("transcript_id").parquet(f"{path}/{name}")


def refresh_stream(spark: SparkSession, source: str, path: str, checkpoint: str, config: dict | None = None) -> StreamingQuery:
    """Follow a folder of Parquet files of utterances; whole transcripts arrive in one file each."""
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    return stream.writeStream.foreachBatch(lambda batch, _: refreshed(batch, path, config)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Records that arrive as a stream, linked with static sources.

The other sources are static, so every arrival is decided on its own: a
stream-static join without state.  ``dropDuplicatesWithinWatermark`` needs a
time column and is left to the caller.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from linkloom.operators import blocking
from linkloom.sources.tables import RECORD


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet files of records as they come."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in RECORD])
    return spark.readStream.schema(schema).parquet(folder)


def exact_name_pairs(stream: DataFrame, s23: DataFrame) -> DataFrame:
    """Streamed pairs of equal country and normalised name."""
    left = blocking.normalised(stream).filter("name <> ''").select(
        F.col("entity_id").alias("source1_entity_id"), "country", "name")
    right = blocking.normalised(s23).select(F.col("entity_id").alias("candidate_entity_id"), "country", "name")
    return left.join(right, ["country", "name"]).select("source1_entity_id", "candidate_entity_id")


def link_batches(
    stream: DataFrame, decide: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Runs any batch matcher on each micro-batch; a batch that is run again
    overwrites its own folder."""

    def sink(batch: DataFrame, number: int) -> None:
        decide(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

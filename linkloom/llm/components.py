"""Connected components of an edge list, as rounds of joins.

Large-star and small-star rounds (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014): every round links a node's neighbours to the
smallest of them, until nothing changes.  Each round's edges are a table in the
shared folder, so lineage stays short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import common


def rejoined(rows: DataFrame, grouped: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """``rows`` with what was computed per ``key``.

    Joined on the key and a hash of it: the grouped side is then dealt anew
    instead of both sides keeping the grouping's partitions, and AQE can split
    the rows of a hot key.
    """
    keys = [key] if isinstance(key, str) else key
    again = F.xxhash64(*keys)
    return rows.withColumn("dealt", again).join(grouped.withColumn("dealt", again), [*keys, "dealt"], how).drop("dealt")


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Links each node's neighbours (``larger_only``: those above it) to the
    smallest of the node and its neighbours."""
    if larger_only:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = rejoined(near, least, "u")
    if larger_only:
        return linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    own = least.select("u", F.col("m").alias("v"))
    return linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(own).distinct()


def connected(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u``, ``v`` long), where
    ``root`` is the smallest node reachable."""
    spark, schema = edges.sparkSession, "u long, v long"

    def table(rows: DataFrame) -> str:
        path = common.new_path(spark, label)
        rows.write.parquet(path)
        return path

    larger_first = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    path, mark = table(larger_first.distinct()), None
    while True:
        now = spark.read.schema(schema).parquet(path)
        path, before = table(_star(_star(now, True), False)), path
        common.drop_written(spark, before)
        now = spark.read.schema(schema).parquet(path)
        row = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if row == mark:
            break
        mark = row
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).filter("node <> root")

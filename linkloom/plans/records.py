"""Business records from the ``documents`` table.

Every document is a record: source ``1 + doc_id % 3``, id ``S<source>-<doc_id>``,
the first four words of the text as name, all others as address, the language as
country.  Words are what stands between runs of blanks, tabs and line ends, so
that a field is one line.  Names and addresses are raw, so that normalisation
has work to do.  The truth is a rule of its own: documents of S1 and S2 or S3
whose whole normalised texts are equal.

Parts are records too, with short fields: the name as name, size and type as
address, the brand as country.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions import text
from linkloom.sources.tables import stored


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records with ``source``."""
    parts = F.split(text.text_of(F.col("text")), "[ \\t\\n\\r]+")
    source = 1 + F.col("doc_id") % 3
    return documents(spark, sf_dir).select(
        source.alias("source"),
        F.concat(F.lit("S"), source, F.lit("-"), F.col("doc_id")).alias("entity_id"),
        F.array_join(F.slice(parts, 1, 4), " ").alias("business_name"),
        F.array_join(F.slice(parts, F.lit(5), F.greatest(F.size(parts) - 4, F.lit(0))), " ").alias("business_address"),
        F.col("lang").alias("country"),
    )


def part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of parts with ``source``."""
    source = 1 + F.col("p_partkey") % 3
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(
        source.alias("source"),
        F.concat(F.lit("S"), source, F.lit("-"), F.col("p_partkey")).alias("entity_id"),
        F.col("p_name").alias("business_name"),
        F.concat_ws(" ", F.col("p_size").cast("string"), F.col("p_type"), F.lit("St.")).alias("business_address"),
        F.col("p_brand").alias("country"),
    )


def sides(spark: SparkSession, sf_dir: str, of=records) -> tuple[DataFrame, DataFrame]:
    """S1, and S2 with S3."""
    rows = of(spark, sf_dir)
    return rows.filter("source = 1").drop("source"), rows.filter("source > 1").drop("source")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source1_entity_id, candidate_entity_id`` of equal normalised texts."""
    rows = documents(spark, sf_dir).select(
        (1 + F.col("doc_id") % 3).alias("source"),
        F.concat(F.lit("S"), 1 + F.col("doc_id") % 3, F.lit("-"), F.col("doc_id")).alias("entity_id"),
        F.md5(text.normalise(F.col("text")).cast("binary")).alias("same"),
    )
    rows = stored(rows, "truth")  # both sides, and all who ask for the truth, read texts once
    left = rows.filter("source = 1").select(F.col("entity_id").alias("source1_entity_id"), "same")
    right = rows.filter("source > 1").select(F.col("entity_id").alias("candidate_entity_id"), "same")
    return left.join(right, "same").drop("same")


def truth_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source1_entity_id, matched_entity_ids``: a sorted comma list per S1 id."""
    s1, _ = sides(spark, sf_dir)
    lists = truth(spark, sf_dir).groupBy("source1_entity_id").agg(
        F.array_join(F.array_sort(F.collect_list("candidate_entity_id")), ",").alias("matched_entity_ids"))
    ids = s1.select(F.col("entity_id").alias("source1_entity_id"))
    return ids.join(lists, "source1_entity_id", "left").fillna("", ["matched_entity_ids"])

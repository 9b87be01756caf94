"""A training corpus from ``documents``: judge quality, drop exact and near
duplicates, mix the sources, encode.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)``, works on all
that the stage before kept, and is written as Parquet and read again.  All
stages take null in any column, empty texts, texts of any length and repeated
rows, and give an empty table for an empty one; columns beyond those of
``documents`` are carried along, whatever their names, up to the last stage.
The tables that a stage writes on its way are removed once its result is
written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import bpe_codec, common, exact_dedup, mixing, quality, queries, simhash


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for label 1.

    Null and empty texts have the score of the labelled rows' mean; rows that
    repeat stay or go together.
    """
    model = queries.quality_model(spark, docs, sf_dir)
    own = docs.select(
        *(common.quoted(c).alias(f"c{i}") for i, c in enumerate(docs.columns)), common.quoted("text").alias("own_text"))
    scored = quality.score(own, model, "own_text", score_col="score", predicted_col="predicted")
    return scored.filter("predicted = 1").select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id; null counts as empty, a
    null id as the smallest.  Of rows that repeat id and text one stays."""
    return exact_dedup.first_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints the document with the smallest id, one without an
    id only if none has one.  Null and empty texts have one fingerprint; of rows
    that repeat an id with other texts one stays."""
    return simhash.first_of_groups(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out in the order of the mix: its files have it by
    their numbers, and each by its rows.  Null and unnamed sources share a pool;
    null ids and rows that repeat each have a place."""
    own = docs.select(
        *(common.quoted(c).alias(f"c{i}") for i, c in enumerate(docs.columns)),
        common.quoted("doc_id").alias("own_id"), common.quoted("source").alias("own_source"))
    mixed = mixing.mix(own, queries.MIX_WEIGHTS, queries.MIX_REST, queries.MIX_BLOCK, "own_id", "own_source")
    return mixing.in_order(mixed).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The codes of every document, with digests of them and of what they decode
    to, and its place in the mix: ``mix_file, mix_row``, as the stage before laid
    the files out (null if ``docs`` is no table of files).  Null and empty texts
    have no codes; rows that repeat each have their own."""
    placed = docs.select("doc_id", "source", "text", *mixing.place_in_files(docs))
    return bpe_codec.bpe_encode(placed, queries.VOCABULARY, keep=["doc_id", "source", "mix_file", "mix_row"])


STAGES = [
    ("quality classifier", judge_quality),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("BPE encoding", encode),
]

#: SQL has no neighbour votes, fingerprints or merges; tests compare the rows with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        with common.scratch(spark) as folder:
            docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = common.new_path(spark, f"stage{k}")
            docs.write.parquet(path)
            common.drop_written(spark, folder)
            if before is not None:
                common.drop_written(spark, before)
            docs, before = spark.read.schema(docs.schema).parquet(path), path
    return docs

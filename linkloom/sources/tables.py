"""Readers and writers: tab-separated records, truth, lists, SQLite, JSON."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions import text

RECORD = ("entity_id", "business_name", "business_address", "country")
TRUTH = ("source1_entity_id", "matched_entity_ids")


def read_tsv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] = RECORD,
    na_mode: str = "text",
    bad_lines: str = "error",
) -> DataFrame:
    """Strings only.  ``na_mode='pandas'`` makes the usual texts for missing
    values null, ``'text'`` leaves them and makes nothing null.  Lines with more
    fields than columns are ``bad_lines``: an ``error``, or left out (``skip``,
    ``warn``), but for one more that is empty; fields that a line lacks are
    missing values."""
    if bad_lines not in ("error", "skip", "warn"):
        raise ValueError(bad_lines)
    more = "__more"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, more)])
    rows = spark.read.csv(
        path if isinstance(path, str) else list(path), schema=schema, sep="\t", header=True, encoding="UTF-8",
        mode="PERMISSIVE", quote='"', escape='"', multiLine=False, enforceSchema=True, nullValue="\u0000", emptyValue="",
    )
    if bad_lines == "error":
        first = F.when(F.col(more).isNull(), F.col(columns[0])).otherwise(F.raise_error(F.lit("a line has too many fields")))
        rows = rows.withColumn(columns[0], first).drop(more)
    else:
        rows = rows.filter(F.col(more).isNull()).drop(more)
    if na_mode == "pandas":
        return rows.select(*(text.missing_texts_to_null(F.col(c)).alias(c) for c in columns))
    return rows.fillna("")


def write_tsv(rows: DataFrame, path: str) -> None:
    """A folder of tab-separated parts with a header each, as :func:`read_tsv`
    reads them; null is empty."""
    rows.write.mode("overwrite").csv(
        path, sep="\t", header=True, quote='"', escape='"', emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_training(spark: SparkSession, folder: str, **options) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """S1, S2, S3 and the truth of ``folder``."""
    s1, s2, s3 = (read_tsv(spark, f"{folder}/train_source{k}.tsv", **options) for k in (1, 2, 3))
    return s1, s2, s3, read_truth(spark, f"{folder}/train_ground_truth.tsv")


def read_test(spark: SparkSession, folder: str, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    s1, s2, s3 = (read_tsv(spark, f"{folder}/test_source{k}.tsv", **options) for k in (1, 2, 3))
    return s1, s2, s3


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, TRUTH)


def first_rows(rows: DataFrame, n: int, order: Sequence[str] = ("entity_id",)) -> DataFrame:
    """The first ``n`` by a key, as the order of a file is no guarantee."""
    return rows.orderBy(*order).limit(n)


def first_per_id(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first row of each ``entity_id`` in the given order."""
    rank = F.row_number().over(W.partitionBy("entity_id").orderBy(*order))
    return rows.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def save_exact_index(forms: DataFrame, path: str) -> None:
    """The exact matcher's forms, sorted by their lookup keys within files: what
    an indexed database table is to point lookups."""
    ordered = forms.repartitionByRange("country", "name", "address").sortWithinPartitions("country", "name", "address")
    ordered.write.mode("overwrite").parquet(path)


def read_exact_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_lists(lists: DataFrame, path: str, line_sep: str = "\n") -> None:
    """A folder of tab-separated parts with a header each; ``\\r\\n`` as line end
    gives what spreadsheet-style writers do."""
    if line_sep == "\n":
        lists.write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="", quote="\u0000")
        return
    # Spark's text writer ends lines with one character: the rest is part of the
    # value.  The header goes before the first row of each partition; a table
    # without rows has no part to bear one.
    end = line_sep[:-1]
    line = F.concat(F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in lists.columns)), F.lit(end))
    is_first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.lit("\t".join(lists.columns) + line_sep)
    lists.select(F.when(is_first, F.concat(header, line)).otherwise(line).alias("value")).write.mode("overwrite").option(
        "lineSep", line_sep[-1]).text(path)


def write_report(report: dict, path: str, spark: SparkSession | None = None) -> None:
    """JSON, indented by two, other scripts kept; with ``spark`` on any store
    that it can write to, else on this machine."""
    whole = json.dumps(report, indent=2, ensure_ascii=False)
    if spark is None:
        with open(path, "w", encoding="utf-8") as f:
            f.write(whole)
        return
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(whole, "utf-8"))
    finally:
        out.close()


def from_chunks(spark: SparkSession, chunks: Sequence[pd.DataFrame], columns: Sequence[str] = RECORD) -> DataFrame:
    """Chunks of records in memory as one frame of strings."""
    whole = pd.concat([c[list(columns)] for c in chunks]) if chunks else pd.DataFrame(columns=list(columns))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.createDataFrame(whole.astype("string").where(whole.notna(), None).values.tolist(), schema)


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share
    (``spark.checkpoint.dir``); where the session names none, a local master has
    a folder of its own, and any other is an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = f"file://{tempfile.gettempdir()}/linkloom-{os.getuid()}"
    return f"{shared.rstrip('/')}/linkloom-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder; :func:`drop_stored`
    removes all that an application has stored."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_path(spark, "x").rsplit("/", 1)[0])
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

"""Operator 7: exact duplicates, with DataFrame operations only.

Texts are equal when they are identical after lower-casing A-Z; a null text
counts as empty.  The 128-bit hashes of those texts are counted first.  Only
texts whose hash occurs twice or more are then shuffled and grouped by hash
*and* text: the grouping compares bytes, so a hash collision never joins two
texts.  Counts combine before the shuffle, so a group of any size costs one row
per task.  Rows meet their group again by hash and digest.

The hashes that repeat and the groups are tables in the shared folder.  Spark
knows the size of the first from its files when it plans the join: if small it
is broadcast, else the texts are shuffled.  Rows and groups are always shuffled
by hash and digest, at any size alike, and AQE splits a hot hash.

The largest id of a group stays (``smallest=True``: the smallest).  Null ids
lose against others; rows that repeat both id and text are one document and
share its verdict (:func:`first_copies` leaves one of them).  Texts of any
length are compared whole.  An empty table gives an empty result; input columns
named as an output column give way to it, and no other name is in the way of the
private ones, which go by position.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MADE = ("keep_id", "group_size", "kept", "text_sha256")


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def groups_of(
    texts: DataFrame, hashes: DataFrame, smallest: bool = False
) -> DataFrame:
    """One row per text that occurs at least twice: ``hash``, ``sha``, ``best``
    id and ``size``.  ``texts`` has ``id, norm, hash`` of every row, ``hashes``
    the hashes of all rows."""
    repeated = common.written(
        hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"), "hashes")
    best = F.min if smallest else F.max
    return (
        texts.join(repeated, "hash", "left_semi")
        .groupBy("hash", "norm")
        .agg(F.count(F.lit(1)).alias("size"), best("id").alias("best"))
        .filter("size > 1")
        .select("hash", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"), "best", "size")
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    smallest: bool = False,
    hash_fn: Callable[[Column], Column] = hash128,
) -> DataFrame:
    """``keep`` (default: all columns) with ``keep_id``, ``group_size``,
    ``kept`` and ``text_sha256``; no row is dropped."""
    kept = common.without(docs.columns if keep is None else keep, MADE)
    texts = docs.select(
        *(common.quoted(c).alias(f"k{i}") for i, c in enumerate(kept)),
        common.quoted(id_col).alias("id"), normalised(common.quoted(text_col)).alias("norm"),
    ).withColumn("hash", hash_fn(F.col("norm")))
    own = [f"k{i}" for i in range(len(kept))]
    rows = texts.select(*own, "id", "hash", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"))
    if text_col.lower() not in (c.lower() for c in kept):
        rows = common.written(rows, "hashes")  # narrow rows: hash the texts once
    groups = common.written(groups_of(texts.select("id", "norm", "hash"), rows.select("hash"), smallest), "groups")
    return (
        rows.join(groups.hint("merge"), ["hash", "sha"], "left")
        .withColumn("keep_id", F.coalesce("best", "id"))
        .select(
            *(F.col(o).alias(c) for o, c in zip(own, kept, strict=True)),
            "keep_id",
            F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
            F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )


def first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per text: the rows that :func:`exact_dedup` keeps, and
    of those that repeat both id and text one."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    texts = docs.select(
        *(common.quoted(c).alias(o) for o, c in zip(own, docs.columns, strict=True)),
        common.quoted(id_col).alias("id"), normalised(common.quoted(text_col)).alias("norm"),
    ).withColumn("hash", hash128(F.col("norm")))
    rows = texts.select(*own, "id", "hash", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"))
    key = ["hash", "sha"]
    slim = common.written(rows.select("id", *key), "hashes")
    groups = common.written(groups_of(texts.select("id", "norm", "hash"), slim.select("hash")), "groups")
    stays = F.col("size").isNull() | F.col("id").eqNullSafe(F.col("best"))
    again = common.written(
        slim.join(groups.hint("merge"), key).filter(stays).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select(*key, F.lit(True).alias("again")), "again")
    if again.isEmpty():
        kept = rows.join(groups.hint("merge"), key, "left").filter(stays)
    else:
        marked = common.written(groups.join(again, key, "left"), "groups")
        found = rows.join(marked.hint("merge"), key, "left").filter(stays)
        kept = found.filter("again is null").unionByName(found.filter("again").dropDuplicates(key))
    return kept.select(*(F.col(o).alias(c) for o, c in zip(own, docs.columns, strict=True)))

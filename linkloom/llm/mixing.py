"""Operator 2: mixing sources to target weights, with DataFrame operations only.

Documents of a source form blocks of ``block_docs``.  With integer weights a_i
and n_i blocks, a fluid schedule serves every unfinished source in proportion
to its weight; at virtual time v it has served T(v) = sum_j min(a_j v, n_j)
blocks in all.  Block k of source i is served in full between virtual times
k / a_i and (k + 1) / a_i, which gives it a release time floor(T(k / a_i)) and
a deadline ceil(T((k + 1) / a_i)).  Earliest deadline first, one block a slot,
meets all of these windows (Pfair scheduling), so a source's blocks are always
less than one block from the fluid schedule, also after others have run out.

At whole virtual times every source has been served a whole number of blocks,
so the windows of round r = floor(k / a_i) lie between T(r) and T(r + 1), and
the rounds are scheduled apart from each other.  A round has at most sum(a_i)
blocks, a bound set by the weights and not by the data.

Within a source, documents are dealt into buckets by a hash of their id, which
shuffles them; a bucket's start comes from counts, so the numbering needs no
pass over one source in one task, and the number of buckets grows with the
documents, so that a bucket stays small.  The windows are a table in the shared
folder: where it is small, Spark knows that from its files and broadcasts it.
Rows are never dropped or repeated.  Sources that the weights do not name, and
null, share one pool of weight ``rest``.  Null ids and ties are numbered in the
order of the remaining sort keys; rows that repeat everything are
interchangeable; texts of any length are carried whole.  An empty table gives an
empty result; input columns named as an output column give way to it, and no
other name is in the way of the private ones, which go by position.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkloom.llm import common

POOL = "(other)"
#: Rows of a source that a bucket has at the most, about.
BUCKET_ROWS = 1 << 16


def _fluid(k: Column, a: Column, sources: Column) -> Column:
    """a * T(k / a), in whole numbers."""
    return F.aggregate(
        sources, F.lit(0).cast("long"), lambda acc, s: acc + F.least(s["a"] * k, s["n"] * a)
    )


_JOB = "struct<deadline:bigint,pool:string,k:bigint,release:bigint,slot:bigint>"


def _earliest_deadline_first(jobs: Column) -> Column:
    """The jobs of one round with their slots.  ``jobs`` is sorted by deadline
    and pool; each slot takes the first that is released."""

    def step(acc: Column, slot: Column) -> Column:
        left = acc["left"]
        at = F.array_position(F.transform(left, lambda j: j["release"] <= slot), True).cast("int")
        job = F.get(left, at - 1)
        return F.struct(
            F.concat(F.slice(left, F.lit(1), at - 1), F.slice(left, at + 1, F.size(left))).alias("left"),
            F.concat(acc["done"], F.array(job.withField("slot", slot))).alias("done"),
        )

    start = F.array_min(F.transform(jobs, lambda j: j["release"]))
    return F.aggregate(
        F.sequence(start, start + F.size(jobs) - 1),
        F.struct(jobs.alias("left"), F.array().cast(f"array<{_JOB}>").alias("done")),
        step,
        lambda acc: acc["done"],
    )


def schedule(pools: DataFrame) -> DataFrame:
    """``pool, k, release, deadline, slot`` of every block, from one row per
    pool: ``pool, a, n`` (name, integer weight, number of blocks)."""
    spark = pools.sparkSession
    known = sorted((r["pool"], r["a"], r["n"]) for r in pools.filter("n > 0").collect())  # the weights name every pool
    schema = "pool string, k long, release long, deadline long, slot long"
    if not known:
        return spark.createDataFrame([], schema)
    sources = F.array(*(F.struct(F.lit(a).cast("long").alias("a"), F.lit(n).cast("long").alias("n")) for _, a, n in known))
    # The blocks of all pools in a row of numbers, so that tasks share them evenly.
    each, start = F.lit(None), 0
    for pool, a, n in known:
        own = F.struct(F.lit(pool).alias("pool"), F.lit(a).cast("long").alias("a"), (F.col("id") - start).alias("k"))
        each = F.when((F.col("id") >= start) & (F.col("id") < start + n), own).otherwise(each)
        start += n
    blocks = (
        spark.range(start)
        .select(each.alias("b"))
        .select("b.*")
        .withColumn("from", _fluid(F.col("k"), F.col("a"), sources))
        .withColumn("to", _fluid(F.col("k") + 1, F.col("a"), sources))
        .selectExpr("pool", "k", "k div a AS round", "`from` div a AS release", "(`to` + a - 1) div a AS deadline")
    )
    jobs = F.sort_array(F.collect_list(F.struct("deadline", "pool", "k", "release", F.lit(0).cast("long").alias("slot"))))
    return (
        blocks.groupBy("round")
        .agg(jobs.alias("jobs"))
        .select(F.inline(_earliest_deadline_first(F.col("jobs"))))
        .select("pool", "k", "release", "deadline", "slot")
    )


def mix(
    docs: DataFrame,
    weights: Mapping[str, int],
    rest: int = 1,
    block_docs: int = 32,
    id_col: str = "doc_id",
    source_col: str = "source",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``keep`` (default: all columns) with ``pool``, ``block`` (of the pool),
    ``release``, ``deadline``, ``slot`` and ``position``, which orders the mix:
    slot * block_docs + the place in the block."""
    if rest < 1 or any(w < 1 for w in weights.values()):
        raise ValueError("weights are whole numbers of at least 1")
    spark = docs.sparkSession
    made = ["pool", "block", "release", "deadline", "slot", "position"]
    kept = common.without(docs.columns if keep is None else keep, made)
    named = F.coalesce(common.quoted(source_col).cast("string"), F.lit(POOL))
    pool = F.when(named.isin(*weights), named).otherwise(F.lit(POOL)) if weights else F.lit(POOL)
    hashed = F.md5(F.coalesce(common.quoted(id_col).cast("string"), F.lit("")).cast("binary"))

    of = {**weights, POOL: rest}
    sizes = {r["pool"]: r["n"] for r in docs.select(pool.alias("pool")).groupBy("pool").agg(F.count(F.lit(1)).alias("n")).collect()}
    pools = [(p, of[p], -(-n // block_docs)) for p, n in sizes.items()]  # one row per weight at the most
    windows = common.written(schedule(spark.createDataFrame(pools, "pool string, a long, n long")), "windows")
    digits = 1
    while max(sizes.values(), default=0) > BUCKET_ROWS * 16**digits:
        digits += 1

    bucket = F.substring(hashed, 1, digits)
    counts = docs.select(pool.alias("pool"), bucket.alias("bucket")).groupBy("pool", "bucket").agg(F.count(F.lit(1)).alias("size"))
    up_to = W.partitionBy("pool").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    starts = common.written(
        counts.withColumn("first", F.sum("size").over(up_to) - F.col("size")).select("pool", "bucket", "first"), "starts")
    own = [f"k{i}" for i in range(len(kept))]
    rows = docs.select(
        *(common.quoted(c).alias(o) for o, c in zip(own, kept, strict=True)),
        pool.alias("pool"),
        bucket.alias("bucket"),
        hashed.alias("hash"),
        common.quoted(id_col).alias("id"),
        F.xxhash64(*map(common.quoted, kept)).alias("tie"),
    )
    inside = W.partitionBy("pool", "bucket").orderBy("hash", "id", "tie")
    rank = F.col("first") + F.col("place") - 1
    return (
        rows.withColumn("place", F.row_number().over(inside))
        .join(starts, ["pool", "bucket"])
        .select(*own, "pool", F.expr(f"(first + place - 1) div {block_docs}").alias("k"), (rank % block_docs).alias("inner"))
        .join(windows, ["pool", "k"])
        .select(
            *(F.col(o).alias(c) for o, c in zip(own, kept, strict=True)),
            "pool",
            F.col("k").alias("block"),
            "release",
            "deadline",
            "slot",
            (F.col("slot") * block_docs + F.col("inner")).alias("position"),
        )
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """The rows laid out in the order of the mix, partition by partition: files
    written from them have that order, and :func:`place_in_files` reads it."""
    return mixed.repartitionByRange("position").sortWithinPartitions("position")


def place_in_files(docs: DataFrame) -> list[Column]:
    """``mix_file`` and ``mix_row``: the number of the part file and of the row
    in it, as columns of a table that was read from files; null for others."""
    try:
        docs.select("_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        return [F.lit(None).cast("long").alias("mix_file"), F.lit(None).cast("long").alias("mix_row")]
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1)
    return [part.try_cast("bigint").alias("mix_file"), F.col("_metadata.row_index").alias("mix_row")]

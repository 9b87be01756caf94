"""Helpers that several operators share: Arrow maps over whole texts, split
rules, and tables written to the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a batch, and bytes of their texts, that are Python strings at a time.
ROWS, BYTES = 1024, 1 << 20


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def without(columns: Sequence[str], names: Sequence[str]) -> list[str]:
    """``columns`` less those that equal one of ``names`` but for case."""
    gone = {n.lower() for n in names}
    return [c for c in columns if c.lower() not in gone]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket_of(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(buckets)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of bounded size, by the lengths of a text column; a
    longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    lo = held = 0
    for k, size in enumerate(sizes.tolist()):
        if k > lo and (held + size > BYTES or k - lo >= ROWS):
            yield batch.slice(lo, k - lo)
            lo, held = k, 0
        held += size
    if batch.num_rows > lo:
        yield batch.slice(lo)


def windows(raw: bytes, gap: re.Pattern[bytes], size: int = BYTES) -> Iterator[bytes]:
    """``raw`` in turns of about ``size`` bytes that end after the first byte of
    a match of ``gap``; longer only where nothing matches."""
    at = 0
    while len(raw) - at > size:
        found = gap.search(raw, at + size)
        if found is None:
            break
        yield raw[at : found.start() + 1]
        at = found.start() + 1
    yield raw[at:] if at else raw


def append_from_text(
    docs: DataFrame,
    text_col: str,
    make: Callable[[], Callable[[list], list[pa.Array]]],
    fields: Sequence[T.StructField],
    keep: Sequence[str] | None = None,
    as_bytes: bool = False,
) -> DataFrame:
    """``keep`` (default: all columns) plus ``fields``, which are computed from
    whole texts (``as_bytes``: their UTF-8).

    ``make()`` runs once per task and returns a function from a list of texts
    to one Arrow array per field.  An input column that has the name of a new
    field gives way to it.
    """
    kept = without(docs.columns if keep is None else keep, [f.name for f in fields])
    source = docs.select(*map(quoted, kept), quoted(text_col).cast("string").alias("__text"))
    schema = T.StructType([source.schema[c] for c in kept] + list(fields))
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in slices(batch, len(kept)):
                texts = part.column(len(kept))
                made = fn((texts.cast(pa.binary()) if as_bytes else texts).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=names)

    return source.mapInArrow(run, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, a local master gets a folder of its own on
    this machine; any other master is an error, as executors would each write
    to a disk of their own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.gettempdir()}/linkloom-{os.getuid()}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: lost
    executors cost no more than the tasks that were running.

    The tables of an application lie in one folder, which :func:`drop_written`
    removes when its results are no longer needed.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Folders of :func:`scratch` that are open.
_SCRATCH: list[str] = []


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/linkloom-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{_SCRATCH[-1] if _SCRATCH else _own_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """The folder of all tables that are written inside, for
    :func:`drop_written` once what was made of them has been written."""
    _SCRATCH.append(new_path(spark, "scratch"))
    try:
        yield _SCRATCH[-1]
    finally:
        _SCRATCH.pop()


def drop_written(spark: SparkSession, path: str | None = None) -> None:
    """Removes one table, or all that this application has written."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path or _own_folder(spark))
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

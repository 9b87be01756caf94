"""Operator 3: token ids as files of directly addressable codes.

Documents are dealt into ranges of ascending id; within a range they are
encoded, an end id is appended to each, and images of about ``IMAGE_TOKENS``
ids (a longer document is one image) are written.  An image is one row of a
Parquet file, so that Spark's writer commits it on any file system and a retry
leaves no half of it; ``part, seq`` order the images as the documents.

The encoder is the tokenizers library, given the texts in words cut at ASCII
white space (see :mod:`linkloom.llm.wordbpe`), each distinct word, less the
punctuation behind it, once per worker's memory.  A null or empty text has the end id alone; a long one is
encoded about a megabyte at a time.  Null ids come first; rows that repeat an id
are ordered by a hash of their text and each have a place of their own.  An
empty table gives no images.  Columns beyond id and text are not read, whatever
their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkloom.llm import common, wordbpe
from linkloom.llm.dac import Image, pack

IMAGE_TOKENS = 1 << 18

_MADE: dict[str, wordbpe.Remembered] = {}


def _memory(path: str) -> wordbpe.Remembered:
    """The library's codes of each word, as binary."""
    if path not in _MADE:
        bpe = wordbpe.load(path)
        _MADE[path] = wordbpe.remembered_parts(bpe.encode_by_library)
    return _MADE[path]


def _images(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    memory = _memory(path)
    end = np.array([end_id], dtype="<u4").tobytes()
    part, seq = TaskContext.get().partitionId(), 0
    doc_ids, parts, sizes, held = [], [], [], 0

    def image() -> pa.RecordBatch:
        data = pack(np.frombuffer(b"".join(parts), dtype="<u4"), doc_ids, sizes)
        return pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
             "n_tokens": pa.array([held], pa.int64()), "image": pa.array([data], pa.binary())})

    for batch in batches:
        for rows in common.slices(batch, 1):
            codes = [[] for _ in range(rows.num_rows)]
            for row, found in wordbpe.looked_up(memory, rows.column(1).cast(pa.binary()).to_pylist()):
                codes[row].append(b"".join(found))
            for doc_id, own in zip(rows.column(0).to_pylist(), codes, strict=True):
                ids = b"".join(own) + end
                doc_ids.append(doc_id)
                parts.append(ids)
                sizes.append(len(ids) // 4)
                held += len(ids) // 4
                if held >= IMAGE_TOKENS:
                    yield image()
                    doc_ids, parts, sizes, held, seq = [], [], [], 0, seq + 1
    if doc_ids:
        yield image()


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Writes the images of all documents to the new folder ``path``."""
    rows = docs.select(common.quoted(id_col).cast("long").alias("id"), common.quoted(text_col).cast("string").alias("text"))
    # Rows that repeat an id, as null, are dealt into several ranges too.
    order = ["id", "hash", "number"]
    keyed = rows.select("id", "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("number"))
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    ordered.mapInArrow(
        lambda batches: _images(batches, vocabulary, end_id), "part int, seq int, n_tokens long, image binary"
    ).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the images."""
    images = spark.read.parquet(path)
    # Counts first summed by part: the running sum over all is one row per part.
    sizes = images.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    parts = sizes.withColumn("base", F.sum("size").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, 0)) - F.col("size")).select("part", "base")
    before = F.sum("n_tokens").over(W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, 0))
    offsets = (
        images.select("part", "seq", "n_tokens")
        .withColumn("before", before - F.col("n_tokens"))
        .join(parts, "part")
        .select("part", "seq", (F.col("base") + F.col("before")).alias("offset"))
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                image = Image(batch.column(2)[k].as_py())
                raw = memoryview(image.all().astype("<u4").tobytes())
                ends = np.r_[image.starts[1:], len(image)]
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(image.starts.tolist(), ends.tolist(), strict=True)]
                n = len(crcs)
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array(np.full(n, batch.column(0)[k].as_py(), np.int32)),
                     "seq": pa.array(np.full(n, batch.column(1)[k].as_py(), np.int32)),
                     "doc_id": pa.array(image.doc_ids, pa.int64()), "begin": pa.array(image.starts),
                     "n_tokens": pa.array(ends - image.starts), "ids_crc32": pa.array(crcs, pa.int64())})

    documents = images.select("part", "seq", "image").mapInArrow(
        unpack, "part int, seq int, doc_id long, begin long, n_tokens long, ids_crc32 long")
    return documents.join(offsets, ["part", "seq"]).select(
        "doc_id", (F.col("offset") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def token_at(spark: SparkSession, path: str, position: int) -> int | None:
    """The id at a position of the whole sequence, from one image; None beyond the end."""
    images = spark.read.parquet(path)
    totals = images.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn(
        "till", F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, 0)))
    part = totals.filter(F.col("till") > position).orderBy("part").first() if position >= 0 else None
    if part is None:
        return None
    left = position - (part["till"] - part["n"])
    own = images.filter(F.col("part") == part["part"])
    running = F.sum("n_tokens").over(W.orderBy("seq").rowsBetween(W.unboundedPreceding, 0))
    at = own.select("seq", "n_tokens", running.alias("till")).filter(F.col("till") > left).orderBy("seq").first()
    image = Image(bytes(own.filter(F.col("seq") == at["seq"]).select("image").first()[0]))
    return image[left - (at["till"] - at["n_tokens"])]

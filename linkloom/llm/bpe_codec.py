"""Operator 9: BPE encoding and decoding of whole texts.

Codes come from the segment-tree merges of :mod:`linkloom.llm.wordbpe`; the
library normalises and splits.  A null or empty text has no codes; a text of any
length is encoded whole, about a megabyte at a time; rows that repeat each get
the same codes; an empty table gives an empty result; input columns named as an
output column give way to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from linkloom.llm import common, wordbpe

IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
DIGESTS = (
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
)

#: Bytes of a worker's memory of words, per generation; workers keep it between stages.
MEMORY = 24 << 20

_MADE: dict[str, wordbpe.Remembered] = {}


def _remembered(path: str) -> wordbpe.Remembered:
    """Of each word's codes: their number, the codes as binary and as decimal
    text, and what they decode to."""
    if path not in _MADE:
        bpe = wordbpe.load(path)
        decimal = [str(i).encode() for i in range(len(bpe.token))]
        token = [t.encode() for t in bpe.token]
        binary = [int(i).to_bytes(4, "little") for i in range(len(bpe.token))]

        def made(words: list[bytes]) -> list[tuple[int, bytes, bytes, bytes]]:
            return [(len(ids), b"".join([binary[i] for i in ids]), b" ".join([decimal[i] for i in ids]),
                     b" ".join([token[i] for i in ids])) for ids in bpe.encode(words)]

        _MADE[path] = wordbpe.Remembered(made, lambda e: 200 + 14 * e[0], MEMORY)
    return _MADE[path]


class _Joined:
    """Digest of texts with a space between them, as they come."""

    def __init__(self):
        self.digest, self.empty = hashlib.sha256(), True

    def add(self, texts: list[bytes]) -> None:
        if texts:
            self.digest.update((b"" if self.empty else b" ") + b" ".join(texts))
            self.empty = False


def bpe_encode(
    docs: DataFrame,
    vocabulary: str,
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """``keep`` (default: all columns) with ``ids`` if ``with_ids``,
    ``n_tokens``, and the digests of the ids and of the text they decode to."""
    fields = [IDS, *DIGESTS] if with_ids else list(DIGESTS)

    def make():
        memory = _remembered(vocabulary)

        def fn(texts: list) -> list[pa.Array]:
            sizes, binary = [0] * len(texts), []
            ids, decoded = [_Joined() for _ in texts], [_Joined() for _ in texts]
            for row, found in wordbpe.looked_up(memory, texts):
                found = [f for f in found if f[0]]  # a word of other white space has no codes
                sizes[row] += sum([f[0] for f in found])
                ids[row].add([f[2] for f in found])
                decoded[row].add([f[3] for f in found])
                if with_ids:
                    binary.append(b"".join([f[1] for f in found]))
            out = [pa.array(sizes, pa.int64()), *(pa.array([j.digest.hexdigest() for j in of], pa.string()) for of in (ids, decoded))]
            if with_ids:
                ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(binary), dtype="<i4"), pa.int32())
                out.insert(0, pa.ListArray.from_arrays(pa.array(ends), values))
            return out

        return fn

    return common.append_from_text(docs, text_col, make, fields, keep, as_bytes=True)


def bpe_decode(
    encoded: DataFrame, vocabulary: str, ids_col: str = "ids", keep: Sequence[str] | None = None
) -> DataFrame:
    """``keep`` (default: all columns) with ``decoded``, the text of the ids:
    tokens with a space between, control tokens included.  Null ids count as
    none."""
    name = T.StructField("decoded", T.StringType())
    kept = common.without(encoded.columns if keep is None else keep, [name.name])
    source = encoded.select(*map(common.quoted, kept), common.quoted(ids_col).alias("__ids"))
    schema = T.StructType([source.schema[c] for c in kept] + [name])

    def run(batches):
        bpe = wordbpe.load(vocabulary)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                texts = [bpe.decode(ids or []) for ids in part.column(len(kept)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return source.mapInArrow(run, schema)

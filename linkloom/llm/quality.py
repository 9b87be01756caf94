"""Operator 10: a quality classifier by nearest-neighbour voting.

The terms of a text are the tokens that a public vocabulary makes of it, and two
more that stand for pairs and for runs of four tokens that the text had before.
Damped relative frequencies times inverse document frequencies, and a truncated
singular value decomposition of the labelled rows, give latent-semantic vectors.
The labelled vectors are broadcast; every document's cosine with all of them is
computed exactly, in blocks, and the ``NEIGHBOURS`` nearest vote for their
labels, each with its similarity as weight.

``SAMPLE`` bounds the labelled rows per label (those of the smallest id hash),
and with it the broadcast and the work per document.  Null and empty texts have
a zero vector and get the label mean of the sample, as do all texts if nothing
is labelled (then 0.5).  A text of any length is read whole, about a megabyte at
a time.  Of neighbours that tie for the last place any may vote.  Rows that
repeat get the same score; rows that repeat an id count once as a label, by the
smaller label and the smaller vector.  An empty table gives an empty result;
input columns named as an output column give way to it.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import common

#: Labelled rows per label, latent dimensions, voters.
SAMPLE, RANK, NEIGHBOURS = 2000, 64, 9
#: Lengths of the token runs that count as terms where they repeat, and the bits
#: of the table that tells whether a run has been seen.
RUNS, SEEN_BITS = (2, 4), 26
_SEED = 20240229
#: Texts are cut before a space between letters: no token reaches across it.
GAP = re.compile(rb"[A-Za-z0-9](?= [A-Za-z])")


@dataclass(frozen=True)
class Vocabulary:
    """A file of base64 tokens and ranks, and the pattern that splits texts for it."""

    path: str
    pattern: str


_LOADED: dict[Vocabulary, tiktoken.Encoding] = {}


def load(vocabulary: Vocabulary) -> tiktoken.Encoding:
    """One per Python worker and file."""
    if vocabulary not in _LOADED:
        with open(vocabulary.path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _LOADED[vocabulary] = tiktoken.Encoding("public", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[vocabulary]


def _runs(ids: np.ndarray, length: int) -> np.ndarray:
    """A number below 2 ** SEEN_BITS for every run of tokens."""
    code = np.zeros(max(len(ids) - length + 1, 0), np.uint64)
    for k in range(length):
        code = (code + ids[k : len(ids) - length + 1 + k].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return (code >> np.uint64(64 - SEEN_BITS)).astype(np.int64)


def terms(text: bytes | None, encoding: tiktoken.Encoding) -> tuple[np.ndarray, np.ndarray]:
    """The terms of a whole text, ascending, and their damped relative frequencies."""
    parts = list(common.windows(text or b"", GAP)) if text and len(text) > common.BYTES else [text or b""]
    repeated = np.zeros(len(RUNS))
    if len(parts) == 1:
        ids = np.array(encoding.encode_ordinary(parts[0].decode("utf-8", "replace")), dtype=np.int64)
        n = len(ids)
        found, counts = np.unique(ids, return_counts=True)
        for k, length in enumerate(RUNS):
            runs = _runs(ids, length)
            repeated[k] = len(runs) - len(np.unique(runs))
    else:
        every, n = np.zeros(encoding.n_vocab, np.int64), 0
        seen = [np.zeros(1 << SEEN_BITS, bool) for _ in RUNS]
        tail = np.zeros(0, np.int64)
        for part in parts:
            ids = np.array(encoding.encode_ordinary(part.decode("utf-8", "replace")), dtype=np.int64)
            n += len(ids)
            every += np.bincount(ids, minlength=len(every))
            ids = np.concatenate([tail, ids])
            for k, length in enumerate(RUNS):
                runs = _runs(ids[max(len(tail) - length + 1, 0) :], length)
                repeated[k] += len(runs)
                seen[k][runs] = True
            tail = ids[-(max(RUNS) - 1) :]
        repeated -= [int(np.count_nonzero(s)) for s in seen]
        found = np.flatnonzero(every)
        counts = every[found]
    more = np.flatnonzero(repeated)
    found = np.concatenate([found, encoding.n_vocab + more])
    counts = np.concatenate([counts, repeated[more]])
    return found, np.sqrt(counts / max(n, 1)).astype(np.float32)


@dataclass
class Model:
    """The latent space and the labelled vectors in it."""

    vocabulary: Vocabulary
    project: np.ndarray  # terms x rank, with inverse document frequencies
    vectors: np.ndarray  # labelled rows x rank, of length one
    labels: np.ndarray
    mean: float

    def vector(self, text: bytes | None) -> np.ndarray:
        found, weights = terms(text, load(self.vocabulary))
        return weights @ self.project[found]

    def score(self, texts: Sequence[bytes | None]) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest neighbours."""
        if not len(self.labels) or not len(texts):
            return np.full(len(texts), self.mean)
        x = np.stack([self.vector(t) for t in texts])
        length = np.linalg.norm(x, axis=1)
        x /= np.maximum(length, 1e-9)[:, None]
        cosine = x @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64)
        total = weight.sum(1)
        votes = (weight * self.labels[near]).sum(1) / np.maximum(total, 1e-12)
        return np.where((length > 1e-9) & (total > 1e-12), np.clip(votes, 0, 1), self.mean)


class _Rows:
    """Sparse rows, for products with narrow dense matrices."""

    def __init__(self, rows: Sequence[tuple[np.ndarray, np.ndarray]], width: int):
        self.rows, self.shape = rows, (len(rows), width)
        at = np.concatenate([np.full(len(t), k) for k, (t, _) in enumerate(rows)])
        term, weight = (np.concatenate(c) for c in zip(*rows, strict=True))
        order = np.argsort(term, kind="stable")
        self.at, self.weight = at[order], weight[order]
        self.terms, self.starts = np.unique(term[order], return_index=True)

    def times(self, dense: np.ndarray) -> np.ndarray:
        return np.stack([w @ dense[t] for t, w in self.rows])

    def transposed_times(self, dense: np.ndarray) -> np.ndarray:
        out = np.zeros((self.shape[1], dense.shape[1]), np.float32)
        ends = [*self.starts[1:].tolist(), len(self.at)]
        for t, a, b in zip(self.terms.tolist(), self.starts.tolist(), ends, strict=True):
            out[t] = self.weight[a:b] @ dense[self.at[a:b]]
        return out


def fit_rows(rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, vocabulary: Vocabulary) -> Model:
    """The decomposition of the labelled rows' weighted terms."""
    width = load(vocabulary).n_vocab + len(RUNS)
    if not len(labels):
        return Model(vocabulary, np.zeros((width, 1), np.float32), np.zeros((0, 1), np.float32), labels, 0.5)
    having = np.zeros(width)
    for found, _ in rows:
        having[found] += 1
    idf = (np.log((1 + len(rows)) / (1 + having)) + 1).astype(np.float32)
    x = _Rows([(t, w * idf[t]) for t, w in rows], width)
    rank = min(RANK, len(rows))
    rng = np.random.default_rng(_SEED)
    basis = rng.standard_normal((width, min(rank + 16, len(rows)))).astype(np.float32)
    for _ in range(4):  # randomised range finding, with powers
        left, _r = np.linalg.qr(x.times(basis))
        basis, _r = np.linalg.qr(x.transposed_times(left))
    _u, _s, vt = np.linalg.svd(x.times(basis), full_matrices=False)
    project = idf[:, None] * (basis @ vt.T[:, :rank]).astype(np.float32)
    project[having == 0] = 0  # a term that no labelled row has says nothing
    vectors = np.stack([w @ project[t] for t, w in rows])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
    return Model(vocabulary, project, vectors.astype(np.float32), labels.astype(np.float64), float(labels.mean()))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    vocabulary: Vocabulary,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> Model:
    """A model from at most ``sample`` labelled rows per label (0 and 1).
    ``labels`` has the rows to learn from; other labels and null are left out."""
    known = (
        labels.select(common.quoted(id_col).alias("__id"), common.quoted(label_col).cast("int").alias("__label"))
        .filter("__label in (0, 1) and __id is not null")
        .groupBy("__id")
        .agg(F.min("__label").alias("__label"))
    )
    order = [F.md5(F.col("__id").cast("string").cast("binary")), F.col("__id")]
    chosen = known.filter("__label = 0").orderBy(*order).limit(sample).union(
        known.filter("__label = 1").orderBy(*order).limit(sample))
    rows = (
        docs.select(common.quoted(id_col).alias("__id"), common.quoted(text_col).alias("__text"))
        .join(F.broadcast(chosen), "__id")  # at most 2 * sample ids
    )

    def make():
        encoding = load(vocabulary)

        def fn(texts: list) -> list[pa.Array]:
            found = [terms(t, encoding) for t in texts]
            return [pa.array([t.astype("<i4").tobytes() for t, _ in found], pa.binary()),
                    pa.array([w.astype("<f4").tobytes() for _, w in found], pa.binary())]

        return fn

    fields = [T.StructField("t", T.BinaryType()), T.StructField("w", T.BinaryType())]
    found = common.append_from_text(rows, "__text", make, fields, ["__id", "__label"], as_bytes=True).groupBy(
        "__id", "__label").agg(F.min(F.struct("t", "w")).alias("v")).select("__id", "__label", "v.*").collect()
    found.sort(key=lambda r: r["__id"])
    vectors = [(np.frombuffer(r["t"], "<i4").astype(np.int64), np.frombuffer(r["w"], "<f4")) for r in found]
    return fit_rows(vectors, np.array([r["__label"] for r in found], dtype=np.float64), vocabulary)


def score(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    score_col: str = "score",
    predicted_col: str = "predicted",
) -> DataFrame:
    """``keep`` (default: all columns) with the score and its rounding."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by SAMPLE, RANK and the vocabulary

    def make():
        def fn(texts: list) -> list[pa.Array]:
            found = sent.value.score(texts)
            return [pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32))]

        return fn

    fields = [T.StructField(score_col, T.DoubleType()), T.StructField(predicted_col, T.IntegerType())]
    return common.append_from_text(docs, text_col, make, fields, keep, as_bytes=True)

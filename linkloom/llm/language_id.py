"""Operator 8: hierarchical language identification.

Whole texts become damped relative frequencies of hashed byte n-grams (letters
only, one to three bytes).  One-versus-one linear support vector machines first
vote for the language family, then others, trained within that family only,
separate its languages.

``SAMPLE`` bounds the rows per language that training reads (those of the
smallest id hash), and ``ALL_SAMPLES`` those of all languages together, but
``LEAST`` of each are read however many languages there are: every language of
the table is learnt.  There is a machine for every two families and for every
two languages of one, so time and memory of the driver grow with their square.
A text that is null or has no letter is ``und`` with
score 0; one of any length is read whole, about a megabyte at a time.  If only
one language is known, it is predicted with score 1.  Rows that repeat get the
same prediction; rows that repeat id and language are learnt from once, by one
of their texts, and rows without an id are not learnt from.  Of languages with
equal votes and sureness the first by name wins.  An empty table gives an empty
result; input columns named as an output column give way to it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import common

SAMPLE, ALL_SAMPLES, LEAST, TERMS = 1000, 16_000, 8, 4096
UNKNOWN = "und"
#: Rows of a family that a machine between two families reads, evenly of its languages.
FAMILY_SAMPLE = 2000
# Families of languages by code; any other is a family of its own.
FAMILIES = {
    "austronesian": "ceb haw id jv mg mi ms sm su tl",
    "baltic": "lt lv",
    "bantu": "ln lg ny rn rw sn st sw tn ts xh zu",
    "celtic": "br cy ga gd gv kw",
    "dravidian": "kn ml ta te",
    "germanic": "af da de en fo fy is lb nds nl nn no sv yi",
    "indic": "as bn gu hi mr ne or pa sa sd si ur",
    "iranian": "ckb fa ku os ps tg",
    "romance": "ast ca es fr gl it la lmo oc pt ro sc scn",
    "semitic": "am ar arz he mt ti",
    "sinitic": "wuu yue zh",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "tai": "lo th",
    "turkic": "az ba cv kk ky tk tr tt ug uz",
    "uralic": "et fi hu se",
}
_FAMILY = {lang: name for name, langs in FAMILIES.items() for lang in langs.split()}

_LETTER = regex.compile(r"\p{L}")
_ANY = re.compile(b"(?=.)", re.DOTALL)
_START = re.compile(rb".(?=[\x00-\x7f\xc0-\xff])", re.DOTALL)  # before a character
# Bytes as classes: 0 for what is no letter, 1-26 for a-z in either case, and
# the bytes beyond ASCII each its own.
_CLASS = np.zeros(256, dtype=np.int64)
for _k in range(26):
    _CLASS[[ord("a") + _k, ord("A") + _k]] = 1 + _k
_CLASS[128:] = 27 + np.arange(128)
_BASE = 155


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0].split("_")[0], f"family of {lang}")


def _hashed(codes: np.ndarray, n: int) -> np.ndarray:
    spread = (codes + n * _BASE**3).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (spread >> np.uint64(52)).astype(np.int64)  # 12 bits: TERMS values


_SINGLE = _hashed(np.arange(_BASE), 1)
_DOUBLE = _hashed(np.arange(_BASE**2), 2)
_TRIPLE = _hashed(np.arange(_BASE**3), 3).astype(np.int16)


def term_weights(text: bytes) -> np.ndarray:
    """Damped relative frequencies of the n-grams of a whole text, of length one.
    The text is read in turns; the last two classes of one lead into the next."""
    out = np.zeros(TERMS, np.int64)
    tail = np.zeros(1, np.int64)
    for part in [*common.windows(text, _ANY), b" "]:
        c = np.concatenate([tail, _CLASS[np.frombuffer(part, dtype=np.uint8)]])
        c = c[(c > 0) | np.r_[True, c[:-1] > 0]]  # one mark between words
        out += np.bincount(_SINGLE[c[len(tail) :][c[len(tail) :] > 0]], minlength=TERMS)
        pair = c[:-1] * _BASE + c[1:]
        out += np.bincount(_DOUBLE[pair[len(tail) - 1 :]], minlength=TERMS)
        if len(c) > 2:
            triple = pair[:-1] * _BASE + c[2:]
            out += np.bincount(_TRIPLE[triple[max(len(tail) - 2, 0) :]], minlength=TERMS)
        tail = c[-2:]
    found = np.sqrt(out.astype(np.float32))
    return found / max(float(np.linalg.norm(found)), 1e-9)


@dataclass
class Machine:
    """A linear support vector machine between two names."""

    first: str
    second: str
    weights: np.ndarray
    bias: float


@dataclass
class Model:
    families: list[str]
    members: dict[str, list[str]]
    between: list[Machine] = field(default_factory=list)  # families
    within: dict[str, list[Machine]] = field(default_factory=dict)


def train(x: np.ndarray, y: np.ndarray, rounds: int = 150, strength: float = 300.0) -> tuple[np.ndarray, float]:
    """Weights and bias for the squared hinge loss with labels +1 and -1, both
    classes weighing the same, by accelerated gradient steps."""
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    rate = 1.0 / (1.0 / strength + 4.0)
    w = np.zeros(x.shape[1] + 1, np.float32)  # the last is the bias
    v = w.copy()
    for k in range(rounds):
        pull = 2 * share * y * np.maximum(1 - y * (x @ v[:-1] + v[-1]), 0)
        new = v - rate * (v / strength - np.r_[x.T @ pull, pull.sum()])
        v = new + (k / (k + 3)) * (new - w)
        w = new
    return w[:-1], float(w[-1])


def _one_versus_one(names: Sequence[str], of: np.ndarray, x: np.ndarray, most: int | None = None) -> list[Machine]:
    """A machine for every two of ``names``, from at most ``most`` rows of each."""
    rows = {}
    for name in names:
        own = np.flatnonzero(of == name)
        rows[name] = own[:: -(-len(own) // most)] if most and len(own) else own
    machines = []
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            own = np.sort(np.concatenate([rows[a], rows[b]]))
            weights, bias = train(x[own].astype(np.float32), np.where(of[own] == a, 1, -1).astype(np.float32))
            machines.append(Machine(a, b, weights, bias))
    return machines


def fit_vectors(x: np.ndarray, langs: Sequence[str]) -> Model:
    of = np.array(langs, dtype=object)
    family = np.array([family_of(v) for v in langs], dtype=object)
    names = sorted(set(family))
    members = {f: sorted(set(of[family == f])) for f in names}
    model = Model(names, members)
    model.between = _one_versus_one(names, family, x, FAMILY_SAMPLE)
    model.within = {f: _one_versus_one(members[f], np.where(family == f, of, None), x) for f in names}
    return model


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
) -> Model:
    """A model from at most ``sample`` rows of each language of ``docs``, and
    ``ALL_SAMPLES`` in all, or ``LEAST`` of each if that is more."""
    rows = docs.select(
        F.md5(F.coalesce(common.quoted(id_col).cast("string"), F.lit("")).cast("binary")).alias("__hash"),
        common.quoted(id_col).alias("__id"),
        common.quoted(lang_col).cast("string").alias("__lang"),
        common.quoted(text_col).cast("string").alias("__text"),
    ).filter("__lang is not null and __text is not null")
    langs = rows.groupBy("__lang").agg(F.count(F.lit(1)).alias("__n"))  # the model has a class for each
    sample = min(sample, max(ALL_SAMPLES // max(langs.count(), 1), LEAST))
    # The hash thins each language to little more than the sample before ranking.
    drawn = F.conv(F.substring("__hash", 1, 8), 16, 10).cast("double") / 2.0**32
    order = W.partitionBy("__lang").orderBy("__hash", "__id")
    ids = (
        rows.select("__hash", "__id", "__lang")
        .join(F.broadcast(langs), "__lang")
        .filter(drawn * F.col("__n") < 1.5 * sample + 50)
        .withColumn("__rank", F.row_number().over(order))
        .filter(F.col("__rank") <= sample)
        .select("__id", "__lang")
        .distinct()
    )

    def make():
        def fn(texts: list) -> list[pa.Array]:
            return [pa.array([term_weights(t).astype("<f2").tobytes() for t in texts], pa.binary())]

        return fn

    chosen = rows.select("__id", "__lang", "__text").join(F.broadcast(ids), ["__id", "__lang"])  # ALL_SAMPLES ids, or LEAST a language
    found = common.append_from_text(
        chosen, "__text", make, [T.StructField("w", T.BinaryType())], ["__id", "__lang"], as_bytes=True
    ).groupBy("__id", "__lang").agg(F.min("w").alias("w")).collect()
    found.sort(key=lambda r: (r["__lang"], r["__id"]))
    x = np.array([np.frombuffer(r["w"], "<f2") for r in found], dtype=np.float16).reshape(-1, TERMS)
    return fit_vectors(x, [r["__lang"] for r in found])


def _vote(names: Sequence[str], machines: Sequence[Machine], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The winner of each row and how sure its duels are, from 0 to 1."""
    if len(names) == 1:
        return np.zeros(len(x), dtype=np.int64), np.ones(len(x))
    votes = np.zeros((len(x), len(names)))
    sure = np.zeros((len(x), len(names)))
    at = {n: k for k, n in enumerate(names)}
    for m in machines:
        chance = 1 / (1 + np.exp(-np.clip(3 * (x @ m.weights + m.bias), -30, 30)))
        for name, p in ((m.first, chance), (m.second, 1 - chance)):
            votes[:, at[name]] += p >= 0.5
            sure[:, at[name]] += p
    sure /= len(names) - 1
    winner = np.argmax(votes + sure / len(names), axis=1)
    return winner, sure[np.arange(len(x)), winner]


def has_letter(text: bytes | None) -> bool:
    return text is not None and any(
        _LETTER.search(part.decode("utf-8", "replace")) for part in common.windows(text, _START))


def predict(model: Model, texts: Sequence[bytes | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: family first, then within it."""
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    own = [k for k, t in enumerate(texts) if has_letter(t)]
    if not own or not model.families:
        return langs, scores
    x = np.stack([term_weights(texts[k]) for k in own])
    family, sure = _vote(model.families, model.between, x)
    for f, name in enumerate(model.families):
        rows = np.flatnonzero(family == f)
        if len(rows):
            which, more = _vote(model.members[name], model.within[name], x[rows])
            for row, k, s in zip(rows.tolist(), which.tolist(), (sure[rows] * more).tolist(), strict=True):
                langs[own[row]], scores[own[row]] = model.members[name][k], s
    return langs, scores


def identify(
    docs: DataFrame, model: Model, text_col: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """``keep`` (default: all columns) with ``lang_pred`` and ``score``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # one row of TERMS weights per pair of names

    def make():
        def fn(texts: list) -> list[pa.Array]:
            langs, scores = predict(sent.value, texts)
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

        return fn

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return common.append_from_text(docs, text_col, make, fields, keep, as_bytes=True)

"""Operator 6: quality rules by what public tokenisers make of a text.

Two public vocabularies, one of pieces with byte fallback and one of byte pairs,
encode the whole text; three measures follow for each: characters of words per
token, the share of tokens that are single bytes beyond ASCII, and the entropy
of the token distribution in bits per token.

Each language (or, where the language is unknown, each script) has a band per
measure, learnt from labelled clean rows: what to expect at a number of tokens,
how far clean rows scatter around it, and how many times that any of them is
off, widened by ``WIDER``.  A text outside a band is rejected.  Without enough
clean rows of its language or script (``LEAST``) it has no band.  All labelled
clean rows are learnt from, by sums over their measures: texts are measured once
for the bands and the verdicts, and no text is shuffled.  Plain counts of words,
symbols, repeated lines and repeated word triples come first, as the base rule.

A null text has no words and fails the base rule like an empty one.  Texts are
measured whole; rows that repeat get the same verdict, and are learnt from once
if they repeat the id.  An empty table gives an empty result; input columns
named as an output column give way to it, and no other name is in the way of the
private ones, which go by position.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import common, quality

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: White space and symbols of the base rule, as bytes.
SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"

#: Clean rows that a band needs.
LEAST = 100
#: A band reaches so many times as far as the clean rows that it is learnt from,
#: which count as off by so many standard deviations at least.
WIDER, OFF = 1.75, 2.0
MEASURES = ("chars_per_token", "byte_share", "token_entropy")
#: The least scatter of each measure.
FLOORS = {"chars_per_token": 0.05, "byte_share": 0.005, "token_entropy": 0.05}


@dataclass(frozen=True)
class Limit:
    """What to expect of a measure at x = log2(tokens): ``c0 + c1 x + c2 x x``;
    its variance, ``a + b / tokens``; and how many standard deviations below and
    above are allowed."""

    c0: float
    c1: float
    c2: float
    a: float
    b: float
    low: float
    high: float


#: Limits of a language or script, by vocabulary (its place) and measure.
Band = Mapping[tuple[int, str], Limit]


@dataclass(frozen=True)
class Bands:
    by_lang: Mapping[str, Band]
    by_script: Mapping[str, Band]


def limit_of(tokens: np.ndarray, values: np.ndarray, floor: float) -> Limit:
    """Least squares for the expectation and for the squared rest, and the
    furthest rests in standard deviations."""
    x = np.log2(tokens)
    basis = np.stack([np.ones_like(x), x, x * x], axis=1)
    c, *_ = np.linalg.lstsq(basis, values, rcond=None)
    rest = values - basis @ c
    (a, b), *_ = np.linalg.lstsq(np.stack([np.ones_like(x), 1 / tokens], axis=1), rest**2, rcond=None)
    a, b = max(float(a), floor**2), max(float(b), 0.0)
    off = rest / np.sqrt(a + b / tokens)
    return Limit(*map(float, c), a, b, WIDER * min(float(off.min()), -OFF), WIDER * max(float(off.max()), OFF))


_SCRIPTS = [
    (name, regex.compile(rf"[{chars}]"))
    for name, chars in (
        ("Latin", r"\p{Latin}"), ("Cyrillic", r"\p{Cyrillic}"), ("Greek", r"\p{Greek}"), ("Arabic", r"\p{Arabic}"),
        ("Hebrew", r"\p{Hebrew}"), ("Han", r"\p{Han}"), ("Kana", r"\p{Hiragana}\p{Katakana}"), ("Hangul", r"\p{Hangul}"),
    )
]


_ASCII = re.compile(r"[\x00-\x7f]+")
_NO_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())


@functools.cache
def _script(character: str) -> str | None:
    return next((name for name, rule in _SCRIPTS if rule.match(character)), None)


def script_of(text: str) -> str:
    """The commonest script among the letters; the earlier listed wins a tie."""
    plain = len(text.encode("ascii", "ignore").translate(None, _NO_LETTERS))
    if text.isascii():
        return "Latin" if plain else "other"
    counts = Counter({"Latin": plain})
    for character, n in Counter(_ASCII.sub("", text)).items():
        counts[_script(character)] += n
    most, name = max(((counts[name], name) for name, _ in _SCRIPTS), key=lambda c: c[0])
    return name if most else "other"


def repeated_words(words: Sequence[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    code = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    base = len(seen)
    pair = code[:-1] * base + code[1:]
    if base > 1 << 20:  # keeps the triple's code within 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    triple = pair[:-1] * base + code[2:]
    _, of, counts = np.unique(triple, return_inverse=True, return_counts=True)
    again = counts[of] > 1
    if not again.any():
        return 0
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : k + n - 2] |= again
    return int(covered.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode("utf-8", "replace")
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    chars = len(text) - int(by_byte[list(SPACES)].sum())
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(words), chars, int(by_byte[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), repeated_words(words)


def fails_base(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


class Pieces:
    """A vocabulary with byte fallback, from a sentencepiece file."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(k) for k in range(self.size)])
        self.encode = self.model.encode


class BytePairs:
    """A vocabulary of byte pairs; single bytes beyond ASCII are its fallback."""

    def __init__(self, vocabulary: quality.Vocabulary):
        encoding = quality.load(vocabulary)
        self.size, self.encode = encoding.n_vocab, encoding.encode_ordinary
        tokens = [b""] * self.size
        for token in encoding.token_byte_values():
            tokens[encoding.encode_single_token(token)] = token
        self.is_byte = np.array([len(t) == 1 and t[0] > 127 for t in tokens])


Vocabulary = str | quality.Vocabulary
_LOADED: dict[Vocabulary, Pieces | BytePairs] = {}


def load(vocabulary: Vocabulary) -> Pieces | BytePairs:
    """One per Python worker and file."""
    if vocabulary not in _LOADED:
        _LOADED[vocabulary] = Pieces(vocabulary) if isinstance(vocabulary, str) else BytePairs(vocabulary)
    return _LOADED[vocabulary]


def fertility(parts: Sequence[str], chars: int, vocabulary: Pieces | BytePairs) -> tuple[int, float, float, float]:
    """Tokens, characters per token, byte share, entropy."""
    if len(parts) == 1:
        ids, counts = np.unique(np.array(vocabulary.encode(parts[0]), dtype=np.int64), return_counts=True)
    else:
        every = np.zeros(vocabulary.size, dtype=np.int64)
        for part in parts:
            every += np.bincount(np.array(vocabulary.encode(part), dtype=np.int64), minlength=vocabulary.size)
        ids = np.flatnonzero(every)
        counts = every[ids]
    n = int(counts.sum())
    if not n:
        return 0, 0.0, 0.0, 0.0
    p = counts / n
    return n, chars / n, float(counts[vocabulary.is_byte[ids]].sum()) / n, float(-(p * np.log2(p)).sum()) + 0.0


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def fields(vocabularies: Sequence[Vocabulary]) -> list[T.StructField]:
    """What :func:`measure` adds; names end in the vocabulary's place."""
    each = [[T.StructField(f"n_tokens_{v}", T.LongType()), *(T.StructField(f"{m}_{v}", T.DoubleType()) for m in MEASURES)]
            for v in range(len(vocabularies))]
    return [*(T.StructField(n, T.LongType()) for n in BASE), T.StructField("base_failed", T.BooleanType()),
            *(f for own in each for f in own), T.StructField("script", T.StringType())]


def measure(
    docs: DataFrame, vocabularies: Sequence[Vocabulary], text_col: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """``keep`` (default: all columns) with the counts, the measures and the script."""
    made = fields(vocabularies)
    kinds = {T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.BooleanType(): pa.bool_(), T.StringType(): pa.string()}

    def make():
        loaded = [load(v) for v in vocabularies]

        def fn(texts: list) -> list[pa.Array]:
            rows = []
            for raw in texts:
                parts = [p.decode("utf-8", "replace") for p in common.windows(raw or b"", quality.GAP)]
                text = parts[0] if len(parts) == 1 else "".join(parts)
                counts = base_counts(text)
                own = [x for v in loaded for x in fertility(parts, counts[1], v)]
                rows.append((*counts, fails_base(counts[0], counts[4]), *own, script_of(text)))
            columns = zip(*rows, strict=True) if rows else [()] * len(made)
            return [pa.array(list(c), kinds[f.dataType]) for c, f in zip(columns, made, strict=True)]

        return fn

    return common.append_from_text(docs, text_col, make, made, keep, as_bytes=True)


def measures(
    docs: DataFrame,
    vocabularies: Sequence[Vocabulary],
    id_col: str | None = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Columns ``keep`` as ``k0``, ``k1`` ..., ``id``, ``lang`` and what
    :func:`measure` adds."""
    lang = common.quoted(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    own_id = common.quoted(id_col) if id_col else F.lit(None).cast("long")
    source = docs.select(*(common.quoted(c).alias(f"k{i}") for i, c in enumerate(keep)), own_id.alias("id"), lang.alias("lang"),
                         common.quoted(text_col).alias("own_text"))
    return measure(source, vocabularies, "own_text", [c for c in source.columns if c != "own_text"])


def _solved(gram: Sequence[Sequence[float]], right: Sequence[float]) -> np.ndarray:
    return np.linalg.lstsq(np.array(gram, float), np.array(right, float), rcond=1e-13)[0]


def learn_from(measured: DataFrame, vocabularies: Sequence[Vocabulary], labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Bands:
    """Bands from all rows of :func:`measures` that ``labels`` calls clean (1) and
    that pass the base rule, as :func:`limit_of` would learn them: three passes
    over the measures, each a sum per language and script."""
    clean = labels.filter(common.quoted(label_col) == 1).select(common.quoted(id_col).alias("id")).distinct()
    names = [(v, m) for v in range(len(vocabularies)) for m in MEASURES]
    rows = common.written(
        measured.filter("not base_failed").drop("word_chars").join(clean, "id").dropDuplicates(["id"]).select(
            F.explode(F.array(*(F.struct(F.lit(by).alias("by"), F.col(by).alias("name")) for by in ("lang", "script")))).alias("g"),
            *(F.greatest(f"n_tokens_{v}", F.lit(1)).cast("double").alias(f"n{v}") for v in range(len(vocabularies))),
            *(F.col(f"{m}_{v}") for v, m in names),
        ).select("g.*", "*").drop("g").filter("name <> ''"), "clean")
    groups, total = rows.groupBy("by", "name"), lambda c, n: F.sum(c).alias(n)
    x = lambda v: F.log2(f"n{v}")
    one = F.lit(1.0)
    power = lambda c, k: one if k == 0 else F.pow(c, F.lit(float(k)))
    first = groups.agg(
        F.count(F.lit(1)).alias("rows"),
        *(total(power(x(v), k), f"x{k}_{v}") for v in range(len(vocabularies)) for k in range(5)),
        *(total(F.col(f"{m}_{v}") * power(x(v), k), f"y{k}_{m}_{v}") for v, m in names for k in range(3)),
    ).filter(F.col("rows") >= LEAST).collect()  # a row per language and script
    if not first:
        return Bands({}, {})
    fits = {(r["by"], r["name"]): {(v, m): list(map(float, _solved(
        [[r[f"x{i + j}_{v}"] for j in range(3)] for i in range(3)], [r[f"y{k}_{m}_{v}"] for k in range(3)]))) for v, m in names} for r in first}
    spark = rows.sparkSession

    def joined(of: Mapping) -> tuple[DataFrame, dict]:
        table = spark.createDataFrame([(*g, [fit[n] for n in names]) for g, fit in of.items()], "by string, name string, c array<array<double>>")
        both = rows.join(F.broadcast(table), ["by", "name"])  # a row per language and script
        c = lambda k, i: F.col("c")[k][i]
        rest = {n: F.col(f"{n[1]}_{n[0]}") - (c(k, 0) + c(k, 1) * x(n[0]) + c(k, 2) * x(n[0]) * x(n[0])) for k, n in enumerate(names)}
        return both, rest

    both, rest = joined(fits)
    second = both.groupBy("by", "name").agg(
        F.count(F.lit(1)).alias("rows"),
        *(total(power(F.col(f"n{v}"), -k), f"i{k}_{v}") for v in range(len(vocabularies)) for k in (1, 2)),
        *(total(rest[v, m] * rest[v, m] * power(F.col(f"n{v}"), -k), f"r{k}_{m}_{v}") for v, m in names for k in (0, 1))).collect()
    for r in second:
        fit = fits[r["by"], r["name"]]
        for v, m in names:
            a, b = map(float, _solved([[r["rows"], r[f"i1_{v}"]], [r[f"i1_{v}"], r[f"i2_{v}"]]], [r[f"r0_{m}_{v}"], r[f"r1_{m}_{v}"]]))
            fit[v, m] += [max(a, FLOORS[m] ** 2), max(b, 0.0)]
    both, rest = joined(fits)
    off = {(v, m): rest[v, m] / F.sqrt(F.col("c")[k][3] + F.col("c")[k][4] / F.col(f"n{v}")) for k, (v, m) in enumerate(names)}
    third = both.groupBy("by", "name").agg(*(f(off[n]).alias(f"{p}_{n[1]}_{n[0]}") for n in names for f, p in ((F.min, "low"), (F.max, "high")))).collect()
    out: dict[str, dict] = {"lang": {}, "script": {}}
    for r in third:
        fit = fits[r["by"], r["name"]]
        out[r["by"]][r["name"]] = {
            (v, m): Limit(*fit[v, m], WIDER * min(r[f"low_{m}_{v}"], -OFF), WIDER * max(r[f"high_{m}_{v}"], OFF)) for v, m in names}
    return Bands(out["lang"], out["script"])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    vocabularies: Sequence[Vocabulary],
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    label_col: str = "quality",
) -> Bands:
    """Bands from all rows of ``docs`` that ``labels`` calls clean (1) and that
    pass the base rule."""
    return learn_from(measures(docs, vocabularies, id_col, text_col, lang_col), vocabularies, labels, id_col, label_col)


def inside(tokens: Column, value: Column, limit: Column) -> Column:
    n = F.greatest(tokens, F.lit(1)).cast("double")
    x = F.log2(n)
    off = (value - (limit["c0"] + limit["c1"] * x + limit["c2"] * x * x)) / F.sqrt(limit["a"] + limit["b"] / n)
    return (off >= limit["low"]) & (off <= limit["high"])


_LIMIT = "struct<" + ",".join(f"{c}:double" for c in Limit.__dataclass_fields__) + ">"


def judge(
    docs: DataFrame,
    vocabularies: Sequence[Vocabulary],
    bands: Bands,
    text_col: str = "text",
    lang_col: str | None = "lang",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """As :func:`measure`, with ``kept``: the base rule holds, and every measure
    lies in the band of the language, else of the script, if that has one."""
    kept = _kept(docs, vocabularies, keep)
    return judge_from(measures(docs, vocabularies, None, text_col, lang_col, kept), vocabularies, bands, kept)


def _kept(docs: DataFrame, vocabularies: Sequence[Vocabulary], keep: Sequence[str] | None = None) -> list[str]:
    return common.without(docs.columns if keep is None else keep, [*(f.name for f in fields(vocabularies)), "kept"])


def judge_from(measured: DataFrame, vocabularies: Sequence[Vocabulary], bands: Bands, kept: Sequence[str]) -> DataFrame:
    """As :func:`judge`, of :func:`measures` with columns ``kept``."""
    made = fields(vocabularies)
    names = [(v, m) for v in range(len(vocabularies)) for m in MEASURES]
    spark = measured.sparkSession

    def table(name: str, of: Mapping[str, Band]) -> DataFrame:
        rows = [(key, [tuple(vars(band[n]).values()) for n in names]) for key, band in of.items()]
        return F.broadcast(spark.createDataFrame(rows, f"{name} string, {name}_band array<{_LIMIT}>"))  # a row per band

    joined = measured.join(table("l", bands.by_lang), F.col("lang") == F.col("l"), "left").join(
        table("s", bands.by_script), F.col("script") == F.col("s"), "left")
    band = F.coalesce("l_band", "s_band")
    holds = F.lit(True)
    for k, (v, m) in enumerate(names):
        holds = holds & inside(F.col(f"n_tokens_{v}"), F.col(f"{m}_{v}"), band[k])
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(holds, F.lit(True))).select(
        *(F.col(f"k{i}").alias(c) for i, c in enumerate(kept)), *(f.name for f in made), "kept")

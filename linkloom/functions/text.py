"""Normalisation of names, addresses and countries as Catalyst expressions.

All take a string column and return a column; null is the empty string.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import unicode_tables as U

# Company forms and what they stand for.
LEGAL_FORMS = {
    "pvt": "private", "private": "private",
    "ltd": "limited", "limited": "limited",
    "inc": "incorporated", "incorporated": "incorporated",
    "corp": "corporation", "corporation": "corporation",
    "co": "company", "company": "company",
    "llc": "llc", "plc": "plc", "llp": "llp",
}

# Words of addresses and what they stand for.
ADDRESS_WORDS = {
    "rd": "road", "st": "street", "ave": "avenue", "av": "avenue",
    "blvd": "boulevard", "boul": "boulevard", "ln": "lane", "dr": "drive",
    "hwy": "highway", "pkwy": "parkway", "ct": "court", "cir": "circle",
    "pl": "place", "ter": "terrace", "trl": "trail", "way": "way", "sq": "square",
    "apt": "apartment", "ste": "suite", "fl": "floor", "bldg": "building",
    "rm": "room", "no": "number",
}

# Name words too common to block on.
GENERIC_WORDS = (
    "llc", "inc", "corp", "corporation", "co", "company", "limited", "ltd", "plc", "llp", "the", "private", "pvt",
    "sarl", "sas", "smt", "sri", "shri", "india", "global", "group", "services", "enterprise", "enterprises",
    "center", "centre", "store", "shop", "solutions", "trading", "traders", "technology", "technologies",
    "international", "holdings", "industries", "industry",
)

# Trailing words that the exact matcher strips from names.
TRAILING_FORMS = (
    "inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "llc", "plc", "pvt", "private",
    "sarl", "sas", "sa",
)

MIN_WORD = 3

# The texts that CSV readers of data frames take for missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def text_of(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def trim_space(c: Column) -> Column:
    """Strips every kind of white space, not only U+0020."""
    return F.regexp_replace(c, f"^[{U.SPACE}]+|[{U.SPACE}]+$", "")


def collapse(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, f"[{U.SPACE}]+", " "))


def words(c: Column) -> Column:
    """The words of a text whose white space is single spaces."""
    return F.filter(F.split(c, " "), lambda w: w != "")


def _mapped(c: Column, table: dict[str, str]) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), c), c)


def strip_marks(c: Column) -> Column:
    """Compatibility decomposition without combining marks."""
    source, target, several = U.tables()
    syllables, first, second, third = U.hangul()
    to_several = F.from_json(F.lit(U.several_json()), "map<string,string>")

    def one(x: Column) -> Column:
        letters = F.concat(*(F.translate(x, syllables, to) for to in (first, second, third)))
        return F.when(x.between(U.HANGUL_FIRST, U.HANGUL_LAST), letters).otherwise(
            F.coalesce(F.try_element_at(to_several, x), F.translate(x, source, target)))

    # Deleting what becomes several characters is the cheap way to look for it.
    has_several = F.translate(c, "".join(several) + syllables, "") != c
    return (
        F.when(~c.rlike(r"[^\x00-\x7f]"), c)
        .when(has_several, F.array_join(F.transform(F.split(c, ""), one), ""))
        .otherwise(F.translate(c, source, target))
    )


def normalise(c: Column) -> Column:
    """Marks off, ``&`` to ``and``, lower case, all but letters and digits to
    single spaces."""
    lowered = F.lower(F.replace(strip_marks(text_of(c)), F.lit("&"), F.lit(" and ")))
    # The class with newer letters is long: only texts beyond U+086F need it.
    newer = c.cast("string").rlike(r"[^\x00-\x{86f}]")
    spaced = F.when(newer, F.regexp_replace(lowered, f"[^{U.LETTER}]+", " ")).otherwise(
        F.regexp_replace(lowered, r"[^\p{L}\p{N}]+", " "))
    return F.trim(spaced)


normalise_name = normalise
normalise_country = normalise
normalise_optional = normalise


def is_missing(c: Column) -> Column:
    return c.isNull() | (trim_space(text_of(c)) == "")


def tokens(c: Column) -> Column:
    return words(normalise(c))


_DOTTED = r"(?<![^ ])(?:(l) (l) (c)|(p) (l) (c)|(p) (c)|(l) (l) (p))(?![^ ])"


def expand_legal_words(normal: Column) -> Column:
    """Company forms of a normalised name, spelt out; ``l l c`` is ``llc``."""
    joined = F.regexp_replace(normal, _DOTTED, "".join(f"${k}" for k in range(1, 12)))
    return F.array_join(F.transform(words(joined), lambda w: _mapped(w, LEGAL_FORMS)), " ")


def expand_address_words(normal: Column) -> Column:
    return F.array_join(F.transform(words(normal), lambda w: _mapped(w, ADDRESS_WORDS)), " ")


def normalise_legal(c: Column) -> Column:
    return expand_legal_words(normalise(c))


normalise_name_full = normalise_legal


def normalise_address(c: Column) -> Column:
    return expand_address_words(normalise(c))


def normalised_record(name: Column, address: Column, country: Column) -> Column:
    return F.struct(
        normalise_legal(name).alias("business_name"),
        normalise_address(address).alias("business_address"),
        normalise_country(country).alias("country"),
    )


def country_key(c: Column, na_mode: str = "text") -> Column:
    """Trimmed and lower case; punctuation stays.  ``na_mode='nan'`` turns null
    into the text ``nan``, as readers that infer types do."""
    missing = {"text": "", "nan": "nan"}[na_mode]
    return F.lower(trim_space(F.coalesce(c.cast("string"), F.lit(missing))))


def missing_texts_to_null(c: Column) -> Column:
    return F.when(~c.isin(*MISSING_TEXTS), c)


def first_word_of(legal: Column) -> Column:
    """The first word of an expanded name that is long and telling enough."""
    telling = F.filter(words(legal), lambda w: (F.length(w) >= MIN_WORD) & ~w.isin(*GENERIC_WORDS))
    return F.coalesce(F.get(telling, F.lit(0)), F.lit(""))


def first_name_word(c: Column) -> Column:
    return first_word_of(normalise_legal(c))


first_name_word_legal = first_name_word
legal_name = normalise_legal


def prefix_of(normal: Column, length: int = 4) -> Column:
    joined = F.replace(normal, F.lit(" "), F.lit(""))
    return F.when(F.length(joined) >= length, F.substring(joined, 1, length)).otherwise(F.lit(""))


def name_prefix(c: Column, length: int = 4) -> Column:
    return prefix_of(normalise(c), length)


def address_words_of(address: Column) -> Column:
    """Distinct words of a normalised address of three letters or more, in order."""
    return F.array_distinct(F.filter(words(address), lambda w: F.length(w) >= MIN_WORD))


def address_words(c: Column) -> Column:
    return address_words_of(normalise_address(c))


# -- the exact matcher's own rules -----------------------------------------

_EDGE = f"[{U.LETTER}_]"
_NULL_WORDS = f"(?<!{_EDGE})(?:null|nan|none)(?!{_EDGE})"


def exact_rules(composed: Column) -> Column:
    """Lower case, words for null and punctuation to single spaces; ``composed``
    is in compatibility composed form."""
    lowered = F.lower(text_of(composed))
    return collapse(F.regexp_replace(F.regexp_replace(lowered, _NULL_WORDS, " "), r"\p{P}", " "))


def strip_trailing_forms(normal: Column) -> Column:
    forms = "|".join((*TRAILING_FORMS, "s a s"))
    return F.regexp_replace(normal, rf"(?:^|\s+)(?:{forms})(?:\s+(?:{forms}))*$", "")


def composed(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``columns`` in compatibility composed form (NFKC).

    Composition depends on neighbours, so rows with a character beyond ASCII go
    through an Arrow UDF; all others, as most are, stay in the JVM.
    """
    text = F.concat_ws("", *(F.col(c).cast("string") for c in columns))
    wide = text.rlike(r"[^\x00-\x7f]")

    def nfkc(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for c in columns:
                frame[c] = frame[c].map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))
            yield frame

    whole = df.withColumns({c: F.col(c).cast("string") for c in columns})
    return whole.filter(~wide).unionByName(whole.filter(wide).mapInPandas(nfkc, whole.schema))


# -- the feature study's and the profile's rules ---------------------------


def study_normalise(c: Column) -> Column:
    """Lower case, all but ASCII letters and digits to single spaces."""
    return F.trim(F.regexp_replace(F.lower(text_of(c)), "[^a-z0-9]+", " "))


def study_tokens(c: Column) -> Column:
    return F.array_distinct(words(study_normalise(c)))


def profile_clean(c: Column) -> Column:
    """Lower case and single spaces; punctuation stays."""
    return F.lower(collapse(text_of(c)))

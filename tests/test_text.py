"""Normal forms: cases built from the rule tables, and properties of results."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from linkloom.functions import text


def run(spark, f, values):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k long, v string")
    return [r[1] for r in sorted(rows.select("k", f(F.col("v"))).collect())]


# -- cases, one per rule ---------------------------------------------------

NORMAL = {
    "ampersand is a word": ("Quill&Fern", "quill and fern"),
    "marks come off": ("Żółw, Ñandú", "zołw nandu"),
    "compatibility forms": ("ﬂ ¾ ⑦ ㎝", "fl 3 4 7 cm"),
    "underscore is no letter": ("left__right_", "left right"),
    "only signs": ("-- / !!", ""),
    "white space of every kind": ("　wide gap\x1f\x85", "wide gap"),
    "other scripts stay": ("Σίγμα дом", "σιγμα дом"),
}


@pytest.mark.parametrize("case", NORMAL)
def test_normal_form(spark, case):
    value, want = NORMAL[case]
    assert run(spark, text.normalise, [value]) == [want]


def test_every_legal_form_is_spelt_out(spark):
    short = sorted(text.LEGAL_FORMS)
    values = [f"Quillon & Reyes {w.upper()}." for w in short]
    assert run(spark, text.normalise_legal, values) == [f"quillon and reyes {text.LEGAL_FORMS[w]}" for w in short]


@pytest.mark.parametrize("letters", ["llc", "plc", "llp", "pc"])
def test_dotted_forms_are_one_word(spark, letters):
    dotted, spaced = ".".join(letters.upper()) + ".", " ".join(letters)
    got = run(spark, text.normalise_legal, [f"Oxbow {dotted}", f"oxbow {spaced} east", f"oxbow {letters}", f"x{spaced}"])
    assert got == [f"oxbow {letters}", f"oxbow {letters} east", f"oxbow {letters}", text.LEGAL_FORMS.get(f"x{spaced}", f"x{spaced}")]


def test_every_address_word_is_spelt_out(spark):
    short = sorted(text.ADDRESS_WORDS)
    values = [f"{k}-B Heron {w.title()}., Lot {w}" for k, w in enumerate(short)]
    want = [f"{k} b heron {text.ADDRESS_WORDS[w]} lot {text.ADDRESS_WORDS[w]}" for k, w in enumerate(short)]
    assert run(spark, text.normalise_address, values) == want


def test_null_is_empty_everywhere(spark):
    for f in (text.normalise, text.normalise_legal, text.normalise_address, text.normalise_country, text.country_key,
              text.first_name_word, text.name_prefix, text.study_normalise, text.profile_clean):
        assert run(spark, f, [None, ""]) == ["", ""]
    for f in (text.tokens, text.address_words, text.study_tokens):
        assert run(spark, f, [None]) == [[]]
    assert run(spark, text.is_missing, [None, "", "\t　 ", ".", "0"]) == [True, True, True, False, False]


def test_countries(spark):
    values = ["  Côte d'Ivoire ", "\tKORea, rep.", None]
    assert run(spark, text.country_key, values) == ["côte d'ivoire", "korea, rep.", ""]
    assert run(spark, text.normalise_country, values) == ["cote d ivoire", "korea rep", ""]
    assert run(spark, lambda c: text.country_key(c, "nan"), values)[2] == "nan"


def test_first_telling_word(spark):
    telling = [w for w in ("quillon", "reyes") if w not in text.GENERIC_WORDS]
    values = [f"{w} {telling[0]}" for w in text.GENERIC_WORDS if w not in text.LEGAL_FORMS]
    assert set(run(spark, text.first_name_word, values)) == {telling[0]}
    # A form that is spelt out to a word off the list tells again.
    spelt = [w for w in text.LEGAL_FORMS if text.LEGAL_FORMS[w] not in text.GENERIC_WORDS]
    assert run(spark, text.first_name_word, spelt) == [text.LEGAL_FORMS[w] for w in spelt]
    assert run(spark, text.first_name_word, ["ab cd", "ab reyes-quillon"]) == ["", "reyes"]


def test_prefixes_and_address_words(spark):
    assert run(spark, text.name_prefix, ["q u-i L", "qui", "Quillon"]) == ["quil", "", "quil"]
    assert run(spark, text.address_words, ["7 Heron Ln. heron LANE 12b, lot"]) == [["heron", "lane", "12b", "lot"]]


def test_study_and_profile_forms(spark):
    assert run(spark, text.study_normalise, ["Größe_7: Zwölf!"]) == ["gr e 7 zw lf"]
    assert run(spark, text.study_tokens, ["fern Fern, quill"]) == [["fern", "quill"]]
    assert run(spark, text.profile_clean, ["\n Fern;   Quill "]) == ["fern; quill"]


def test_record_and_missing_texts(spark):
    rows = spark.createDataFrame([("Oxbow Corp", "9 Heron Blvd", " Peru "), (None, None, None)], "n string, a string, c string")
    found = rows.select(text.normalised_record(F.col("n"), F.col("a"), F.col("c")).alias("r")).select("r.*").collect()
    assert {tuple(r) for r in found} == {("oxbow corporation", "9 heron boulevard", "peru"), ("", "", "")}
    values = [*text.MISSING_TEXTS, "na", " ", "0"]
    assert run(spark, text.missing_texts_to_null, values) == [None] * len(text.MISSING_TEXTS) + ["na", " ", "0"]


# -- properties of random texts --------------------------------------------


def random_texts(seed, n):
    rng = random.Random(seed)
    pools = ["abcXYZ 019 &_.,'", "éèüñßÅçøŁıſ", "ﬁ½①㎏ﷺ", "각힣가나", "हिन्दी", "漢字かなｶﾅ", "\t  \x1c\x85", "😀🏽‍", "ࡰ\U00010570\U00012f90"]
    return ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def kept_character(c):
    """What one character of a text may leave in its normal form."""
    parts = (x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
    return "".join("and" if x == "&" else y if y.isalnum() else " " for x in parts for y in x.lower() if not unicodedata.combining(y))


def test_normal_form_has_the_letters_of_the_text(spark):
    values = random_texts(1, 1500)
    found = run(spark, text.normalise, values)
    for value, got in zip(values, found, strict=True):
        assert got.replace(" ", "") == "".join(map(kept_character, value)).replace(" ", "")
        assert got == " ".join(got.split(" ")) and got.strip() == got
        assert all(c == " " or c.isalnum() for c in got)
    # Gaps: a space stands exactly where something other than letters and digits stood.
    gaps = [len("".join(" and " if c == "&" else kept_character(c) for c in v).split()) for v in values]
    assert [len(g.split()) for g in found] == gaps
    assert run(spark, text.normalise, found) == found


def test_every_character_that_decomposes(spark):
    chars = [chr(c) for c in range(0x20, 0x30000) if not 0xD800 <= c <= 0xDFFF and unicodedata.normalize("NFKD", chr(c)) != chr(c)]
    want = ["".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)) for c in chars]
    assert run(spark, text.strip_marks, chars) == want


FORMS = ["l", "c", "p", "s", "a", "inc", "ltd", "x", "llc", "pvt", "sa"]


def random_names(seed, n):
    rng = random.Random(seed)
    return [" ".join(rng.choice(FORMS) for _ in range(rng.randint(0, 7))) for _ in range(n)]


def test_spelt_out_names_are_stable(spark):
    values = random_names(2, 2000)
    found = run(spark, text.expand_legal_words, values)
    assert run(spark, text.expand_legal_words, found) == found
    for value, got in zip(values, found, strict=True):
        words = got.split()
        assert not set(words) & {k for k, v in text.LEGAL_FORMS.items() if k != v}
        # Spelt-out words put back to letters give the name's own letters.
        short = {v: k for k, v in sorted(text.LEGAL_FORMS.items()) if k in FORMS}
        assert "".join(short.get(w, w) for w in words) == value.replace(" ", "")
        for form in ("l l c", "p l c", "l l p", "p c"):
            assert f" {form} " not in f" {got} "


def test_trailing_forms_come_off_whole(spark):
    values = random_names(4, 2000)
    found = run(spark, text.strip_trailing_forms, values)
    assert run(spark, text.strip_trailing_forms, found) == found
    for value, got in zip(values, found, strict=True):
        rest = value[len(got):].split()
        assert value.startswith(got) and not got.endswith((" ", *(f" {w}" for w in text.TRAILING_FORMS), " s a s"))
        # What came off is made of forms alone: taking single words, then spelt ones, leaves nothing.
        assert not " ".join(w for w in rest if w not in text.TRAILING_FORMS).replace("s a s", "").strip()


def test_exact_rules(spark):
    cases = {
        "nan-Null,NONE": "", "none of it": "of it", "nonexistent nullity": "nonexistent nullity", "é ﬁ": "é fi",
        "a+b $1 & _x_": "a+b $1 x", "énone none é": "énone é", "none_1": "none 1", "(q)—r": "q r", " \t": "",
    }
    # A word for null beside an underscore is part of a longer word.
    cases["none_1"] = "none 1"
    values = list(cases)
    rows = spark.createDataFrame(list(enumerate(values)), "k long, v string")
    found = text.composed(rows, ["v"]).select("k", text.exact_rules(F.col("v"))).collect()
    assert {values[k]: v for k, v in found} == cases


def test_exact_rules_leave_no_punctuation(spark):
    values = random_texts(3, 400)
    rows = spark.createDataFrame(list(enumerate(values)), "k long, v string")
    found = dict(text.composed(rows, ["v"]).select("k", text.exact_rules(F.col("v"))).collect())
    for k, value in enumerate(values):
        got = found[k]
        assert not any(unicodedata.category(c)[0] == "P" for c in got)
        assert got == got.lower() and got == " ".join(got.split()) and not {"null", "nan", "none"} & set(got.split())
        letters = [c for c in unicodedata.normalize("NFKC", value).lower() if c.isalnum()]
        assert [c for c in got if c.isalnum()] == letters


def test_no_python_in_the_plan(spark):
    rows = spark.createDataFrame([("a",)], "v string")
    for f in (text.normalise, text.normalise_legal, text.normalise_address, text.address_words, text.study_normalise):
        assert "Python" not in rows.select(f(F.col("v")))._jdf.queryExecution().toString()

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm import bpe_codec, dac, queries, token_store, wordbpe

BPE = wordbpe.load(queries.VOCABULARY)
SF = "/root/testdata/sf0.001"


def library(text):
    return BPE.library.encode(text, add_special_tokens=False).ids


def codes(text):
    return [i for ids in BPE.encode(text.encode().split()) for i in ids]


def library_codes(text):
    return np.frombuffer(b"".join(BPE.encode_by_library(text.encode().split())), "<u4").tolist()


TRICKY = "ab'sSTrevmldéÉßÜΣσςIİı \n\t\x1c\x85\xa0\x01\x0b\u0301\u0338 <|endoftext|>½²٣漢字éfi!?,.—“”́‍😀ǅʼnƏƁȺ"


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=TRICKY, max_size=40),
                 st.lists(st.sampled_from([*wordbpe.byte_symbols()[:5], "<|endoftext|>", "<|", "|>", "a", " ", "'s", "\x01"]), max_size=12).map("".join)))
def test_codes_equal_the_library(text):
    assert codes(text) == library_codes(text) == library(text)


def test_every_character_of_the_basic_plane_inside_a_word():
    # A thousand characters to a text: alone, between letters, beside an apostrophe and doubled.
    every = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    for lo in range(0, len(every), 1000):
        text = " ".join(f"a{c}b {c}b a{c} {c}{c} '{c} {c}'s 1{c} {c}" for c in every[lo : lo + 1000])
        want = library(text)
        assert codes(text) == want
        assert library_codes(text) == want
    for text in ("ƏLİ VƏ", "ƁALA", "Heydar Əliyev was born"):
        assert codes(text) == library_codes(text) == library(text)


def test_control_tokens_in_text():
    for text in ("<|endoftext|>", "a<|endoftext|><|startoftext|> b", "<|endof text|>", "<|EndOfText|>"):
        ids = library(text)
        assert codes(text) == library_codes(text) == ids
        assert BPE.decode(ids) == BPE.library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("n", [1, 2, 3, 63, 64, 65, 500, 20_000])
def test_long_words_merge_alike(n):
    rng = random.Random(n)
    word = "".join(rng.choice("abcdefghij") for _ in range(n))
    assert BPE.merge([word.encode()])[0] == BPE.merge_long(BPE.symbols(word.encode())) == library(word)


def test_repeated_letters_merge_from_the_left():
    for word in ("a" * 7, "a" * 64, "l" * 65, "th" * 40, "aaab" * 30):
        assert BPE.merge([word.encode()])[0] == library(word)


def test_memory_forgets_but_stays_right():
    memory = wordbpe.Remembered(lambda ws: [w.upper() for w in ws], len, 1000)
    rng = random.Random(3)
    for _ in range(50):
        docs = [[bytes([rng.choice(b"abcdefghijklx")]) * rng.choice([1, 2, 90]) for _ in range(rng.randint(0, 9))] for _ in range(3)]
        assert memory.look(docs) == [[w.upper() for w in d] for d in docs]
        assert all(len(w) <= wordbpe.LONGEST for w in memory.young)
        assert sum(150 + 2 * len(w) for w in memory.young) == memory.held <= 1000 + 27 * 400


def test_words_are_made_of_their_parts():
    """A word that differs from one before in case or in the punctuation behind it asks nothing of the library."""
    asked = []
    memory = wordbpe.remembered_parts(lambda ws: asked.extend(ws) or BPE.encode_by_library(ws))
    rng = random.Random(9)
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    cores = ["a", "Word", "WORD", "é", "Straße", "don't", "it's", "x1", "1", "K", "a\u0301", "a\u0338", "’s", "<|endoftext|>a", "<|", "ΑΣ", "İi"]
    words = [c + m + n for c in cores for m in ["", *marks] for n in ["", rng.choice(marks), "'s", "a", "\u0338"]]
    words += [m + c + n for c in cores for m in marks for n in ["", m, "..."]] + ["".join(rng.choices(marks, k=4)) for _ in range(300)]
    for lo in range(0, len(words), 97):
        own = words[lo : lo + 97]
        found = memory.look([[w.encode() for w in own]])[0]
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == [library(w) for w in own]
    assert len(asked) == len(set(asked)) < len(set(words))
    asked.clear()
    memory.look([[b"Lower", b"lower,", b"LOWER.)", b"lower,"]])
    assert set(asked) - {b",", b".)"} == {b"lower"}


def test_long_texts_come_in_windows(monkeypatch):
    monkeypatch.setattr(wordbpe, "WINDOW", 50)
    rng = random.Random(4)
    texts = [None, b"", b"x" * 300, b" ".join(rng.choice([b"ab", b"c" * 70, b"", b"\n"]) for _ in range(400)), b" a", b"b "]
    memory = wordbpe.Remembered(lambda ws: ws, len)
    found = {}
    for row, words in wordbpe.looked_up(memory, texts):
        assert sum(map(len, words)) <= 400
        found.setdefault(row, []).extend(words)
    assert found == {k: (t or b"").split() for k, t in enumerate(texts)}


def test_unspaced_text_and_marks():
    text = "漢字" * 3000 + " " + "ab1" * 4000 + " \x01 a\x01 <|endoftext|>x"
    assert codes(text) == library_codes(text) == library(text)


def test_encode_and_decode_round_trip(spark):
    texts = ["", None, "Hello, World's end!", "É" * 300, "x " * 5000, "a\x00b"]
    docs = spark.createDataFrame([(k, t, "n") for k, t in enumerate(texts)], "doc_id long, text string, N_Tokens string")
    encoded = bpe_codec.bpe_encode(docs, queries.VOCABULARY)
    assert encoded.columns == ["doc_id", "text", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    for row in bpe_codec.bpe_decode(encoded, queries.VOCABULARY).collect():
        ids = BPE.library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["decoded"] == BPE.library.decode(ids, skip_special_tokens=False)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500), st.integers(0, 31))
def test_directly_addressable_codes(values, shift):
    ids = (np.array(values, dtype=np.uint32) >> np.uint32(shift)).astype(np.uint32)
    cut = len(ids) // 3
    image = dac.Image(dac.pack(ids, [5, None], [cut, len(ids) - cut]))
    assert image.all().tolist() == ids.tolist()
    assert image.doc_ids == [5, None] and image.starts.tolist() == [0, cut]
    assert [image[i] for i in range(0, len(ids), 7)] == ids[::7].tolist()
    with pytest.raises(IndexError):
        image[len(ids)]


def test_token_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "IMAGE_TOKENS", 50)
    rows = [(k, f"word{k} " * (k % 9)) for k in range(40)] + [(100, None), (99, "")]
    path = str(tmp_path / "tokens")
    token_store.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, queries.VOCABULARY, 2)
    found = {r["doc_id"]: r for r in token_store.read_documents(spark, path).collect()}
    start, every = 0, []
    for doc_id, text in sorted(rows):
        ids = [*BPE.library.encode(text or "", add_special_tokens=False).ids, 2]
        row = found[doc_id]
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
        every += ids
    for at in (0, 77, len(every) - 1):
        assert token_store.token_at(spark, path, at) == every[at]
    assert token_store.token_at(spark, path, len(every)) is None


def test_token_files_of_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    token_store.write_tokens(spark.createDataFrame([], "doc_id long, text string"), path, queries.VOCABULARY, 2)
    assert token_store.read_documents(spark, path).count() == 0


def test_queries_equal_the_library_over_documents(spark):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    files = {r["doc_id"]: r for r in queries.op3_token_files(spark, SF).collect()}
    coded = {r["doc_id"]: r for r in queries.op9_bpe_codec(spark, SF).collect()}
    assert len(files) == len(coded) == len(docs)
    start = 0
    for doc_id, text in docs:
        ids = library(text)
        of = files[doc_id]
        assert (of["start"], of["n_tokens"]) == (start, len(ids) + 1)
        assert of["ids_crc32"] == zlib.crc32(np.array([*ids, 2], "<u4").tobytes())
        start += len(ids) + 1
        one = coded[doc_id]
        assert one["n_tokens"] == len(ids)
        assert one["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = BPE.library.decode(ids, skip_special_tokens=False)
        assert one["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_repeats_null_ids_and_clashing_names(spark):
    rows = [(7, "one two", "x"), (7, "one two", "x"), (7, "other", "x"), (None, "a", "x"), (None, "b", "x"), (1, "\xa0", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Ids_SHA256 string")
    found = bpe_codec.bpe_encode(docs, queries.VOCABULARY, with_ids=False)
    assert found.columns == ["doc_id", "text", "n_tokens", "ids_sha256", "decoded_sha256"] and found.count() == 6
    for r in found.collect():
        ids = library(r["text"])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    odd = docs.selectExpr("doc_id", "text", "1 AS id", "2 AS part", "3 AS image", "4 AS __text")
    path = queries.common.new_path(spark, "tokens")
    token_store.write_tokens(odd, path, queries.VOCABULARY, 2)
    got = token_store.read_documents(spark, path).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"]) for r in got) == sorted(
        (d is not None, d or 0, len(library(t)) + 1) for d, t, _ in rows)
    assert sorted(r["start"] for r in got)[0] == 0
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in ordered[1:]] == list(np.cumsum([r["n_tokens"] for r in ordered])[:-1])
    assert [r["doc_id"] for r in ordered] == [None, None, 1, 7, 7, 7]

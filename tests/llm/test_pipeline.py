import hashlib
import math
import os
from fractions import Fraction

import corpus_pipeline
import pytest
from linkloom.llm import bpe_codec, common, mixing, queries, quality, simhash, wordbpe

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_mix(docs):
    """The ids in the order of the mix: blocks of every source, earliest deadline first."""
    pools = {}
    for doc_id, source in docs:
        pool = source if source in queries.MIX_WEIGHTS else mixing.POOL
        pools.setdefault(pool, []).append((hashlib.md5(str(doc_id).encode()).hexdigest(), doc_id))
    size, of = queries.MIX_BLOCK, {**queries.MIX_WEIGHTS, mixing.POOL: queries.MIX_REST}
    blocks = {p: [sorted(rows)[k : k + size] for k in range(0, len(rows), size)] for p, rows in pools.items()}
    fluid = lambda v: sum(min(of[p] * v, len(b)) for p, b in blocks.items())
    jobs = {(p, k): (math.floor(fluid(Fraction(k, of[p]))), math.ceil(fluid(Fraction(k + 1, of[p])))) for p in blocks for k in range(len(blocks[p]))}
    out, slot = [], 0
    while jobs:
        _, pool, k = min((d, p, k) for (p, k), (r, d) in jobs.items() if r <= slot)
        out += [doc_id for _, doc_id in blocks[pool][k]]
        del jobs[pool, k]
        slot += 1
    return out


def test_pipeline_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = queries.quality_model(spark, docs, SF)
    rows = [r.asDict() for r in docs.collect()]
    kept = [r for r, s in zip(rows, model.score([(r["text"] or "").encode() for r in rows]), strict=True) if s >= 0.5]
    largest = {}
    for r in kept:
        norm = (r["text"] or "").translate(LOWER)
        largest[norm] = max(largest.get(norm, -1), r["doc_id"])
    kept = [r for r in kept if largest[(r["text"] or "").translate(LOWER)] == r["doc_id"]]
    prints = {r["doc_id"]: simhash.fingerprint((r["text"] or "").encode()) for r in kept}
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    kept = {r["doc_id"]: r for r in kept if find(r["doc_id"]) == r["doc_id"]}

    found = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(kept)
    assert 0 < len(found) < len(rows)
    order = plain_mix([(d, r["source"]) for d, r in kept.items()])
    assert [r["doc_id"] for r in sorted(found, key=lambda r: (r["mix_file"], r["mix_row"]))] == order
    bpe = wordbpe.load(queries.VOCABULARY)
    for r in found:
        ids = bpe.library.encode(kept[r["doc_id"]]["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == docs.columns
        now = common.written(now, "test")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "mixing sources", "BPE encoding"]


def test_stages_take_nulls_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, "", "en", None, 0), (10**9, "", "en", None, 0)], docs.schema)
    for rows in (docs.limit(0), odd):
        now = rows
        for _, stage in corpus_pipeline.STAGES:
            now = common.written(stage(spark, now, SF), "test")
        assert now.count() <= rows.count()


def test_stages_take_clashing_names_repeats_and_long_texts(spark):
    base = " ".join(f"w{k}" for k in range(300))
    rows = [(1, base), (1, base), (1, base + " other"), (2, base.upper()), (3, None), (None, None), (None, base + " more"),
            (4, "long " * 300_000), (4, "long " * 300_000), (5, "漢字" * 100_000)]
    names = ("__hash", "hash", "id", "fp", "score", "predicted", "kept", "pool", "position", "c0", "k0", "own_id", "own_text", "slot")
    docs = spark.createDataFrame([(d, t, "en", "src0", 1, *(f"{n}{d}" for n in names)) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    now = common.written(docs, "test")
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        now = common.written(stage(spark, now, SF), "test")
        assert now.columns == docs.columns
        assert all(r[n] == f"{n}{r['doc_id']}" for r in now.collect() for n in names)
    ids = [r["doc_id"] for r in now.collect()]
    # One row of the near copies of ``base`` and of the empty text, and the two that are like no other.
    assert sorted(i for i in ids if i is not None) == sorted(set(ids) - {None}) and len(ids) == 4
    judged = corpus_pipeline.judge_quality(spark, docs, SF)
    assert judged.columns == docs.columns
    assert all(r[n] == f"{n}{r['doc_id']}" for r in judged.collect() for n in names)
    assert corpus_pipeline.encode(spark, now, SF).count() == 4


def test_tables_of_stages_are_dropped(spark):
    folder = common._own_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    corpus_pipeline.run(spark, SF).count()
    left = sorted(n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before)
    assert left in (["stage3"], ["scratch", "stage3"])


def test_shared_folder_is_named_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):  # noqa: N802
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        common.shared_folder(Session())
    Context.master = "local[4]"
    Session.conf = type("Conf", (dict,), {"set": dict.__setitem__})()
    assert common.shared_folder(Session()).startswith("file://")


def test_stage_modules_are_the_operators():
    assert corpus_pipeline.ORACLE_SQL is None
    assert all(m.__name__.startswith("linkloom.llm.") for m in (bpe_codec, mixing, quality, simhash))

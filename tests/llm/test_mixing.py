import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from linkloom.llm import common, mixing


def plain_schedule(pools):
    """Earliest deadline first over all slots, from exact windows."""

    def fluid(v):
        return sum(min(a * v, n) for a, n in pools.values())

    jobs = {}
    for pool, (a, n) in pools.items():
        for k in range(n):
            jobs[pool, k] = (fluid(Fraction(k, a)).__floor__(), fluid(Fraction(k + 1, a)).__ceil__())
    slots, left = {}, dict(jobs)
    for t in range(len(jobs)):
        ready = [(d, pool, k) for (pool, k), (r, d) in left.items() if r <= t]
        _, pool, k = min(ready)
        slots[pool, k] = t
        del left[pool, k]
    return jobs, slots


@pytest.mark.parametrize("pools", [
    {"a": (3, 10), "b": (2, 4), "c": (1, 9)},
    {"a": (1, 1)},
    {"a": (7, 30), "b": (7, 2), "c": (5, 11), "d": (1, 1), "e": (1, 6)},
    {"a": (1, 5), "b": (1, 5), "c": (1, 5)},
    {"a": (2, 3), "b": (3, 0)},
])
def test_schedule_is_earliest_deadline_first(spark, pools):
    frame = spark.createDataFrame([(p, a, n) for p, (a, n) in pools.items()], "pool string, a long, n long")
    jobs, slots = plain_schedule(pools)
    found = {(r["pool"], r["k"]): r for r in mixing.schedule(frame).collect()}
    assert {j: (r["release"], r["deadline"]) for j, r in found.items()} == jobs
    assert {j: r["slot"] for j, r in found.items()} == slots


def test_prefixes_stay_within_a_block_of_the_fluid_schedule(spark):
    pools = {"a": (5, 40), "b": (3, 7), "c": (2, 19), "d": (1, 30)}
    frame = spark.createDataFrame([(p, a, n) for p, (a, n) in pools.items()], "pool string, a long, n long")
    order = [r["pool"] for r in sorted(mixing.schedule(frame).collect(), key=lambda r: r["slot"])]
    assert Counter(order) == {p: n for p, (_, n) in pools.items()}
    served, due = Counter(), dict.fromkeys(pools, Fraction(0))
    for pool in order:
        served[pool] += 1
        step = Fraction(1)
        while step:  # a slot of fluid service, which a source may leave on the way
            open_ = [p for p in pools if due[p] < pools[p][1]]
            total = sum(pools[p][0] for p in open_)
            if not total:
                break
            part = min([step] + [(pools[p][1] - due[p]) * total / pools[p][0] for p in open_])
            for p in open_:
                due[p] += part * pools[p][0] / total
            step -= part
        assert all(abs(served[p] - due[p]) < 1 for p in pools)


def test_every_row_has_one_position(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice(["hot"] * 5 + ["x", "y", None, "unnamed"]), "old") for k in range(400)]
    rows += [(None, "hot", "old")] * 3 + [(7, rows[7][1], "old")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, source string, SLOT string")
    mixed = mixing.mix(docs, {"hot": 2, "x": 1, "y": 1}, 1, 8)
    assert [c for c in mixed.columns if c.lower() == "slot"] == ["slot"]
    found = mixed.collect()
    assert sorted((str(r["doc_id"]), str(r["source"])) for r in found) == sorted((str(a), str(b)) for a, b, _ in rows)
    assert len({r["position"] for r in found}) == len(rows)
    blocks = defaultdict(list)
    for r in found:
        assert r["pool"] == (r["source"] if r["source"] in ("hot", "x", "y") else mixing.POOL)
        assert r["release"] <= r["slot"] < r["deadline"] and r["position"] // 8 == r["slot"]
        blocks[r["pool"], r["block"]].append(r["slot"])
    assert all(len(set(s)) == 1 and len(s) <= 8 for s in blocks.values())
    sizes = Counter(r["pool"] for r in found)
    for pool, n in sizes.items():
        assert sorted(len(v) for (p, _), v in blocks.items() if p == pool)[-(n // 8):] == [8] * (n // 8)


def test_layout_and_empty_table(spark):
    docs = spark.createDataFrame([(k, "a" if k % 3 else "b") for k in range(50)], "doc_id long, source string")
    laid = mixing.in_order(mixing.mix(docs, {"a": 1, "b": 1}, 1, 4)).collect()
    assert [r["position"] for r in laid] == sorted(r["position"] for r in laid)
    assert mixing.mix(docs.limit(0), {"a": 1}, 1, 4).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 0})


def test_names_cannot_clash_and_buckets_grow(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    names = ("__hash", "__id", "hash", "id", "k", "k0", "bucket", "first", "place", "inner", "tie")
    docs = spark.createDataFrame([(k, "a" if k % 3 else "b", *(f"{n}{k}" for n in names)) for k in range(300)],
                                 "doc_id long, source string, " + ", ".join(f"`{n}` string" for n in names))
    found = mixing.mix(docs, {"a": 2, "b": 1}, 1, 4).collect()
    assert len({r["position"] for r in found}) == 300
    assert all(r[n] == f"{n}{r['doc_id']}" for r in found for n in names)


def test_no_array_enters_the_window(spark):
    docs = spark.createDataFrame([(k, "a") for k in range(50)], "doc_id long, source string")
    plan = mixing.mix(docs, {"a": 1})._jdf.queryExecution().optimizedPlan()

    def nodes(node):
        yield node
        for k in range(node.children().size()):
            yield from nodes(node.children().apply(k))

    windows = [n for n in nodes(plan) if n.nodeName() == "Window"]
    assert windows and all("array" not in n.children().apply(0).schema().simpleString() for n in windows)


def test_files_keep_the_order(spark):
    docs = spark.createDataFrame([(k, "a" if k % 3 else "b") for k in range(2000)], "doc_id long, source string").repartition(4)
    mixed = mixing.mix(docs, {"a": 1, "b": 1}, 1, 4)
    want = [r["doc_id"] for r in sorted(mixed.collect(), key=lambda r: r["position"])]
    laid = common.written(mixing.in_order(mixed).select("doc_id", "source"), "laid")
    rows = laid.select("doc_id", *mixing.place_in_files(laid)).collect()
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: (r["mix_file"], r["mix_row"]))] == want
    loose = docs.select("doc_id", *mixing.place_in_files(docs)).first()
    assert loose["mix_file"] is None and loose["mix_row"] is None


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, source string")
    plan = mixing.mix(docs, {"a": 1})._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan

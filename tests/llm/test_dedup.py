import hashlib
import random
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from linkloom.llm import exact_dedup, simhash
from linkloom.llm.components import connected

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected_exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for doc_id, text in rows:
        norm = (text or "").translate(LOWER)
        known = [d for d in groups[norm] if d is not None]
        keep = max(known) if known else None
        out.append((doc_id, keep, len(groups[norm]), doc_id == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return out


ROWS = [(1, "Same"), (2, "sAME"), (3, "same "), (4, None), (5, ""), (6, "É"), (7, "é"), (8, "x" * 100_000), (9, "X" * 100_000),
        (None, "same"), (None, "alone"), (10, "again"), (10, "again")]


def key(row):
    return tuple((x is None, str(x)) for x in row)


def test_exact_groups(spark):
    docs = spark.createDataFrame([(d, t, "mine") for d, t in ROWS], "doc_id long, text string, KEPT string")
    found = exact_dedup.exact_dedup(docs, keep=["doc_id"])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected_exact(ROWS), key=key)
    whole = exact_dedup.exact_dedup(docs).select("doc_id", *exact_dedup.MADE)  # hashed with the texts, not from a table
    assert sorted(map(tuple, whole.collect()), key=key) == sorted(expected_exact(ROWS), key=key)
    assert exact_dedup.exact_dedup(docs).columns == ["doc_id", "text", "keep_id", "group_size", "kept", "text_sha256"]


def test_hash_collisions_join_nothing(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    found = exact_dedup.exact_dedup(docs, keep=["doc_id"], hash_fn=lambda c: F.lit("same hash"))
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected_exact(ROWS), key=key)


CLASHES = ("__hash", "__size", "__norm", "__id", "__same", "fp", "id", "row", "hash", "sha", "best", "size", "k0", "root", "own_id")


def test_no_name_of_the_callers_clashes(spark):
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    docs = spark.createDataFrame([(d, t, *(f"{c}{d}" for c in CLASHES)) for d, t in ROWS[:7]], schema)
    for found in (exact_dedup.exact_dedup(docs), exact_dedup.first_copies(docs), simhash.near_duplicates(docs), simhash.first_of_groups(docs)):
        rows = found.collect()
        assert found.columns[: len(CLASHES) + 2] == docs.columns
        assert rows and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in CLASHES)
    assert exact_dedup.exact_dedup(docs).count() == simhash.near_duplicates(docs).count() == 7


def test_one_row_of_every_text(spark):
    rows = [*ROWS, (2, "SAME"), (9, "X" * 100_000), (None, "alone"), (4, None)]
    docs = spark.createDataFrame([(d, t, k) for k, (d, t) in enumerate(rows)], "doc_id long, text string, k int")
    found = exact_dedup.first_copies(docs)
    assert found.columns == docs.columns
    want = {}
    for d, t in rows:
        norm = (t or "").translate(LOWER)
        want[norm] = max(want.get(norm, -1), -1 if d is None else d)
    got = [((r["text"] or "").translate(LOWER), -1 if r["doc_id"] is None else r["doc_id"]) for r in found.collect()]
    assert sorted(got) == sorted(want.items())
    assert exact_dedup.first_copies(docs.limit(0)).count() == 0


def test_one_row_of_every_group(spark):
    base = " ".join(f"w{k}" for k in range(400))
    rows = [(5, base), (6, base + " tail"), (5, base + " other tail"), (None, base + " end"), (7, None), (None, ""), (8, " \n"),
            (None, "words of their own here"), (None, "words of their own here"), (12, "yet other words entirely in this")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r["doc_id"], r["text"]) for r in simhash.first_of_groups(docs).collect()]
    assert sum(d == 5 for d, _ in found) == 1 and not any(d in (6, 8) for d, _ in found)
    assert sorted((d is None, d or 0) for d, _ in found) == [(False, 5), (False, 7), (False, 12), (True, 0), (True, 0)]
    assert simhash.first_of_groups(docs.limit(0)).count() == 0


def test_only_repeated_texts_are_shuffled(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    texts = docs.select(F.col("doc_id").alias("id"), exact_dedup.normalised(F.col("text")).alias("norm")).withColumn(
        "hash", exact_dedup.hash128(F.col("norm")))
    grouped = exact_dedup.groups_of(texts, texts.select("hash"))
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    # The texts meet the repeated hashes, a table whose size Spark knows, before any shuffle.
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert plan.index("LeftSemi") > plan.index("HashAggregate") and "SortMergeJoin" not in plan


def test_smallest_id_and_empty_table(spark):
    docs = spark.createDataFrame([(3, "a"), (2, "A")], "doc_id long, text string")
    assert {r["keep_id"] for r in exact_dedup.exact_dedup(docs, smallest=True).collect()} == {2}
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_plan_is_native(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    plan = exact_dedup.exact_dedup(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# -- fingerprints ----------------------------------------------------------


def plain_fingerprint(text):
    words = [w for w in (text or "").translate(LOWER).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    rng = random.Random(1)
    for n in (0, 1, 3, 4, 5, 17, 300):
        text = "".join(rng.choice(["Word", "é", "a\xa0b", "X1"]) + rng.choice([" ", "\n", "  ", "\t", "\x0b"]) for _ in range(n))
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \n") == 0


def test_fingerprints_of_long_texts_in_turns(monkeypatch):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["Word", "é", "a\xa0b", "X1", "y" * 90]) + rng.choice([" ", "\n", "  "]) for _ in range(n)) for n in (1, 4, 5, 9, 400)]
    monkeypatch.setattr(simhash.common.windows, "__defaults__", (30,))
    for text in texts:
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_spark_hashes_alike(spark):
    row = spark.sql("SELECT xxhash64('a b c d') AS h").first()
    assert row["h"] % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_visitors_meet_every_home():
    rng = np.random.default_rng(2)
    for width, threshold in ((21, 1), (22, 1), (32, 2), (32, 1), (16, 2)):
        y = rng.integers(0, 1 << width, 60)
        rows, anchors = simhash.visits(y, width, threshold)
        met = set(zip(rows.tolist(), anchors.tolist(), strict=True))
        assert len(met) == len(rows)
        bits = [0, *(1 << np.arange(width)).tolist()]
        flips = {a ^ b for a in bits for b in bits} if threshold == 2 else set(bits)
        for flip in flips:
            x = y ^ flip
            home = simhash._homes(x, width)
            assert all((k, h) in met for k, h in enumerate(home.tolist()))
            assert (np.bitwise_count((home ^ x).astype(np.uint64)) <= width // 15).all()
        # No anchor is visited in vain: each is the home of a value within the threshold.
        homes = {(k, h) for flip in flips for k, h in enumerate(simhash._homes(y ^ flip, width).tolist())}
        assert met == homes


def brute_components(values):
    nodes = sorted(set(values))
    parent = {v: v for v in nodes}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if ((a ^ b) % 2**64).bit_count() <= simhash.LIMIT:
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {v: find(v) for v in nodes}


def close_values(seed, n):
    rng = random.Random(seed)
    values = [rng.getrandbits(64) for _ in range(n // 4)]
    while len(values) < n:
        v = rng.choice(values)
        for b in rng.sample(range(64), rng.randint(1, 7)):
            v ^= 1 << b
        values.append(v)
    return [v - 2**64 if v >= 2**63 else v for v in values]


def check_links(spark, values, blocks=simhash.BLOCKS):
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "doc_id long, fp long")
    found = {r["fp"]: r["component_id"] for r in simhash.components(frame, blocks=blocks).collect()}
    first = {}
    roots = brute_components(values)
    for k, v in enumerate(values):
        first.setdefault(roots[v], k)
    assert found == {v: first[roots[v]] for v in set(values)}


def test_components_equal_brute_force(spark):
    check_links(spark, close_values(5, 600))
    check_links(spark, close_values(8, 300), simhash.WIDE_BLOCKS)


def test_tiles_equal_brute_force(spark, monkeypatch):
    import functools

    # Small limits, so that anchors are dealt out as tiles and batches are cut.
    monkeypatch.setattr(simhash, "TILE", 3)
    values = close_values(6, 200) + [v for v in range(64)]
    keys, roles, fps = simhash.replicate(np.array(sorted(set(values)), dtype=np.int64))
    order = np.lexsort((roles, keys))
    import pyarrow as pa

    def stream(keys, roles, fps, size=37):
        for lo in range(0, len(keys), size):
            yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + size]) for x in (keys, roles, fps)], names=["key", "role", "fp"])

    first = list(simhash.compare(stream(keys[order], roles[order], fps[order]), False))
    rows = [r for b in first for r in b.to_pylist()]
    links = [(r["u"], r["v"]) for r in rows if r["role"] == 2]
    tiles = sorted((r["tile"], r["key"], r["role"], r["u"]) for r in rows if r["role"] < 2)
    assert tiles
    again = stream(*(np.array(x, dtype=t) for x, t in (
        ([t << 40 | k for t, k, _, _ in tiles], np.int64), ([r for _, _, r, _ in tiles], np.int8), ([u for *_, u in tiles], np.int64))))
    links += [(r["u"], r["v"]) for b in simhash.compare(again, True) for r in b.to_pylist()]
    parent = {v: v for v in values}

    def find(v):
        return functools.reduce(lambda v, _: parent[v], range(len(parent)), v)

    for a, b in links:
        assert ((a ^ b) % 2**64).bit_count() <= 64
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    assert {v: find(v) for v in values} == brute_components(values)


def test_near_duplicates_edges(spark):
    base = " ".join(f"w{k}" for k in range(400))
    rows = [(5, base), (6, base + " tail"), (7, None), (8, ""), (9, " \n"), (10, "one two"), (None, base), (11, "x " * 50_000),
            (12, "other words entirely in this text"), (12, "other words entirely in this text")]
    docs = spark.createDataFrame([(d, t, "s") for d, t in rows], "doc_id long, text string, Component_ID string")
    found = simhash.near_duplicates(docs)
    assert found.columns == ["doc_id", "text", "fingerprint", "component_id"]
    got = sorted(map(tuple, found.select("doc_id", "fingerprint", "component_id").collect()), key=key)
    prints = {t: plain_fingerprint(t) for _, t in rows}
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    roots = brute_components([signed(p) for p in prints.values()])
    best = {}
    for d, t in rows:
        if d is not None:
            r = roots[signed(prints[t])]
            best[r] = min(best.get(r, d), d)
    want = sorted([(d, f"{prints[t]:016x}", best[roots[signed(prints[t])]]) for d, t in rows], key=key)
    assert got == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_connected_chain_and_star(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(20, 60)] + [(3, 3)]
    found = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {k: 100 for k in range(101, 141)} | {k: 7 for k in range(20, 60)}
    assert found == want

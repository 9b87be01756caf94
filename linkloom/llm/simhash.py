"""Operator 4: near-duplicates by SimHash fingerprints and anchor points.

A fingerprint has 64 bits; two link when they differ in at most ``LIMIT`` = 4.
The bits form three blocks, so two linked fingerprints differ in at most one
bit of some block.  In every block the anchors are a covering code: a perfect
Hamming code over 15 bits (covering radius 1) next to bits that are taken as
they are.  Each fingerprint has its home at the nearest anchor and visits every
anchor within covering radius plus the block's threshold, 1 + 1 = 2.  If x and
y differ in one bit of the block at most, y is within 2 of x's home, so they
meet there, and all 64 bits are compared.

``WIDE_BLOCKS`` has two blocks of 32 bits, of two coded parts and two free bits
each, and a threshold of 2: about seven times the copies, and a fifteenth of the
comparisons, for tables of more than some hundred million fingerprints.

Equal fingerprints are one node before anything is replicated, and an anchor
yields a spanning forest of its links, never all pairs.  Anchors with more than
``TILE`` homes are dealt out again as tiles of homes by visitors.  Links lead
to components; nothing about all documents goes to the driver.

Null and empty texts have fingerprint zero and link like any other; a text of
any length is read whole, about a megabyte at a time.  Rows that repeat an id
keep their own fingerprint; a component's id is its smallest id that is not
null.  An empty table gives an empty result; private columns are named by
position, so no column of the caller's can clash with them.
"""

from __future__ import annotations

import functools
import itertools
import operator
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import common
from linkloom.llm.components import connected, rejoined

SHINGLE, SEED, LIMIT = 4, 42, 4
#: First bit and width of each block; two linked fingerprints differ in at most
#: ``LIMIT // len(blocks)`` bits of some block.  ``WIDE_BLOCKS`` is the finer cover.
BLOCKS = ((0, 21), (21, 21), (42, 22))
WIDE_BLOCKS = ((0, 32), (32, 32))
Blocks = tuple[tuple[int, int], ...]
_CODED = 15
#: Homes of one anchor that one task holds; rows that are compared at a time.
TILE, ROWS, PAIRS = 16_384, 1 << 17, 1 << 19

_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")
_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


# -- fingerprints ----------------------------------------------------------


def _hashes(words: list[bytes]) -> list[int]:
    """The hash of every ``SHINGLE`` words in a row."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.r_[0, ends[:-SHINGLE]].tolist()
    h = xxhash.xxh64_intdigest
    return [h(joined[a:b], SEED) for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist(), strict=True)]


def fingerprint(text: bytes | None) -> int:
    """A bit is 1 if over half of the shingles' hashes have it.  The text is read
    in turns; the last words of one lead into the next."""
    ones, total = np.zeros(64, np.int64), 0
    words: list[bytes] = []
    for part in common.windows(text or b"", _SPACE):
        words = words[1 - SHINGLE :] + part.lower().split() if total else words + part.lower().split()
        if len(words) >= SHINGLE:
            hashes = _hashes(words)
            parts = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
            ones += np.concatenate([np.bincount(parts[:, k], minlength=256) @ _BIT_OF_BYTE for k in range(8)])
            total += len(hashes)
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED) if words else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, text_col: str = "text", keep: Sequence[str] | None = None, name: str = "fp"
) -> DataFrame:
    """``keep`` (default: all columns) with the fingerprint as a signed long."""

    def make():
        def fn(texts: list) -> list[pa.Array]:
            values = np.array([fingerprint(t) for t in texts], dtype=np.uint64)
            return [pa.array(values.view(np.int64))]

        return fn

    return common.append_from_text(docs, text_col, make, [T.StructField(name, T.LongType())], keep, as_bytes=True)


# -- anchors ---------------------------------------------------------------

#: The syndrome of every value of the coded bits: bit i counts as i + 1.
_SYNDROME = np.zeros(1 << _CODED, dtype=np.int64)
for _i in range(_CODED):
    _SYNDROME[np.arange(1 << _CODED) >> _i & 1 == 1] ^= _i + 1
#: The one bit that leads from there to the nearest codeword.
_CORRECTION = np.r_[0, 1 << np.arange(_CODED)][_SYNDROME]
#: By how many flips beyond the home a codeword is reached, and by syndrome: the
#: flips of the coded bits that lead to those codewords.
_STEPS = [[[] for _ in range(_CODED + 1)] for _ in range(LIMIT)]
for _level in range(LIMIT):
    for _bits in itertools.combinations(range(_CODED), _level + 1):
        _STEPS[_level][functools.reduce(operator.xor, (_i + 1 for _i in _bits))].append(sum(1 << _i for _i in _bits))
_STEPS[0][0] = [0]


def _homes(block: np.ndarray, width: int) -> np.ndarray:
    """The nearest anchor: every coded part at its codeword."""
    for p in range(width // _CODED):
        block = block ^ _CORRECTION[block >> p * _CODED & ((1 << _CODED) - 1)] << p * _CODED
    return block


def visits(block: np.ndarray, width: int, threshold: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and anchors: all homes of the values that differ from each
    value in at most ``threshold`` bits."""
    parts = width // _CODED
    free = [1 << k for k in range(parts * _CODED, width)]
    syndromes = [_SYNDROME[block >> p * _CODED & ((1 << _CODED) - 1)] for p in range(parts)]
    out_rows, out = [], []
    for levels in itertools.product(range(threshold + 1), repeat=parts):
        left = threshold - sum(levels)
        if left < 0:
            continue
        found = [(np.arange(len(block)), block)]
        for p, level in enumerate(levels):
            if not level:
                found = [(rows, at ^ _CORRECTION[at >> p * _CODED & ((1 << _CODED) - 1)] << p * _CODED) for rows, at in found]
                continue
            before, found = found, []
            for rows, at in before:
                for s, steps in enumerate(_STEPS[level]):
                    here = syndromes[p][rows] == s
                    if steps and here.any():
                        own, own_at = rows[here], at[here]
                        found += [(own, own_at ^ step << p * _CODED) for step in steps]
        for n in range(left + 1):
            for bits in itertools.combinations(free, n):
                out_rows += [rows for rows, _ in found]
                out += [at ^ sum(bits) for _, at in found]
    return np.concatenate(out_rows), np.concatenate(out)


def replicate(values: np.ndarray, blocks: Blocks = BLOCKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor key, role (0 home, 1 visitor) and value, for signed longs."""
    bits = values.view(np.uint64)
    keys, roles, out = [], [], []
    for k, (low, width) in enumerate(blocks):
        block = (bits >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64)
        rows, anchors = visits(block, width, LIMIT // len(blocks))
        keys += [_homes(block, width) | k << 32, anchors | k << 32]
        roles += [np.zeros(len(values), np.int8), np.ones(len(rows), np.int8)]
        out += [values, values[rows]]
    return np.concatenate(keys), np.concatenate(roles), np.concatenate(out)


# -- links -----------------------------------------------------------------


def union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of ``a[i]`` and ``b[i]``; ``parent`` names roots only,
    before and after, and a root is the smallest of its tree."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def forest(keys: np.ndarray, roles: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among homes and visitors of the same key; the rows are
    sorted by key, homes first."""
    nodes, node = np.unique(values, return_inverse=True)
    parent = np.arange(len(nodes))
    is_home = roles == 0
    home_key, home_node = keys[is_home], node[is_home]
    home_bits = nodes[home_node].view(np.uint64)
    visitor_key, visitor_node = keys[~is_home], node[~is_home]
    low = np.searchsorted(home_key, visitor_key, "left")
    many = np.searchsorted(home_key, visitor_key, "right") - low
    some = many > 0
    low, many, visitor_node = low[some], many[some], visitor_node[some]
    visitor_bits = nodes[visitor_node].view(np.uint64)
    at = 0
    ends = np.cumsum(many)
    while at < len(many):
        base = ends[at] - many[at]
        to = max(at + 1, int(np.searchsorted(ends, base + PAIRS, "right")))
        n = many[at:to]
        v = np.repeat(np.arange(at, to), n)
        h = np.arange(len(v)) - np.repeat(ends[at:to] - n - base, n) + np.repeat(low[at:to], n)
        near = np.bitwise_count(visitor_bits[v] ^ home_bits[h]) <= LIMIT
        union(parent, visitor_node[v[near]], home_node[h[near]])
        at = to
    linked = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[linked], nodes[parent[linked]]


_LINKS = T.StructType([T.StructField(n, t) for n, t in (
    ("tile", T.IntegerType()), ("key", T.LongType()), ("role", T.ByteType()), ("u", T.LongType()), ("v", T.LongType()))])


def _batch(tile, key, role, u, v) -> pa.RecordBatch:
    n = len(u)
    full = [np.broadcast_to(x, n) if np.ndim(x) == 0 else x for x in (tile, key, role, u, v)]
    kinds = (pa.int32(), pa.int64(), pa.int8(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(x), k) for x, k in zip(full, kinds, strict=True)], names=_LINKS.names)


def _tiles(n_homes: int) -> int:
    return -(-n_homes // TILE)


def _tile_of(values: np.ndarray, tiles: int) -> np.ndarray:
    mixed = values.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
    return 1 + (mixed % np.uint64(tiles)).astype(np.int32)


class _Anchor:
    """The anchor whose rows have not all come: homes, then visitors."""

    def __init__(self, key: int):
        self.key, self.homes, self.tiles = key, [], 0

    def add(self, roles: np.ndarray, values: np.ndarray, final: bool) -> Iterator[pa.RecordBatch]:
        homes, visitors = values[roles == 0], values[roles == 1]
        if len(homes):
            self.homes.append(homes)
        if not len(visitors):
            return
        if not self.tiles:
            self.homes = [np.concatenate(self.homes)] if self.homes else [visitors[:0]]
            self.tiles = 1 if final else _tiles(len(self.homes[0]))
            if self.tiles > 1:
                yield _batch(_tile_of(self.homes[0], self.tiles), self.key, 0, self.homes[0], self.homes[0])
        if self.tiles > 1:
            for t in range(1, self.tiles + 1):
                yield _batch(t, self.key, 1, visitors, visitors)
        elif len(self.homes[0]):
            own = np.concatenate([self.homes[0], visitors])
            u, v = forest(np.full(len(own), self.key), np.repeat([0, 1], [len(self.homes[0]), len(visitors)]), own)
            yield _batch(0, self.key, 2, u, v)


def compare(batches: Iterator[pa.RecordBatch], final: bool) -> Iterator[pa.RecordBatch]:
    """Rows (key, role, u) sorted by key and role to links (role 2), and unless
    ``final`` to the tiles of anchors with too many homes (roles 0 and 1)."""
    held: _Anchor | None = None
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            keys, roles, values = (np.asarray(part.column(k)) for k in range(3))
            if held is not None and keys[0] == held.key:
                n = int(np.searchsorted(keys, held.key, "right"))
                yield from held.add(roles[:n], values[:n], final)
                keys, roles, values = keys[n:], roles[n:], values[n:]
                if not len(keys):
                    continue
            n = int(np.searchsorted(keys, keys[-1], "left"))  # the last key may go on in the next batch
            if n:
                heavy_keys, counts = np.unique(keys[:n][roles[:n] == 0], return_counts=True)
                light = np.ones(n, bool)
                for key in heavy_keys[counts > TILE].tolist():
                    a, b = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                    light[a:b] = False
                    yield from _Anchor(key).add(roles[a:b], values[a:b], final)
                u, v = forest(keys[:n][light], roles[:n][light], values[:n][light])
                yield _batch(0, 0, 2, u, v)
            held = _Anchor(int(keys[-1]))
            yield from held.add(roles[n:], values[n:], final)


def links(nodes: DataFrame, label: str = "simhash", blocks: Blocks = BLOCKS) -> DataFrame:
    """``u, v``: links that connect what is within ``LIMIT`` bits, among the
    distinct longs of column ``fp``."""

    def spread(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                key, role, fp = replicate(np.asarray(batch.slice(lo, 4096).column(0)), blocks)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(role), pa.array(fp)], names=["key", "role", "fp"])

    placed = nodes.select("fp").mapInArrow(spread, "key long, role byte, fp long")
    first = common.written(
        placed.repartition("key").sortWithinPartitions("key", "role").mapInArrow(lambda b: compare(b, False), _LINKS),
        label,
    )
    again = (
        first.filter("role < 2")
        .select("tile", "key", "role", F.col("u").alias("fp"))
        .repartition("key", "tile")
        .sortWithinPartitions("tile", "key", "role")
    )

    def tiles(batches):
        # Within a partition the rows are sorted by tile first, so a key of the
        # next tile starts anew.
        def renamed():
            for b in batches:
                key = np.asarray(b.column(1)) | np.asarray(b.column(0)).astype(np.int64) << 40
                yield pa.RecordBatch.from_arrays([pa.array(key), b.column(2), b.column(3)], names=["key", "role", "fp"])

        return compare(renamed(), True)

    return first.filter("role = 2").select("u", "v").union(again.mapInArrow(tiles, _LINKS).filter("role = 2").select("u", "v"))


def components(
    rows: DataFrame, id_col: str = "doc_id", fp_col: str = "fp", label: str = "simhash", blocks: Blocks = BLOCKS
) -> DataFrame:
    """``fp, component_id, root`` for every distinct fingerprint of ``rows``; a
    root is one of its component's fingerprints."""
    nodes = common.written(
        rows.groupBy(common.quoted(fp_col).alias("fp")).agg(F.min(common.quoted(id_col)).alias("first_id")), label)
    roots = connected(links(nodes, label, blocks), label)
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rejoined(named, smallest, "root").select("fp", "component_id", "root")


def _printed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, row, fp`` of every row.  A row is known by its id and a hash of its
    text, so that rows that repeat an id with another text keep apart and no
    text is fingerprinted twice."""
    rows = docs.select(
        common.quoted(id_col).alias("id"), F.xxhash64(common.quoted(text_col).cast("string")).alias("row"),
        common.quoted(text_col).alias("text"))
    return common.written(fingerprints(rows, "text", ["id", "row"], "fp"), "simhash")


def _known(docs: DataFrame, kept: Sequence[str], id_col: str, text_col: str) -> DataFrame:
    """``kept`` by position, with what knows a row: no name of the caller's is in the way."""
    return docs.select(
        *(common.quoted(c).alias(f"k{i}") for i, c in enumerate(kept)),
        common.quoted(id_col).alias("own_id"), F.xxhash64(common.quoted(text_col).cast("string")).alias("own_row"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] | None = None,
    blocks: Blocks = BLOCKS,
) -> DataFrame:
    """``keep`` (default: all columns) with ``fingerprint`` (16 hex digits) and
    ``component_id``; input columns of these names give way."""
    kept = common.without(docs.columns if keep is None else keep, ["fingerprint", "component_id"])
    slim = _printed(docs, id_col, text_col)
    named = slim.join(components(slim, "id", blocks=blocks), "fp").withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))
    if [c.lower() for c in kept] == [id_col.lower()]:
        return named.select(F.col("id").alias(kept[0]), "fingerprint", "component_id")
    one = named.dropDuplicates(["id", "row"])
    return _known(docs, kept, id_col, text_col).join(
        one, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_row") == F.col("row"))
    ).select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(kept)), "fingerprint", "component_id")


def first_of_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: Blocks = BLOCKS
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of every component the
    smallest id that is not null, of equal ids one text.  Rows that repeat both
    id and text stay or go together."""
    slim = _printed(docs, id_col, text_col)
    named = slim.join(components(slim, "id", blocks=blocks).select("fp", "root"), "fp").select("id", "row", "root").distinct()
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "row")
    first = named.groupBy("root").agg(F.min(order).alias("first")).select("root", "first.id", "first.row")
    others = common.written(
        rejoined(named, first.select("root", F.col("id").alias("first_id"), F.col("row").alias("first_row")), "root")
        .filter(~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("row") == F.col("first_row"))))
        .select("id", "row"), "simhash")
    # The rows that go are a table of their own: where it is small, Spark finds that from its files and broadcasts it.
    return _known(docs, docs.columns, id_col, text_col).join(
        others, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_row") == F.col("row")), "left_anti"
    ).select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)))

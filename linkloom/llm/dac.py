"""Directly addressable codes: integers in levels of one-byte chunks.

Level 0 holds the low byte of every integer; level k holds byte k of those that
need it.  A bitmap per level marks which integers go on, and a rank directory
counts the marks before every 512th bit, so any integer is found from a few
bytes per level without decoding its neighbours.

An image, little-endian: ``LLDAC1``, 2 zero bytes, u64 number of documents,
u64 number of integers, u32 number of levels, u32 zero; i64 id of each document
with a byte each that is 1 for a null id; u64 start of each document; then per level u64 number of chunks, the chunks,
the bitmap (lowest bit first, padded to 64 bytes), and the u64 rank directory.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"LLDAC1\0\0"
STEP = 512  # bits to a directory entry
_HEAD = struct.Struct("<8sQQII")


def pack(ids: np.ndarray, doc_ids: list[int | None], sizes: list[int]) -> bytes:
    """The image of ``ids`` (unsigned 32-bit), cut into documents of ``sizes``."""
    levels, rest = [], np.ascontiguousarray(ids, dtype=np.uint32)
    while True:
        chunks, rest = (rest & 0xFF).astype(np.uint8), rest >> 8
        goes_on = rest > 0
        levels.append((chunks, goes_on))
        if not goes_on.any():
            break
        rest = rest[goes_on]
    starts = np.r_[0, np.cumsum(np.array(sizes, dtype=np.uint64))].astype("<u8")[: len(sizes)]
    out = [
        _HEAD.pack(MAGIC, len(doc_ids), len(ids), len(levels), 0),
        np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes(),
        np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes(),
        starts.tobytes(),
    ]
    for chunks, goes_on in levels:
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.r_[bits, np.zeros(-len(bits) % (STEP // 8), np.uint8)]
        marks = np.bitwise_count(bits).reshape(-1, STEP // 8).sum(1, dtype=np.uint64)
        directory = np.r_[np.zeros(1, np.uint64), np.cumsum(marks, dtype=np.uint64)].astype("<u8")
        out += [struct.pack("<Q", len(chunks)), chunks.tobytes(), bits.tobytes(), directory.tobytes()]
    return b"".join(out)


class Image:
    """A packed image, read in place."""

    def __init__(self, data: bytes):
        magic, docs, self.size, levels, _ = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not an image of directly addressable codes")
        at = _HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found

        ids, null = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if n else int(d) for d, n in zip(ids, null, strict=True)]
        self.starts = take("<u8", docs).astype(np.int64)
        self.levels = []
        for _k in range(levels):
            n = int(take("<u8", 1)[0])
            blocks = -(-n // STEP)
            self.levels.append((take("u1", n), take("u1", blocks * (STEP // 8)), take("<u8", blocks + 1)))

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, i: int) -> int:
        """Integer ``i``, from one chunk and one rank per level."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, directory) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * k
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block, byte = i // STEP, i >> 3
            before = int(np.bitwise_count(bits[block * (STEP // 8) : byte]).sum(dtype=np.int64))
            i = int(directory[block]) + before + (int(bits[byte]) & ((1 << (i & 7)) - 1)).bit_count()
        return value

    def all(self) -> np.ndarray:
        """Every integer, level by level."""
        value = None
        for k, (chunks, bits, _) in reversed(list(enumerate(self.levels))):
            here = chunks.astype(np.uint32)
            if value is not None:
                here[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)] |= value << np.uint32(8)
            value = here
        return value if value is not None else np.zeros(0, np.uint32)

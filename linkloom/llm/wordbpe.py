"""BPE with word ends: merges by a segment tree over adjacent pair ranks.

Each leaf of the tree holds the rank of the pair that starts at its symbol,
each inner node the smaller of its children, so the root names the lowest rank
and, of equal ranks, the leftmost pair.  A merge changes three leaves and the
paths above them.  Words of up to ``BATCHED`` symbols are merged many at a time,
one tree per row of an array; longer ones by the same tree over Python lists.

Texts are cut at ASCII white space, and what is made of each word between is
remembered.  Normal form and splitting of a word are always the library's own.
The cut changes nothing: control tokens hold no white space, canonical
composition and lower case never reach across it, and no alternative of the
splitting pattern matches it.
"""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from tokenizers import Tokenizer

from linkloom.llm import common

#: Words of more symbols get a tree of their own.
BATCHED = 64
#: Bytes that a memory of words holds, per generation (of two), and the length of
#: the longest word that it keeps.
MEMORY, LONGEST = 64 << 20, 64
#: Bytes of text that are lists of words at a time.
WINDOW = 1 << 20
#: Words that are one text for the library.
TOGETHER = 1000
_NONE = np.int64(2**62)
_POS_BITS = 7
_MARK = "\x01"
_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(others)) for b in range(256)]


class WordBpe:
    """A vocabulary file of this kind, its splitting rule and its merges."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = [""] * (max([*vocab.values(), *special.values()]) + 1)
        for t, i in (vocab | special).items():
            self.token[i] = t
        symbols = byte_symbols()
        self.byte_of = {ord(c): b for b, c in enumerate(symbols)}
        self.inner = np.array([vocab[c] for c in symbols], dtype=np.int64)
        self.last = np.array([vocab[c + end] for c in symbols], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.span = len(self.token)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = np.array([vocab[a] * self.span + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.lexsort((-np.arange(len(keys)), keys))  # of a pair listed twice the later rank holds
        first = np.r_[True, np.diff(keys[order]) != 0]
        self.ranks = order[first]
        self.keys = keys[self.ranks]
        self.rank_of = dict(zip(self.keys.tolist(), self.ranks.tolist(), strict=True))
        self.ends = np.array([t.endswith(end) for t in self.token])
        self.ends[list(special.values())] = True
        self.mark = vocab[symbols[ord(_MARK)] + end]
        self.special = {t.encode(): [i] for t, i in special.items()}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")

    # -- splitting ---------------------------------------------------------

    def _split(self, normal: str) -> tuple[list[bytes], list[int]]:
        """The pieces of a normal form that merges never cross, and where they start."""
        found = self.library.pre_tokenizer.pre_tokenize_str(normal)
        if not found:
            return [], []
        symbols = " ".join([w for w, _ in found])  # no piece has a byte for a space
        return symbols.translate(self.byte_of).encode("latin-1").split(b" "), [a for _, (a, _) in found]

    def pieces(self, text: str) -> list[bytes]:
        """The pieces of a text in UTF-8, and control tokens as such."""
        out: list[bytes] = []
        for part in self.marks.split(text):
            if part.encode() in self.special:
                out.append(part.encode())
            elif part:
                out += self._split(self.library.normalizer.normalize_str(part))[0]
        return out

    def pieces_of_each(self, words: list[str]) -> list[list[bytes]]:
        """:meth:`pieces` of each word; as one text for the library where no
        control token and no white space inside a word is in the way."""
        text = " ".join(words)
        if "<|" not in text:
            normal = self.library.normalizer.normalize_str(text)
            if normal.count(" ") == len(words) - 1:
                found, starts = self._split(normal)
                ends = np.cumsum([len(w) + 1 for w in normal.split(" ")])
                cuts = np.searchsorted(starts, ends).tolist()
                return [found[a:b] for a, b in zip([0, *cuts], cuts)]  # noqa: B905
        return [self.pieces(w) for w in words]

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Codes of each word, by segment trees."""
        split = self.pieces_of_each([w.decode("utf-8", "replace") for w in words])
        known = dict(self.special)
        plain = list({p for pieces in split for p in pieces} - known.keys())
        known.update(zip(plain, self.merge(plain) if plain else [], strict=True))
        return [known[pieces[0]] if len(pieces) == 1 else [i for p in pieces for i in known[p]] for pieces in split]

    def _library_ids(self, *texts: str) -> np.ndarray:
        found = self.library.encode_batch_fast(list(texts), add_special_tokens=False)
        return np.concatenate([np.array(f.ids, dtype="<u4") for f in found])

    def encode_by_library(self, words: list[bytes]) -> list[bytes]:
        """Codes of each word as little-endian unsigned 32-bit integers, by the
        library's encoder in one call for many words.

        Words of letters are at least a piece each, so if they have as many ends
        of pieces as there are words, each ends where a piece does.  Others have
        a piece of their own, a control character, between them."""
        texts = [w.decode("utf-8", "replace") for w in words]
        out = [b""] * len(words)
        single = [k for k, t in enumerate(texts) if t.isalpha()]
        alpha = [texts[k] for k in single]
        # The library is slower on a longer text.
        ids = self._library_ids(*(" ".join(alpha[k : k + TOGETHER]) for k in range(0, max(1, len(alpha)), TOGETHER)))
        ends = 4 * (np.flatnonzero(self.ends[ids]) + 1)
        if len(ends) == len(single):
            raw = ids.tobytes()
            for k, a, b in zip(single, [0, *ends.tolist()], ends.tolist()):  # noqa: B905
                out[k] = raw[a:b]
            rest = [k for k, t in enumerate(texts) if not t.isalpha()]
        else:
            rest = list(range(len(texts)))
        alone = [k for k in rest if _MARK in texts[k] or "<|" in texts[k]]
        for k in alone:
            out[k] = self._library_ids(texts[k]).tobytes()
        rest = sorted(set(rest) - set(alone))
        ids = self._library_ids(f" {_MARK} ".join([texts[k] for k in rest]))
        raw, cuts = ids.tobytes(), (4 * np.flatnonzero(ids == self.mark)).tolist()
        for k, a, b in zip(rest, [0, *(c + 4 for c in cuts)], [*cuts, len(raw)]):  # noqa: B905
            out[k] = raw[a:b]
        return out

    # -- merging -----------------------------------------------------------

    def symbols(self, word: bytes) -> np.ndarray:
        raw = np.frombuffer(word, dtype=np.uint8)
        ids = self.inner[raw]
        ids[-1] = self.last[raw[-1]]
        return ids

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.span + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], _NONE)

    def merge_batch(self, symbols: np.ndarray, lens: np.ndarray, width: int) -> tuple[list[int], list[int]]:
        """Codes of words of at most ``width`` symbols, a power of two, and where
        each word's end; ``symbols`` are those of all words in a row."""
        n, cols = len(lens), np.arange(width)
        filled = cols < lens[:, None]
        sym = np.full((n, width + 1), -1, dtype=np.int64)  # the last column stays empty
        sym[:, :width][filled] = symbols
        nxt = np.full((n, width + 1), width, dtype=np.int64)
        nxt[:, :width] = np.where(cols + 1 < lens[:, None], cols + 1, width)
        prv = np.tile(np.r_[width, np.arange(width - 1), width], (n, 1))
        tree = np.full((n, 2 * width), _NONE, dtype=np.int64)
        first, second = np.nonzero(filled[:, 1:])
        rank = self._rank(sym[first, second], sym[first, second + 1])
        tree[first, width + second] = np.where(rank < _NONE, rank << _POS_BITS | second, _NONE)
        for node in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        # Rows are addressed in flat views: a row's cells start at its offset.
        flat_sym, flat_nxt, flat_prv, flat_tree = sym.ravel(), nxt.ravel(), prv.ravel(), tree.ravel()
        rows = np.arange(n)
        while True:
            rows = rows[flat_tree[rows * (2 * width) + 1] < _NONE]
            if not len(rows):
                break
            cell, leaf = rows * (width + 1), rows * (2 * width)
            best = flat_tree[leaf + 1]
            at, made = best & ((1 << _POS_BITS) - 1), self.merged[best >> _POS_BITS]
            gone, before = flat_nxt[cell + at], flat_prv[cell + at]
            after = flat_nxt[cell + gone]
            flat_sym[cell + at], flat_sym[cell + gone] = made, -1
            flat_nxt[cell + at], flat_prv[cell + after] = after, at
            own = np.concatenate([made, flat_sym[cell + before]])
            rank = self._rank(own, np.concatenate([flat_sym[cell + after], made]))
            where = np.concatenate([at, np.where(before < width, before, 0)])
            leaves = np.concatenate([leaf, leaf]) + width + where
            some = np.concatenate([np.ones(len(rows), bool), before < width])
            flat_tree[leaf + width + gone] = _NONE
            flat_tree[leaves[some]] = np.where(rank < _NONE, rank << _POS_BITS | where, _NONE)[some]
            base = np.concatenate([leaf, leaf, leaf])
            node = width + np.concatenate([gone, where])
            for _ in range(width.bit_length() - 1):
                node >>= 1
                child = base + 2 * node
                flat_tree[base + node] = np.minimum(flat_tree[child], flat_tree[child + 1])
        stays = sym >= 0
        return sym[stays].tolist(), np.cumsum(stays.sum(1)).tolist()

    def merge_long(self, word: np.ndarray) -> list[int]:
        """Codes of one word of any length."""
        n = len(word)
        width = 1 << max(1, (n - 1).bit_length())
        sym, span, rank_of = word.tolist(), self.span, self.rank_of
        nxt, prv = [*range(1, n), -1], [-1, *range(n - 1)]
        none = (int(_NONE), 0)
        tree = [none] * (2 * width)
        for i in range(n - 1):
            tree[width + i] = (rank_of.get(sym[i] * span + sym[i + 1], none[0]), i)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, value: tuple[int, int]) -> None:
            node = width + i
            tree[node] = value
            while node > 1:
                node >>= 1
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        while tree[1][0] < none[0]:
            rank, at = tree[1]
            gone, before = nxt[at], prv[at]
            after = nxt[gone]
            sym[at], sym[gone], nxt[at] = int(self.merged[rank]), -1, after
            if after >= 0:
                prv[after] = at
            put(gone, none)
            put(at, (rank_of.get(sym[at] * span + sym[after], none[0]), at) if after >= 0 else none)
            if before >= 0:
                put(before, (rank_of.get(sym[before] * span + sym[at], none[0]), before))
        return [s for s in sym if s >= 0]

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Codes of each piece, by segment trees."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum(lens)
        symbols = self.inner[raw]
        symbols[ends - 1] = self.last[raw[ends - 1]]
        out: list[list[int]] = [[]] * len(words)
        width = 2
        while width <= BATCHED:
            own = np.flatnonzero((lens <= width) & ((lens > width // 2) | (width == 2)))
            if len(own):
                n = lens[own]
                places = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[own] - n, n)
                ids, stops = self.merge_batch(symbols[places], n, width)
                for k, a, b in zip(own.tolist(), [0, *stops], stops):  # noqa: B905
                    out[k] = ids[a:b]
            width *= 2
        for k in np.flatnonzero(lens > BATCHED).tolist():
            out[k] = self.merge_long(symbols[ends[k] - lens[k] : ends[k]])
        return out

    def decode(self, ids: list[int]) -> str:
        """As the library without a decoder does: tokens with a space between."""
        return " ".join([self.token[i] for i in ids])


def _holes(found: list) -> list[int]:
    """Where ``found`` has None."""
    n = found.count(None)
    if 8 * n > len(found):
        return [i for i, f in enumerate(found) if f is None]
    at, out = -1, []
    for _ in range(n):
        at = found.index(None, at + 1)
        out.append(at)
    return out


class Remembered:
    """What is made of each word, kept in two generations of bounded bytes.
    ``weigh`` gives the bytes of what was made; words above ``LONGEST`` bytes
    are made anew each time."""

    def __init__(self, make: Callable[[list[bytes]], list], weigh: Callable[[object], int], most: int | None = None):
        self.make, self.weigh, self.most = make, weigh, MEMORY if most is None else most
        self.young: dict[bytes, object] = {}
        self.old: dict[bytes, object] = {}
        self.held = 0

    def look(self, lists: list[list[bytes]]) -> list[list]:
        """What was made of every word of ``lists``, in place of the words."""
        if self.held > self.most:
            self.old, self.young, self.held = self.young, {}, 0
        found = [list(map(self.young.get, words)) for words in lists]
        holes = [_holes(f) for f in found]
        missing = list({words[i] for words, own in zip(lists, holes, strict=True) for i in own})
        if missing:
            made = {w: self.old[w] for w in missing if w in self.old}
            unseen = [w for w in missing if w not in made]
            if unseen:
                made.update(zip(unseen, self.make(unseen), strict=True))
            for word, value in made.items():
                if len(word) <= LONGEST and word not in self.young:
                    self.young[word] = value
                    self.held += 150 + len(word) + self.weigh(value)
            for words, own, f in zip(lists, holes, found, strict=True):
                for i in own:
                    f[i] = made[words[i]]
        return found


#: ASCII punctuation that is a piece apart from a letter before it, whatever follows:
#: an apostrophe may begin an ending, and control tokens hold the others.
_TAIL = b'!"#$%&()*+,-./:;=?@[\\]^_`{}~'


def in_parts(word: bytes) -> tuple[bytes, bytes]:
    """A word up to its last letter, and the punctuation behind it, where that is
    a letter of ASCII.  The normal form reaches across neither, and no piece
    holds both; ASCII letters alone are in lower case, as normal forms are."""
    core = word.rstrip(_TAIL)
    if len(core) < len(word) and not core[-1:].isalpha():
        core = word
    return core.lower() if core.isalpha() else core, word[len(core) :]


def remembered_parts(make: Callable[[list[bytes]], list[bytes]]) -> Remembered:
    """What ``make`` makes of words, made of their parts, which are remembered too."""

    def joined(words: list[bytes]) -> list[bytes]:
        split = [in_parts(w) for w in words]
        if all(c == w for (c, _), w in zip(split, words, strict=True)):
            return make(words)
        cores, tails = memory.look([[c for c, _ in split], [t for _, t in split if t]])
        rest = iter(tails)
        return [found + next(rest) if tail else found for found, (_, tail) in zip(cores, split, strict=True)]

    memory = Remembered(joined, len)
    return memory


def looked_up(memory: Remembered, texts: Iterable[bytes | None]) -> Iterator[tuple[int, list]]:
    """Number of the text and what was made of its words, in order; a long text
    comes in several turns, and about ``WINDOW`` bytes are held at a time."""
    rows: list[int] = []
    words: list[list[bytes]] = []
    held = 0
    for row, text in enumerate(texts):
        for window in common.windows(text or b"", _SPACE, WINDOW):
            rows.append(row)
            words.append(window.split())
            held += len(window)
            if held >= WINDOW:
                yield from zip(rows, memory.look(words), strict=True)
                rows, words, held = [], [], 0
    yield from zip(rows, memory.look(words), strict=True)


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """One per Python worker and file."""
    if path not in _LOADED:
        # A worker is one of several on its machine: no threads of the library's own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[path] = WordBpe(path)
        # Lists of words come and go by the million and hold no cycles.
        gc.set_threshold(200_000, 50, 100)
    return _LOADED[path]

"""Tables that make JVM expressions agree with current Unicode.

All but the letter ranges are derived from :mod:`unicodedata`: compatibility
decomposition followed by dropping combining marks works one character at a
time, so most of it is a single ``translate``.
"""

from __future__ import annotations

import json
import unicodedata
from functools import cache

HANGUL_FIRST, HANGUL_LAST = "가", "힣"

# Letters and numbers of newer Unicode than the JVM's (first, last).
NEWER_LETTERS = (
    (2160, 2183), (2185, 2190), (2229, 2229), (2248, 2249), (3165, 3165), (3293, 3293), (5901, 5901), (5919, 5919),
    (6988, 6988), (11311, 11311), (11359, 11359), (40957, 40959), (42944, 42945), (42960, 42961), (42963, 42963),
    (42965, 42969), (42994, 42996), (66928, 66938), (66940, 66954), (66956, 66962), (66964, 66965), (66967, 66977),
    (66979, 66993), (66995, 67001), (67003, 67004), (67456, 67461), (67463, 67504), (67506, 67514), (69488, 69505),
    (69745, 69746), (69749, 69749), (70207, 70208), (71488, 71494), (72368, 72383), (73474, 73474), (73476, 73488),
    (73490, 73523), (73552, 73561), (77712, 77808), (78895, 78895), (78913, 78918), (92784, 92862), (92864, 92873),
    (110576, 110579), (110581, 110587), (110589, 110590), (110879, 110882), (110898, 110898), (110933, 110933),
    (119488, 119507), (122624, 122654), (122661, 122666), (122928, 122989), (123536, 123565), (124112, 124139),
    (124144, 124153), (124896, 124902), (124904, 124907), (124909, 124910), (124912, 124926), (173790, 173791),
    (177973, 177977), (191472, 192093), (201552, 205743),
)

#: Character classes for Java regular expressions.
LETTER = r"\p{L}\p{N}" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in NEWER_LETTERS)
SPACE = r"\s\x1c-\x1f\x85\p{Z}"


def plain(char: str) -> str:
    """Compatibility decomposition without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))


@cache
def tables() -> tuple[str, str, dict[str, str]]:
    """``translate`` arguments (with deletions last), and what becomes several
    characters, Hangul syllables aside."""
    single, gone, several = {}, [], {}
    for code in range(0x80, 0x110000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        if HANGUL_FIRST <= char <= HANGUL_LAST:
            continue
        to = plain(char)
        if to == char:
            continue
        if not to:
            gone.append(char)
        elif len(to) == 1:
            single[char] = to
        else:
            several[char] = to
    return "".join([*single, *gone]), "".join(single.values()), several


@cache
def several_json() -> str:
    return json.dumps(tables()[2], ensure_ascii=True)


@cache
def hangul() -> tuple[str, str, str, str]:
    """All syllables, those without a final letter last, and the first, second
    and (shorter) third letters of their decomposition."""
    syllables = [chr(c) for c in range(ord(HANGUL_FIRST), ord(HANGUL_LAST) + 1)]
    parts = sorted(((s, plain(s)) for s in syllables), key=lambda p: -len(p[1]))
    return (
        "".join(s for s, _ in parts),
        "".join(p[0] for _, p in parts),
        "".join(p[1] for _, p in parts),
        "".join(p[2] for _, p in parts if len(p) > 2),
    )

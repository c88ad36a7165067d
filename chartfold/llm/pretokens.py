"""Pre-tokens of byte-level vocabularies, cut in numpy for many texts at once.

The pattern of these vocabularies reads, in this order: a contraction ('s 't 're 've 'm 'll 'd), an optional space
before a run of letters, of digits or of other signs, white space up to the last one before a sign, white space.
Only neighbouring characters decide where a piece starts, so the starts of all texts come from a few array operations.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np

LETTER, NUMBER, OTHER, SPACE, ODD = 1, 2, 3, 4, 5      # 0: not the first byte of a character
_SPACES = set(range(9, 14)) | {0x20, 0x85}


def _class_of(database, ch: str) -> int:
    kind = database.category(ch)
    if kind == "Cn":
        return ODD
    if ord(ch) in _SPACES or kind[0] == "Z":
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(kind[0], OTHER)


def character_classes() -> np.ndarray:
    """Class of each character below U+10000; ``ODD`` where Unicode 3.2 and the present one differ, so that versions of a library may, too."""
    old = unicodedata.ucd_3_2_0
    out = np.full(0x10000, ODD, np.uint8)
    for code in range(0x10000):
        ch = chr(code)
        kind = _class_of(unicodedata, ch)
        if _class_of(old, ch) == kind:
            out[code] = kind
    return out


def byte_level(path: str) -> bool:
    """Whether the vocabulary file cuts by that pattern and changes nothing before it."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    pre = d.get("pre_tokenizer") or {}
    return (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
            and not d.get("normalizer") and not d.get("truncation") and not d.get("padding")
            and all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized")) for t in d.get("added_tokens", [])))


def piece_starts(raw: np.ndarray, edges: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the pieces, positions of characters of class ``ODD``) in the UTF-8 bytes ``raw``.

    ``edges``: bool[len(raw) + 1], true where a text starts; pieces never cross texts.
    """
    size = len(raw)
    ascii_class = np.zeros(256, np.uint8)
    ascii_class[:128] = classes[:128]
    own = ascii_class[raw]
    two = np.flatnonzero((raw >= 0xC0) & (raw < 0xE0))
    three = np.flatnonzero((raw >= 0xE0) & (raw < 0xF0))
    four = np.flatnonzero(raw >= 0xF0)
    own[two] = classes[((raw[two] & 31).astype(np.int32) << 6) | (raw[two + 1] & 63)]
    own[three] = classes[((raw[three] & 15).astype(np.int32) << 12) | ((raw[three + 1] & 63).astype(np.int32) << 6) | (raw[three + 2] & 63)]
    own[four] = ODD
    kind = own.copy()                                     # of every byte
    for lead, more in ((two, 1), (three, 2), (four, 3)):
        for k in range(1, more + 1):
            kind[lead + k] = own[lead]
    first = own != 0
    at_edge = edges[:size]
    space = kind == SPACE
    after_space = np.empty(size, bool)
    after_space[:1], after_space[1:] = False, space[:-1]
    after_blank = np.empty(size, bool)
    after_blank[:1], after_blank[1:] = False, raw[:-1] == 0x20
    changed = np.empty(size, bool)
    changed[:1], changed[1:] = True, kind[1:] != kind[:-1]
    start = first & (at_edge | (changed & ~(after_blank & ~space)))
    # the last white space before a sign is a piece of its own, or starts the sign's piece
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~edges[1:size])
    for _ in range(2):
        last -= own[last] == 0
    start[last] = True
    # contractions
    quote = np.flatnonzero((raw == 0x27) & start)
    if len(quote):
        pad = np.concatenate((raw, np.zeros(3, np.uint8)))
        a, b = pad[quote + 1], pad[quote + 2]
        in_text = np.concatenate((~edges[:size], np.zeros(3, bool)))
        short = np.isin(a, np.frombuffer(b"stmd", np.uint8)) & in_text[quote + 1]
        long = (((a == 0x72) & (b == 0x65)) | ((a == 0x76) & (b == 0x65)) | ((a == 0x6C) & (b == 0x6C))) & in_text[quote + 1] & in_text[quote + 2]
        for hit, n in ((short, 2), (long, 3)):
            start[quote[hit] + 1] = False
            end = quote[hit] + n
            start[end[end < size]] = True
    return np.flatnonzero(start), np.flatnonzero(own == ODD)

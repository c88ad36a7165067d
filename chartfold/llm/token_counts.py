"""Token counts by a two-tier look-up on the map side.

Tier 1 is a broadcast hash table of the frequent pre-tokens of all texts with their token counts: ``FREQUENT`` entries
at most, each pre-token stored exactly in three 64-bit words (23 bytes and the length), open addressing, probed for all pieces of
a block of texts at once.  Tier 2: what misses is looked up in a cache that the worker process keeps, and what misses there
too goes to the library, every distinct piece once.  No pre-token of a text is shuffled: the frequent ones are
found from a summary of bounded size that each task makes of its texts (at most ``SUMMARY`` rows a task), and texts are never moved.

The tables decide the speed only; every count is the library's for exactly that piece.  Texts with a special token, or
with a character that Unicode 3.2 did not have (so library versions may class it differently), go to the library itself, cut only at spaces before
ASCII letters, where a piece starts in any version.  Vocabularies that do not cut by the byte-level pattern, and
sentencepiece models, get whole texts.

Null text counts as empty: 0 tokens.  Null doc_ids, repeated rows and ties of any kind are rows like all others, one result each, in no order.
Very long texts are counted whole; a piece of any length is one piece.  An empty table gives an empty result; further columns are left out of the result.
"""

from __future__ import annotations

import os
import re
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_parts, row_chunks
from .pretokens import byte_level, character_classes, piece_starts

FREQUENT = 1 << 17              # entries of the broadcast table
SUMMARY = 1 << 14               # pre-tokens a task reports
REMEMBERED = 1 << 17            # pieces in one half of a worker's cache
LONGEST_REMEMBERED = 64         # bytes
KEY_BYTES = 23                  # longest pre-token of the table
TEXT_AT_ONCE = 1 << 20
LIMIT = 1024                    # tokens

_CUT = re.compile(r" (?=[A-Za-z])")
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


# ---------------------------------------------------------------- exact keys and the table

def piece_keys(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """uint64[3, n]: the bytes of every piece of at most ``KEY_BYTES`` bytes, and its length in the last byte."""
    padded = np.concatenate((raw, np.zeros(32, np.uint8)))
    window = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(padded) - 7,), (1,))
    out = np.zeros((3, len(starts)), np.uint64)
    masks = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], np.uint64)
    for w in range(3):
        rest = np.clip(lengths - 8 * w, 0, 8)
        some = np.flatnonzero(rest) if w else slice(None)
        out[w, some] = window[starts[some] + 8 * w] & masks[rest[some]]
    out[2] |= lengths.astype(np.uint64) << np.uint64(56)
    return out


def key_bytes(key) -> bytes:
    raw = np.asarray(key, "<u8").tobytes()
    return raw[:raw[23]]


def _spread(keys: np.ndarray) -> np.ndarray:
    h = (keys[0] * _A) ^ ((keys[1] + _C) * _B) ^ (keys[2] * _C)
    h ^= h >> np.uint64(29)
    h *= _A
    return h ^ (h >> np.uint64(32))


class LengthTable:
    """Open addressing over four slots an entry; ``counts`` is -1 in free slots."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.mask = (1 << max(4, (4 * len(counts)).bit_length())) - 1
        self.keys = np.zeros((3, self.mask + 1), np.uint64)
        self.counts = np.full(self.mask + 1, -1, np.int32)
        self.probes = 1
        slot = (_spread(keys) & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(counts))
        while len(left):                                  # one entry takes a free slot, the others go on to the next
            free = left[self.counts[slot[left]] < 0]
            _, one = np.unique(slot[free], return_index=True)
            put = free[one]
            self.keys[:, slot[put]] = keys[:, put]
            self.counts[slot[put]] = counts[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            slot[left] = (slot[left] + 1) & self.mask
            self.probes += bool(len(left))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Counts of the keys, -1 for those that the table does not hold."""
        out = np.full(keys.shape[1], -1, np.int32)
        slot = (_spread(keys) & np.uint64(self.mask)).astype(np.int64)
        open_ = np.arange(keys.shape[1])
        for _ in range(self.probes):
            at = slot[open_]
            same = (self.keys[0, at] == keys[0, open_]) & (self.keys[1, at] == keys[1, open_]) & (self.keys[2, at] == keys[2, open_])
            out[open_[same]] = self.counts[at[same]]
            open_ = open_[~same & (self.counts[at] >= 0)]
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & self.mask
        return out


# ---------------------------------------------------------------- library and worker cache

class Library:
    """Token counts of texts or pieces as the library of the vocabulary file gives them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.special: list[bytes] = []
        self.by_pieces = False
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.count = lambda texts: [len(i) for i in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            self.special = [x.content.encode() for x in t.get_added_tokens_decoder().values()]
            self.by_pieces = byte_level(path)
            self.count = lambda texts: [len(e) for e in t.encode_batch_fast(texts, add_special_tokens=False)]
        self.young: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def count_pieces(self, pieces: list[bytes]) -> list[int]:
        """Through the cache: two halves, the older one is forgotten when the younger is full."""
        young, old = self.young, self.old
        got = list(map(young.get, pieces))
        for i in [i for i, g in enumerate(got) if g is None]:
            p = pieces[i]
            if p in old:
                got[i] = young[p] = old[p]
        missing = [i for i, g in enumerate(got) if g is None]
        if missing:
            new = list({pieces[i] for i in missing})
            made = dict(zip(new, self.count([p.decode() for p in new])))
            for i in missing:
                got[i] = made[pieces[i]]
            young.update((p, n) for p, n in made.items() if len(p) <= LONGEST_REMEMBERED)
        if len(young) > REMEMBERED:
            self.young, self.old = {}, young
        return got

    def count_odd(self, text: bytes) -> int:
        first, *rest = _CUT.split(text.decode())
        return sum(self.count([first] + [" " + p for p in rest]))


def _worker_library(path: str) -> Library:
    """One vocabulary a worker process, as a worker serves many tasks."""
    held = sys.modules.setdefault("chartfold_token_counts", types.ModuleType("chartfold_token_counts"))
    if getattr(held, "path", None) != path:
        held.path, held.library, held.classes = path, Library(path), character_classes()
    return held.library, held.classes


def cut_texts(data: np.ndarray, off: np.ndarray, classes: np.ndarray, special: list[bytes]):
    """(bytes, starts, lengths, text of each piece, odd texts) of the texts between the offsets."""
    raw = data[int(off[0]):int(off[-1])]
    off = off - off[0]
    edges = np.zeros(len(raw) + 1, bool)
    edges[off] = True
    starts, odd_at = piece_starts(raw, edges, classes)
    lengths = np.diff(np.append(starts, len(raw)))
    text = np.searchsorted(off, starts, side="right") - 1
    odd = set((np.searchsorted(off, odd_at, side="right") - 1).tolist())
    whole = raw.tobytes()
    for s in special:
        at = whole.find(s)
        while at >= 0:
            odd.add(int(np.searchsorted(off, at, side="right") - 1))
            at = whole.find(s, at + 1)
    return raw, whole, off, starts, lengths, text, odd


def count_texts(column, library: Library, classes: np.ndarray, table: LengthTable | None) -> np.ndarray:
    """Tokens of each text of an Arrow column."""
    off, data = binary_parts(column)
    out = np.zeros(len(column), np.int64)
    for lo, hi in row_chunks(off, TEXT_AT_ONCE):
        if off[hi] == off[lo]:
            continue
        if not library.by_pieces:
            out[lo:hi] = library.count([data[a:b].tobytes().decode() for a, b in zip(off[lo:hi], off[lo + 1:hi + 1])])
            continue
        raw, whole, cuts, starts, lengths, text, odd = cut_texts(data, off[lo:hi + 1], classes, library.special)
        if odd:
            plain = ~np.isin(text, np.fromiter(odd, np.int64))
            starts, lengths, text = starts[plain], lengths[plain], text[plain]
            for t in odd:
                out[lo + t] = library.count_odd(whole[cuts[t]:cuts[t + 1]])
        counts = np.full(len(starts), -1, np.int64)
        if table is not None:
            short = np.flatnonzero(lengths <= KEY_BYTES)
            counts[short] = table.find(piece_keys(raw, starts[short], lengths[short]))
        miss = np.flatnonzero(counts < 0)
        if len(miss):
            s, n = starts[miss], lengths[miss]
            counts[miss] = library.count_pieces([whole[a:b] for a, b in zip(s.tolist(), (s + n).tolist())])
        out[lo:hi] += np.bincount(text, weights=counts, minlength=hi - lo).astype(np.int64)
    return out


# ---------------------------------------------------------------- the frequent pre-tokens

def _merge(keys: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys added up; of more than ``most`` the frequent ones."""
    order = np.lexsort(keys)
    keys, counts = keys[:, order], counts[order]
    new = np.ones(len(counts), bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    at = np.flatnonzero(new)
    keys, counts = keys[:, at], np.add.reduceat(counts, at) if len(at) else counts
    if len(counts) > most:
        top = np.argpartition(counts, len(counts) - most)[-most:]
        keys, counts = keys[:, top], counts[top]
    return keys, counts


def _summarise(path: str):
    def run(batches):
        library, classes = _worker_library(path)
        keys, counts = np.zeros((3, 0), np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            off, data = binary_parts(batch.column(0))
            for lo, hi in row_chunks(off, TEXT_AT_ONCE):
                if off[hi] == off[lo]:
                    continue
                raw, _, _, starts, lengths, _, _ = cut_texts(data, off[lo:hi + 1], classes, [])
                short = np.flatnonzero(lengths <= KEY_BYTES)
                k = piece_keys(raw, starts[short], lengths[short])
                k, c = _merge(k, np.ones(k.shape[1], np.int64), 4 * SUMMARY)
                keys, counts = _merge(np.hstack((keys, k)), np.concatenate((counts, c)), 4 * SUMMARY)
        keys, counts = _merge(keys, counts, SUMMARY)
        for a in range(0, len(counts), 1 << 12):
            yield pa.RecordBatch.from_arrays([pa.array([key_bytes(k) for k in keys[:, a:a + (1 << 12)].T], pa.binary()),
                                              pa.array(counts[a:a + (1 << 12)])], names=["piece", "n"])
    return run


def frequent_lengths(texts: DataFrame, path: str, most: int = FREQUENT) -> LengthTable:
    """Table of the ``most`` frequent pre-tokens by the tasks' summaries, with the library's token counts.

    The driver holds ``most`` pre-tokens of at most 23 bytes, whatever the size of the input.
    """
    top = (texts.mapInArrow(_summarise(path), "piece binary, n long").groupBy("piece").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "piece").limit(most).select("piece").toArrow().column(0).combine_chunks())
    off, data = binary_parts(top)
    library = Library(path)
    pieces, whole = [], data.tobytes()
    for a, b in zip(off.tolist(), off[1:].tolist()):
        pieces.append(whole[a:b].decode())
    keys = piece_keys(data, off[:-1].astype(np.int64), np.diff(off)) if pieces else np.zeros((3, 0), np.uint64)
    return LengthTable(keys, np.array(library.count(pieces), np.int32) if pieces else np.zeros(0, np.int32))


def _count(path: str, held):
    def run(batches):
        library, classes = _worker_library(path)
        table = held.value if held is not None else None
        for batch in batches:
            n = count_texts(batch.column("text"), library, classes, table)
            off, _ = binary_parts(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(off)), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; ``path``: a .json or .model vocabulary that every machine has."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = None
    if Library(path).by_pieces:
        table = frequent_lengths(rows.select("text"), path)
        table.keys.flags.writeable = table.counts.flags.writeable = False
        held = spark.sparkContext.broadcast(table)
    return rows.mapInArrow(_count(path, held), "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)

"""Periodic runs of words: maximal stretches that repeat their first words at least four times.

The texts of a block are one sequence of word numbers, each text ended by a number of its own, so that no extension leaves its text.

Longest common extensions come from a difference cover.  The cover modulo ``V`` holds so few residues that only ``len(COVER)/V`` of all
positions are sampled, yet for any two positions some shift below ``V`` brings both onto samples.  Only sampled
suffixes are sorted: first by their first ``V`` words, then by doubling over the samples.  An extension compares the few words up to the shift;
where they all agree it takes the samples' ranks and the minimum of the neighbours' common prefixes between them, from a sparse table.
Backward extensions are forward ones of the reversed sequence.

A run of period q and length of at least 4q holds 3q successive positions i with word i = word i + q.  So for each q the positions
0, 3q, 6q, ... of a text hit every run, and the grid of all periods of a text of n words has about n/3 * ln n places.  Each
place that matches is extended both ways; a stretch that several places or multiples of its period find is kept
once, with its smallest period.

Null and empty texts have no words and no runs.  A null doc_id is never edited; repeated rows and ties are rows like all others, one result
each.  A text of any length is searched whole, by one task, in memory that follows its words.  An empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_parts, row_chunks

V = 13
COVER = (0, 1, 3, 9)             # every residue modulo 13 is a difference of two of these
EXPONENT = 4
LEAST_LENGTH = 6
TEXT_AT_ONCE = 1 << 20
PLACES_AT_ONCE = 1 << 20

_IN_COVER = np.zeros(V, bool)
_IN_COVER[list(COVER)] = True
#: shift that brings residues a and b onto the cover
_SHIFT = np.array([[next(d for d in range(V) if _IN_COVER[(a + d) % V] and _IN_COVER[(b + d) % V]) for b in range(V)] for a in range(V)], np.int64)


class Extensions:
    """Longest common extensions to the right in a sequence of non-negative numbers."""

    def __init__(self, words: np.ndarray):
        self.n = n = len(words)
        # past the end: numbers that occur nowhere else, so that comparisons stop
        self.words = np.concatenate((words.astype(np.int64), np.arange(-1, -3 * V - 2, -1)))
        self.at = np.flatnonzero(_IN_COVER[np.arange(n) % V])
        self.number = np.full(n + V, -1, np.int64)
        self.number[self.at] = np.arange(len(self.at))
        self._sort()

    def _window_ranks(self) -> np.ndarray:
        """Rank of each sample by its first ``V`` words."""
        bits = max(1, int(self.words.max(initial=0)) + 3 * V + 3).bit_length()
        a_key = max(1, 63 // bits)
        keys = []
        for lo in range(0, V, a_key):
            key = np.zeros(len(self.at), np.int64)
            for k in range(lo, min(V, lo + a_key)):
                key = (key << bits) | (self.words[self.at + k] + 3 * V + 2)
            keys.append(key)
        return _ranks(keys)

    def _sort(self):
        m = len(self.at)
        levels = [self._window_ranks()]                  # equal ranks at level k: the first V * 2**k words agree
        span = V
        while m and int(levels[-1].max()) + 1 < m:
            r = levels[-1]
            ahead = np.full(m, -1, np.int64)
            inside = np.flatnonzero(self.at + span < self.n)
            ahead[inside] = r[self.number[self.at[inside] + span]]
            outside = np.setdiff1d(np.arange(m), inside, assume_unique=True)
            ahead[outside] = -1 - outside                # suffixes that end within the span differ anyway
            levels.append(_ranks([r, ahead]))
            span *= 2
        self.rank = levels[-1]
        order = np.empty(m, np.int64)
        order[self.rank] = np.arange(m)
        # common prefix of neighbours: whole spans by the levels, then words
        a, b = self.at[order[:-1]], self.at[order[1:]]
        common = np.zeros(max(0, m - 1), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            step = V << k
            x, y = a + common, b + common
            fits = np.flatnonzero((x < self.n) & (y < self.n))
            same = fits[levels[k][self.number[x[fits]]] == levels[k][self.number[y[fits]]]]
            common[same] += step
        live = np.arange(len(common))
        for _ in range(V):
            live = live[self.words[np.minimum(a[live] + common[live], self.n + V)] == self.words[np.minimum(b[live] + common[live], self.n + V + 1)]]
            common[live] += 1
        self.minima = [common]                           # minima[k][i]: over 2**k entries from i
        width = 1
        while 2 * width <= len(common):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` on equal those from ``j`` on (i != j, pair by pair)."""
        out = np.zeros(len(i), np.int64)
        shift = _SHIFT[i % V, j % V]
        live = np.arange(len(i))
        for k in range(V):
            live = live[self.words[i[live] + k] == self.words[j[live] + k]] if k else live[self.words[i] == self.words[j]]
            live = live[k < shift[live]] if k else live
            out[live] += 1
            if not len(live):
                break
        # those that agree up to their shift go on from the samples there
        done = np.flatnonzero((out >= shift) & (np.maximum(i, j) + shift < self.n))
        x, y = self.number[i[done] + shift[done]], self.number[j[done] + shift[done]]
        lo, hi = np.minimum(self.rank[x], self.rank[y]), np.maximum(self.rank[x], self.rank[y])
        k = np.frexp((hi - lo).astype(np.float64))[1] - 1
        far = np.empty(len(done), np.int64)
        for level in np.unique(k):
            some = np.flatnonzero(k == level)
            table = self.minima[level]
            far[some] = np.minimum(table[lo[some]], table[hi[some] - (1 << level)])
        out[done] = shift[done] + far
        return out


def _ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Dense ranks by the keys, the first one deciding first."""
    m = len(keys[0])
    order = np.lexsort(keys[::-1])
    new = np.zeros(m, bool)
    for key in keys:
        s = key[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(m, np.int64)
    out[order] = np.cumsum(new)
    return out


def _grid(first: np.ndarray, sizes: np.ndarray):
    """Blocks of (place, period): for every text and period q up to a quarter of its words the places 0, 3q, 6q, ..."""
    most = sizes // EXPONENT
    step = EXPONENT - 1
    held_i, held_q, held = [], [], 0
    for q in range(1, int(most.max(initial=0)) + 1):
        texts = np.flatnonzero(most >= q)
        n = (sizes[texts] - q + step * q - 1) // (step * q)       # places below size - q
        lo = 0
        ends = np.cumsum(n)
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PLACES_AT_ONCE, side="right")))
            k = n[lo:hi]
            to = np.cumsum(k)
            i = np.repeat(first[texts[lo:hi]], k) + step * q * (np.arange(int(to[-1])) - np.repeat(to - k, k))
            held_i.append(i)
            held_q.append(q)
            held += len(i)
            if held >= PLACES_AT_ONCE:
                yield np.concatenate(held_i), np.repeat(held_q, [len(x) for x in held_i])
                held_i, held_q, held = [], [], 0
            lo = hi
    if held:
        yield np.concatenate(held_i), np.repeat(held_q, [len(x) for x in held_i])


def _few(line: np.ndarray, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
    """How many of the first ``V`` words from ``i`` and ``j`` on, in steps of ``step``, are equal one after the other."""
    out = np.zeros(len(i), np.int64)
    live = np.arange(len(i))
    for k in range(V):
        live = live[line[i[live] + step * k] == line[j[live] + step * k]]
        out[live] += 1
    return out


def find_runs(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """int64[k, 4]: text, start in the text, length, smallest period of every run, in this order.

    ``words``: the texts' word numbers one after the other, ``sizes``: words of each text.
    """
    sizes = np.asarray(sizes, np.int64)
    ends = np.cumsum(sizes)
    # every text between numbers that occur once; V more at both sides of the line
    total = len(words)
    top = int(words.max(initial=0)) + 1
    line = top + np.arange(total + len(sizes) + 2 * V)
    line[V + np.arange(total) + np.repeat(np.arange(len(sizes)), sizes)] = words
    first = V + ends - sizes + np.arange(len(sizes))
    places, periods, before, after = ([] for _ in range(4))
    for i, q in _grid(first, sizes):
        some = np.flatnonzero(line[i] == line[i + q])
        i, q = i[some], q[some]
        right, left = _few(line, i, i + q, 1), _few(line, i - 1, i - 1 + q, -1)
        some = np.flatnonzero((right == V) | (left == V) | (right + left + q >= np.maximum(LEAST_LENGTH, EXPONENT * q)))
        for held, values in ((places, i), (periods, q), (after, right), (before, left)):
            held.append(values[some])
    if not places:
        return np.zeros((0, 4), np.int64)
    i, q, right, left = (np.concatenate(x) for x in (places, periods, after, before))
    text = np.searchsorted(first, i, side="right") - 1
    far = np.flatnonzero((right == V) | (left == V))
    if len(far):
        # only the texts with extensions that few words do not end are indexed
        used = np.unique(text[far])
        n = sizes[used] + 1
        to = np.cumsum(n) - n
        part = line[np.repeat(first[used] - to, n) + np.arange(int(n.sum()))]
        moved = np.zeros(len(sizes), np.int64)
        moved[used] = to - first[used]
        at, q_far = i[far] + moved[text[far]], q[far]
        right[far] = Extensions(part).extend(at, at + q_far)
        some = np.flatnonzero(left[far] == V)
        if len(some):                                     # in the reversed sequence, from the words before both places
            at = len(part) - at[some]
            left[far[some]] = Extensions(part[::-1]).extend(at, at - q_far[some])
    length = left + right + q
    good = np.flatnonzero(length >= np.maximum(LEAST_LENGTH, EXPONENT * q))
    found = np.stack((text, i - left - first[text], length, q), axis=1)[good]
    found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:, :3] != found[:-1, :3]).any(axis=1)
    found = found[keep]
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def edited_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place of a text whose id plants a repetition; None: the text as it is."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _digest(batches):
    for batch in batches:
        off, data = binary_parts(batch.column("text"))
        ids = batch.column("doc_id").to_pylist()
        rows = []
        for lo, hi in row_chunks(off, TEXT_AT_ONCE):
            numbers = _Numbers()
            lists, coded = [], []
            for t in range(lo, hi):
                split = data[off[t]:off[t + 1]].tobytes().split()
                order = edited_order(ids[t], len(split))
                if order is not None:
                    split = [split[k] for k in order.tolist()]
                lists.append(split)
                coded.append(np.fromiter(map(numbers.__getitem__, split), np.int64, len(split)))
            runs = find_runs(np.concatenate(coded), [len(x) for x in lists])
            cuts = np.searchsorted(runs[:, 0], np.arange(hi - lo + 1))
            for k, split in enumerate(lists):
                mine = runs[cuts[k]:cuts[k + 1], 1:]
                rows.append((ids[lo + k], *summary(split, mine)))
        names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        columns = list(zip(*rows)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n.endswith("sha256") else pa.int64()) for n, c in zip(names, columns)], names=names)


def collapse(split: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without the repetitions: of each run only its first period stays, unless another run drops it."""
    if not len(runs):
        return split
    depth = np.zeros(len(split) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return [split[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def strongest(runs: np.ndarray):
    """The run of the greatest length / period, compared exactly; ties go to the smallest start, then period."""
    best = None
    for s, n, q in runs.tolist():
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    return best


def summary(split: list[bytes], runs: np.ndarray) -> tuple:
    best = strongest(runs)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *head, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(collapse(split, runs))).hexdigest())


def document_runs(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, number of runs, the strongest one, digests of all runs and of the text without repetitions.  No shuffle."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_digest, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                                    "runs_sha256 string, collapsed_sha256 string")

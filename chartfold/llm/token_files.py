"""Token-id files with fixed-width bit packing.

A file holds the ids of consecutive documents: a header, the doc_ids, the end of every document in ids, the byte
offset of every block, and blocks of ``BLOCK`` ids with the fewest bits that hold any id of the vocabulary.
Any id range is read by its blocks alone, unpacked in numpy.  All numbers are little-endian:

    magic "CFTOKEN1" | bits u4 | block u4 | documents u8 | ids u8
    doc_ids i8[documents] | has id u1[documents] | ends u8[documents] | block offsets u8[blocks + 1] | blocks

Tasks write whole files under names that no other attempt uses and return the names; only names that the finished
job returned are read, so a lost executor leaves at most unread files.
"""

from __future__ import annotations

import os
import re
import sys
import types
import uuid
import zlib
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import binary_parts, durable, row_chunks, shared_folder
from .pretokens import byte_level, character_classes
from .ranges import deal_by_id
from .token_counts import KEY_BYTES, LengthTable, cut_texts, piece_keys

MAGIC = b"CFTOKEN1"
BLOCK = 4096
END_ID = 2
IDS_A_FILE = 2 << 20             # a file is closed after the document that reaches this
CHARS_A_RANGE = 16 << 20         # characters that a range of documents holds about
CACHE_UNITS = 1 << 17            # pieces whose ids a worker remembers
LONGEST_REMEMBERED = 64          # bytes of a piece
LINE = 256                       # new pieces that go to the library as one text
TEXT_AT_ONCE = 1 << 20           # bytes of text whose pieces are looked up together
_CUT = re.compile(r" (?=[A-Za-z])")
_HEAD = np.dtype([("magic", "S8"), ("bits", "<u4"), ("block", "<u4"), ("documents", "<u8"), ("ids", "<u8")])


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):                            # whole bytes: the packed form is the array itself
        return ids.astype(f"<u{bits // 8}").tobytes()
    wide = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(wide.reshape(-1), bitorder="little").tobytes()


def unpack(raw, count: int, bits: int) -> np.ndarray:
    """First ``count`` ids of a block: an 8-byte window per id, shifted and masked."""
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", count).astype(np.uint32)
    padded = np.concatenate((np.frombuffer(raw, np.uint8), np.zeros(8, np.uint8)))
    window = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(padded) - 7,), (1,))
    at = np.arange(count, dtype=np.uint64) * np.uint64(bits)
    return ((window[at >> np.uint64(3)] >> (at & np.uint64(7))) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def encode_file(doc_ids: list, ends: list[int], ids: np.ndarray, bits: int) -> bytes:
    blocks = [pack(ids[i:i + BLOCK], bits) for i in range(0, len(ids), BLOCK)]
    head = np.array([(MAGIC, bits, BLOCK, len(doc_ids), len(ids))], _HEAD)
    offsets = np.concatenate(([0], np.cumsum([len(b) for b in blocks]))).astype("<u8")
    return b"".join((head.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                     np.array([d is not None for d in doc_ids], "u1").tobytes(), np.array(ends, "<u8").tobytes(), offsets.tobytes(), *blocks))


class TokenFile:
    """Random access to the bytes of a file."""

    def __init__(self, raw):
        self.raw = memoryview(raw)
        head = np.frombuffer(self.raw, _HEAD, 1)[0]
        if head["magic"] != MAGIC:
            raise ValueError("not a token file")
        self.bits, self.block, n, self.n_ids = (int(head[k]) for k in ("bits", "block", "documents", "ids"))
        at = _HEAD.itemsize
        self.doc_ids = np.frombuffer(self.raw, "<i8", n, at)
        self.has_id = np.frombuffer(self.raw, "u1", n, at + 8 * n).astype(bool)
        self.ends = np.frombuffer(self.raw, "<u8", n, at + 9 * n).astype(np.int64)
        blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(self.raw, "<u8", blocks + 1, at + 17 * n).astype(np.int64)
        self.base = at + 17 * n + 8 * (blocks + 1)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop-1; only the blocks that hold them are unpacked."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        parts = [unpack(self.raw[self.base + self.offsets[b]:self.base + self.offsets[b + 1]], min(self.block, self.n_ids - b * self.block), self.bits)
                 for b in range(first, last + 1)]
        return np.concatenate(parts)[start - first * self.block:stop - first * self.block]


class Encoder:
    """Encodes texts with the tokenizers library by pre-tokens, which no merge crosses.

    A vocabulary that cuts by the byte-level pattern (read from its file): the pieces of a block of texts are cut in numpy, the
    library encodes each distinct piece once, and the ids of the pieces met are remembered in a table that is probed for all
    pieces at once.  The ids of a block are then one gather.  New pieces go to the library many in a line, between line feeds: none
    holds white space but a first blank, so the pattern cuts them there again.  ``CACHE_UNITS`` pieces are remembered; beyond, those used
    least are forgotten and learned anew when met.  Texts with a special token go to the library whole, and those with a character that versions of Unicode class
    differently are cut only at spaces before ASCII letters.  With any other vocabulary every text goes to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.bits = bits_for(self.tokenizer.get_vocab_size())
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_pieces = byte_level(path)
        self.classes = character_classes() if self.by_pieces else None
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if self.by_pieces and len(feed) == 1 else None
        self._start()

    def _start(self) -> None:
        self.table = LengthTable(np.zeros((3, 0), np.uint64), np.zeros(0, np.int32))
        self.known: dict[bytes, int] = {}              # every remembered piece; the table holds the short ones of them
        self.recent: list[bytes] = []                  # short pieces that the table does not hold yet
        self.in_table = 0
        self.ids = np.empty(1 << 16, "<u4")            # ids of the remembered pieces, one after the other
        self.first, self.size, self.uses = (np.zeros(1 << 12, np.int64) for _ in range(3))
        self.entries = self.used = 0

    def _library(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def _coded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each piece)."""
        texts = [p.decode() for p in pieces]
        sizes = np.zeros(len(texts), np.int64)
        alone = [i for i, t in enumerate(texts) if self.feed is None or t[-1].isspace()]
        apart = set(alone)
        lined = [i for i in range(len(texts)) if i not in apart] if apart else list(range(len(texts)))
        lines = [lined[i:i + LINE] for i in range(0, len(lined), LINE)]
        got: list[tuple[int, np.ndarray]] = []
        for line, ids in zip(lines, self._library(["\n".join([texts[i] for i in line]) for line in lines])):
            ids = np.array(ids, np.uint32)
            ends = np.append(np.flatnonzero(ids == self.feed), len(ids))
            if len(ends) != len(line):                    # not the cut that was expected: one by one
                alone += line
                continue
            starts = np.concatenate(([0], ends[:-1] + 1))
            sizes[line] = ends - starts
            got.append((line[0], ids[ids != self.feed]))
        coded = self._library([texts[i] for i in alone])
        for i, ids in zip(alone, coded):
            sizes[i] = len(ids)
        if not alone:
            return np.concatenate([g for _, g in got]) if got else np.empty(0, np.uint32), sizes
        out = np.empty(int(sizes.sum()), np.uint32)
        at = np.cumsum(sizes) - sizes
        loose = set(alone)
        kept = np.array([i for i in lined if i not in loose], np.int64)
        n = sizes[kept]
        out[np.repeat(at[kept] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] = np.concatenate([g for _, g in got]) if got else []
        for i, ids in zip(alone, coded):
            out[at[i]:at[i] + sizes[i]] = ids
        return out, sizes

    def _append(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Entries for these ids; the number of the first."""
        at, total = self.entries, len(ids)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty(len(self.ids), "<u4")))
        while at + len(sizes) > len(self.size):
            self.first, self.size, self.uses = (np.concatenate((x, np.zeros(len(x), np.int64))) for x in (self.first, self.size, self.uses))
        self.ids[self.used:self.used + total] = ids
        self.size[at:at + len(sizes)] = sizes
        self.first[at:at + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.uses[at:at + len(sizes)] = 0
        self.entries, self.used = at + len(sizes), self.used + total
        return at

    def _learn(self, pieces: list[bytes]) -> tuple[dict[bytes, int], tuple[int, int]]:
        """Entries of new pieces; long ones come last and hold only until the mark that is returned is set again."""
        new = set(pieces)
        long = [p for p in new if len(p) > LONGEST_REMEMBERED]
        short = list(new.difference(long)) if long else list(new)
        made = dict(zip(short, count(self._append(*self._coded(short)))))
        mark = self.entries, self.used
        self.known.update(made)
        self.recent += short
        if long:
            made.update(zip(long, count(self._append(*self._coded(long)))))
        return made, mark

    def _remember(self, pieces: list[bytes]) -> None:
        """Table of the remembered pieces that are short enough for it."""
        short = [p for p in pieces if len(p) <= KEY_BYTES]
        sizes = np.fromiter(map(len, short), np.int64, len(short))
        raw = np.frombuffer(b"".join(short), np.uint8)
        self.table = LengthTable(piece_keys(raw, np.cumsum(sizes) - sizes, sizes), np.array([self.known[p] for p in short], np.int32))
        self.in_table, self.recent = len(short), []

    def _settle(self) -> None:
        """Take the recent pieces into the table once they are as many as those in it; forget the less used ones when there are too many."""
        if len(self.known) > CACHE_UNITS:
            pieces, at = list(self.known), np.fromiter(self.known.values(), np.int64, len(self.known))
            uses = self.uses[at]
            keep = np.argsort(-uses, kind="stable")[:CACHE_UNITS // 4]
            keep = keep[uses[keep] > 1]
            first, size = self.first[at[keep]], self.size[at[keep]]
            upto = np.cumsum(size)
            ids = self.ids[np.repeat(first - (upto - size), size) + np.arange(int(size.sum()))]
            self._start()
            pieces = [pieces[i] for i in keep.tolist()]
            self.known = dict(zip(pieces, count(self._append(ids, size))))
            self._remember(pieces)
        elif len(self.recent) > max(1024, self.in_table):
            self._remember(list(self.known))

    def _entries_of(self, raw, whole, starts, lengths) -> tuple[np.ndarray, tuple[int, int]]:
        entry = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(lengths <= KEY_BYTES)
        entry[short] = self.table.find(piece_keys(raw, starts[short], lengths[short]))
        miss = np.flatnonzero(entry < 0)
        mark = self.entries, self.used
        if len(miss):
            pieces = [whole[a:b] for a, b in zip(starts[miss].tolist(), (starts[miss] + lengths[miss]).tolist())]
            got = list(map(self.known.get, pieces))
            unknown = [p for p, g in zip(pieces, got) if g is None]
            if unknown:
                made, mark = self._learn(unknown)
                got = [made[p] if g is None else g for p, g in zip(pieces, got)]
            entry[miss] = got
        return entry, mark

    def _odd(self, text: bytes) -> np.ndarray:
        whole = text.decode()
        units = [whole]
        if not any(s in text for s in self.special):
            first, *rest = _CUT.split(whole)
            units = [first] + [" " + p for p in rest]
        return np.fromiter(chain.from_iterable(self._library(units)), np.uint32)

    def encode(self, off: np.ndarray, data: np.ndarray) -> list[np.ndarray]:
        """Ids of each text ``data[off[i]:off[i + 1]]``."""
        n = len(off) - 1
        if not self.by_pieces:
            texts = [data[a:b].tobytes().decode() for a, b in zip(off, off[1:])]
            return [np.array(i, "<u4") for i in self._library(texts)]
        if off[-1] == off[0]:
            return [np.empty(0, "<u4")] * n
        raw, whole, cuts, starts, lengths, text, odd = cut_texts(data, off, self.classes, self.special)
        if odd:
            plain = ~np.isin(text, np.fromiter(odd, np.int64))
            starts, lengths, text = starts[plain], lengths[plain], text[plain]
        entry, mark = self._entries_of(raw, whole, starts, lengths)
        self.uses[:self.entries] += np.bincount(entry, minlength=self.entries)
        size = self.size[entry]
        upto = np.cumsum(size)
        total = int(upto[-1]) if len(upto) else 0
        ids = self.ids[np.repeat(self.first[entry] - (upto - size), size) + np.arange(total)]
        ends = np.concatenate(([0], np.cumsum(np.bincount(text, weights=size, minlength=n)).astype(np.int64)))
        out = [ids[a:b] for a, b in zip(ends, ends[1:])]
        for t in odd:
            out[t] = self._odd(whole[cuts[t]:cuts[t + 1]])
        self.entries, self.used = mark
        self._settle()
        return out


def _coder(path: str) -> Encoder:
    """The encoder of this worker process: a worker serves many tasks and loads the vocabulary once."""
    held = sys.modules.setdefault("chartfold_worker_state", types.ModuleType("chartfold_worker_state"))
    if getattr(held, "path", None) != path:
        held.path, held.coder = path, Encoder(path)
    return held.coder


def _write(folder: str, tokenizer: str, end_id: int):
    def run(batches):
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder)
        coder = _coder(tokenizer)
        end = np.array([end_id], "<u4")
        doc_ids, ends, held, total, part, seq = [], [], [], 0, None, 0

        def close():
            nonlocal doc_ids, ends, held, total, seq
            name = f"{part:08d}-{seq:06d}-{uuid.uuid4().hex}.tok"
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(encode_file(doc_ids, ends, np.concatenate(held), coder.bits))
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                                              "name": [name], "n_docs": [len(doc_ids)], "n_ids": [total]})
            doc_ids, ends, held, total, seq = [], [], [], 0, seq + 1
            return row

        for batch in batches:
            off, data = binary_parts(batch.column("text"))
            for lo, hi in row_chunks(off, TEXT_AT_ONCE):
                some = batch.slice(lo, hi - lo)
                coded = coder.encode(off[lo:hi + 1], data)
                for p, doc, ids in zip(some.column("part").to_pylist(), some.column("doc_id").to_pylist(), coded):
                    if p != part:
                        if doc_ids:
                            yield close()
                        part, seq = p, 0
                    held += [ids, end]
                    total += len(ids) + 1
                    doc_ids.append(doc)
                    ends.append(total)
                    if total >= IDS_A_FILE:
                        yield close()
        if doc_ids:
            yield close()
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Encode the texts in ascending doc_id order into files in ``folder``; returns the files (part, seq, name, n_docs, n_ids, first).

    ``first``: ids in all files before.  Null text counts as empty: the end id alone.  Ties of doc_id go by a hash of
    the text, null doc_ids come first; every row is written.  ``folder`` is a path or URI that all executors
    reach.  ``tokenizer`` is the path of a byte-level vocabulary file on every machine.
    """
    folder = shared_folder(docs.sparkSession, folder)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt, parts = deal_by_id(rows, weight=F.octet_length("text"), most=CHARS_A_RANGE)
    dealt = dealt.withColumn("tie", F.xxhash64("text")).repartitionById(parts, "part").sortWithinPartitions("part", "doc_id", "tie")
    files = durable(dealt.select("part", "doc_id", "text").mapInArrow(_write(folder, tokenizer, end_id),
                                                                      "part int, seq int, name string, n_docs long, n_ids long"))
    # one row a file, some millions of ids each
    return files.withColumn("first", F.sum("n_ids").over(Window.orderBy("part", "seq")) - F.col("n_ids"))


def _read(batches):
    for batch in batches:
        for path, first, raw in zip(*(batch.column(c) for c in ("name", "first", "content"))):
            f = TokenFile(raw.as_buffer())
            at, first = 0, first.as_py()
            step = 64 << 10
            for lo in range(0, len(f.ends), step):
                ends = f.ends[lo:lo + step]
                starts = np.concatenate(([at], ends[:-1]))
                ids = f.ids(at, int(ends[-1])).astype("<u4")
                crc = [zlib.crc32(ids[a - at:b - at].tobytes()) for a, b in zip(starts, ends)]
                docs = pa.array(f.doc_ids[lo:lo + step], pa.int64(), mask=~f.has_id[lo:lo + step])
                yield pa.RecordBatch.from_arrays([docs, pa.array(starts + first), pa.array(ends - starts), pa.array(crc, pa.int64())],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])
                at = int(ends[-1])


def read_token_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the listed files of ``folder``, read back by Spark."""
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    listed = files.select("name", "first")
    return (stored.join(F.broadcast(listed), "name") if files.count() <= 100_000 else stored.join(listed, "name")).mapInArrow(
        _read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the documents as token files in the shared folder and return what the files hold, one row per document."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token_files")
    return read_token_files(spark, folder, write_token_files(docs, folder, tokenizer, end_id))

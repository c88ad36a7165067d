"""Helpers shared by the pipeline operators: table reads, durable intermediates, Arrow text access, hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import storage_root

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Shuffle files of an execution go when it ends, not when the driver next collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def durable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives lost executors; removed with the frame only where spark.cleaner.referenceTracking.cleanCheckpoints is on.

    The shuffle files that ``df`` was made from go as soon as it is written: the frame returned reads the checkpoint alone.
    """
    spark = df.sparkSession
    storage_root(spark)
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint(eager=True)       # a plan of its own, made under the setting
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def shared_folder(spark: SparkSession, folder: str) -> str:
    """The folder, made, with the scheme of the file system that Spark takes it to be on: tasks write to the same place as Spark reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    whole = fs.makeQualified(path).toString()
    return "file://" + whole[5:] if whole.startswith("file:/") and not whole.startswith("file://") else whole


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(col):
    return F.translate(col, UPPER, LOWER)


# ---------------------------------------------------------------- Arrow text access

def binary_parts(column) -> tuple[np.ndarray, np.ndarray]:
    """(offsets int64[n+1], bytes uint8) of a string or binary Arrow column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    return off, np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)


def row_chunks(offsets: np.ndarray, most: int):
    """Ranges of rows holding about ``most`` bytes; one row is never cut, so a long text is a chunk of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi


def binary_array(items: list[bytes]) -> pa.Array:
    return pa.array(items, type=pa.binary())


# ---------------------------------------------------------------- hashing

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)
_RADIX = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of the splitmix generator."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def mix_int(x: int) -> int:
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], dtype=np.uint64))[0])


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse modulo 2**64, kept per process and grown when a longer text comes."""
    if len(_POWERS[0]) < size:
        grown = 1 << (size - 1).bit_length()
        for i, base in enumerate((_RADIX, pow(_RADIX, -1, 1 << 64))):
            p = np.full(grown, base, np.uint64)
            p[0] = 1
            _POWERS[i] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0][:size], _POWERS[1][:size]


def word_hashes(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray):
    """Hash of every word of the texts ``data[offsets[i]:offsets[i+1]]``, A-Z counted as a-z.

    Returns (hashes uint64, first word of each text int64[n+1]).  Words are
    maximal runs of bytes with ``in_word``; they never cross texts.
    """
    base = int(offsets[0])
    raw = data[base:int(offsets[-1])]
    off = (offsets - base).astype(np.int64)
    size = len(raw)
    if not size:
        return np.empty(0, np.uint64), np.zeros(len(off), np.int64)
    inside = in_word[raw]
    edge = np.zeros(size + 1, bool)
    edge[off] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:size]
    last[:-1] &= ~inside[1:] | edge[1:size]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    codes = np.arange(1, 257, dtype=np.uint64)
    codes[65:91] += np.uint64(32)
    power, inverse = _powers(size)
    terms = codes[raw]
    terms *= power
    sums = np.cumsum(terms, dtype=np.uint64)
    words = (sums[ends] - sums[starts] + terms[starts]) * inverse[starts]
    return mix(words + (ends - starts).astype(np.uint64) * _M2), np.searchsorted(starts, off).astype(np.int64)


#: Words of the shingle operators: runs without space, tab, line feed, vertical tab, form feed, return.
def not_space() -> np.ndarray:
    t = np.ones(256, bool)
    t[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return t

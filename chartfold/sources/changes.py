"""Tables kept as a base and change files, merged when read.

A write of a small batch adds one ``c=<n>`` folder and leaves the base alone, so the bytes written follow the batch.
Numbers ascend and order the changes.  ``v=<n>`` is a base with every change up to n in it, ``m=<n>`` one merged
file set of the changes between the base and n.  As in ``VersionedTable`` a folder counts once it holds ``_SUCCESS``:
a run that dies leaves nothing that a reader takes.

``compact`` folds the changes into a new base once they have grown to a share of it, and many small changes into
one ``m=`` folder before that; each byte of a change is thus rewritten a bounded number of times for each doubling
of the changes.  Folders that the last base but one made superfluous are removed, so a reader that has just
opened the table keeps its files.  One writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import rows_by_key_filter
from ..operators.upsert import change_order, latest_per_key, upsert_by_key
from ..session import STORED_CODEC, storage_root
from .storage import _fs

CHANGE = "_change"            # number of the change a row came with
COMPACT_SHARE = 0.5           # changes of this share of the base's bytes are folded into it
MERGE_FOLDERS = 32            # so many change folders are merged into one


@dataclass(frozen=True)
class LatestRow:
    """Rows replace the stored ones with their key: the last change wins, within a change the latest version."""
    keys: tuple

    def whole(self, df: DataFrame) -> DataFrame:
        """A base as it is stored."""
        return df

    def fold(self, changes: DataFrame) -> DataFrame:
        return latest_per_key(changes, self.keys, order_by=[F.col(CHANGE), *change_order(changes)]).drop(CHANGE)

    def onto(self, base: DataFrame, changes: DataFrame) -> DataFrame:
        return upsert_by_key(base, self.fold(changes), self.keys, dedupe=False, null_safe=False)


@dataclass(frozen=True)
class SignedCounts:
    """Rows carry a signed count ``n``: counts of equal rows are summed, rows with none left are gone.

    A base holds every row once.  So a base row that the key filter of the changes does not know is as it was, and only the others are folded.
    """

    def whole(self, df: DataFrame) -> DataFrame:
        return self.fold(df)

    def fold(self, changes: DataFrame) -> DataFrame:
        rest = [c for c in changes.columns if c not in ("n", CHANGE)]
        return changes.groupBy(*rest).agg(F.sum("n").alias("n")).where("n != 0")

    def onto(self, base: DataFrame, changes: DataFrame) -> DataFrame:
        changes = changes.drop(CHANGE)
        keys = [c for c in base.columns if c != "n"]
        if keys != [c for c in changes.columns if c != "n"]:
            return self.fold(base.unionByName(changes, allowMissingColumns=True))
        free, hit = rows_by_key_filter(base, changes, keys)
        return free.unionByName(self.fold(hit.unionByName(changes)))


class ChangeTable:
    def __init__(self, spark: SparkSession, name: str, rule, root: str | None = None):
        self.spark = spark
        self.rule = rule
        self.path = f"{(root or storage_root(spark) + '/tables').rstrip('/')}/{name}"

    # -- metadata ------------------------------------------------------------
    def _listing(self) -> dict[str, list[tuple[int, bool]]]:
        """(number, committed) of every folder, by kind: v, m, c."""
        fs, p = _fs(self.spark, self.path)
        out = {"v": [], "m": [], "c": []}
        if fs.exists(p):
            done = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
            for st in fs.listStatus(p):
                kind, _, number = st.getPath().getName().partition("=")
                if st.isDirectory() and kind in out and number.isdigit():
                    out[kind].append((int(number), fs.exists(done(st.getPath(), "_SUCCESS"))))
        return {k: sorted(v) for k, v in out.items()}

    def _live(self, upto: int | None = None) -> tuple[int | None, list[tuple[str, int]]]:
        """Number of the base and the change folders to merge onto it."""
        have = {k: [n for n, ok in v if ok and (upto is None or n <= upto)] for k, v in self._listing().items()}
        if not have["v"]:
            return None, []
        base = have["v"][-1]
        merged = [n for n in have["m"] if n > base][-1:]
        return base, [("m", n) for n in merged] + [("c", n) for n in have["c"] if n > max([base, *merged])]

    def exists(self) -> bool:
        return self._live()[0] is not None

    def last(self) -> int:
        """Number of the last change held; 0 for a table without a base."""
        base, folders = self._live()
        return folders[-1][1] if folders else base or 0

    # -- io --------------------------------------------------------------------
    def _folder(self, kind: str, n: int) -> str:
        return f"{self.path}/{kind}={n}"

    def _put(self, df: DataFrame, kind: str, n: int) -> None:
        # an uncommitted folder of that number is left over from a run that died
        df.write.mode("overwrite").option("compression", STORED_CODEC).parquet(self._folder(kind, n))

    def _changes(self, folders) -> DataFrame:
        out = None
        for kind, n in folders:
            one = self.spark.read.parquet(self._folder(kind, n)).withColumn(CHANGE, F.lit(n))
            out = one if out is None else out.unionByName(one, allowMissingColumns=True)
        return out

    def write(self, df: DataFrame) -> None:
        """Replace the table."""
        self._put(self.rule.whole(df), "v", max([0, *(n for v in self._listing().values() for n, _ in v)]) + 1)
        self._remove_superseded()

    def read(self, upto: int | None = None, only=None) -> DataFrame:
        """The rows with every change in, or those up to a number.  ``only`` cuts base and changes down to the wanted rows before
        they are merged; it must decide alike for all versions of a row."""
        base, folders = self._live(upto)
        if base is None:
            raise FileNotFoundError(f"{self.path} has no committed base")
        only = only or (lambda df: df)
        stored = only(self.spark.read.parquet(self._folder("v", base)))
        return self.rule.onto(stored, only(self._changes(folders))) if folders else stored

    def append(self, batch: DataFrame, number: int | None = None) -> int:
        """Add a change.  A change whose number the table holds already is not applied again, so a run that is
        repeated with its number leaves the table as it is; without a number the next free one is taken."""
        last = self.last()
        if not last:
            raise FileNotFoundError(f"{self.path} has no committed base")
        if number is None:
            number = last + 1
        if number > last:
            self._put(self.rule.fold(batch.withColumn(CHANGE, F.lit(number))), "c", number)
        return number

    # -- compaction -------------------------------------------------------------
    def bytes_of(self, kind: str, n: int) -> int:
        fs, p = _fs(self.spark, self._folder(kind, n))
        return fs.getContentSummary(p).getLength()

    def compact(self) -> str | None:
        """Fold the changes where that is due; returns the kind of folder written, if any."""
        base, folders = self._live()
        if not folders:
            return None
        if sum(self.bytes_of(*f) for f in folders) >= COMPACT_SHARE * self.bytes_of("v", base):
            self._put(self.read(), "v", folders[-1][1])
            self._remove_superseded()
            return "v"
        if len(folders) >= MERGE_FOLDERS:
            self._put(self.rule.fold(self._changes(folders)), "m", folders[-1][1])
            return "m"
        return None

    def _remove_superseded(self) -> None:
        have = self._listing()
        bases = [n for n, ok in have["v"] if ok]
        if len(bases) < 2:
            return
        before = bases[-2]
        fs, _ = _fs(self.spark, self.path)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for kind, found in have.items():
            for n, _ in found:
                if n < before or (n == before and kind != "v"):
                    fs.delete(path(self._folder(kind, n)), True)

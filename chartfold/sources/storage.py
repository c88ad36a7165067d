"""Versioned parquet tables in the shared storage folder.

Spark cannot overwrite a path it is reading, and plain parquet has no
DELETE/MERGE.  Every write goes to a new ``v=<n>`` folder; the version is
visible once the job commit writes ``_SUCCESS``, so a half-written version
(a lost executor, a failed job) is never read.  Readers take the highest
committed version; ``keep`` bounds how many old versions remain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import storage_root


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class VersionedTable:
    def __init__(self, spark: SparkSession, name: str, root: str | None = None):
        self.spark = spark
        self.name = name
        self.root = (root or storage_root(spark) + "/tables").rstrip("/")
        self.path = f"{self.root}/{name}"

    # -- metadata ----------------------------------------------------------
    def _listing(self) -> list[tuple[int, bool]]:
        """(version, committed) for every ``v=<n>`` folder."""
        fs, p = _fs(self.spark, self.path)
        if not fs.exists(p):
            return []
        jvm = self.spark.sparkContext._jvm
        out = []
        for st in fs.listStatus(p):
            nm = st.getPath().getName()
            if st.isDirectory() and nm.startswith("v=") and nm[2:].isdigit():
                out.append((int(nm[2:]), fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))))
        return sorted(out)

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return [v for v, ok in self._listing() if ok]

    def exists(self) -> bool:
        """Table-exists probe (S12): a committed version is present."""
        return bool(self.versions())

    def current_path(self) -> str | None:
        v = self.versions()
        return f"{self.path}/v={v[-1]}" if v else None

    # -- io ------------------------------------------------------------------
    def read(self) -> DataFrame:
        p = self.current_path()
        if p is None:
            raise FileNotFoundError(f"table {self.name} has no committed version")
        return self.spark.read.parquet(p)

    def write(self, df: DataFrame, partition_by=None, keep: int = 3) -> str:
        """Write ``df`` as the next version (full replace, S6/S7)."""
        # past every folder, committed or not: a failed write never blocks the next one
        allv = self._listing()
        nxt = (allv[-1][0] + 1) if allv else 1
        out = f"{self.path}/v={nxt}"
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(out)
        self._vacuum(keep)
        return out

    def _vacuum(self, keep: int):
        vs = self.versions()
        fs, _ = _fs(self.spark, self.path)
        jvm = self.spark.sparkContext._jvm
        for old in vs[:-keep] if keep and len(vs) > keep else []:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={old}"), True)

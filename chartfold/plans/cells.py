"""Wide cells kept as counted values, under insert, edit and void (A10, H5).

``MAX`` cannot be taken back: when the greatest value of a cell is voided, the wide row alone does not say which value is
next.  The state therefore holds, per group and cell, each distinct value with the number of rows that have it.  An
increment is the signed difference of the changed rows: what they were counts -1, what they are counts +1; rows that
did not change in what the pivot reads cancel out.  Only the groups in the difference
are folded again: the rest of the state is read but not shuffled, and flat rows of other obs are not read.

A cell is named by (concept, family, answer), not by a column, and every value of a row is counted, whether or not
its column exists yet.  So a family that a concept gains later finds the values of its older rows in the state (rule a), and a
column whose last row is voided goes, as in a rebuild: the catalog is folded from counts of (concept, type, answer).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import rows_with_keys, rows_without_keys
from ..sources.changes import ChangeTable, SignedCounts
from .pivot import (MAX_BROADCAST_CATALOG, CatalogEntry, PivotSpec, by_group, catalog_frame, catalog_rows,
                    project_folded)

# families -> the state's column for their values
VALUES = {"numeric": ("num", "double"), "text": ("txt", "string"), "datetime": ("ts", "timestamp_ntz"), "drug": ("drug", "bigint")}
ROW = "row"                   # counts the rows of a group and their dates of creation


def _entry(family: str, spec: PivotSpec, value: str | None, concept: Column, answer: Column) -> Column:
    held = VALUES["datetime"][0] if family == ROW else VALUES.get(family, (None,))[0]
    return F.struct(concept.alias("concept"), F.lit(family).alias("family"), answer.alias("answer"),
                    *[(F.col(value) if name == held and value else F.lit(None)).cast(kind).alias(name) for name, kind in VALUES.values()])


def count_cells(flat: DataFrame, spec: PivotSpec = PivotSpec(), sign: int = 1) -> DataFrame:
    """(keys, concept, family, answer, num, txt, ts, drug, n): one row per group, cell and distinct value.

    -0.0 is counted as 0.0, which it equals.  Every flat row also counts in its group's ``row`` entry, so groups without any concept exist (rule on NULL concepts).
    """
    concept, none = F.col(spec.concept), F.lit(None).cast("string")
    coded = _entry("coded", spec, None, concept, F.col(spec.answer))
    entries = [_entry(ROW, spec, spec.created, none, none), F.when(concept.isNotNull() & F.col(spec.answer).isNotNull(), coded)]
    for family in VALUES:
        value = spec.value_col(family)
        entries.append(F.when(concept.isNotNull() & F.col(value).isNotNull(), _entry(family, spec, value, concept, none)))
    # a flat row is shuffled once, by its group, and not once for each of its entries
    rows = by_group(flat, spec).select(*spec.keys, F.explode(F.array_compact(F.array(*entries))).alias("e")).select(*spec.keys, "e.*")
    return rows.groupBy(*spec.keys, "concept", "family", "answer", *[n for n, _ in VALUES.values()]) \
               .agg((F.count(F.lit(1)) * sign).alias("n"))


def count_types(flat: DataFrame, spec: PivotSpec = PivotSpec(), sign: int = 1) -> DataFrame:
    """(concept, family, answer, n): rows per column that the pivot discovers; bounded by the number of columns."""
    df = flat.where(F.col(spec.concept).isNotNull())
    if spec.concept_filter is not None:
        df = df.where(spec.concept_filter)
    family = spec.classify()
    return df.groupBy(F.col(spec.concept).alias("concept"), family.alias("family"),
                      F.when(family == "coded", F.col(spec.answer)).alias("answer")).agg((F.count(F.lit(1)) * sign).alias("n"))


def difference(count, before: DataFrame, after: DataFrame, spec: PivotSpec) -> DataFrame:
    """Signed counts that lead from the rows ``before`` to the rows ``after``."""
    return SignedCounts().fold(count(before, spec, -1).unionByName(count(after, spec, 1)))


def fold_state(state: DataFrame, catalog: list[CatalogEntry], spec: PivotSpec = PivotSpec()) -> DataFrame:
    """The wide rows of the groups in ``state``."""
    cat = catalog_frame(state.sparkSession, catalog).select(
        F.col("col_id").alias("__cid"), F.col("concept").alias("__concept"), F.col("family").alias("__family"),
        F.coalesce("answer", F.lit("")).alias("__answer"))
    if len(catalog) <= MAX_BROADCAST_CATALOG:          # the catalog is on the driver already
        cat = F.broadcast(cat)
    cells = state.join(cat, (F.col("concept") == F.col("__concept")) & (F.col("family") == F.col("__family"))
                       & (F.coalesce("answer", F.lit("")) == F.col("__answer")), "left")
    # one shuffle, by the group, for both steps: first by cell, so that what a group gathers is bounded by the columns
    agg = {name: spec.agg(family, F.col(name)) for family, (name, _) in VALUES.items()}
    cells = cells.select(*spec.keys, "__cid", F.when(F.col("family") == ROW, F.col("ts")).alias("__created"),
                         F.when(F.col("family") == "coded", F.lit(1)).alias("one"), *agg).repartition(*spec.keys)
    by_cell = cells.groupBy(*spec.keys, "__cid").agg(F.max("__created").alias("__created"), F.max("one").alias("one"), *[c.alias(n) for n, c in agg.items()])
    entry = F.when(F.col("__cid").isNotNull(), F.struct(F.col("__cid").alias("k"), F.struct("one", *agg).alias("v")))
    folded = by_cell.groupBy(*spec.keys).agg(
        *([F.max("__created").alias("date_created")] if spec.created else []), F.map_from_entries(F.collect_list(entry)).alias("__m"))
    return project_folded(folded, catalog, spec)


def touched_groups(state, delta: DataFrame, old: list[CatalogEntry], new: list[CatalogEntry], spec: PivotSpec) -> DataFrame:
    """Groups of the difference, and groups that hold values for a column that the catalog has gained.  ``state``: function of the
    cut that the state is read with."""
    groups = delta.select(*spec.keys)
    had = {(e.concept, e.family, e.answer) for e in old}
    grown = [e for e in new if e.family != "coded" and (e.concept, e.family, e.answer) not in had]
    if grown:
        g = catalog_frame(delta.sparkSession, grown).select("concept", "family")
        g = F.broadcast(g) if len(grown) <= MAX_BROADCAST_CATALOG else g
        groups = groups.unionByName(state(lambda df: df.join(g, ["concept", "family"], "left_semi")).select(*spec.keys))
    return groups.distinct()


class CellStore:
    """The counted cells of a wide table, stored as a base and signed changes.

    The two tables (cells, types) take a change under one number.  Readers use the greatest number that both hold, so a run
    that dies between the two changes nothing; repeated with its number it adds what is missing.
    """

    def __init__(self, spark: SparkSession, root: str, spec: PivotSpec = PivotSpec()):
        if any(f not in (F.max, F.min) for f in spec.aggregates.values()):
            raise ValueError("distinct values give the greatest and the least of a cell only")
        self.spec = spec
        self.cells = ChangeTable(spark, "cells", SignedCounts(), root)
        self.types = ChangeTable(spark, "types", SignedCounts(), root)

    def build(self, flat: DataFrame) -> None:
        self.cells.write(count_cells(flat, self.spec))
        self.types.write(count_types(flat, self.spec))

    def number(self) -> int:
        return min(self.cells.last(), self.types.last())

    def state(self, only=None) -> DataFrame:
        """The counted cells; ``only`` cuts them down by what names a cell before the changes are merged."""
        return self.cells.read(self.number(), only)

    def found(self) -> list:
        """The discovered (concept, family, answer) with safe name parts: one row per column, the only thing collected."""
        return self.types.read(self.number()).select(
            "concept", "family", "answer", self.spec.name_fn(F.col("concept")).alias("concept_safe"),
            self.spec.name_fn(F.col("answer")).alias("answer_safe")).collect()

    def catalog(self) -> list[CatalogEntry]:
        return catalog_rows(self.found(), self.spec)

    def apply(self, before: DataFrame, after: DataFrame, number: int | None = None) -> DataFrame:
        """Take in the changed rows as they were and as they are; returns the change of the cells as it is stored."""
        number = self.number() + 1 if number is None else number
        self.cells.append(difference(count_cells, before, after, self.spec), number)
        self.types.append(difference(count_types, before, after, self.spec), number)
        return self.cells._changes([("c", number)])

    def wide(self) -> DataFrame:
        found = self.found()
        # no row has a concept: nothing is emitted, rule (e)
        return fold_state(self.state() if found else self.state().where(F.lit(False)), catalog_rows(found, self.spec), self.spec)

    def compact(self) -> None:
        self.cells.compact()
        self.types.compact()


def refresh_wide_cells(wide_old: DataFrame, old: list[CatalogEntry], store: CellStore, delta: DataFrame) -> tuple[DataFrame, list[CatalogEntry]]:
    """The stored wide table with the touched groups folded anew from the state."""
    from .incremental import _staged, align_columns
    spec, found = store.spec, store.found()
    new = catalog_rows(found, spec)
    if not found or not old:               # nothing emitted now, or nothing emitted before: rule (e)
        return store.wide(), new
    groups = _staged(touched_groups(store.state, delta, old, new, spec), "touched_groups")
    fresh = fold_state(store.state(lambda df: rows_with_keys(df, groups, spec.keys, null_safe=True)), new, spec)
    kept = rows_without_keys(align_columns(wide_old, old, new, spec), groups, spec.keys, null_safe=True)
    return kept.unionByName(fresh), new


__all__ = ["CellStore", "count_cells", "count_types", "difference", "fold_state", "refresh_wide_cells", "touched_groups"]

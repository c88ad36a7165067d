"""Dynamic long-to-wide pivot.

1. Discover: one distinct job over the flat table gives (concept, value type,
   coded answer) triples.  It is partial-aggregated, so its result is
   bounded by the number of distinct output columns, not by the data.
2. Catalog: names from Spark column expressions; collected once (one row
   per output column, the only thing that visits the driver), sorted, and
   de-duplicated (``_2``, ``_3``).
3. Widen: either
   * ``conditional`` - ``groupBy(keys).agg(max(CASE ...))``, one aggregate
     per output column (the source's plan; fine for narrow catalogs), or
   * ``long`` - broadcast-join each row to its catalog cells, pre-aggregate
     to (keys, column id), then fold the cells of a group into a map and
     project the columns.  Work per row is O(1) in the number of columns
     and the shuffled buffers stay narrow, so it is the plan for wide
     catalogs.
   ``auto`` picks by catalog width.

Rules kept from the source: the type decides which columns exist, values
come from any row of the concept; 'other' and unnamed answers get no
column; NULL-concept rows still form groups; one-hot absent = 0, others
absent = NULL; a concept with two types gets two column families.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.classify import FAMILIES, value_type
from ..functions.naming import FAMILY_SUFFIX, dedupe_names, safe_name_col

ENCOUNTER_KEYS = ("person_id", "encounter_id", "encounter_type_name", "visit_date_started", "location_name")
FAMILY_RANK = {f: i for i, f in enumerate(FAMILIES)}
# Above this many output columns the long plan is used by ``auto``.
WIDE_THRESHOLD = 100
# One row per output column; far beyond any usable table width.
MAX_BROADCAST_CATALOG = 1_000_000


@dataclass
class PivotSpec:
    """Where the long table keeps each part of an observation (U2 hooks included)."""
    keys: tuple = ENCOUNTER_KEYS
    concept: str = "concept_name"
    answer: str = "value_coded_name"
    coded: str = "value_coded"
    numeric: str = "value_numeric"
    text: str = "value_text"
    datetime: str = "value_datetime"
    drug: str = "value_drug"
    created: str | None = "date_created"
    concept_filter: Column | None = None              # F14 / "filter specific concepts"
    name_fn: Callable[[Column], Column] = safe_name_col  # "change column naming conventions"
    families: tuple = FAMILIES                         # which column families to emit
    aggregates: dict = field(default_factory=dict)     # family -> fn(Column) -> Column, default max
    type_map: dict = field(default_factory=dict)       # classified type -> family it is pivoted as

    def value_col(self, family: str) -> str:
        return {"numeric": self.numeric, "text": self.text, "datetime": self.datetime,
                "drug": self.drug}[family]

    def classify(self) -> Column:
        t = value_type(self.coded, self.numeric, self.text, self.datetime, self.drug)
        if not self.type_map:
            return t
        mapped = None
        for src, dst in self.type_map.items():
            mapped = (F.when(t == src, F.lit(dst)) if mapped is None
                      else mapped.when(t == src, F.lit(dst)))
        return mapped.otherwise(t)

    def agg(self, family: str, c: Column) -> Column:
        return self.aggregates.get(family, F.max)(c)

    def agg_cells(self, family: str, c: Column) -> Column:
        """The aggregate over the cells of a group that hold a value; NULL in a group without one, in both plans."""
        out = self.agg(family, c)
        return F.when(F.count(c) > 0, out) if family in self.aggregates else out


@dataclass(frozen=True)
class CatalogEntry:
    col_id: int
    name: str
    concept: str
    family: str
    answer: str | None


def concept_types(flat: DataFrame, spec: PivotSpec = PivotSpec()) -> DataFrame:
    """A1: DISTINCT (concept, value type) over named concepts."""
    df = flat.where(F.col(spec.concept).isNotNull())
    if spec.concept_filter is not None:
        df = df.where(spec.concept_filter)
    return df.select(F.col(spec.concept).alias("concept_name"),
                     spec.classify().alias("value_type")).distinct()


def coded_answers(flat: DataFrame, spec: PivotSpec = PivotSpec()) -> DataFrame:
    """A2: DISTINCT (concept, answer) for every concept that has a coded row, in one job."""
    df = flat.where(F.col(spec.concept).isNotNull() & F.col(spec.answer).isNotNull())
    if spec.concept_filter is not None:
        df = df.where(spec.concept_filter)
    return df.select(F.col(spec.concept).alias("concept_name"),
                     F.col(spec.answer).alias("answer")).distinct()


def discover(flat: DataFrame, spec: PivotSpec = PivotSpec()) -> DataFrame:
    """One distinct job: (concept, family, coded answer) with safe name parts.

    A coded concept's answers come from any of its rows with a named answer
    (only coded rows can have one), so a single DISTINCT replaces the
    source's one-query-per-concept loop.
    """
    df = flat.where(F.col(spec.concept).isNotNull())
    if spec.concept_filter is not None:
        df = df.where(spec.concept_filter)
    fam = spec.classify()
    d = df.select(F.col(spec.concept).alias("concept"), fam.alias("family"),
                  F.when(fam == "coded", F.col(spec.answer)).alias("answer")).distinct()
    return d.select("concept", "family", "answer",
                    spec.name_fn(F.col("concept")).alias("concept_safe"),
                    spec.name_fn(F.col("answer")).alias("answer_safe"))


def named_idents(rows, spec: PivotSpec = PivotSpec()) -> list[tuple]:
    """Sorted (concept, family rank, answer or "", family, answer, name before de-duplication) of the discovered columns."""
    coded = {r.concept for r in rows if r.family == "coded"}
    out = []
    for r in rows:
        if r.family not in spec.families:
            continue
        if r.family == "coded":
            if r.answer is None or r.concept not in coded:
                continue
            raw = f"{r.concept_safe}_{r.answer_safe}"
        elif r.family in FAMILY_SUFFIX:
            raw = f"{r.concept_safe}_{FAMILY_SUFFIX[r.family]}"
        else:
            continue
        out.append((r.concept, FAMILY_RANK[r.family], r.answer or "", r.family, r.answer, raw))
    return sorted(set(out))


def reserved_names(spec: PivotSpec) -> set[str]:
    return set(spec.keys) | ({"date_created"} if spec.created else set())


def catalog_rows(rows, spec: PivotSpec = PivotSpec()) -> list[CatalogEntry]:
    """Column catalog from the collected distinct rows: sorted, names de-duplicated (H7)."""
    out = named_idents(rows, spec)
    names = dedupe_names([o[5] for o in out], taken=reserved_names(spec))
    return [CatalogEntry(i, n, o[0], o[3], o[4]) for i, (n, o) in enumerate(zip(names, out))]


def build_catalog(flat: DataFrame, spec: PivotSpec = PivotSpec()) -> list[CatalogEntry]:
    """A3: the sorted, de-duplicated column catalog (one collected row per column)."""
    return catalog_rows(discover(flat, spec).collect(), spec)


def catalog_frame(spark, catalog: list[CatalogEntry]) -> DataFrame:
    schema = T.StructType([T.StructField("col_id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("concept", T.StringType()), T.StructField("family", T.StringType()),
                           T.StructField("answer", T.StringType())])
    return spark.createDataFrame([Row(e.col_id, e.name, e.concept, e.family, e.answer) for e in catalog],
                                 schema)


def _base_aggs(spec: PivotSpec) -> list[Column]:
    return [F.max(spec.created).alias("date_created")] if spec.created else []


def widen_conditional(flat: DataFrame, catalog: list[CatalogEntry], spec: PivotSpec = PivotSpec()) -> DataFrame:
    aggs = _base_aggs(spec)
    concept = F.col(spec.concept)
    for e in catalog:
        hit = concept == F.lit(e.concept)
        if e.family == "coded":
            cond = hit & (F.col(spec.answer) == F.lit(e.answer))
            aggs.append(F.coalesce(spec.agg_cells("coded", F.when(cond, F.lit(1))), F.lit(0)).alias(e.name))
        else:
            aggs.append(spec.agg_cells(e.family, F.when(hit, F.col(spec.value_col(e.family)))).alias(e.name))
    if not aggs:
        return flat.select(*spec.keys).distinct()
    return flat.groupBy(*spec.keys).agg(*aggs)


def widen_long(flat: DataFrame, catalog: list[CatalogEntry], spec: PivotSpec = PivotSpec()) -> DataFrame:
    return project_folded(fold_cells(flat, catalog, spec), catalog, spec)


def fold_cells(flat: DataFrame, catalog: list[CatalogEntry], spec: PivotSpec = PivotSpec()) -> DataFrame:
    """Cells pre-aggregated per (group, column id), then folded into one map per group."""
    spark = flat.sparkSession
    cat = catalog_frame(spark, catalog).select(
        F.col("col_id").alias("__cid"), F.col("concept").alias("__concept"),
        F.col("family").alias("__family"), F.col("answer").alias("__answer"))
    # The catalog is already on the driver, so its size is known: broadcast is bounded, beyond it the join shuffles.
    if len(catalog) <= MAX_BROADCAST_CATALOG:
        cat = F.broadcast(cat)
    fam = F.col("__family")
    match = ((fam == "coded") & (F.col(spec.answer) == F.col("__answer")))
    for f in ("numeric", "text", "datetime", "drug"):
        match = match | ((fam == f) & F.col(spec.value_col(f)).isNotNull())
    created = [spec.created] if spec.created else []
    src = flat.select(*spec.keys, *created, spec.concept, spec.answer,
                      spec.numeric, spec.text, spec.datetime, spec.drug)
    cells = src.join(cat, (F.col(spec.concept) == F.col("__concept")) & match, "left")
    v = {
        "one": F.when(fam == "coded", F.lit(1)),
        "num": F.when(fam == "numeric", F.col(spec.numeric)),
        "txt": F.when(fam == "text", F.col(spec.text)),
        "ts": F.when(fam == "datetime", F.col(spec.datetime)),
        "drug": F.when(fam == "drug", F.col(spec.drug)),
    }
    fam_of = {"one": "coded", "num": "numeric", "txt": "text", "ts": "datetime", "drug": "drug"}
    used = [k for k in v if fam_of[k] in {e.family for e in catalog}]
    step1 = cells.groupBy(*spec.keys, "__cid").agg(
        *([F.max(spec.created).alias("__created")] if spec.created else []),
        *[spec.agg(fam_of[k], v[k]).alias(k) for k in used])
    entry = F.when(F.col("__cid").isNotNull(),
                   F.struct(F.col("__cid").alias("k"), F.struct(*[F.col(k) for k in used]).alias("v")))
    return step1.groupBy(*spec.keys).agg(
        *([F.max("__created").alias("date_created")] if spec.created else []),
        F.map_from_entries(F.collect_list(entry)).alias("__m"))


def project_folded(step2: DataFrame, catalog: list[CatalogEntry], spec: PivotSpec = PivotSpec()) -> DataFrame:
    """The wide columns out of the per-group cell map."""
    key_of = {"coded": "one", "numeric": "num", "text": "txt", "datetime": "ts", "drug": "drug"}
    # One selectExpr call for all columns: the expressions hold only integer
    # ids and quoted column names, so no data value is spliced into SQL text.
    out = [_q(k) for k in spec.keys] + (["date_created"] if spec.created else [])
    for e in catalog:
        val = f"__m[{e.col_id}].{key_of[e.family]}"
        if e.family == "coded":
            val = f"coalesce({val}, 0)"
        out.append(f"{val} AS {_q(e.name)}")
    return step2.selectExpr(*out)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def by_group(flat: DataFrame, spec: PivotSpec = PivotSpec()) -> DataFrame:
    """What the pivot reads of a row, dealt by group.

    The greatest text of a group is found in sorted rows.  A task that reads a stored table would sort its whole file before the
    shuffle and again after it; dealt first, rows are sorted once, in shuffle partitions.
    """
    needed = dict.fromkeys([*spec.keys, *([spec.created] if spec.created else []), spec.concept, spec.answer,
                            spec.numeric, spec.text, spec.datetime, spec.drug])
    return flat.select(*needed).repartition(*spec.keys)


def widen(flat: DataFrame, spec: PivotSpec = PivotSpec(), strategy: str = "auto",
          catalog: list[CatalogEntry] | None = None, stored: bool = False) -> DataFrame:
    """The wide table; columns discovered from ``flat`` unless a catalog is given.

    ``stored``: ``flat`` is read from files, not joined in the same plan, which would have dealt it by encounter already.
    Where no row has a concept, discovery finds nothing and nothing is emitted: no rows, rule (e).
    """
    if catalog is None:
        found = discover(flat, spec).collect()
        if not found:
            flat = flat.where(F.lit(False))
        catalog = catalog_rows(found, spec)
    if strategy == "auto":
        strategy = "long" if len(catalog) > WIDE_THRESHOLD else "conditional"
    if stored:
        flat = by_group(flat, spec)
    if strategy == "conditional":
        return widen_conditional(flat, catalog, spec)
    if strategy == "long":
        return widen_long(flat, catalog, spec)
    raise ValueError(f"unknown strategy {strategy!r}")

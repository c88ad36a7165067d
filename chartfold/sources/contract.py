"""Schema contract of the raw tables: typed columns, rows that do not fit go to a quarantine.

The type of a column follows from its name (SURVEY §1.2: ids and references are 64-bit, flags boolean, dates without a zone,
measurements double, anything else text), so the rule covers all 44 tables and columns that a source adds later.  A row fits
when its key columns hold values and every other value converts without loss:

* an id or number given as text must be one ("12.7" and "" are no id), a fraction is no id, "50,0" is no double;
* a flag is true/false, t/f, yes/no, y/n (any case), or 1/0;
* a date that does not exist, zero dates included, is no date.

A row with several faults is quarantined once, with every reason.  Missing columns other than keys are read as they are (absent),
extra columns are kept with the type of their name.  Columns that already have their type are passed through
untouched, so cursor filters still reach the scan.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import RAW_TABLES, TableSpec
from .changes import ChangeTable
from .raw import FLAG_COLUMNS, Reader, cursor_scan

REFERENCES = ("creator", "encounter_type", "value_coded", "value_drug", "previous_version", "state", "duration_mins")
MEASUREMENTS = ("value_numeric", "dose", "quantity")
DATES = {("person", "birthdate"), ("patient_state", "start_date"), ("patient_state", "end_date")}
MOMENTS = ("death_date",)
TRUE, FALSE = ("1", "true", "t", "y", "yes"), ("0", "false", "f", "n", "no")
REASONS = "_reasons"


def column_type(table: str, column: str) -> str:
    """Type of a raw column by its name."""
    if column in FLAG_COLUMNS:
        return "boolean"
    if (table, column) in DATES:
        return "date"
    if column.startswith("date_") or column.endswith(("_datetime", "_date_time")) or column in MOMENTS:
        return "timestamp_ntz"
    if column in MEASUREMENTS:
        return "double"
    # text keys of the catalog (roles, privileges, properties) are named without _id
    return "bigint" if column.endswith("_id") or column in REFERENCES else "string"


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def converted(name: str, have: str, want: str) -> Column:
    """The value as its contract type; NULL where it does not convert without loss."""
    c = _col(name)
    if have == want:
        return c
    if want == "boolean":
        text = F.lower(F.trim(c)) if have == "string" else None
        if text is None:                                           # numbers: 1 and 0
            return F.when(c == 1, F.lit(True)).when(c == 0, F.lit(False))
        return F.when(text.isin(*TRUE), F.lit(True)).when(text.isin(*FALSE), F.lit(False))
    out = c.try_cast(want)
    if want == "bigint" and (have in ("double", "float") or have.startswith("decimal")):
        return F.when(out.cast("double") == c.cast("double"), out)
    if want == "date" and have in ("timestamp", "timestamp_ntz"):
        return F.when(out.cast(have) == c, out)
    return out


def checked(df: DataFrame, spec: TableSpec, types: dict | None = None) -> DataFrame:
    """All rows with typed columns and ``_reasons``: what does not fit, empty for rows that do.

    ``types`` overrides the type of single columns of this table by name.
    """
    absent = [k for k in spec.keys if k not in df.columns]
    if absent:
        raise ValueError(f"{spec.name} has no key column {', '.join(absent)}")
    values, faults = [], []
    for name, have in df.dtypes:
        want = (types or {}).get(name) or column_type(spec.name, name)
        value = converted(name, have, want)
        values.append(value.alias(name))
        if name in spec.keys:
            faults.append(F.when(_col(name).isNull(), F.lit(f"{name}: key is null")))
        if have != want:
            faults.append(F.when(_col(name).isNotNull() & value.isNull(), F.lit(f"{name}: not {want}")))
    return df.select(*values, F.array_compact(F.array(*faults)).alias(REASONS))


def accepted(df: DataFrame, spec: TableSpec, types: dict | None = None) -> DataFrame:
    """The typed rows that fit."""
    ok = F.lit(True)
    for name, have in df.dtypes:
        want = (types or {}).get(name) or column_type(spec.name, name)
        if name in spec.keys:
            ok = ok & _col(name).isNotNull()
        if have != want:
            ok = ok & (_col(name).isNull() | converted(name, have, want).isNotNull())
    return checked(df.where(ok), spec, types).drop(REASONS)


def rejected(df: DataFrame, spec: TableSpec, types: dict | None = None) -> DataFrame:
    """(table_name, row_key, row_digest, reasons, row): rows that do not fit, as they were read."""
    raw = F.to_json(F.struct(*[_col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    bad = checked(df.select(*[_col(c) for c in df.columns], raw.alias("__row")), spec, {**(types or {}), "__row": "string"})
    key = F.to_json(F.from_json("__row", ", ".join(f"`{k}` string" for k in spec.keys)), {"ignoreNullFields": "false"})
    return bad.where(F.size(REASONS) > 0).select(
        F.lit(spec.name).alias("table_name"), key.alias("row_key"), F.sha2("__row", 256).alias("row_digest"),
        F.col(REASONS).alias("reasons"), F.col("__row").alias("row"))


def load_typed(reader: Reader, names=None, since=None, types: dict | None = None,
               on_reject: Callable[[DataFrame], None] | None = None) -> dict[str, DataFrame]:
    """The tables of the catalog under the contract; ``on_reject`` gets the rows of each table that do not fit.

    The cursor is applied to typed rows; broken rows are given whatever their dates, as theirs may be what is broken.
    ``types``: table -> column -> type, for sources that differ.
    """
    out = {}
    for name in names or RAW_TABLES:
        spec, df, own = RAW_TABLES[name], reader(name), (types or {}).get(name)
        out[name] = cursor_scan(accepted(df, spec, own), spec, since)
        if on_reject is not None:
            on_reject(rejected(df, spec, own))
    return out


def quarantine_into(table: ChangeTable):
    """``on_reject`` that keeps each broken row once, however often it is read (rule: LatestRow of table_name and row_digest)."""
    def put(bad: DataFrame) -> None:
        if table.exists():
            table.append(bad)
            table.compact()
        else:
            table.write(bad.dropDuplicates(["table_name", "row_digest"]))
    return put

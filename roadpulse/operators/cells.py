"""Versioned wide-column cells as a long table.

A cell is ``(rowkey, family, qualifier, version, value)``. Puts turn rows of
any shape into cells; reads pick the latest version per cell and can nest the
result per row; deletes are markers that take out the cells they cover. The
writer lays cells out in key order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

CELL = ("rowkey", "family", "qualifier")
FULL = (*CELL, "version", "value")


# --- puts --------------------------------------------------------------------

def _version(value: Column | int) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("bigint")


def put_family(rows: DataFrame, family: str, version: Column | int, cells: str = "cells") -> DataFrame:
    """``(rowkey, map qualifier -> value)`` rows to cells; empty maps put nothing."""
    return (rows.withColumn("_v", _version(version))
            .select("rowkey", "_v", F.explode(cells).alias("qualifier", "value"))
            .select("rowkey", F.lit(family).alias("family"), "qualifier", F.col("_v").alias("version"), "value"))


def put_headers(rows: DataFrame, family: str, headers: Sequence[str], version: Column | int,
                values: str = "vals") -> DataFrame:
    """``(rowkey, array of values)`` rows to cells, named by position."""
    names = F.array(*[F.lit(h) for h in headers])
    zipped = F.explode(F.arrays_zip(names.alias("qualifier"), F.col(values).alias("value"))).alias("_c")
    return (rows.withColumn("_v", _version(version)).select("rowkey", "_v", zipped)
            .where("_c.qualifier IS NOT NULL AND _c.value IS NOT NULL")
            .select("rowkey", F.lit(family).alias("family"), F.col("_c.qualifier").alias("qualifier"),
                    F.col("_v").alias("version"), F.col("_c.value").alias("value")))


def put_nested(rows: DataFrame, version: Column | int, families: str = "families") -> DataFrame:
    """``(rowkey, map family -> map qualifier -> value)`` rows to cells."""
    return (rows.withColumn("_v", _version(version))
            .select("rowkey", "_v", F.explode(families).alias("family", "_cells"))
            .select("rowkey", "family", "_v", F.explode("_cells").alias("qualifier", "value"))
            .select("rowkey", "family", "qualifier", F.col("_v").alias("version"), "value"))


def put_versioned(rows: DataFrame, family: str, cells: str = "cells") -> DataFrame:
    """As ``put_family`` where each value is a struct ``(value, version)``."""
    return (rows.select("rowkey", F.explode(cells).alias("qualifier", "_c"))
            .select("rowkey", F.lit(family).alias("family"), "qualifier",
                    F.col("_c.version").alias("version"), F.col("_c.value").alias("value")))


def put_columns(df: DataFrame, family: str | Mapping[str, Sequence[str]], version: Column | int,
                key: Column | str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns of a DataFrame to cells; the first column is the key unless given.

    ``family`` may map several families to their columns. Nulls put nothing.
    """
    rowkey = F.col(df.columns[0]) if key is None else (F.col(key) if isinstance(key, str) else key)
    if isinstance(family, str):
        names = columns if columns is not None else df.columns[1:]
        family = {family: names}
    entries = [F.struct(F.lit(f).alias("family"), F.lit(c).alias("qualifier"),
                        F.col(c).cast("string").alias("value"))
               for f, cs in family.items() for c in cs]
    return (df.select(rowkey.cast("string").alias("rowkey"), _version(version).alias("version"),
                      F.explode(F.array(*entries)).alias("_c"))
            .where("_c.value IS NOT NULL")
            .select("rowkey", "_c.family", "_c.qualifier", "version", "_c.value"))


def union_cells(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- reads -------------------------------------------------------------------

def latest(cells: DataFrame) -> DataFrame:
    """The newest version of every cell (combined map-side)."""
    return cells.groupBy(*CELL).agg(F.max(F.struct("version", "value")).alias("_c")).select(
        *CELL, "_c.version", "_c.value")


def wanted(cells: DataFrame, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Cells of the named columns; the filter reaches the scan."""
    terms = [(F.col("family") == f) & F.col("qualifier").isin(list(cs)) for f, cs in columns.items()]
    condition = terms[0]
    for term in terms[1:]:
        condition |= term
    return cells.where(condition)


def nest(found: DataFrame, by: Sequence[str] = ("rowkey",), versions: bool = False) -> DataFrame:
    """``families``: map family -> map qualifier -> value (or (value, version))."""
    value = F.struct("value", "version") if versions else F.col("value")
    per_family = found.groupBy(*by, "family").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("qualifier", value.alias("v"))))).alias("_m"))
    return per_family.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("family", "_m"))).alias("families"))


def read_columns(cells: DataFrame, columns: Mapping[str, Sequence[str]], versions: bool = False) -> DataFrame:
    """Latest values of chosen columns, nested per row: map family -> map
    qualifier -> value. Missing cells and families are left out.

    Every column is one conditional maximum, so all of them are found in a
    single combined aggregation per row key.
    """
    names = [(f, c) for f, cs in columns.items() for c in cs]
    newest = wanted(cells, columns).groupBy("rowkey").agg(*[
        F.max(F.when((F.col("family") == f) & (F.col("qualifier") == c), F.struct("version", "value"))).alias(f"_{i}")
        for i, (f, c) in enumerate(names)])

    def entry(i: int, qualifier: str) -> Column:
        cell = F.col(f"_{i}")
        value = F.struct(cell["value"].alias("value"), cell["version"].alias("version")) if versions else cell["value"]
        return F.when(cell.isNotNull(), F.struct(F.lit(qualifier).alias("key"), value.alias("value")))

    families = [F.struct(F.lit(f).alias("key"), F.map_from_entries(F.array_compact(F.array(*[
        entry(i, c) for i, (g, c) in enumerate(names) if g == f]))).alias("value")) for f in columns]
    return newest.select("rowkey", F.map_from_entries(F.filter(
        F.array(*families), lambda x: F.size(x["value"]) > 0)).alias("families"))


def read_families(cells: DataFrame, families: Sequence[str]) -> DataFrame:
    """Latest version of every cell of whole families, one row per cell.

    A row of the store may have any number of cells, so it is not gathered;
    ``nest`` does that for rows that are known to be narrow.
    """
    return latest(cells.where(F.col("family").isin(list(families))))


def get_rows(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """All cells of the given row keys."""
    return cells.join(keys.select("rowkey").distinct(), "rowkey", "left_semi")


# --- deletes -----------------------------------------------------------------
#
# A marker ``(rowkey, family, qualifier, version)`` covers the cells that agree
# with it; a null means any. Markers of all kinds can be put together with
# ``union_cells`` and resolved at once.

MARKER = (*CELL, "version")


def _markers(df: DataFrame) -> DataFrame:
    """Markers of the rows of ``df``; parts of the key that it lacks are null."""
    kinds = {**dict.fromkeys(CELL, "string"), "version": "bigint"}
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c)
                       for c in MARKER]).distinct()


def row_markers(keys: DataFrame) -> DataFrame:
    """Whole rows."""
    return _markers(keys.select("rowkey"))


def family_markers(keys: DataFrame, families: Sequence[str]) -> DataFrame:
    """Whole families of the given rows."""
    return _markers(keys.select("rowkey", F.explode(F.array(*[F.lit(f) for f in families])).alias("family")))


def column_markers(keys: DataFrame, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """The same columns of all given rows, in every version."""
    names = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(c).alias("qualifier"))
                      for f, cs in columns.items() for c in cs])
    return _markers(keys.select("rowkey", F.explode(names).alias("_c")).select("rowkey", "_c.*"))


def listed_markers(gone: DataFrame) -> DataFrame:
    """What ``gone`` lists per row: (rowkey, family, qualifier) and, if it has a
    ``version`` column, only that version; a null version means all."""
    return _markers(gone)


def delete_marked(cells: DataFrame, markers: DataFrame) -> DataFrame:
    """Cells that no marker covers.

    One anti-join by row key, so the cells are shuffled once whatever the
    kinds of markers; a row with very many cells may be split by AQE. A row's
    markers are tried one by one; a list of very many single cells of one row
    is better deleted by ``delete_listed``, which joins on the whole cell key.
    """
    m = markers.select(*[F.col(c).alias(f"_{c}") for c in MARKER])
    covered = F.col("rowkey") == F.col("_rowkey")
    for c in MARKER[1:]:
        covered &= F.col(f"_{c}").isNull() | (F.col(c) == F.col(f"_{c}"))
    return cells.join(m, covered, "left_anti")


def delete_rows(cells: DataFrame, keys: DataFrame) -> DataFrame:
    return delete_marked(cells, row_markers(keys))


def delete_families(cells: DataFrame, keys: DataFrame, families: Sequence[str]) -> DataFrame:
    return delete_marked(cells, family_markers(keys, families))


def delete_columns(cells: DataFrame, keys: DataFrame, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    return delete_marked(cells, column_markers(keys, columns))


def delete_listed(cells: DataFrame, gone: DataFrame) -> DataFrame:
    """As ``delete_marked`` of ``listed_markers``, by the whole cell key: lists may be of any length."""
    if "version" not in gone.columns:
        return cells.join(gone.select(*CELL).distinct(), list(CELL), "left_anti")
    whole = gone.where("version IS NULL").select(*CELL).distinct()
    single = gone.where("version IS NOT NULL").select(*CELL, "version").distinct()
    return (cells.join(whole, list(CELL), "left_anti")
            .join(single, [*CELL, "version"], "left_anti"))


def listed_columns(rows: DataFrame, columns: str = "columns", family: str | None = None) -> DataFrame:
    """Per-row column sets as a list for ``delete_listed``: an array of
    qualifiers of one family, or a map family -> array of qualifiers."""
    if family is not None:
        return rows.select("rowkey", F.lit(family).alias("family"), F.explode(columns).alias("qualifier"))
    return (rows.select("rowkey", F.explode(columns).alias("family", "_q"))
            .select("rowkey", "family", F.explode("_q").alias("qualifier")))


# --- layout ------------------------------------------------------------------

def sorted_layout(cells: DataFrame, partitions: int | None = None) -> DataFrame:
    """Cells by family and key across and inside partitions, newest version first.

    Ranges are cut over the whole cell key, so one very wide row is split too.
    """
    keys = [F.col(c) for c in ("family", "rowkey", "qualifier")]
    ranged = (cells.repartitionByRange(partitions, *keys) if partitions
              else cells.repartitionByRange(*keys))
    return ranged.sortWithinPartitions(*keys, F.col("version").desc())


def with_range(cells: DataFrame, splits: DataFrame) -> DataFrame:
    """Add ``region``, the number of split keys at or below the row key, to see
    how evenly the splits ``(split, rowkey)`` of ``ranks.split_keys`` cut the cells."""
    array = splits.agg(F.array_sort(F.collect_list("rowkey")).alias("s")).select("s").scalar()
    return (cells.withColumn("_s", array)
            .withColumn("region", F.size(F.filter("_s", lambda s: s <= F.col("rowkey")))).drop("_s"))

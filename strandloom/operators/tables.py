"""Table operators: projection, renaming, union, distinct-on, comparison, merging, reshaping."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import fill_empty, first_rows


def _picked(df: DataFrame, fields: list[str] | str | re.Pattern) -> list[str]:
    if isinstance(fields, re.Pattern):
        return [c for c in df.columns if fields.search(c)]
    return [x.strip() for x in fields.split(",")] if isinstance(fields, str) else list(fields)


def select_fields(df: DataFrame, fields: list[str] | str | re.Pattern) -> DataFrame:
    """Keep fields by list, comma list or pattern."""
    return df.select(*_picked(df, fields))


def drop_fields(df: DataFrame, fields: list[str] | str | re.Pattern) -> DataFrame:
    return df.drop(*_picked(df, fields))


def select_as(df: DataFrame, spec: str) -> DataFrame:
    """"a=>x,b=>p_#,c": select and rename; # is the old name."""
    out = []
    for part in spec.split(","):
        old, _, new = (x.strip() for x in part.partition("=>"))
        out.append(F.col(old).alias((new or old).replace("#", old)))
    return df.select(*out)


def rename(df: DataFrame, how: dict[str, str] | tuple[str, str] | Callable[[str], str], exclude: tuple[str, ...] = ()) -> DataFrame:
    """Rename by pairs, by (pattern, replacement) or by a function; two columns of one name are an error."""
    if isinstance(how, dict):
        change = lambda c: how.get(c, c)
    elif isinstance(how, tuple):
        change = lambda c: re.sub(how[0], how[1], c)
    else:
        change = how
    names = [c if c in exclude else change(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"columns would share a name: {sorted(n for n in set(names) if names.count(n) > 1)}")
    return df.toDF(*names)


def map_fields(df: DataFrame, f: Callable[[Column], Column], fields: list[str] | None = None) -> DataFrame:
    """f on each (named) column."""
    return df.withColumns({c: f(F.col(c)) for c in fields or df.columns})


def keep_rows(df: DataFrame, condition: Column | str, complement: bool = False) -> DataFrame:
    """Rows that satisfy the condition, or with complement those that do not (an unknown condition counts as not)."""
    condition = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
    return df.where(~condition if complement else condition)


def valid_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which none of the columns is null, NaN or infinite."""
    out = df.dropna(subset=columns)
    for c, kind in df.select(*columns).dtypes:
        if kind in ("double", "float"):
            out = out.where(~F.isnan(c) & (F.abs(c) < float("inf")))
    return out


def append(*tables: DataFrame, fields: list[str] | str = "first") -> DataFrame:
    """Union of all rows: columns of the first table, "intersect", "union" (missing ones get the empty value) or a list."""
    if fields == "union":
        out = tables[0].withColumn("__t", F.lit(0))
        for i, t in enumerate(tables[1:], 1):
            out = out.unionByName(t.withColumn("__t", F.lit(i)), allowMissingColumns=True)
        for c in [c for c in out.columns if c != "__t"]:
            has = F.col("__t").isin([i for i, t in enumerate(tables) if c in t.columns])
            out = fill_empty(out, [c], has)
        return out.drop("__t")
    names = list(tables[0].columns) if fields == "first" else [c for c in tables[0].columns if all(c in t.columns for t in tables)] if fields == "intersect" else list(fields)
    out = tables[0].select(*names)
    for t in tables[1:]:
        out = out.unionByName(t.select(*names))
    return out


def append_labelled(name: str, **tables: DataFrame) -> DataFrame:
    """Union of all rows with the label of each row's table."""
    return append(*(t.withColumn(name, F.lit(k)) for k, t in tables.items()))


def apply_together(f: Callable[[DataFrame], DataFrame], *tables: DataFrame) -> list[DataFrame]:
    """f on the union of the tables, then cut back; f must keep the column __table."""
    whole = f(append(*(t.withColumn("__table", F.lit(i)) for i, t in enumerate(tables))))
    return [whole.where(F.col("__table") == i).drop("__table") for i in range(len(tables))]


def dependent(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> list[str]:
    """Columns that the keys determine: one distinct value (nulls count) in each group; one aggregate over the data."""
    columns = columns if columns is not None else [c for c in df.columns if c not in keys]
    if not columns:
        return []
    same = df.groupBy(*keys).agg(*(F.min(F.struct(c)).eqNullSafe(F.max(F.struct(c))).alias(c) for c in columns))
    found = same.agg(*(F.min(c).alias(c) for c in columns)).first()
    return [c for c in columns if found[c] is not False]


def unique_rows(df: DataFrame, keys: list[str], order_by: list[str], trim: bool = False, check: bool = False, **aggregates: Column) -> DataFrame:
    """Distinct on keys, the first row by order_by; trim drops columns that the keys do not determine, check demands that they do.

    aggregates are computed over each group besides.
    """
    rest = [c for c in df.columns if c not in keys and c not in aggregates]
    if trim or check:
        fixed = dependent(df, keys, rest)
        if check and len(fixed) < len(rest):
            raise ValueError(f"not determined by {keys}: {sorted(set(rest) - set(fixed))}")
        rest = fixed
    picked = [F.min_by(F.struct(*rest), F.struct(*order_by)).alias("__x")] if rest else []
    out = df.groupBy(*keys).agg(*picked, *(a.alias(n) for n, a in aggregates.items())) if picked or aggregates else df.select(*keys).distinct()
    return out.select(*keys, *(F.col(f"__x.{c}").alias(c) for c in rest), *aggregates)


def distinct_values(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """Distinct keys; with order_by in order of first appearance, as column `first`."""
    if order_by:
        return df.groupBy(*keys).agg(F.min(F.struct(*order_by)).alias("first"))
    return df.select(*keys).distinct()


def compare(a: DataFrame, b: DataFrame, fields: list[str], equal: bool = False) -> bool:
    """Whether a's combinations of the fields are a subset of b's, or equal to them."""
    x, y = a.select(*fields), b.select(*fields)
    return x.subtract(y).isEmpty() and (not equal or y.subtract(x).isEmpty())


def set_counts(a: DataFrame, b: DataFrame, fields: list[str]) -> DataFrame:
    """One row: distinct rows in a, only a, both, only b, b."""
    x = a.select(*fields).withColumn("__a", F.lit(1)).withColumn("__b", F.lit(0))
    y = b.select(*fields).withColumn("__a", F.lit(0)).withColumn("__b", F.lit(1))
    each = x.unionByName(y).groupBy(*fields).agg(F.max("__a").alias("a"), F.max("__b").alias("b"))
    return each.agg(F.sum("a").alias("in_a"), F.sum(F.expr("a * (1 - b)")).alias("only_a"), F.sum(F.expr("a * b")).alias("both"), F.sum(F.expr("b * (1 - a)")).alias("only_b"), F.sum("b").alias("in_b"))


def merge_columns(a: DataFrame, b: DataFrame, on: list[str], conflict: str = "error", a_prefix: str = "", b_prefix: str = "") -> DataFrame:
    """Columns of two tables aligned by key. A shared column is kept once if equal; else an error, dropped, or prefixed."""
    shared = [c for c in a.columns if c in b.columns and c not in on]
    if not shared:
        return a.join(b, on)
    both = a.join(b.select(*on, *(F.col(c).alias(f"__{c}" if c in shared else c) for c in b.columns if c not in on)), on)
    differ = both.agg(*(F.max(~F.col(c).eqNullSafe(F.col(f"__{c}"))).alias(c) for c in shared)).first()
    clash = [c for c in shared if differ[c]]
    if clash and conflict == "error":
        raise ValueError(f"columns differ: {clash}")
    if conflict == "drop":
        return both.drop(*(f"__{c}" for c in shared), *clash)
    out = both.drop(*(f"__{c}" for c in shared if c not in clash))
    for c in clash:
        out = out.withColumnsRenamed({c: a_prefix + c, f"__{c}": b_prefix + c})
    return out


def to_long(df: DataFrame, ids: list[str], columns: list[str], name: str = "sample", value: str = "value") -> DataFrame:
    """A matrix as one row for each cell."""
    return df.unpivot(ids, columns, name, value)


def split_array(df: DataFrame, column: str, n: int, names: list[str] | None = None) -> DataFrame:
    """A fixed-width array column as n columns."""
    names = names or [f"{column}_{i + 1}" for i in range(n)]
    return df.withColumns({x: F.get(column, F.lit(i)) for i, x in enumerate(names)}).drop(column)


def chunks(n: int, groups: int) -> list[int]:
    """n cut into groups of near equal size, larger ones first."""
    return [n // groups + (i < n % groups) for i in range(groups)]

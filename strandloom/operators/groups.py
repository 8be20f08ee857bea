"""Grouping: frequencies, modes, user functions on groups, crosstabs, pivots, order statistics, dependencies."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def frequency(df: DataFrame, keys: list[str], weight: str | None = None, domain: DataFrame | None = None, name: str = "n") -> DataFrame:
    """Count, or sum of weights, for each key; on a given domain missing keys have 0."""
    out = df.groupBy(*keys).agg((F.sum(weight) if weight else F.count("*")).alias(name))
    if domain is not None:
        out = domain.select(*keys).distinct().join(out, keys, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def frequency_sorted(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Keys by falling count, ties by key."""
    return frequency(df, keys, name=name).orderBy(F.desc(name), *keys)


def frequencies(value: str, domain: DataFrame | None = None, **tables: DataFrame) -> DataFrame:
    """Counts of one value in several tables side by side, 0 where it is missing."""
    tagged = None
    for k, t in tables.items():
        one = t.select(F.col(value), *(F.lit(int(k == j)).cast("bigint").alias(j) for j in tables))
        tagged = one if tagged is None else tagged.unionByName(one)
    out = tagged.groupBy(value).agg(*(F.sum(k).alias(k) for k in tables))
    if domain is not None:
        out = domain.select(value).distinct().join(out, value, "left").fillna(0, list(tables))
    return out


def multiplicity(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Each row with the number of rows of its key: counts joined back, so a hot key is no single window."""
    return df.join(df.groupBy(*keys).agg(F.count("*").alias(name)), keys)


def group_rows(df: DataFrame, keys: list[str], f: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """f on each group as a pandas table, 0 to n rows out. For functions that no expression gives; a group must fit a task."""
    return df.groupBy(*keys).applyInPandas(f, schema)


def group_values(df: DataFrame, keys: list[str], domain: DataFrame | None = None, default: dict | None = None, **aggregates: Column) -> DataFrame:
    """One row for each group; on a given domain empty groups have the defaults."""
    out = df.groupBy(*keys).agg(*(a.alias(n) for n, a in aggregates.items()))
    if domain is not None:
        out = domain.select(*keys).distinct().join(out, keys, "left")
        if default:
            out = out.fillna(default)
    return out


def group_expand(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """Each row with aggregates of its group: aggregated map-side and joined back."""
    return df.join(df.groupBy(*keys).agg(*(a.alias(n) for n, a in aggregates.items())), keys)


def group_lists(df: DataFrame, keys: list[str], value: str, order_by: list[str], name: str | None = None) -> DataFrame:
    """The values of each group as an array in order."""
    pairs = F.array_sort(F.collect_list(F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)), F.col(value).alias("v"))))
    return df.groupBy(*keys).agg(F.transform(pairs, lambda x: x.v).alias(name or value))


def modes(df: DataFrame, keys: list[str], value: str, largest: bool = False, name: str = "mode") -> DataFrame:
    """The most frequent value of each group; ties go to the smallest, or the largest. Nulls are not counted."""
    n = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    best = F.max_by(value, F.struct("__n", value)) if largest else F.min_by(value, F.struct(-F.col("__n"), value))
    return n.groupBy(*keys).agg(best.alias(name))


def mode(df: DataFrame, value: str, largest: bool = False):
    row = modes(df.withColumn("__g", F.lit(1)), ["__g"], value, largest).first()
    return row["mode"] if row else None


def is_dependent(df: DataFrame, group: list[str], value: list[str], both_ways: bool = False) -> DataFrame:
    """One row, `holds`: whether the group determines the value (and the value the group)."""
    each = df.select(F.struct(*group).alias("g"), F.struct(*value).alias("v")).distinct()
    forward = each.groupBy("g").count().agg(F.coalesce(F.max("count") <= 1, F.lit(True)).alias("holds"))
    if not both_ways:
        return forward
    back = each.groupBy("v").count().agg(F.coalesce(F.max("count") <= 1, F.lit(True)).alias("back"))
    return forward.crossJoin(back).select((F.col("holds") & F.col("back")).alias("holds"))


def is_segregated(df: DataFrame, key: str, order_by: str) -> DataFrame:
    """One row, `holds`: whether equal keys are contiguous by the (unique) integer ordinal order_by."""
    span = df.groupBy(key).agg(F.min(order_by).alias("lo"), F.max(order_by).alias("hi"), F.count("*").alias("n"))
    # Keys are contiguous exactly when the sorted spans do not overlap.
    w = Window.orderBy("lo")
    overlaps = span.select("lo", F.lag("hi").over(w).alias("before")).where("lo < before")
    return overlaps.agg((F.count("*") == 0).alias("holds"))


def contingency(df: DataFrame, a: str, b: str, columns: list | None = None, margins: bool = False) -> DataFrame:
    """Counts of a by b as long rows (a, b, n); margins add rows with a null a, b or both (grouping flags tell them apart)."""
    if margins:
        return df.cube(a, b).agg(F.count("*").alias("n"), F.grouping(a).alias("all_a"), F.grouping(b).alias("all_b"))
    return df.groupBy(a).pivot(b, columns).count().fillna(0) if columns else df.groupBy(a, b).agg(F.count("*").alias("n"))


def pivot(df: DataFrame, row: str, column: str, value: str, columns: list, default=0, order_by: list[str] | None = None, strict: bool = False) -> DataFrame:
    """Rows by columns; the last value by order_by wins, holes hold the default. strict: repeated cells and holes are errors."""
    if strict:
        cells = df.groupBy(row, column).count()
        seen = cells.agg(F.max("count"), F.count("*"), F.count_distinct(row)).first()
        if (seen[0] or 0) > 1:
            raise ValueError("a cell occurs more than once")
        if seen[1] < seen[2] * len(columns):
            raise ValueError("a cell is missing")
    last = F.max_by(value, F.struct(*(order_by or [value])))
    return df.groupBy(row).pivot(column, columns).agg(last).fillna(default)


def quantiles(df: DataFrame, value: str, q: list[float] | None = None, keys: list[str] | None = None) -> DataFrame:
    """Quantiles by linear interpolation, NaN dropped, as rows (keys, q, value); the default grid depends on the size."""
    clean = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    if q is None:
        n = clean.count()
        q = [i / 100 for i in range(101)] if n > 199 else [i / 20 for i in range(21)] if n > 49 else [0, 0.25, 0.5, 0.75, 1]
    found = F.percentile(value, F.array(*map(F.lit, map(float, q)))).alias("__q")
    out = clean.groupBy(*(keys or [])).agg(found)
    pairs = F.explode(F.arrays_zip(F.array(*map(F.lit, map(float, q))).alias("q"), F.col("__q").alias("value")))
    return out.select(*(keys or []), pairs.alias("x")).select(*(keys or []), "x.q", "x.value")


def nth(df: DataFrame, value: str, n: int, keys: list[str] | None = None, largest: bool = False, name: str = "value") -> DataFrame:
    """The n-th smallest (largest) value, duplicates counted, of all rows or of each group; counts are taken first, so ties stay small."""
    keys = keys or []
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    if not keys:
        top = counts.orderBy(F.desc(value) if largest else F.asc(value)).limit(n)
        return top.withColumn("__c", F.sum("__n").over(Window.orderBy(F.desc(value) if largest else F.asc(value)))).where(F.col("__c") >= n).agg((F.max if largest else F.min)(value).alias(name))
    w = Window.partitionBy(*keys).orderBy(F.desc(value) if largest else F.asc(value))
    return counts.withColumn("__c", F.sum("__n").over(w)).where(F.col("__c") >= n).groupBy(*keys).agg((F.max if largest else F.min)(value).alias(name))


def proportions(df: DataFrame, flag: str) -> DataFrame:
    """One row: how many are true and false, and the share of true ones."""
    x = F.col(flag)
    return df.agg(F.count_if(x).alias("n_true"), F.count_if(~x).alias("n_false"), F.avg(x.cast("double")).alias("share"))


def all_equal(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row, `holds`: whether all rows agree in the columns."""
    return df.agg(F.coalesce(F.min(F.struct(*columns)).eqNullSafe(F.max(F.struct(*columns))), F.lit(True)).alias("holds"))


ROW_REDUCERS: dict[str, Callable[[Column], Column]] = {
    "sum": lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y),
    "mean": lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y) / F.size(a),
    "max": F.array_max, "min": F.array_min,
    "median": lambda a: (F.get(F.array_sort(a), F.floor((F.size(a) - 1) / 2).cast("int")) + F.get(F.array_sort(a), F.floor(F.size(a) / 2).cast("int"))) / 2,
    "var": lambda a: _variance(a), "std": lambda a: F.sqrt(_variance(a)),
    "any": lambda a: F.exists(a, lambda x: x), "all": lambda a: F.forall(a, lambda x: x),
}


def _variance(a: Column) -> Column:
    m = ROW_REDUCERS["mean"](a)
    return F.aggregate(a, F.lit(0.0), lambda x, y: x + (y - m) * (y - m)) / (F.size(a) - 1)


def row_reduce(df: DataFrame, columns: list[str], how: str, name: str) -> DataFrame:
    """A reduction across columns of each row."""
    kind = "boolean" if how in ("any", "all") else "double"
    return df.withColumn(name, ROW_REDUCERS[how](F.array(*(F.col(c).cast(kind) for c in columns))))

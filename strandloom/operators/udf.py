"""User functions on rows, groups and windows, and type normalisation.

Each takes an expression where one will do; a Python function runs in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_map(df: DataFrame, f: Callable[..., tuple], inputs: list[str], schema: str) -> DataFrame:
    """One row out for each row in: f(*inputs) gives the new columns, the old ones stay."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            made = pd.DataFrame([f(*r) for r in zip(*(pdf[c] for c in inputs), strict=True)], columns=names, index=pdf.index)
            yield pd.concat([pdf, made], axis=1)

    added = df.sparkSession.createDataFrame([], schema).schema
    names = added.names
    return df.mapInPandas(run, type(df.schema)([*df.schema.fields, *added.fields]))


def row_expand(df: DataFrame, f: Callable[..., Iterable[tuple]], inputs: list[str], schema: str, keep: list[str]) -> DataFrame:
    """Zero to n rows out for each row in, with the kept columns of the source row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = [(*k, *r) for k, args in zip(zip(*(pdf[c] for c in keep), strict=True), zip(*(pdf[c] for c in inputs), strict=True), strict=True) for r in f(*args)]
            yield pd.DataFrame(out, columns=[*keep, *names])

    added = df.sparkSession.createDataFrame([], schema).schema
    names = added.names
    return df.mapInPandas(run, type(df.schema)([*(df.schema[c] for c in keep), *added.fields]))


def group_map(df: DataFrame, keys: list[str], value: str, f: Callable[[pd.Series], float]) -> DataFrame:
    """One number for each group by a Python aggregate; a group's values must fit a task."""
    kind = F.pandas_udf("double")(_series(f))
    return df.groupBy(*keys).agg(kind(value).alias("value"))


def window_map(df: DataFrame, keys: list[str], order_by: list[str], value: str, width: int, f: Callable[[pd.Series], float], name: str = "value") -> DataFrame:
    """A Python aggregate over centred windows of an odd number of rows; only full windows are kept."""
    half = (width if width % 2 else width + 1) // 2
    frame = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(-half, half)
    kind = F.pandas_udf("double")(_series(f))
    return df.withColumns({name: kind(value).over(frame), "__n": F.count(F.lit(1)).over(frame)}).where(F.col("__n") == 2 * half + 1).drop("__n")


def _series(f: Callable[[pd.Series], float]):
    def run(values: pd.Series) -> float:
        return float(f(values))

    return run


def key_map(df: DataFrame, keys: list[str], value: str, name: str = "values") -> DataFrame:
    """Key to its values: a multimap as rows (key, array)."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias(name))


def retype(df: DataFrame, source: str, target: str) -> DataFrame:
    """All columns of one type as another."""
    return df.withColumns({c: F.col(c).cast(target) for c, k in df.dtypes if k == source})


def without_nulls(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in defaults.items()})


def shuffled_index(df: DataFrame, order_by: list[str], seed: int, name: str = "place") -> DataFrame:
    """A random permutation 0 to n - 1, fixed by the seed, as a column: hashes are ranged, so no task holds all rows."""
    h = F.xxhash64(*order_by, F.lit(seed))
    parts = df.withColumn("__h", h).withColumn("__p", F.pmod(F.shiftrightunsigned("__h", 52), F.lit(4096)))
    counts = parts.groupBy("__p").agg(F.count("*").alias("__c"))
    before = counts.select("__p", F.coalesce(F.sum("__c").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"))
    inside = F.row_number().over(Window.partitionBy("__p").orderBy("__h", *order_by)) - 1
    return parts.withColumn(name, inside).join(before, "__p").withColumn(name, F.col(name) + F.col("__b")).drop("__h", "__p", "__b")

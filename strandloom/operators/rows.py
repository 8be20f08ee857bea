"""Row order and "first" without a row order: ordinals on demand, ordered first values, outer joins with default values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import empty_value


def with_ordinal(df: DataFrame, name: str = "_rid", order_by: list[str] | None = None) -> DataFrame:
    """Add an ordinal that rises with the scan order or, if given, a key; gaps are allowed, so no shuffle to one task."""
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    return df.withColumn(name, F.monotonically_increasing_id())


def ordered(order_by: list[str]) -> Column:
    return F.struct(*order_by)


def first_rows(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row for each key: the first by order_by. An aggregate, so a hot key is combined map-side."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    picked = F.min_by(F.struct(*rest), ordered(order_by)).alias("__x")
    return df.groupBy(*keys).agg(picked).select(*keys, *(F.col(f"__x.{c}").alias(c) for c in rest)).select(*df.columns)


def fill_empty(df: DataFrame, columns: list[str], unless: Column) -> DataFrame:
    """Put the type's empty value into columns of rows that found no match; nulls of matched rows stay."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.withColumns({c: F.when(unless, F.col(c)).otherwise(empty_value(kinds[c])) for c in columns})


def take_rows(df: DataFrame, ordinals: list[int], name: str = "_rid", complement: bool = False) -> DataFrame:
    """Rows whose ordinal is listed, or all others."""
    hit = F.col(name).isin([int(i) for i in ordinals])
    return df.where(~hit if complement else hit)


def set_rows(df: DataFrame, mask: Column, values: dict[str, Column]) -> DataFrame:
    """Masked assignment."""
    return df.withColumns({c: F.when(mask, v).otherwise(F.col(c)) for c, v in values.items()})


def repeat_rows(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("__i", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("__i") if n else df.limit(0)


def shuffled(df: DataFrame, seed: int) -> DataFrame:
    """All rows in a random order that the seed fixes."""
    return df.orderBy(F.xxhash64(F.struct(*df.columns), F.lit(seed)))


def is_sorted(df: DataFrame, by: list[str], order_by: list[str]) -> bool:
    """Whether rows taken by order_by are ascending in `by`; checked in ranges whose edges are then compared."""
    d = with_ordinal(df.select(ordered(by).alias("k"), ordered(order_by).alias("o")), "__r", ["o"])
    part = d.withColumn("p", F.spark_partition_id())
    w = Window.partitionBy("p").orderBy("o")
    inside = part.withColumn("bad", F.coalesce(F.lag("k").over(w) > F.col("k"), F.lit(False)))
    edges = inside.groupBy("p").agg(F.max("bad").alias("bad"), F.min_by("k", "o").alias("a"), F.max_by("k", "o").alias("b")).orderBy("p").collect()
    return not any(e["bad"] for e in edges) and all(tuple(x["b"]) <= tuple(y["a"]) for x, y in zip(edges, edges[1:], strict=False))


def numbered(df: DataFrame, keys: list[str], place: str = "place", ranges: int = 512) -> DataFrame:
    """df with each row's place (from 1) in the order of the keys, of which the first is a number.

    Ranges of the first key are numbered apart and start after the rows of those before, so no task sorts all rows; a
    value that many rows share is one range. Nulls come first.
    """
    first = F.col(keys[0]).cast("double")
    cuts = sorted(set(df.agg(F.percentile_approx(first, [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0] or []))
    edges = sorted({x for c in cuts for x in (c, math.nextafter(c, math.inf))})  # a common value gets a range of its own
    cut = F.split(F.lit(",".join(map(repr, edges))), ",").cast("array<double>") if edges else F.array().cast("array<double>")
    df = df.withColumn("__range", F.when(first.isNull(), -1).otherwise(F.size(F.filter(cut, lambda c: c <= first))))
    sizes = df.groupBy("__range").agg(F.count("*").alias("__rows"))  # at most 2 * ranges rows
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__range").orderBy(*keys))
    return df.withColumn("__own", own).join(F.broadcast(starts), "__range").withColumn(place, F.col("__before") + F.col("__own")).drop("__range", "__own", "__before")

"""Ordered analytics: ranks, equal-count buckets, moving windows, standard scores, normalisation, FDR, balanced samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ColumnLike, _c


def running_sum(df: DataFrame, keys: list[str], position: str, value: str, name: str, width: int = 1 << 20) -> DataFrame:
    """Sum of value up to each position (positions are unique in a key), in two steps: inside blocks of positions, then over
    blocks' totals, so that a hot key is spread over its blocks."""
    block = F.floor(F.col(position) / width).alias("__block")
    df = df.withColumn("__block", block)
    totals = df.groupBy(*keys, "__block").agg(F.sum(value).alias("__total"))
    before = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "__block", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*keys, "__block").orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumn(name, F.sum(value).over(inside)).join(totals, [*keys, "__block"])
    return out.withColumn(name, F.col(name) + F.col("__before")).drop("__before", "__block")


def rank_groups(df: DataFrame, value: str, n: int, order_by: list[str], keys: list[str] | None = None, name: str = "bucket") -> DataFrame:
    """Equal-count buckets 1 to n by rank within keys; the first buckets take the remainder."""
    return df.withColumn(name, F.ntile(n).over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy(value, *order_by)))


def tied_rank(df: DataFrame, value: str, keys: list[str] | None = None, descending: bool = False, name: str = "rank") -> DataFrame:
    """Average rank of tied values; null and NaN get null. Ranks come from counts of distinct values, joined back."""
    keys = keys or []
    counts = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(F.desc(value) if descending else F.asc(value)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = counts.withColumn(name, F.sum("__n").over(w) - (F.col("__n") - 1) / 2).drop("__n")
    return df.join(ranks, [*keys, value], "left")


def sliding(df: DataFrame, keys: list[str], order_by: list[str], width: int, **aggregates: Column) -> DataFrame:
    """Aggregates over centred windows of an odd number of rows; only full windows are kept."""
    half = (width if width % 2 else width + 1) // 2
    w = Window.partitionBy(*keys).orderBy(*order_by)
    frame = w.rowsBetween(-half, half)
    out = df.withColumns({n: a.over(frame) for n, a in aggregates.items()} | {"__n": F.count(F.lit(1)).over(frame)})
    return out.where(F.col("__n") == 2 * half + 1).drop("__n")


def zscores(df: DataFrame, value: str, keys: list[str] | None = None, baseline: DataFrame | None = None, name: str = "z") -> DataFrame:
    """(x - mean) / sd of its group, or of a baseline table."""
    keys = keys or []
    base = (baseline if baseline is not None else df).groupBy(*keys).agg(F.avg(value).alias("__m"), F.stddev_samp(value).alias("__s"))
    out = df.join(base, keys) if keys else df.crossJoin(F.broadcast(base))  # one row
    return out.withColumn(name, (F.col(value) - F.col("__m")) / F.col("__s")).drop("__m", "__s")


def quantile_normalise(df: DataFrame, sample: str, value: str, order_by: list[str], name: str = "normalised") -> DataFrame:
    """Give each sample the same distribution: the mean over samples of the values of each rank."""
    ranked = df.withColumn("__r", F.row_number().over(Window.partitionBy(sample).orderBy(value, *order_by)))
    means = ranked.groupBy("__r").agg(F.avg(value).alias(name))
    return ranked.join(means, "__r").drop("__r")


def fdr_cutoff(df: DataFrame, p: str, is_null: str, fdr: float = 0.05, max_fdr: float | None = None) -> DataFrame:
    """One row, `cutoff`: the largest p-value whose ratio of null to real hits up to it is at most fdr.

    The scan stops at the first p-value with 100 real hits and a ratio above max_fdr.
    """
    max_fdr = min(3 * fdr, 1.0) if max_fdr is None else max_fdr
    counts = df.groupBy(F.col(p).alias("p")).agg(F.sum(F.col(is_null).cast("bigint")).alias("n0"), F.sum((~F.col(is_null)).cast("bigint")).alias("n1"))
    w = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = counts.select("p", F.sum("n0").over(w).alias("c0"), F.sum("n1").over(w).alias("c1")).withColumn("ratio", F.col("c0") / F.greatest("c1", F.lit(1)))
    run = run.withColumn("stop", F.min(F.when((F.col("c1") >= 100) & (F.col("ratio") > max_fdr), F.col("p"))).over(Window.partitionBy()))
    return run.where((F.col("ratio") <= fdr) & (F.col("stop").isNull() | (F.col("p") < F.col("stop")))).agg(F.max("p").alias("cutoff"))


def adjust_p(df: DataFrame, p: str, method: str = "BH", keys: list[str] | None = None, name: str = "adjusted") -> DataFrame:
    """Adjusted p-values: BH (fdr), BY, bonferroni, holm, hochberg or none. Null p-values stay null and are not counted."""
    keys = keys or []
    part = keys or [F.lit(0)]
    counts = df.where(F.col(p).isNotNull()).groupBy(*keys, p).agg(F.count("*").alias("__k"))
    up = Window.partitionBy(*part).orderBy(p).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*part).orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumns({"__last": F.sum("__k").over(up), "__n": F.sum("__k").over(Window.partitionBy(*part))})
    first = F.col("__last") - F.col("__k") + 1
    if method in ("BH", "fdr", "BY"):
        harmonic = F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.col("__n")), F.lit(0.0), lambda a, i: a + 1 / i) if method == "BY" else F.lit(1.0)
        value = F.min(F.col(p) * F.col("__n") * harmonic / F.col("__last")).over(down)
    elif method == "hochberg":
        value = F.min(F.col(p) * (F.col("__n") - F.col("__last") + 1)).over(down)
    elif method == "holm":
        value = F.max(F.col(p) * (F.col("__n") - first + 1)).over(up)
    elif method == "bonferroni":
        value = F.col(p) * F.col("__n")
    elif method == "none":
        value = F.col(p)
    else:
        raise ValueError(method)
    table = counts.select(*keys, p, F.least(value, F.lit(1.0)).alias(name))
    return df.join(table, [*keys, p], "left")


def balanced_sample(df: DataFrame, value: str, label: str, buckets: int, order_by: list[str], seed: int = 0, keep_ratio: bool = False) -> DataFrame:
    """Rows of two classes down-sampled so that each bucket of the value holds both equally, or in the rarest common ratio."""
    d = rank_groups(df, value, buckets, order_by, name="__b")
    counts = d.groupBy("__b").agg(F.count_if(F.col(label)).alias("__t"), F.count_if(~F.col(label)).alias("__f"))
    if keep_ratio:
        ratio = counts.where("__t > 0").agg(F.min(F.col("__f") / F.col("__t"))).first()[0] or 0.0
        quota = F.when(F.col(label), F.when(F.col("__f") >= ratio * F.col("__t"), F.col("__t")).otherwise(0)).otherwise(F.floor(ratio * F.col("__t")))
    else:
        quota = F.least("__t", "__f")
    d = d.join(counts, "__b").withColumn("__r", F.row_number().over(Window.partitionBy("__b", label).orderBy(F.xxhash64(*order_by, F.lit(seed)), *order_by)))
    return d.where(F.col("__r") <= quota).drop("__b", "__t", "__f", "__r")


def condensed_pairs(df: DataFrame, row: str) -> DataFrame:
    """Row pairs (i, j) with i > j of a small table, as condensed distances list them: the result is the product asked for."""
    a, b = df.select(F.col(row).alias("i")), df.select(F.col(row).alias("j"))
    return a.join(b, F.col("i") > F.col("j"))


def lag_of(value: ColumnLike, keys: list[str], order_by: list[str], n: int = 1) -> Column:
    return F.lag(_c(value), n).over(Window.partitionBy(*keys).orderBy(*order_by))

"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, range partitions, overfull ranges split.

Every pass is made of DataFrame expressions. A small digest (key, text hash, size) is written once; splitters, exact
range totals and shard boundaries come from it, so the documents themselves are read only for the last projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import long_array, materialise, upper_bound, json_literal

#: Rows of a range in a table of up to MAX_RANGES of them; in larger ones ranges grow, and their windows sort with spilling.
ROWS_PER_RANGE = 100_000
#: Sampled keys for each range, and the most ranges: what the driver and the plan hold does not grow with the table beyond.
OVERSAMPLE, MAX_RANGES = 16, 8192
_PRIVATE = ("__k", "__h", "__size", "__salt", "__range", "__before", "__n", "__shard", "__slot")


def _ranged(df: DataFrame, splitters: list[tuple[int, int, int]]) -> DataFrame:
    if not splitters:
        return df.withColumn("__range", F.lit(0))
    cuts = json_literal([{"k": k, "h": h, "s": s} for k, h, s in splitters], "array<struct<k:bigint,h:bigint,s:bigint>>")
    at = F.struct(F.col("__k").alias("k"), F.col("__h").alias("h"), F.col("__salt").alias("s"))
    return df.withColumn("__range", upper_bound(cuts, len(splitters), lambda cut: cut <= at).cast("int"))


def _drawn(df: DataFrame, weight: Column, total: float, wanted: int) -> list[tuple[int, int, int]]:
    """Keys drawn with a chance in proportion to their weight, by a hash of the row, so that a retry draws the same."""
    u = F.pmod(F.xxhash64("__k", "__h", "__salt", F.lit(77)), F.lit(1 << 40)) / float(1 << 40)
    rows = df.where(u * float(total) < weight * float(wanted)).select("__k", "__h", "__salt").collect()
    return sorted(tuple(r) for r in rows)


def _quantiles(drawn: list, n: int) -> list:
    return sorted({drawn[len(drawn) * i // n] for i in range(1, n)}) if drawn else []


def shard_documents(docs: DataFrame, n_shards: int = 16, key: str | Column = "doc_id", text: str = "text",
                    shard: str = "shard", slot: str = "slot", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """All rows of docs with their shard (0 to n_shards - 1) and slot (gapless from 0 within a shard).

    A row's size is the UTF-8 bytes of its text (null: none) plus 1. Rows are ranged by (key, hash of the text), and
    shard boundaries lie at exact shares of all bytes, so shard sizes differ by less than two of the largest rows.
    A null key comes first. Rows that agree in key and text are told apart by a written salt when they fill more than
    one range; which of them gets which slot is then arbitrary but fixed. Columns of docs that already carry the two
    output names are replaced. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    keyed = F.col(key) if isinstance(key, str) else key
    base = docs.drop(shard, slot).withColumns({
        "__k": F.coalesce(keyed.cast("bigint"), F.lit(-(1 << 63))), "__h": F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
        "__size": (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint"), "__salt": F.lit(0).cast("bigint"),
    })
    digest = materialise(base.select("__k", "__h", "__size", "__salt"), "shard-digest")
    n, total = digest.agg(F.count("*"), F.coalesce(F.sum("__size"), F.lit(0))).first()
    if not n:
        return base.drop(*_PRIVATE).withColumns({shard: F.lit(0).cast("int"), slot: F.lit(0).cast("bigint")})
    weight = F.col("__size") + F.lit(total / n)  # bounds both bytes and rows of a range
    ranges = min(max(64 * n_shards, -(-2 * n // rows_per_range)), max(MAX_RANGES, 64 * n_shards))
    splitters = _quantiles(_drawn(digest, weight, 2 * total, OVERSAMPLE * ranges), ranges)

    def totals(df: DataFrame) -> dict[int, tuple[int, int]]:
        return {r[0]: (r[1], r[2]) for r in df.groupBy("__range").agg(F.count("*"), F.sum("__size")).collect()}

    hot: list[tuple[int, int]] = []
    while True:  # each turn splits the overfull ranges by a sample of their own, until none is or none can be split
        held = totals(_ranged(digest, splitters))
        most = max(4 * (n // ranges + 1), 64)
        over = {r: c for r, (c, b) in held.items() if c + b * n // total > 2 * most}
        if not over:
            break
        inside = _ranged(digest, splitters).where(F.col("__range").isin(list(over)))
        if not hot:
            hot = [(r[0], r[1]) for r in inside.groupBy("__k", "__h").count().where(F.col("count") > most).select("__k", "__h").collect()]
            if hot:  # copies of one row that no key can tell apart: a written salt does
                pairs = spark.createDataFrame(hot, "__k bigint, __h bigint")
                salted = materialise(base.join(pairs, ["__k", "__h"], "left_semi").withColumn("__salt", F.xxhash64(F.monotonically_increasing_id())), "shard-hot")
                rest = base.join(pairs, ["__k", "__h"], "left_anti")
                base = rest.unionByName(salted.select(*rest.columns))
                digest = materialise(base.select("__k", "__h", "__size", "__salt"), "shard-digest")
                inside = _ranged(digest, splitters).where(F.col("__range").isin(list(over)))
        w = sum(c + held[r][1] * n / total for r, c in over.items()) * total / n
        pieces = max(2, int(2 * sum(over.values()) // (n // ranges + 1)) + 1)
        more = sorted({*splitters, *_quantiles(_drawn(inside, weight, w, OVERSAMPLE * pieces), pieces)})
        if more == splitters:
            break
        splitters = more

    held = totals(_ranged(digest, splitters))
    rows_before, bytes_before, crossing, r0, b0 = [], [], set(), 0, 0
    for r in range(len(splitters) + 1):
        rows_before.append(r0)
        bytes_before.append(b0)
        c, b = held.get(r, (0, 0))
        if c and b0 * n_shards // total != (b0 + b) * n_shards // total:
            crossing.add(r)
        r0, b0 = r0 + c, b0 + b

    def placed(df: DataFrame) -> DataFrame:
        order = Window.partitionBy("__range").orderBy("__k", "__h", "__salt", "__size")
        df = _ranged(df, splitters).withColumns({
            "__before": F.coalesce(F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "__n": F.row_number().over(order) - 1,
        })
        df = df.withColumns({"__before": F.col("__before") + F.get(long_array(bytes_before), F.col("__range")), "__n": F.col("__n") + F.get(long_array(rows_before), F.col("__range"))})
        return df.withColumn("__shard", F.expr(f"__before * {n_shards} div {total}").cast("int"))

    # Only ranges that a boundary crosses are needed to find each shard's first row.
    edges = dict(placed(digest.transform(lambda d: _ranged(d, splitters)).where(F.col("__range").isin(sorted(crossing))).drop("__range")).groupBy("__shard").agg(F.min("__n")).collect())
    first = []
    for s in range(n_shards):  # a shard that begins at a range's start has that range's first row
        starts = [rows_before[r] for r in held if bytes_before[r] * n_shards // total == s]
        first.append(min([*starts, *([edges[s]] if s in edges else [])], default=n))
    return placed(base).withColumns({shard: F.col("__shard"), slot: F.col("__n") - F.get(long_array(first), F.col("__shard"))}).drop(*_PRIVATE)

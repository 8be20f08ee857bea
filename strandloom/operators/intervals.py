"""Interval algebra on closed, 1-based segments: joins, unions, depth, intersection, difference, introns, coverage, masks.

Segments are rows (keys..., start, end). Joins are equi-joins on hierarchical bins: a segment of the tag side lies in the
one smallest bin that holds it, a segment of the site side meets all bins of all levels that it touches. Each pair meets
in exactly one bin, long segments make few rows, and no step compares all pairs of a chromosome. Neither side is broadcast:
Spark sizes a table by its compressed files and does not count the rows that bins add.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import running_sum

#: Width of the smallest bins, growth from level to level, number of levels.
BIN, FACTOR, LEVELS = 256, 16, 6


def _bins(width: int) -> list[int]:
    return [width * FACTOR**i for i in range(LEVELS)]


def interval_join(site: DataFrame, tag: DataFrame, keys: list[str], how: str = "touch", min_overlap: float = 0.0, start: str = "start", end: str = "end",
                  site_prefix: str = "site_", tag_prefix: str = "tag_", width: int = BIN) -> DataFrame:
    """Pairs of segments of equal keys: touch (they overlap), contain (the tag lies in the site), or an overlap of at
    least min_overlap of the shorter. start and end come out prefixed, other columns as they are; null ends are left out."""
    s = site.where(f"{start} is not null and {end} is not null").withColumnsRenamed({start: f"{site_prefix}{start}", end: f"{site_prefix}{end}"})
    t = tag.where(f"{start} is not null and {end} is not null").withColumnsRenamed({start: f"{tag_prefix}{start}", end: f"{tag_prefix}{end}"})
    ss, se, ts, te = f"{site_prefix}{start}", f"{site_prefix}{end}", f"{tag_prefix}{start}", f"{tag_prefix}{end}"
    widths = _bins(width)
    bin_of = lambda c, w: F.floor(F.col(c) / w)
    own = F.struct(F.lit(LEVELS).alias("l"), F.lit(0).cast("bigint").alias("b"))
    for level, w in reversed(list(enumerate(widths))):
        own = F.when(bin_of(ts, w) == bin_of(te, w), F.struct(F.lit(level).alias("l"), bin_of(ts, w).alias("b"))).otherwise(own)
    touched = F.concat(
        *(_level(ss, se, w, level) for level, w in enumerate(widths)),
        F.array(F.struct(F.lit(LEVELS).alias("l"), F.lit(0).cast("bigint").alias("b"))),
    )
    s, t = s.where(F.col(ss) <= F.col(se)).withColumn("__bin", F.explode(touched)), t.withColumn("__bin", own)
    out = s.join(t.hint("merge"), [*keys, "__bin"]).drop("__bin")
    common = F.least(se, te) - F.greatest(ss, ts) + 1
    if how == "contain":
        return out.where((F.col(ts) >= F.col(ss)) & (F.col(te) <= F.col(se)))
    out = out.where((F.col(ts) <= F.col(se)) & (F.col(te) >= F.col(ss)))
    return out.where(common >= min_overlap * (F.least(F.col(se) - F.col(ss), F.col(te) - F.col(ts)) + 1)) if min_overlap > 0 else out


def _level(start: str, end: str, width: int, level: int) -> Column:
    return F.transform(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width)), lambda b: F.struct(F.lit(level).alias("l"), b.alias("b")))


def flip_strand(df: DataFrame, strand: str = "strand") -> DataFrame:
    return df.withColumn(strand, F.when(F.col(strand) == "+", "-").when(F.col(strand) == "-", "+").otherwise(F.col(strand)))


def _islands(df: DataFrame, keys: list[str], start: str, end: str, weld: bool, sums: dict[str, Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col(start) > before + int(weld)).cast("int"), F.lit(1))
    df = df.withColumn("__new", new).withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return df.groupBy(*keys, "__island").agg(F.min(start).alias(start), F.max(end).alias(end), *(c.alias(n) for n, c in sums.items())).drop("__island")


def segment_union(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", weld: bool = True, score: str | None = None, block: int = 1 << 20) -> DataFrame:
    """Merged segments of each key; weld merges adjacent ones too. With score, the sum of each union's scores.

    Merging runs inside blocks of positions first; only the blocks' unions meet in a key's own window.
    """
    sums = {score: F.sum(score)} if score else {}
    df = df.select(*keys, start, end, *([score] if score else [])).withColumn("__block", F.floor(F.col(start) / block))
    return _islands(_islands(df, [*keys, "__block"], start, end, weld, sums).drop("__block"), keys, start, end, weld, sums)


def depth(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", score: str | Column | None = None, cutoff: float = 1, name: str = "depth", block: int = 1 << 20) -> DataFrame:
    """Maximal runs of constant depth (count, or sum of scores) of at least cutoff; a cutoff of 0 or less gives inner gaps too."""
    value = F.lit(1) if score is None else F.col(score) if isinstance(score, str) else score
    value = value.cast("double") if dict(df.select(value.alias("x")).dtypes)["x"] in ("double", "float") else value.cast("bigint")
    events = df.select(*keys, F.explode(F.array(F.struct(F.col(start).cast("bigint").alias("at"), value.alias("d")), F.struct((F.col(end) + 1).cast("bigint").alias("at"), (-value).alias("d")))).alias("e"))
    events = events.select(*keys, "e.at", "e.d").groupBy(*keys, "at").agg(F.sum("d").alias("d")).where("d <> 0")
    levels = running_sum(events, keys, "at", "d", name, block).withColumn("__block", F.floor(F.col("at") / block))
    firsts = levels.groupBy(*keys, "__block").agg(F.min("at").alias("__first"))
    firsts = firsts.select(*keys, "__block", F.lead("__first").over(Window.partitionBy(*keys).orderBy("__block")).alias("__next"))
    inside = F.lead("at").over(Window.partitionBy(*keys, "__block").orderBy("at"))
    out = levels.withColumn("__in", inside).join(firsts, [*keys, "__block"])
    out = out.select(*keys, F.col("at").alias(start), (F.coalesce("__in", "__next") - 1).alias(end), name)
    return out.where(F.col(end).isNotNull() & (F.col(name) >= cutoff))


def depth_of_two(a: DataFrame, b: DataFrame, keys: list[str], a_score: float = 1, b_score: float = 1, cutoff: float = 1, start: str = "start", end: str = "end") -> DataFrame:
    """Depth of two sets with scores of their own (b_score = -1 subtracts)."""
    both = a.select(*keys, start, end).withColumn("__s", F.lit(a_score)).unionByName(b.select(*keys, start, end).withColumn("__s", F.lit(b_score)))
    return depth(both, keys, start, end, "__s", cutoff)


def intersection(a: DataFrame, b: DataFrame, keys: list[str], row: str, start: str = "start", end: str = "end", b_disjoint: bool = False) -> DataFrame:
    """a clipped to the union of b: (keys, row, start, end), one row for each piece."""
    islands = b.select(*keys, start, end) if b_disjoint else segment_union(b, keys, start, end)
    hits = interval_join(a.select(*keys, row, start, end), islands, keys, start=start, end=end)
    return hits.select(*keys, row, F.greatest(f"site_{start}", f"tag_{start}").alias(start), F.least(f"site_{end}", f"tag_{end}").alias(end))


def difference(a: DataFrame, b: DataFrame, keys: list[str], row: str, start: str = "start", end: str = "end") -> DataFrame:
    """What is left of each a outside the union of b: (keys, row, start, end)."""
    hits = intersection(a, b, keys, row, start, end).groupBy(*keys, row).agg(F.array_sort(F.collect_list(F.struct(F.col(start).alias("s"), F.col(end).alias("e")))).alias("cuts"))
    out = a.select(*keys, row, start, end).join(hits, [*keys, row], "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<struct<s:bigint,e:bigint>>")))
    # Pieces lie between the end of one cut and the start of the next.
    left = F.concat(F.array(F.col(start).cast("bigint")), F.transform("cuts", lambda c: c.e + 1))
    right = F.concat(F.transform("cuts", lambda c: c.s - 1), F.array(F.col(end).cast("bigint")))
    pieces = F.filter(F.arrays_zip(left.alias("s"), right.alias("e")), lambda p: p.s <= p.e)
    return out.withColumn("__p", F.explode(pieces)).select(*keys, row, F.col("__p.s").alias(start), F.col("__p.e").alias(end))


def introns(exons: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Gaps between the merged exons of each key."""
    merged = segment_union(exons, keys, start, end)
    gap = merged.withColumn("__next", F.lead(start).over(Window.partitionBy(*keys).orderBy(start)))
    return gap.where("__next is not null").select(*keys, (F.col(end) + 1).alias(start), (F.col("__next") - 1).alias(end))


def coverage(df: DataFrame, keys: list[str], low: int, high: int, max_bins: int = 0, start: str = "start", end: str = "end") -> DataFrame:
    """Depth at low, low + step, ... up to high as rows (keys, pos, depth); step is 1 or so that at most max_bins remain."""
    step = -(-(high - low + 1) // max_bins) if max_bins else 1
    last = (high - low) // step
    at = lambda c: F.least(F.greatest(F.round((F.col(c) - low) / step).cast("bigint"), F.lit(0)), F.lit(last))
    inside = df.where((F.col(end) >= low) & (F.col(start) <= high)).select(*keys, at(start).alias("start"), at(end).alias("end"))
    runs = depth(inside, keys)
    points = runs.withColumn("bin", F.explode(F.sequence("start", "end"))).select(*keys, "bin", "depth")
    grid = df.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint"))))
    return grid.join(points, [*keys, "bin"], "left").select(*keys, (F.col("bin") * step + low).alias("pos"), F.coalesce("depth", F.lit(0)).alias("depth"))


def transcript_places(exons: DataFrame, keys: list[str], start: str = "start", end: str = "end", strand: str | None = None) -> DataFrame:
    """Each exon with its place in the spliced transcript (t_start, t_end), read backwards on the - strand."""
    direction = F.when(F.col(strand) == "-", -F.col(start)).otherwise(F.col(start)) if strand else F.col(start)
    n = F.col(end) - F.col(start) + 1
    before = F.coalesce(F.sum(n).over(Window.partitionBy(*keys).orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return exons.withColumn("t_start", before + 1).withColumn("t_end", F.col("t_start") + n - 1)


def spliced(exons: DataFrame, keys: list[str], seq: str, start: str = "start", strand: str | None = None) -> DataFrame:
    """Sequences of each key's exons joined in transcript order, reverse-complemented on the - strand."""
    from ..functions.columns import reverse_complement

    minus = (F.col(strand) == "-") if strand else F.lit(False)
    part = F.struct(F.when(minus, -F.col(start)).otherwise(F.col(start)).alias("o"), F.when(minus, reverse_complement(seq)).otherwise(F.col(seq)).alias("s"))
    return exons.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x.s), "").alias("seq"))


def mask(exons: DataFrame, windows: DataFrame, keys: list[str], start: str = "start", end: str = "end", strand: str | None = None) -> DataFrame:
    """Windows in transcript coordinates (keys, w_start, w_len) as genome segments: (keys, w_start, w_len, start, end)."""
    placed = transcript_places(exons, keys, start, end, strand).join(windows, keys)
    lo, hi = F.greatest("t_start", "w_start"), F.least(F.col("t_end"), F.col("w_start") + F.col("w_len") - 1)
    placed = placed.withColumns({"__lo": lo - F.col("t_start"), "__hi": hi - F.col("t_start")}).where("__lo <= __hi")
    minus = (F.col(strand) == "-") if strand else F.lit(False)
    return placed.select(*keys, "w_start", "w_len", F.when(minus, F.col(end) - F.col("__hi")).otherwise(F.col(start) + F.col("__lo")).alias(start), F.when(minus, F.col(end) - F.col("__lo")).otherwise(F.col(start) + F.col("__hi")).alias(end))


def lanes(df: DataFrame, keys: list[str], row: str, start: str = "start", end: str = "end") -> DataFrame:
    """The lowest free lane for each segment, in order of start: a greedy walk, cut where no segment reaches across, so one
    task holds one cluster of overlapping segments only."""
    w = Window.partitionBy(*keys).orderBy(start, row)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("__new", F.coalesce((F.col(start) > before).cast("int"), F.lit(1)))
    marked = marked.withColumn("__cluster", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([start, row])
        free: list[int] = []
        out = []
        for s, e in zip(pdf[start], pdf[end], strict=True):
            lane = next((i for i, x in enumerate(free) if x < s), len(free))
            free[lane : lane + 1] = [e]
            out.append(lane + 1)
        return pdf.assign(lane=out)[[*keys, row, start, end, "lane"]]

    fields = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in (*keys, row, start, end)) + ", lane bigint"
    return marked.groupBy(*keys, "__cluster").applyInPandas(walk, schema)


def nearest_segments(a: DataFrame, b: DataFrame, keys: list[str], row: str, start: str = "start", end: str = "end") -> DataFrame:
    """For each a the end of the closest b before it and the start of the closest b after it, overlaps apart; null where
    there is none, or where a key or an end of a is null."""
    out = _last_before(a.select(*keys, row, start, end), F.col(start), b.select(*keys, F.col(end).alias("__x")), keys, "previous")
    out = _last_before(out, -F.col(end), b.select(*keys, (-F.col(start)).alias("__x")), keys, "next")
    return out.withColumn("next", -F.col("next"))


def _last_before(asks: DataFrame, at: Column, points: DataFrame, keys: list[str], name: str, block: int = 1 << 16) -> DataFrame:
    """asks with the greatest point (keys, __x) below at, looked for inside blocks of positions first; only blocks' last
    points meet in a key's own window. Frames only grow, so time is that of the sorting."""
    both = asks.withColumns({"__x": at, "__point": F.lit(0)}).unionByName(points.dropna().distinct().withColumn("__point", F.lit(1)), allowMissingColumns=True)
    both, point = both.withColumn("__block", F.floor(F.col("__x") / block)), F.when(F.col("__point") == 1, F.col("__x"))
    lower = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    lasts = both.groupBy(*keys, "__block").agg(F.max(point).alias("__last")).select(*keys, "__block", F.max("__last").over(lower).alias("__before")).dropna()
    inside = Window.partitionBy(*keys, "__block").orderBy("__x", "__point").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.withColumn(name, F.max(point).over(inside)).where("__point = 0").join(lasts, [*keys, "__block"], "left")
    return out.withColumn(name, F.coalesce(name, "__before")).drop("__x", "__point", "__block", "__before")


def lift(df: DataFrame, blocks: DataFrame, keys: list[str], row: str, start: str = "start", end: str = "end") -> DataFrame:
    """Coordinates through aligned blocks (keys, b_start, b_end, to_key, to_start): segments inside one block, others with nulls."""
    inside = interval_join(blocks.withColumnsRenamed({"b_start": start, "b_end": end}), df.select(*keys, row, start, end), keys, "contain", start=start, end=end)
    moved = inside.select(row, "to_key", (F.col(f"tag_{start}") - F.col(f"site_{start}") + F.col("to_start")).alias("lifted_start"), (F.col(f"tag_{end}") - F.col(f"site_{start}") + F.col("to_start")).alias("lifted_end"))
    return df.join(moved, row, "left")

"""Mixing sources to target weights by Pfair scheduling.

A source's rows form blocks of equal row counts. The target is a fluid: at any time the sources that still have rows share
each slot by their exact weights. Once V units of fluid have gone out for each unit of weight, t(V) = sum(min(w V, blocks))
slots have passed, so block i of a source of weight w is released at slot floor(t(i/w)) and due at ceil(t((i+1)/w)).
Earliest-deadline-first then keeps each source within less than one block of its target at every slot, through all phases
(a phase ends when the fluid of a source does). The driver places blocks, and blocks grow with the table once it has
MAX_BLOCKS of them, so its part stays the same; rows stay DataFrame expressions.
"""

from __future__ import annotations

import bisect
import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stated

#: Parts that rounded() deals out; schedules take weights as they are.
PERIOD = 1024
BLOCK_ROWS = 64
#: Blocks that the driver places, besides a last one of each source; a larger table has larger blocks, of equal size again.
MAX_BLOCKS = 1 << 18
ROWS_PER_BUCKET = 50_000
_NULL = "\x01null"


def rounded(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole parts of the period that sum to it: at least 1 each, largest remainders first, ties by name."""
    whole = sum(weights.values())
    spare = period - len(weights)
    exact = {s: spare * w / whole for s, w in weights.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[: period - sum(out.values())]:
        out[s] += 1
    return out


def edf_pattern(parts: dict[str, int]) -> dict[str, list[int]]:
    """For each source the slots of one period that its blocks get."""
    return {s: [slot for slot, _, _ in x] for s, x in schedule(parts, parts).items()}


def whole_weights(weights: dict[str, float]) -> dict[str, int]:
    """Integers in exactly the ratios of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    return {s: int(x * scale) for s, x in exact.items()}


def fluid(blocks: dict[str, int], weights: dict[str, int]):
    """t at (blocks served) / (weight), as a function that gives numerator and denominator, and the times at which phases end."""
    ends = sorted((Fraction(n, weights[s]), n, weights[s]) for s, n in blocks.items())
    before, rates, stops = [0], [sum(weights[s] for s in blocks)], []
    for v, n, w in ends:
        stops.append(before[-1] + v * rates[-1])
        before.append(before[-1] + n)
        rates.append(rates[-1] - w)
    levels = [v for v, _, _ in ends]

    def slots(served: int, weight: int) -> tuple[int, int]:
        k = bisect.bisect_left(levels, Fraction(served, weight))
        return before[k] * weight + rates[k] * served, weight

    return slots, sorted(set(stops))


def schedule(blocks: dict[str, int], weights: dict[str, float]) -> dict[str, list[tuple[int, int, int]]]:
    """(slot, deadline's slot, phase) of each block of each source. Sources of weight 0 follow all others, as one phase more."""
    if bad := [s for s in blocks if not 0 <= weights[s] < math.inf]:
        raise ValueError(f"weights must be finite and not negative: {bad[:5]}")
    out: dict[str, list[tuple[int, int, int]]] = {s: [] for s in blocks}
    first = {s: n for s, n in blocks.items() if n and weights[s]}
    last = {s: n for s, n in blocks.items() if n and not weights[s]}
    start = phase = 0
    for left, given in ((first, weights), (last, last)):
        if not left:
            continue
        whole = whole_weights({s: given[s] for s in left})
        slots, stops = fluid(left, whole)
        due: list[tuple[int, str]] = []
        waiting = [(0, s) for s in left]  # by release
        heapq.heapify(waiting)
        total, now = sum(left.values()), 0
        for slot in range(total):
            while waiting and waiting[0][0] <= slot:
                s = heapq.heappop(waiting)[1]
                p, q = slots(len(out[s]) + 1, whole[s])
                heapq.heappush(due, (-(-p // q), s))
            deadline, s = heapq.heappop(due)
            while stops[now] < slot + 1:
                now += 1
            out[s].append((start + slot, start + deadline, phase + now))
            if len(out[s]) < left[s]:
                p, q = slots(len(out[s]), whole[s])
                heapq.heappush(waiting, (p // q, s))
        start, phase = start + total, phase + len(stops)
    return out


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, source: str = "source", key: str = "doc_id",
                text: str = "text", block_rows: int = BLOCK_ROWS, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """docs with mix_block (the source's block), mix_slot (its place in the stream), mix_row (place in the block),
    mix_phase and mix_due (the deadline's slot). Sorted by (mix_slot, mix_row) this is the mixed stream.

    weights: target by source; a source without one, and all if None, weighs the square root of its row count.
    No row is dropped or repeated. A null source is a source of its own; rows with equal key and text are
    interchangeable. Blocks hold block_rows rows, or the table's rows / max_blocks if that is more; the last block of a
    source may be short. A source is cut into hashed buckets before it is numbered, so a hot source never meets one task.
    Columns of docs that carry one of the five output names are replaced. An empty table gives an empty result.
    """
    names = ["mix_block", "mix_slot", "mix_row", "mix_phase", "mix_due"]
    docs = docs.drop(*names)
    based = docs.withColumns({"__src": F.coalesce(F.col(source).cast("string"), F.lit(_NULL)), "__hash": F.xxhash64(key, text)})
    counts = {r[0]: r[1] for r in based.groupBy("__src").count().collect()}
    if not counts:
        return docs.withColumns({c: F.lit(0).cast("int" if c in ("mix_row", "mix_phase") else "bigint") for c in names})
    target = {s: float((weights or {}).get("null" if s == _NULL else s, n**0.5)) for s, n in counts.items()}
    block_rows = max(block_rows, -(-sum(counts.values()) // max_blocks))
    plan = schedule({s: -(-n // block_rows) for s, n in counts.items()}, target)
    rows = [{"__src": s, "__block": b, "mix_slot": slot, "mix_due": due, "mix_phase": phase} for s, x in plan.items() for b, (slot, due, phase) in enumerate(x)]
    placed = stated(docs.sparkSession, rows, "__src string, __block bigint, mix_slot bigint, mix_due bigint, mix_phase int", "blocks")

    buckets = -(-sum(counts.values()) // ROWS_PER_BUCKET) * 16
    based = based.withColumn("__sub", F.pmod("__hash", F.lit(buckets)))
    sizes = based.groupBy("__src", "__sub").agg(F.count("*").alias("__rows"))
    before = sizes.withColumn("__first", F.coalesce(F.sum("__rows").over(Window.partitionBy("__src").orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # The blocks that a bucket touches go to its row, so that texts meet their slots by the key by which they are numbered.
    cut = before.withColumn("__block", F.explode(F.expr(f"sequence(__first div {block_rows}, (__first + __rows - 1) div {block_rows})")))
    slots = cut.join(placed, ["__src", "__block"]).groupBy("__src", "__sub", "__first").agg(F.array_sort(F.collect_list(F.struct("__block", "mix_slot", "mix_due", "mix_phase"))).alias("__slots"))
    order = Window.partitionBy("__src", "__sub").orderBy("__hash", key)
    out = based.withColumn("__n", F.row_number().over(order) - 1).join(slots, ["__src", "__sub"])
    out = out.withColumn("__n", F.col("__first") + F.col("__n")).withColumns({"mix_block": F.expr(f"__n div {block_rows}"), "mix_row": F.expr(f"cast(__n % {block_rows} as int)")})
    out = out.withColumn("__p", F.expr(f"get(__slots, cast(mix_block - __first div {block_rows} as int))"))
    out = out.withColumns({c: F.col(f"__p.{c}") for c in ("mix_slot", "mix_phase", "mix_due")})
    return out.select(*docs.columns, *names)

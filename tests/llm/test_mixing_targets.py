"""Mixing against its exact targets: at each slot every source is within one block of the share that its weight gives it."""

from __future__ import annotations

from collections import Counter
from fractions import Fraction

import pytest

from strandloom.llm import mixing


def targets(blocks, weights):
    """Each source's share after each slot: slots are shared by weight among the sources that still have blocks."""
    left = {s: Fraction(n) for s, n in blocks.items()}
    for _ in range(sum(blocks.values())):
        room = Fraction(1)
        while room:
            whole = sum(Fraction(weights[s]) for s in left if left[s])
            share = {s: Fraction(weights[s]) / whole for s in left if left[s]}
            step = min([room, *(left[s] / x for s, x in share.items())])
            left |= {s: left[s] - step * x for s, x in share.items()}
            room -= step
        yield {s: n - left[s] for s, n in blocks.items()}


def stream(spark, rows, weights=None, block_rows=1):
    """Sources in the order of the slots."""
    data = [(i, s, "t") for i, s in enumerate(s for s, n in rows.items() for _ in range(n))]
    got = mixing.mix_sources(spark.createDataFrame(data, "doc_id int, source string, text string"), weights, block_rows=block_rows).collect()
    assert sorted(r.doc_id for r in got) == [x[0] for x in data]
    slots = {}
    for r in got:
        assert slots.setdefault(r.mix_slot, r.source) == r.source and r.mix_slot < r.mix_due
    assert sorted(slots) == list(range(len(slots)))
    return [slots[i] for i in sorted(slots)]


def worst(order, blocks, weights):
    done = Counter()
    out = 0
    for s, want in zip(order, targets(blocks, weights), strict=True):
        done[s] += 1
        out = max(out, *(abs(done[x] - w) for x, w in want.items()))
    return out


def test_hot_source_keeps_its_target(spark):
    """0.6 among 20 sources, over some thousand slots and all phases."""
    rows = {"hot": 1800} | {f"s{i}": 40 + 4 * i for i in range(19)}
    weights = {"hot": 0.6} | {f"s{i}": 0.4 / 19 for i in range(19)}
    assert worst(stream(spark, rows, weights), rows, weights) < 1


def test_each_of_many_sources_keeps_its_target(spark):
    """More sources than were once scheduled by themselves; the smallest is given a weight."""
    rows = {f"s{i:03}": 3 for i in range(230)} | {"small": 2}
    weights = dict.fromkeys(rows, 1) | {"small": 77}
    assert worst(stream(spark, rows, weights), rows, weights) < 1


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1, "c": 1}, {"a": 0.1, "b": 7.3, "c": 1e-3}, {"a": 1e9, "b": 3, "c": 2**0.5}])
def test_schedule_is_exact(weights):
    blocks = {"a": 300, "b": 41, "c": 7}
    plan = mixing.schedule(blocks, weights)
    placed = sorted((slot, s) for s, x in plan.items() for slot, _, _ in x)
    assert [slot for slot, _ in placed] == list(range(348)) and worst([s for _, s in placed], blocks, weights) < 1
    assert all(x == sorted(x) and all(slot < due for slot, due, _ in x) for x in plan.values())


def test_sources_of_weight_zero_come_last():
    plan = mixing.schedule({"a": 5, "b": 3}, {"a": 1.0, "b": 0.0})
    assert [x[0] for x in plan["a"]] == [0, 1, 2, 3, 4] and [x[0] for x in plan["b"]] == [5, 6, 7]
    with pytest.raises(ValueError, match="negative"):
        mixing.schedule({"a": 1}, {"a": -1.0})


def test_larger_tables_have_larger_blocks(spark):
    """At most so many blocks, besides one a source; names of sources are taken as they are."""
    rows = {'a "b"\n\\': 300, "": 90, "é ,": 45, "null": 7}
    data = spark.createDataFrame([(i, s, "t") for i, s in enumerate(s for s, n in rows.items() for _ in range(n))], "doc_id int, source string, text string")
    got = mixing.mix_sources(data, block_rows=1, max_blocks=10).collect()
    assert Counter(r.source for r in got) == rows and len({r.doc_id for r in got}) == 442
    blocks = {s: -(-n // 45) for s, n in rows.items()}
    assert Counter(s for s, _ in {(r.source, r.mix_block) for r in got}) == blocks and len({r.mix_slot for r in got}) == sum(blocks.values()) <= 10 + len(rows)

"""Components against a search of the graph, joined by one task, by turns, and by both."""

from __future__ import annotations

import random

import pytest

from strandloom.llm.components import components


@pytest.mark.parametrize("few", [0, 60, 1 << 19])
def test_components(spark, few):
    r = random.Random(few)
    links = [(i, i + 1) for i in range(100, 180)] + [(7, x) for x in range(200, 260)] + [(r.randint(300, 420), r.randint(300, 420)) for _ in range(70)] + [(5, 5), (7, 200), (-3, 1 << 60)]
    near = {}
    for a, b in links:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want, left = set(), set(near)
    while left:
        reached, new = set(), {left.pop()}
        while new:
            reached |= new
            new = set().union(*(near[x] for x in new)) - reached
        left -= reached
        want.add(frozenset(reached))
    got = {}
    for row in components(spark.createDataFrame(links, "a bigint, b bigint"), few).collect():
        got.setdefault(row.label, set()).add(row.node)
    assert {frozenset(x) for x in got.values()} == want and sum(map(len, got.values())) == len(near)
    assert components(spark.createDataFrame([], "a bigint, b bigint"), few).count() == 0

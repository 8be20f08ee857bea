"""Interval operators against a model that looks at every base."""

from __future__ import annotations

import random

import pytest

from strandloom.operators import intervals as I

from .conftest import rows


def segments(seed, n, span=60, chroms=2):
    r = random.Random(seed)
    return [(r.randrange(chroms), i, a, a + r.randrange(12)) for i in range(n) for a in [r.randrange(1, span)]]


def frame(spark, data):
    return spark.createDataFrame(data, "chr int, id int, start bigint, end bigint")


def bases(data):
    return {(c, p) for c, _, s, e in data for p in range(s, e + 1)}


@pytest.mark.parametrize("seed", range(6))
def test_joins(spark, seed):
    a, b = segments(seed, 15), segments(seed + 100, 25)
    A, B = frame(spark, a), frame(spark, b).withColumnRenamed("id", "tag")
    touch = [(x[1], y[1]) for x in a for y in b if x[0] == y[0] and y[2] <= x[3] and y[3] >= x[2]]
    inside = [(x[1], y[1]) for x in a for y in b if x[0] == y[0] and y[2] >= x[2] and y[3] <= x[3]]
    for width in (4, 256):
        assert rows(I.interval_join(A, B, ["chr"], width=width).select("id", "tag")) == sorted(touch)
        assert rows(I.interval_join(A, B, ["chr"], "contain", width=width).select("id", "tag")) == sorted(inside)


def test_long_segments_meet_once(spark):
    a = frame(spark, [(1, 0, 1, 10**9), (1, 1, 500, 500)])
    b = frame(spark, [(1, 7, 10**8, 10**8 + 5), (1, 8, 1, 2 * 10**9), (1, 9, 500, 501)]).withColumnRenamed("id", "tag")
    got = rows(I.interval_join(a.where("id = 1"), b, ["chr"]).select("id", "tag"))
    assert got == [(1, 8), (1, 9)]


@pytest.mark.parametrize("seed", range(6))
def test_union_depth_difference(spark, seed):
    a, b = segments(seed, 12), segments(seed + 50, 10)
    A, B = frame(spark, a), frame(spark, b)
    merged = I.segment_union(A, ["chr"], block=16)
    assert {(c, p) for c, s, e in rows(merged) for p in range(s, e + 1)} == bases(a)
    assert all(y[1] > x[2] + 1 for x, y in zip(rows(merged), rows(merged)[1:], strict=False) if x[0] == y[0])
    deep = {}
    for c, _, s, e in a:
        for p in range(s, e + 1):
            deep[c, p] = deep.get((c, p), 0) + 1
    got = {(r["chr"], p): r["depth"] for r in I.depth(A, ["chr"], block=16).collect() for p in range(r["start"], r["end"] + 1)}
    assert got == deep
    left = {(i, c, p) for c, i, s, e in rows(I.difference(A, B, ["chr"], "id").select("chr", "id", "start", "end")) for p in range(s, e + 1)}
    assert left == {(i, c, p) for c, i, s, e in a for p in range(s, e + 1) if (c, p) not in bases(b)}
    both = {(i, c, p) for c, i, s, e in rows(I.intersection(A, B, ["chr"], "id").select("chr", "id", "start", "end")) for p in range(s, e + 1)}
    assert both == {(i, c, p) for c, i, s, e in a for p in range(s, e + 1) if (c, p) in bases(b)}


def test_small_cases(spark):
    assert rows(I.segment_union(frame(spark, [(1, 0, 1, 3), (1, 1, 4, 6)]), ["chr"])) == [(1, 1, 6)]
    assert len(rows(I.segment_union(frame(spark, [(1, 0, 1, 3), (1, 1, 4, 6)]), ["chr"], weld=False))) == 2
    assert rows(I.introns(frame(spark, [(1, 0, 1, 3), (1, 1, 10, 12), (1, 2, 20, 21)]), ["chr"])) == [(1, 4, 9), (1, 13, 19)]
    empty = frame(spark, [])
    assert rows(I.segment_union(empty, ["chr"])) == [] and rows(I.depth(empty, ["chr"])) == []
    minus = spark.createDataFrame([("t", 1, 10, "-"), ("t", 21, 30, "-")], "tx string, start bigint, end bigint, strand string")
    windows = spark.createDataFrame([("t", 9, 4)], "tx string, w_start bigint, w_len bigint")
    assert rows(I.mask(minus, windows, ["tx"], strand="strand").select("start", "end")) == [(9, 10), (21, 22)]
    lanes = rows(I.lanes(frame(spark, [(1, 0, 1, 5), (1, 1, 3, 8), (1, 2, 6, 9), (1, 3, 20, 21)]), ["chr"], "id").select("id", "lane"))
    assert lanes == [(0, 1), (1, 2), (2, 1), (3, 1)]

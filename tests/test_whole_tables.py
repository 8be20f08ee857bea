"""Queries that answer for every row of their tables, and for whole texts, against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from strandloom.functions import columns as C
from strandloom.operators import stats as S
from strandloom.plans import catalogue, stat_queries, table_queries  # noqa: F401

DIR = "/root/testdata/sf0.001"


def greedy(points, method, cutoff):
    """Clusters by merging the closest two again and again until none is within the cutoff."""
    groups = [[i] for i in range(len(points))]
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))

    def apart(a, b):
        if method == "ward":
            gap = points[a].mean(0) - points[b].mean(0)
            return (2 * len(a) * len(b) / (len(a) + len(b)) * (gap @ gap)) ** 0.5
        return {"average": np.mean, "complete": np.max, "single": np.min}[method](d[np.ix_(a, b)])

    while len(groups) > 1:
        least, i, j = min((apart(groups[i], groups[j]), i, j) for j in range(len(groups)) for i in range(j))
        if least > cutoff:
            break
        groups[i] += groups.pop(j)
    return {frozenset(g) for g in groups}


@pytest.mark.parametrize("method", ["ward", "average", "complete", "single"])
def test_linkage(method):
    points = np.random.default_rng(1).normal(size=(45, 3))
    for cutoff in (0.3, 1.0, 2.5, 99.0):
        found = S.cut_tree(S.linkage(points, method), cutoff)
        assert {frozenset(np.flatnonzero(found == c)) for c in set(found)} == greedy(points, method, cutoff)


def test_fastcluster_has_every_vector(spark):
    data = spark.read.parquet(f"{DIR}/embeddings.parquet").toPandas().set_index("vec_id")
    got = catalogue.QUERIES["q_fastcluster"](spark, DIR).toPandas().set_index("vec_id")
    assert sorted(got.index) == sorted(data.index) and len(data) > 200
    assert (got["label"].sort_index() == data["label"].sort_index()).all()
    for _, rows in got.groupby("label"):
        points = np.stack(data.loc[rows.index, "embedding"]).astype(float)
        want = {frozenset(rows.index[list(g)]) for g in greedy(points, "ward", 2.0)}
        assert {frozenset(g.index) for _, g in rows.groupby("cluster")} == want


def frames(seq):
    """Each ATG with its last in-frame stop, by walking codons."""
    out = []
    for i in range(len(seq) - 2):
        if seq[i : i + 3] == "ATG":
            stops = []
            for j in range(i, len(seq) - 2, 3):
                if not re.fullmatch("[A-Z]{3}", seq[j : j + 3]):
                    break
                if seq[j : j + 3] in ("TAA", "TAG", "TGA"):
                    stops.append(j + 3)
            out += [(i + 1, s) for s in stops[-1:]]
    return out


def test_reading_frames():
    r = random.Random(0)
    for alphabet in ("ATG", "ACGT", "ATGATGATGATG-", "ATGATGATGATGé\U0001f600N"):
        for n in [*range(12), 60, 400]:
            for _ in range(20):
                seq = "".join(r.choice(alphabet) for _ in range(n))
                assert C.reading_frames(seq) == frames(seq)


def test_findorf_reads_whole_texts(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").where("text is not null").select("doc_id", "text").collect()
    table = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")
    seqs = {d.doc_id: re.sub("[^ACGT]", "", d.text.lower().translate(table)) for d in docs}
    short = {i: seq for i, seq in seqs.items() if len(seq) < 6000}  # the walk takes the square of the length
    want = [(i, *x) for i, seq in short.items() for x in frames(seq)]
    got = [tuple(r) for r in catalogue.QUERIES["q_findorf"](spark, DIR).collect()]
    assert sorted(x for x in got if x[0] in short) == sorted(want)
    assert max(x[2] for x in got) > 6000


def test_numbered_is_the_place_in_the_whole_order(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from strandloom.operators.rows import numbered

    df = spark.range(3000).select((F.pmod(F.xxhash64("id"), F.lit(40)) * F.when(F.col("id") % 3 == 0, 0).otherwise(1)).alias("a"), F.when(F.col("id") % 7 > 0, F.xxhash64("id", F.lit(1))).alias("b"), "id")
    df = df.unionByName(spark.createDataFrame([(None, 1, 9001), (None, None, 9002)], df.schema))
    want = df.withColumn("place", F.row_number().over(Window.orderBy("a", "b", "id")).cast("bigint")).select("id", "place").collect()
    assert sorted(numbered(df, ["a", "b", "id"], ranges=16).select("id", "place").collect()) == sorted(want)
    assert numbered(df.limit(0), ["a", "b", "id"]).count() == 0


def test_a_header_after_many_comments(spark, tmp_path):
    from strandloom.sources.text import read_table

    (tmp_path / "t.tsv").write_text("skipped\n" + "# c\n" * 2500 + "a\tb\n1\t2\n")
    assert [(r.a, r.b) for r in read_table(spark, str(tmp_path / "t.tsv"), skip=1).select("a", "b").collect()] == [("1", "2")]


def test_a_very_long_alignment_tag(spark, tmp_path):
    from strandloom.sources.genomics import read_sam

    tag = "x" * 1_200_000
    (tmp_path / "t.sam").write_text(f"r1\t0\tchr1\t100\t9\t10M\t*\t0\t0\tACGTACGTAC\t*\tZZ:Z:{tag}\n")
    assert read_sam(spark, str(tmp_path / "t.sam"), tags={"ZZ": "Z"}).first()["ZZ"] == tag

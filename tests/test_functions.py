"""Worked examples of scalar functions, table operators and sources."""

from __future__ import annotations

import gzip
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.functions import columns as C
from strandloom.functions import probability as P
from strandloom.operators import groups as G
from strandloom.operators import joins as J
from strandloom.operators import rows as R
from strandloom.operators import stats as S
from strandloom.operators import tables as T
from strandloom.operators import windows as W
from strandloom.sources import genomics, text
from strandloom.sources.store import Store, files

from .conftest import rows


def one(spark, column, **values):
    kinds = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'array<string>' if isinstance(v, list) else 'bigint'}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], kinds).select(column.alias("y")).first()["y"]


def test_strings(spark):
    for spec, want in {"-2": "b", "-end": "d", "-2:end": "b-c-d", "-2:end+": "b+c+d", "-1, 3": "a-c"}.items():
        assert one(spark, C.cut("s", spec), s="a-b-c-d") == want
    assert one(spark, C.template("$1-$2", "a", "b"), a=1, b=4) == "1-4"
    assert one(spark, C.si_number("x"), x=1500.0) == "1.5k"
    assert one(spark, C.si_number("x"), x=0.002) == "2m"
    assert one(spark, C.number_text("x", min_digits=3), x=7.0) == "007"
    assert tuple(one(spark, C.first_match("a", "z"), a=["x", "yz", "z"])) == ("yz", 2)
    assert tuple(one(spark, C.first_match("a", "q"), a=["x"])) == (None, 0)
    assert one(spark, C.to_int("s"), s="1.0") == 1


def test_genome_scalars(spark):
    for name, code in {"chrX": 31, "chrY": 32, "chrM": 41, "2a": 51, "chr7": 7, "III": 3, "scaffold": 0}.items():
        assert one(spark, C.chr_code("s"), s=name) == code
    assert one(spark, C.chr_name("n"), n=31) == "chrX"
    assert one(spark, C.seg_length("a", "b"), a=0, b=0) == 0
    with pytest.raises(Exception, match="shorter"):
        one(spark, C.seg_length("a", "b"), a=5, b=2)
    assert one(spark, C.reverse_complement("s"), s="AACGT") == "ACGTT"
    assert [tuple(x) for x in one(spark, C.cigar_segments("s", F.lit(100)), s="5S10M2I5D100N20M")] == [(100, 114), (215, 234)]
    with pytest.raises(Exception, match="unsupported"):
        one(spark, C.cigar_segments("s", F.lit(1)), s="5=")
    assert [tuple(x) for x in one(spark, C.orfs("s"), s="CCATGAAATAACC")] == [(3, 11)]
    assert [tuple(x) for x in one(spark, C.orfs("s"), s="ATGTAATAG")] == [(1, 9)]  # to the last stop in frame


def test_ranks_and_chunks(spark):
    d = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 2.0), (4, 3.0), (5, None)], "id int, x double")
    assert rows(W.tied_rank(d, "x").select("id", "rank")) == [(1, 1.0), (2, 2.5), (3, 2.5), (4, 4.0), (5, None)]
    assert T.chunks(11, 3) == [4, 4, 3]
    assert rows(W.condensed_pairs(spark.range(3).withColumnRenamed("id", "i0"), "i0")) == [(1, 0), (2, 0), (2, 1)]
    assert R.is_sorted(d.where("id < 5"), ["x"], ["id"]) and not R.is_sorted(d.where("id < 5").withColumn("o", -F.col("id")), ["x"], ["o"])


def test_adjusted_p(spark):
    p = [0.01, 0.04, 0.03, 0.005, 0.04]
    d = spark.createDataFrame(list(enumerate(p)), "id int, p double")

    def got(m):
        return [round(r[1], 6) for r in rows(W.adjust_p(d, "p", m).select("id", "adjusted"))]

    assert got("BH") == [0.025, 0.04, 0.04, 0.025, 0.04]
    assert got("bonferroni") == [0.05, 0.2, 0.15, 0.025, 0.2]
    assert got("holm") == [0.04, 0.09, 0.09, 0.025, 0.09]
    assert got("hochberg") == [0.04, 0.04, 0.04, 0.025, 0.04]


def test_joins(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z")], "k int, a string")
    b = spark.createDataFrame([(2, 5), (3, None)], "k int, b int")
    assert rows(J.table_join(a, b, ["k"], fill="B")) == [(1, "x", 0), (2, "y", 5), (2, "z", 5)]
    assert rows(J.table_join(a, b, ["k"], fill="AB")) == [(1, "x", 0), (2, "y", 5), (2, "z", 5), (3, "", None)]
    with pytest.raises(ValueError, match="without a match"):
        J.table_join(a, b, ["k"], a_full=True)
    with pytest.raises(ValueError, match="more than one"):
        J.table_join(a, b, ["k"], b_unique=True)
    with pytest.raises(Exception, match="no match"):
        J.lookup(a, ["k"], b, ["k"], ["b"]).collect()
    twice = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "k int, v int")
    with pytest.raises(Exception, match="ambiguous"):
        J.lookup(a, ["k"], twice, ["k"], ["v"], safe=True).collect()
    assert rows(J.replace_by_table(a, "a", spark.createDataFrame([("x", "X")], "o string, n string"), "o", "n")) == [(1, "X"), (2, "y"), (2, "z")]


def test_tables(spark):
    t = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, "b", 3)], "k int, f string, v int")
    assert rows(T.unique_rows(t, ["k"], ["v"], trim=True)) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="not determined"):
        T.unique_rows(t, ["k"], ["v"], check=True)
    with pytest.raises(ValueError, match="share"):
        T.rename(t, {"f": "k"})
    with pytest.raises(ValueError, match="differ"):
        T.merge_columns(t.where("k = 2"), t.where("k = 2").withColumn("v", F.lit(9)), ["k"])
    with pytest.raises(ValueError, match="more than once"):
        G.pivot(t, "k", "f", "v", ["a", "b"], strict=True)
    assert G.mode(t, "k") == 1 and G.mode(t.limit(0), "k") is None
    assert rows(R.set_rows(t, F.col("k") == 1, {"v": F.lit(0)}).select("v")) == [(0,), (0,), (3,)]
    assert R.repeat_rows(t.limit(1), 3).count() == 3


def test_typed_table(spark, tmp_path):
    body = "# note\n#:: id\tN::n\tn::m\tF::x\t<F::y\tB::b\tX::gone\n\"a\"\t1\tNA\t1.5\t2\ttrue\tq\nb\t2\t3\t0.5\t4\tf\tq\n"
    path = tmp_path / "t.tsv.gz"
    with gzip.open(path, "wt") as f:
        f.write(body)
    d = text.read_table(spark, str(path))
    assert rows(d.drop("_rid")) == [("a", 1, 0, [1.5, 2.0], True), ("b", 2, 3, [0.5, 4.0], False)]
    (tmp_path / "bad.tsv").write_text("a\tb\n1\n")
    with pytest.raises(Exception, match="wrong number"):
        text.read_table(spark, str(tmp_path / "bad.tsv")).collect()
    (tmp_path / "open.tsv").write_text("a\tF::b\t<<<\nx\t1\t2\t3\ny\t4\n")
    assert rows(text.read_table(spark, str(tmp_path / "open.tsv")).drop("_rid")) == [("x", [1.0, 2.0, 3.0]), ("y", [4.0])]
    (tmp_path / "auto.tsv").write_text("a\tb\tc\n1\t1.5\tx\n2\t2\ty\n")
    assert dict(text.read_table(spark, str(tmp_path / "auto.tsv"), infer=True).dtypes) == {"_rid": "bigint", "a": "bigint", "b": "double", "c": "string"}
    text.write_table(d.select("id", "n"), str(tmp_path / "out"), "id=>name,n")
    assert rows(text.read_table(spark, str(tmp_path / "out" / "*.csv")).drop("_rid")) == [("a", 1), ("b", 2)]
    (tmp_path / "m.tsv").write_text("\ts1\ts2\ng1\t1\t2\ng2\t3\t4\n")
    assert rows(text.read_matrix(spark, str(tmp_path / "m.tsv"))) == [("g1", "s1", 1.0), ("g1", "s2", 2.0), ("g2", "s1", 3.0), ("g2", "s2", 4.0)]
    got = text.line_map(spark, str(tmp_path / "m.tsv"), lambda ls: [(len(ls),)], "n bigint", each=2)
    assert rows(got) == [(1,), (2,)]


def test_genomics_sources(spark, tmp_path):
    gtf = 'chr1\tx\texon\t10\t50\t.\t+\t.\tgene_id "g"; transcript_id "t"; exon_number "1"; gene_name "G"; gene_biotype "protein_coding"; exon_id "e";\nchr1\tx\tCDS\t20\t40\t.\t+\t.\tgene_id "g"; transcript_id "t"; protein_id "p";\nKI270\tx\texon\t1\t2\t.\t+\t.\tgene_id "u"; transcript_id "v";\n'
    (tmp_path / "a.gtf").write_text(gtf)
    r = genomics.read_gtf(spark, str(tmp_path / "a.gtf")).collect()
    assert len(r) == 1 and (r[0].exn_start, r[0].cds_start, r[0].cds_end, r[0].protid, r[0].gene_typ) == (10, 20, 40, "p", "protein_coding")
    sam = "@HD\nr1\t0\tchr1\t100\t60\t5M10N5M\t*\t0\t0\tAAAAACCCCC\t*\tNH:i:1\tAS:i:9\nr2\t16\tchr1\t102\t60\t4M\t*\t0\t0\tAAAA\t*\tNH:i:2\tAS:i:5\nr3\t4\t*\t0\t0\t*\t*\t0\t0\tA\t*\n"
    (tmp_path / "a.sam").write_text(sam)
    reads = genomics.read_sam(spark, str(tmp_path / "a.sam"), tags={"NH": "i", "AS": "i"})
    assert rows(reads.select("readid", "start", "end", "strand", "segno", "NH")) == [("r1", 100, 104, "+", 1, 1), ("r1", 115, 119, "+", 2, 1), ("r2", 102, 105, "-", 1, 2)]
    assert genomics.best_hits(reads).select("readid").distinct().count() == 1
    sites = spark.createDataFrame([(1, "s", 101, 103)], "chrno int, site string, start bigint, end bigint")
    assert rows(genomics.read_counts(reads, sites, ["chrno"], "site", unique=None)) == [("s", 2)]
    (tmp_path / "a.fa").write_text(">one desc\nACGT\nAC\n>two\nGG\n")
    fa = genomics.read_fasta(spark, str(tmp_path / "a.fa"))
    assert rows(fa) == [("one desc", "ACGTAC"), ("two", "GG")]
    genomics.write_fasta(fa, str(tmp_path / "fa"))
    genomics.write_genome(fa.where("head = 'two'").unionByName(spark.createDataFrame([("1", "ACGTACGTAC")], "head string, seq string")), str(tmp_path / "genome"), chunk=4)
    segs = spark.createDataFrame([(0, "1", 3, 9, "+"), (1, "1", 3, 9, "-")], "row int, chr string, start bigint, end bigint, strand string")
    got = genomics.get_sequences(spark.read.parquet(str(tmp_path / "genome")), segs, "row", chunk=4, strand="strand")
    assert rows(got.select("row", "seq")) == [(0, "GTACGTA"), (1, "TACGTAC")]
    (tmp_path / "lane.html").write_text("<table><tr><th>Lane</th><th>PF</th></tr><tr><td>1</td><td><b>9</b></td></tr></table>")
    assert [r.cells for r in genomics.read_lane_report(spark, str(tmp_path / "lane.html")).collect()] == [["Lane", "PF"], ["1", "9"]]
    m = spark.createDataFrame([(0, "3M1I2M2D2M", "2A2^GT2", "ACCGTTAA", 10)], "record_no bigint, cigar string, md string, seq string, pos bigint")
    assert rows(genomics.mutations(m).select("kind", "ref_pos", "ref", "alt")) == [("D", 15, "GT", ""), ("I", 12, "", "G"), ("S", 12, "A", "C")]


def test_store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"))
    s.save(readme="hello", meta={"a": 1}, t=spark.range(3))
    assert s.names() == ["t"] and s.load("t").count() == 3 and s.readme() == "hello" and s.meta() == {"a": 1}
    s.save(rewrite=True, t=spark.range(5))
    assert s.load("t").count() == 5
    s.delete("t")
    assert s.names() == []
    (tmp_path / "x.txt").write_text("1")
    assert rows(files(spark, str(tmp_path), r"\.txt$").select("name")) == [("x.txt",)]


def test_distributions():
    assert P.t_two_sided(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert P.f_upper(3.5, 2, 20) == pytest.approx(0.0497350, abs=1e-6)
    assert P.chi2_upper(3.84, 1) == pytest.approx(0.0500435, abs=1e-6)
    assert P.fisher_two_sided(3, 1, 1, 3) == pytest.approx(0.4857143, abs=1e-6)
    assert P.binomial_two_sided(7, 10) == pytest.approx(0.34375, abs=1e-9)
    assert P.hypergeometric_upper(2, 2, 2, 4) == pytest.approx(1 / 6)
    assert P.normal_two_sided(1.959964) == pytest.approx(0.05, abs=1e-6)


def test_clustering_and_cox(spark):
    x = np.array([[0.0], [0.1], [5.0], [5.1], [20.0]])
    z = S.linkage(x, "average")
    assert S.cut_tree(z, 1.0).tolist() == [1, 1, 2, 2, 3] and sorted(S.tree_order(z)) == [0, 1, 2, 3, 4]
    d = np.abs(x - x.T)
    y = S.scaling(d, 1)
    assert np.abs(np.abs(y - y.T) - d).max() < 1e-6
    data = [(float(t), 1, float(t < 5)) for t in range(1, 10)] + [(3.5, 0, 0.0), (7.5, 1, 1.0)]
    fit = S.cox(spark.createDataFrame(data, "t double, s int, x double"), "t", "s", ["x"]).first()
    assert fit["coef"] > 0 and 0 < fit["p"] < 1 and math.isfinite(fit["se"])

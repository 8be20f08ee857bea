"""The flagship pipeline on a fixture worked out by hand."""

from __future__ import annotations

import pytest

from strandloom.plans.cryptic import cryptic, run_files

from .conftest import rows


def gtf(rows_):
    return "".join(f'chr1\tx\texon\t{a}\t{b}\t.\t+\t.\tgene_id "{g}"; transcript_id "{t}"; gene_biotype "{k}";\n' for a, b, g, t, k in rows_)


def test_files(spark, tmp_path):
    (tmp_path / "m.gtf").write_text(gtf([(100, 199, "MSTRG.1", "MSTRG.1.1", ""), (300, 349, "MSTRG.1", "MSTRG.1.1", ""), (1000, 1099, "MSTRG.2", "T1", ""), (5000, 5049, "MSTRG.3", "T2", "")]))
    (tmp_path / "r.gtf").write_text(gtf([(1000, 1099, "G1", "T1", "protein_coding"), (5000, 5049, "G2", "T2", "lncRNA")]))
    (tmp_path / "rep.tsv").write_text("chr\tN::start\tN::end\tN::rep_recNo\trep_name\trep_Fam\trep_subFam\tstrand\nchr1\t150\t180\t1\tL1a\tL1\tL1s\t+\nchr1\t190\t330\t2\tAluY\tSINE\tAlu\t-\nchr1\t1000\t1100\t3\tX\tLTR\tE\t+\n")
    (tmp_path / "a.tsv").write_text("MSTRG.1\t30\nMSTRG.2\t60\nMSTRG.3\t10\n__no_feature\t5\n")
    out = run_files(spark, str(tmp_path / "m.gtf"), str(tmp_path / "r.gtf"), str(tmp_path / "rep.tsv"), {"a": str(tmp_path / "a.tsv")}, str(tmp_path / "out"))
    genes = {r.gene_STRid: r for r in out.genes.collect()}
    # MSTRG.1: record 1 overlaps 31 bases, record 2 10 + 31 = 41.
    assert (genes["MSTRG.1"].rep_recNo, genes["MSTRG.1"].gene_group, genes["MSTRG.1"].gene_len) == (2, "RT_SINE", 150)
    assert genes["MSTRG.2"].gene_group == "cdgene" and genes["MSTRG.3"].gene_group == "nonRT"
    assert (genes["MSTRG.2"].geneid, genes["MSTRG.3"].geneid, genes["MSTRG.1"].geneid) == ("G1", "G2", "MSTRG.1")
    assert rows(out.info) == [("MSTRG.1", "AluY", "Alu", "RT_SINE", 150, "MSTRG.1")]
    assert rows(out.rpkm) == [("MSTRG.1", "a", pytest.approx(1e9 * 30 / 100 / 150))]
    assert spark.read.csv(str(tmp_path / "out" / "RAT_readcount.tsv"), sep="\t", header=True).first().a == "30"


def test_samples_must_agree(spark):
    exons = spark.createDataFrame([(1, 1, 9, "g", "t", "")], "chrno int, exn_start bigint, exn_end bigint, geneid string, transid string, gene_typ string")
    reps = spark.createDataFrame([(1, 1, 2, 1, "n", "f", "s", "+")], "chrno int, start bigint, end bigint, rep_recNo bigint, rep_name string, rep_Fam string, rep_subFam string, strand string")
    counts = spark.createDataFrame([("g", "a", 1), ("h", "a", 1), ("g", "b", 1)], "gene_STRid string, sample string, readnum bigint")
    with pytest.raises(ValueError, match="different genes"):
        cryptic(exons, exons, reps, counts)

"""The flagship pipeline: transcripts that overlap repeats, their dominant element, read counts and RPKM.

One lazy plan from exon tables, repeats and counts to three tables; only the sinks and asked-for checks act.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import chr_code, overlap_length
from ..operators.intervals import interval_join, segment_union
from ..operators.joins import lookup
from ..operators.rows import fill_empty
from ..operators.tables import unique_rows
from ..sources.genomics import read_gtf
from ..sources.text import read_table


@dataclass
class Cryptic:
    """genes: one row a gene; counts and rpkm: long (RAT_ID, sample, value) of genes whose dominant element is a repeat."""

    genes: DataFrame
    info: DataFrame
    counts: DataFrame
    rpkm: DataFrame


def gene_ids(merged: DataFrame, reference: DataFrame, novel: str = "MSTRG.") -> DataFrame:
    """Merged exons with geneid: the most frequent reference gene over the gene's known transcripts' exon rows, coding
    transcripts preferred where there are any; the merged gene's own id where it has no known transcript."""
    ref = reference.groupBy("transid").agg(F.max_by("geneid", F.struct("geneid")).alias("ref_gene"), F.max((F.col("gene_typ") == "protein_coding").cast("int")).alias("coding"))
    known = merged.where(~F.col("transid").startswith(novel)).join(ref, "transid", "left")
    known = known.withColumns({"coding": F.coalesce("coding", F.lit(0)), "ref_gene": F.coalesce("ref_gene", "gene_STRid")})
    best = known.groupBy("gene_STRid").agg(F.max("coding").alias("any_coding"))
    votes = known.join(best, "gene_STRid").where("coding = any_coding").groupBy("gene_STRid", "ref_gene").agg(F.count("*").alias("n"))
    mode = votes.groupBy("gene_STRid").agg(F.min_by("ref_gene", F.struct(-F.col("n"), "ref_gene")).alias("geneid"))
    return merged.join(mode, "gene_STRid", "left").withColumn("geneid", F.coalesce("geneid", "gene_STRid"))


def dominant_repeats(exons: DataFrame, repeats: DataFrame) -> DataFrame:
    """For each gene_STRid the repeat record with the largest sum of overlaps over its exon rows, ties to the smaller record."""
    hits = interval_join(repeats.select("chrno", "start", "end", "rep_recNo"), exons.select("chrno", F.col("exn_start").alias("start"), F.col("exn_end").alias("end"), "gene_STRid"), ["chrno"])
    total = hits.groupBy("gene_STRid", "rep_recNo").agg(F.sum(overlap_length("site_start", "site_end", "tag_start", "tag_end")).alias("ovlp"))
    return total.groupBy("gene_STRid").agg(F.min_by("rep_recNo", F.struct(-F.col("ovlp"), "rep_recNo")).alias("rep_recNo"))


def cryptic(merged: DataFrame, reference: DataFrame, repeats: DataFrame, counts: DataFrame, novel_only_id: bool = True, check: bool = True) -> Cryptic:
    """merged, reference: exon tables of read_gtf; repeats: chr or chrno, start, end, rep_recNo, rep_name, rep_Fam,
    rep_subFam, strand; counts: gene_STRid, sample, readnum (rows that begin with __ are left out).

    novel_only_id keeps the published habit of naming the associated gene only if it is a novel one; False names the
    reference gene instead. check demands the same genes in every sample.
    """
    t = merged.withColumnRenamed("geneid", "gene_STRid").drop("gene_typ")
    t = gene_ids(t, reference)
    types = reference.groupBy("geneid").agg(F.min("gene_typ").alias("gene_typ"))
    t = lookup(t, ["geneid"], types, ["geneid"], ["gene_typ"], default=F.lit("novel_detected"))
    if "chrno" not in repeats.columns:
        repeats = repeats.withColumn("chrno", chr_code("chr"))
    dominant = dominant_repeats(t.where("gene_typ <> 'protein_coding'"), repeats)
    attributes = repeats.groupBy("rep_recNo").agg(*(F.min(a).alias(b) for a, b in (("rep_name", "RT_name"), ("rep_Fam", "Fam"), ("rep_subFam", "subFam"), ("strand", "RT_strand"))))
    dominant = dominant.join(attributes, "rep_recNo").withColumn("__hit", F.lit(True))
    genes = unique_rows(t.select("gene_STRid", "geneid", "gene_typ", "chrno"), ["gene_STRid"], ["geneid", "chrno"])
    genes = genes.join(dominant, "gene_STRid", "left")
    genes = fill_empty(genes, ["rep_recNo", "RT_name", "Fam", "subFam", "RT_strand"], F.col("__hit").isNotNull()).drop("__hit")
    genes = genes.withColumn("gene_group", F.when(F.col("gene_typ") == "protein_coding", "cdgene").when(F.col("Fam") == "", "nonRT").otherwise(F.concat(F.lit("RT_"), "Fam")))
    exons = t.select("gene_STRid", F.col("exn_start").alias("start"), F.col("exn_end").alias("end"))
    sizes = segment_union(exons, ["gene_STRid"]).groupBy("gene_STRid").agg(F.min("start").alias("gene_start"), F.max("end").alias("gene_end"), F.sum(F.col("end") - F.col("start") + 1).alias("gene_len"))
    genes = genes.join(sizes, "gene_STRid")
    counts = counts.where(~F.col("gene_STRid").startswith("__"))
    if check:
        per = counts.groupBy("gene_STRid").agg(F.count("*").alias("n"))
        lo, hi, samples = per.agg(F.min("n"), F.max("n")).crossJoin(counts.agg(F.count_distinct("sample"))).first()
        if lo is not None and not lo == hi == samples:
            raise ValueError("samples list different genes")
    both = counts.join(genes, "gene_STRid")
    totals = both.groupBy("sample").agg(F.sum("readnum").alias("total"))
    both = both.join(totals, "sample").withColumn("RPKM", F.lit(1e9) * F.col("readnum") / F.col("total") / F.col("gene_len"))
    rt = both.where(F.col("gene_group").startswith("RT_"))
    named = F.when(F.col("geneid").startswith("MSTRG"), F.col("geneid")).otherwise("") if novel_only_id else F.when(F.col("geneid").startswith("MSTRG"), "").otherwise(F.col("geneid"))
    info = rt.select(F.col("gene_STRid").alias("RAT_ID"), F.col("RT_name").alias("dominant_retrotransposon"), F.col("subFam").alias("subfamily"), F.col("gene_group").alias("family"), F.col("gene_len").alias("transcription_length"), named.alias("associated_Ensembl_gene_id")).distinct()
    long = lambda c: rt.select(F.col("gene_STRid").alias("RAT_ID"), "sample", F.col(c).alias("value"))
    return Cryptic(genes, info, long("readnum"), long("RPKM"))


def wide(long: DataFrame, samples: list[str]) -> DataFrame:
    return long.groupBy("RAT_ID").pivot("sample", samples).agg(F.first("value"))


def run_files(spark: SparkSession, merged_gtf: str, reference_gtf: str, repeats_tsv: str, count_files: dict[str, str], output: str) -> Cryptic:
    """From files (GTF, typed TSV, one headless count TSV a sample) to RAT_info, RAT_readcount and RAT_RPKM below output."""
    rep = read_table(spark, repeats_tsv)
    if "pos" in rep.columns:
        rep = rep.withColumns({"start": F.get("pos", F.lit(0)).cast("bigint"), "end": F.get("pos", F.lit(1)).cast("bigint")})
    counts = None
    for sample, path in count_files.items():
        one = read_table(spark, path, header="gene_STRid\tN::readnum").select("gene_STRid", F.lit(sample).alias("sample"), "readnum")
        counts = one if counts is None else counts.unionByName(one)
    out = cryptic(read_gtf(spark, merged_gtf), read_gtf(spark, reference_gtf), rep, counts)
    samples = list(count_files)
    for name, df in (("RAT_info", out.info), ("RAT_readcount", wide(out.counts, samples)), ("RAT_RPKM", wide(out.rpkm, samples))):
        df.orderBy("RAT_ID").coalesce(1).write.mode("overwrite").csv(f"{output}/{name}.tsv", sep="\t", header=True)
    return out

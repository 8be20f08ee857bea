"""GTF, SAM, FASTA, lane reports: text scans into relations, and their sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import chr_code, cigar_segments, reverse_complement, sam_strand


def _attribute(name: str):
    return F.regexp_extract("attributes", rf'(?:^|;)\s*{name} "?([^";]*)"?', 1)


def read_gtf(spark: SparkSession, path: str, extra: tuple[str, ...] = (), keep_unknown: bool = False) -> DataFrame:
    """Exons of a GTF with the CDS part inside each: chrno, exn_start, exn_end, cds_start, cds_end, strand, geneid, transid,
    exn_rank, gene_name, gene_typ, trans_name, protid, exnid and extra attributes. Exons without CDS have (0, 0)."""
    raw = spark.read.text(path).where(~F.col("value").startswith("#"))
    p = F.split("value", "\t")
    rows = raw.select(chr_code(F.get(p, F.lit(0))).alias("chrno"), F.get(p, F.lit(2)).alias("feature"), F.get(p, F.lit(3)).cast("bigint").alias("start"), F.get(p, F.lit(4)).cast("bigint").alias("end"), F.get(p, F.lit(6)).alias("strand"), F.get(p, F.lit(8)).alias("attributes"))
    rows = rows.where(F.col("feature").isin("exon", "CDS"))
    if not keep_unknown:
        rows = rows.where("chrno > 0")
    names = {"geneid": "gene_id", "transid": "transcript_id", "gene_name": "gene_name", "trans_name": "transcript_name", "protid": "protein_id", "exnid": "exon_id"}
    typ = F.when(_attribute("gene_biotype") != "", _attribute("gene_biotype")).otherwise(_attribute("gene_type"))
    rows = rows.withColumns({k: _attribute(v) for k, v in names.items()} | {"gene_typ": typ, "exn_rank": F.coalesce(_attribute("exon_number").try_cast("int"), F.lit(0))} | {x: _attribute(x) for x in extra})
    exons = rows.where("feature = 'exon'").drop("feature", "attributes").withColumnsRenamed({"start": "exn_start", "end": "exn_end"})
    cds = rows.where("feature = 'CDS'").select(F.col("transid").alias("t"), F.col("start").alias("cds_start"), F.col("end").alias("cds_end"), F.col("protid").alias("cds_protid"))
    inside = (F.col("t") == F.col("transid")) & (F.col("cds_start") >= F.col("exn_start")) & (F.col("cds_end") <= F.col("exn_end"))
    out = exons.join(cds, inside, "left")
    fill = {"cds_start": F.coalesce("cds_start", F.lit(0)), "cds_end": F.coalesce("cds_end", F.lit(0)), "protid": F.when(F.col("protid") == "", F.coalesce("cds_protid", F.lit(""))).otherwise(F.col("protid"))}
    order = ["chrno", "exn_start", "exn_end", "cds_start", "cds_end", "strand", "geneid", "transid", "exn_rank", "gene_name", "gene_typ", "trans_name", "protid", "exnid", *extra]
    return out.withColumns(fill).select(*order)


def write_gtf(df: DataFrame, path: str, chrom: str = "chr", start: str = "start", end: str = "end", gene: str = "geneid", strand: str | None = None, prefix: str = "chr") -> None:
    """Each segment as an exon line."""
    s = F.col(strand) if strand else F.lit(".")
    line = F.concat_ws("\t", F.concat(F.lit(prefix), F.col(chrom).cast("string")), F.lit("strandloom"), F.lit("exon"), F.col(start).cast("string"), F.col(end).cast("string"), F.lit("."), s, F.lit("."), F.concat(F.lit('gene_id "'), F.col(gene), F.lit('"; transcript_id "'), F.col(gene), F.lit('";')))
    df.select(line.alias("value")).write.text(path)


def read_sam(spark: SparkSession, path: str, paired: bool = False, tags: dict[str, str] | None = None) -> DataFrame:
    """Mapped alignments, one row for each reference segment: record_no, readid, flag, chrno, start, end, strand, segno,
    read_len and the tags asked for (name to type: i, f, Z or A; a missing tag is null)."""
    raw = spark.read.text(path).where(~F.col("value").startswith("@")).withColumn("record_no", F.monotonically_increasing_id())
    p = F.split("value", "\t")
    kinds = {"i": "bigint", "f": "double", "Z": "string", "A": "string"}
    field = lambda t: F.get(F.transform(F.filter(p, lambda x: x.startswith(t + ":")), lambda x: x.substr(F.lit(6), F.length(x))), F.lit(0))
    rows = raw.select("record_no", F.get(p, F.lit(0)).alias("readid"), F.get(p, F.lit(1)).cast("int").alias("flag"), chr_code(F.get(p, F.lit(2))).alias("chrno"), F.get(p, F.lit(3)).cast("bigint").alias("pos"), F.get(p, F.lit(5)).alias("cigar"), F.length(F.get(p, F.lit(9))).alias("read_len"), *(field(t).cast(kinds[k]).alias(t) for t, k in (tags or {}).items()))
    rows = rows.where((F.col("flag").bitwiseAND(4) == 0) & (F.col("chrno") > 0) & (F.col("cigar") != "*"))
    rows = rows.withColumn("strand", sam_strand("flag", paired)).select("*", F.posexplode(cigar_segments("cigar", "pos")).alias("i", "s"))
    return rows.select("record_no", "readid", "flag", "chrno", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "strand", (F.col("i") + 1).alias("segno"), "read_len", *(tags or {}))


def best_hits(reads: DataFrame, score: str = "AS", only_unique: bool = True, hits: str = "NH") -> DataFrame:
    """Segments of each read's best alignment (highest score, then first record); only_unique keeps reads mapped once."""
    if only_unique:
        return reads.where(F.col(hits) == 1)
    best = reads.groupBy("readid").agg(F.min_by("record_no", F.struct(-F.col(score), "record_no")).alias("record_no"), F.count_distinct("record_no").alias("mapped_loci"))
    return reads.join(best, ["readid", "record_no"]).withColumn("is_uniq_map", F.col("mapped_loci") == 1)


def read_counts(reads: DataFrame, sites: DataFrame, keys: list[str], site: str, read: str = "readid", barcode: str | None = None, umi: str | None = None, revstrand: bool = False, unique: str | None = "NH") -> DataFrame:
    """Distinct reads (or UMIs) that touch each site, by barcode if given; only reads mapped once, if that column is named."""
    from ..operators.intervals import flip_strand, interval_join

    r = reads.where(F.col(unique) == 1) if unique else reads
    s = flip_strand(sites) if revstrand else sites
    what = umi or read
    by = [site, *([barcode] if barcode else [])]
    return interval_join(s, r, keys).select(*by, what).distinct().groupBy(*by).agg(F.count("*").alias("reads"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """head and seq of each record; lines of a sequence are joined."""
    rec = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "")
    return rec.select(F.regexp_extract("value", r"^([^\r\n]*)", 1).alias("head"), F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s", "").alias("seq"))


def write_fasta(df: DataFrame, path: str, head: str = "head", seq: str = "seq", append: bool = False) -> None:
    df.select(F.concat(F.lit(">"), F.col(head), F.lit("\n"), F.col(seq)).alias("value")).write.mode("append" if append else "error").text(path)


def write_genome(fasta: DataFrame, path: str, chunk: int = 100_000) -> None:
    """Sequences as Parquet by chromosome, cut into chunks."""
    n = F.ceil(F.length("seq") / chunk).cast("int")
    rows = fasta.select(F.col("head").alias("chr"), "seq", F.explode(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).alias("i"))
    rows.select("chr", "i", F.expr(f"substring(seq, i * {chunk} + 1, {chunk})").alias("part")).write.partitionBy("chr").parquet(path)


def get_sequences(genome: DataFrame, segments: DataFrame, row: str, chunk: int = 100_000, chrom: str = "chr", start: str = "start", end: str = "end", strand: str | None = None) -> DataFrame:
    """The sequence of each segment from the chunks of write_genome, reverse-complemented on the - strand: an equi-join on chunks."""
    wanted = segments.withColumn("i", F.explode(F.sequence(F.floor((F.col(start) - 1) / chunk).cast("int"), F.floor((F.col(end) - 1) / chunk).cast("int"))))
    g = genome.select(F.col("chr").cast("string").alias("__chr"), "i", "part")
    both = wanted.withColumn("__chr", F.col(chrom).cast("string")).join(g, ["__chr", "i"])
    lo = F.greatest(F.col(start) - F.col("i") * chunk, F.lit(1))
    hi = F.least(F.col(end) - F.col("i") * chunk, F.lit(chunk))
    piece = both.withColumn("__s", F.substring("part", lo.cast("int"), (hi - lo + 1).cast("int")))
    seqs = piece.groupBy(row).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", F.col("__s").alias("s")))), lambda x: x.s), "").alias("seq"))
    out = segments.join(seqs, row, "left")
    return out.withColumn("seq", F.when(F.col(strand) == "-", reverse_complement("seq")).otherwise(F.col("seq"))) if strand else out


def read_lane_report(spark: SparkSession, path: str) -> DataFrame:
    """Cells of the tables of HTML lane reports: file, row, cells (text without tags), one row for each table row."""
    page = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    rows = page.select("file", F.posexplode(F.regexp_extract_all("value", F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("row", "html"))
    cells = F.transform(F.regexp_extract_all("html", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda x: F.trim(F.regexp_replace(x, "(?s)<[^>]*>", "")))
    return rows.select("file", "row", cells.alias("cells"))


def mutations(reads: DataFrame, cigar: str = "cigar", md: str = "md", seq: str = "seq", pos: str = "pos", row: str = "record_no") -> DataFrame:
    """Variants of each alignment from CIGAR and MD: row, kind (S, I, D), ref_pos, read_pos, ref, alt. A walk over two strings
    at once, so a Python function in Arrow batches."""
    import re

    import pandas as pd

    def run(frames):
        for pdf in frames:
            out: list[tuple] = []
            for rid, cg, m, s, p in zip(pdf[row], pdf[cigar], pdf[md], pdf[seq], pdf[pos], strict=True):
                ref, q, aligned = int(p), 1, []  # aligned: (reference place, read place) of M bases
                deletions = {}
                for n, op in ((int(a), b) for a, b in re.findall(r"(\d+)([MIDNSH])", cg)):
                    if op == "M":
                        aligned += [(ref + i, q + i) for i in range(n)]
                        ref, q = ref + n, q + n
                    elif op == "I":
                        out.append((rid, "I", ref - 1, q, "", s[q - 1 : q - 1 + n]))
                        q += n
                    elif op == "D":
                        deletions[len(aligned)] = (ref, q - 1)
                        ref += n
                    elif op == "N":
                        ref += n
                    elif op == "S":
                        q += n
                at = 0
                for n, gone, base in re.findall(r"(\d+)|\^([A-Z]+)|([A-Z])", m):
                    if n:
                        at += int(n)
                    elif gone:
                        where = deletions.get(at, (int(p), 0))
                        out.append((rid, "D", where[0], where[1], gone, ""))
                    else:
                        r, x = aligned[at]
                        out.append((rid, "S", r, x, base, s[x - 1]))
                        at += 1
            yield pd.DataFrame(out, columns=["row", "kind", "ref_pos", "read_pos", "ref", "alt"])

    return reads.select(row, cigar, md, seq, pos).mapInPandas(run, "row bigint, kind string, ref_pos bigint, read_pos bigint, ref string, alt string")

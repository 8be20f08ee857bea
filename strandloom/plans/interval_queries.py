"""Queries of the interval algebra and the flagship query."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import overlap_length, seg_length
from ..operators import intervals as I
from ..operators.rows import fill_empty
from .catalogue import SITE, TAG, Tables, query

_PAIRS = "pairs as (select sid, tid, ln, s.chr, greatest(s.s, t.s) as lo, least(s.e, t.e) as hi, s.s as ss, s.e as se, t.s as ts, t.e as te from site s join tag t on s.chr = t.chr and t.s <= s.e and t.e >= s.s)"
_JOIN = f"with {SITE}, {TAG}, {_PAIRS} "


def _islands(source: str, weld: int, extra: str = "", keys: str = "chr") -> str:
    return f"""select {keys}, cast(min(s) as bigint) as "start", cast(max(e) as bigint) as "end"{extra} from (
      select *, sum(new) over (partition by {keys} order by s, e rows unbounded preceding) as island from (
        select *, case when s <= max(e) over (partition by {keys} order by s, e rows between unbounded preceding and 1 preceding) + {weld} then 0 else 1 end as new from {source})) group by {keys}, island"""


def _runs(source: str, cutoff: int, keys: str = "chr") -> str:
    return f"""select {keys}, pos as "start", nxt - 1 as "end", depth from (
      select {keys}, pos, cast(sum(d) over (partition by {keys} order by pos) as bigint) as depth, lead(pos) over (partition by {keys} order by pos) as nxt from (
        select {keys}, pos, sum(d) as d from (select {keys}, cast(s as bigint) as pos, w as d from {source} union all select {keys}, cast(e as bigint) + 1, -w from {source}) group by {keys}, pos having sum(d) <> 0))
      where nxt is not null and depth >= {cutoff}"""


@query("q_overlap_join", _JOIN + "select sid, tid, ln, chr, cast(hi - lo + 1 as bigint) as ovlp from pairs")
def overlap_join(spark, d):
    t = Tables(spark, d)
    hits = I.interval_join(t.site, t.tag, ["chr"])
    return hits.select("sid", "tid", "ln", "chr", overlap_length("site_start", "site_end", "tag_start", "tag_end").cast("bigint").alias("ovlp"))


@query("q_contain_join", _JOIN + "select sid, tid, ln, chr from pairs where ts >= ss and te <= se")
def contain_join(spark, d):
    t = Tables(spark, d)
    return I.interval_join(t.site, t.tag, ["chr"], "contain").select("sid", "tid", "ln", "chr")


@query("q_minoverlap_join", _JOIN + "select sid, tid, ln, chr from pairs where hi - lo + 1 >= 0.5 * (least(se - ss, te - ts) + 1)")
def minoverlap_join(spark, d):
    t = Tables(spark, d)
    return I.interval_join(t.site, t.tag, ["chr"], min_overlap=0.5).select("sid", "tid", "ln", "chr")


@query("q_stranded_join", f"""with {SITE}, {TAG} select sid, tid, ln, s.chr from (select *, case when sid % 2 = 0 then '-' else '+' end as strand from site) s
  join (select *, case when ln % 2 = 0 then '+' else '-' end as strand from tag) t on s.chr = t.chr and t.s <= s.e and t.e >= s.s and s.strand <> t.strand""")
def stranded_join(spark, d):
    t = Tables(spark, d)
    site = t.site.withColumn("strand", F.when(F.col("sid") % 2 == 0, "-").otherwise("+"))
    tag = t.tag.withColumn("strand", F.when(F.col("ln") % 2 == 0, "+").otherwise("-"))
    return I.interval_join(I.flip_strand(site), tag, ["chr", "strand"]).select("sid", "tid", "ln", "chr")


@query("q_segunion", f"with {TAG} " + _islands("tag", 1))
def segunion(spark, d):
    return I.segment_union(Tables(spark, d).tag, ["chr"])


@query("q_segunion_noweld", f"with {TAG} " + _islands("tag", 0))
def segunion_noweld(spark, d):
    return I.segment_union(Tables(spark, d).tag, ["chr"], weld=False)


@query("q_segunion_score", f"with {TAG} " + _islands("tag", 1, ", cast(sum(ln) as bigint) as score"))
def segunion_score(spark, d):
    return I.segment_union(Tables(spark, d).tag.withColumn("score", F.col("ln")), ["chr"], score="score")


@query("q_segconc", f"with {TAG} " + _runs("(select *, 1 as w from tag)", 1))
def segconc(spark, d):
    return I.depth(Tables(spark, d).tag, ["chr"])


@query("q_segconc_cutoff2", f"with {TAG} " + _runs("(select *, 1 as w from tag)", 2))
def segconc_cutoff2(spark, d):
    return I.depth(Tables(spark, d).tag, ["chr"], cutoff=2)


@query("q_segconc_two_sets", f"with {SITE}, {TAG}, both_sets as (select chr, s, e, 1 as w from site union all select chr, s, e, -1 from tag) " + _runs("both_sets", 1))
def segconc_two_sets(spark, d):
    t = Tables(spark, d)
    return I.depth_of_two(t.site, t.tag, ["chr"], 1, -1)


_UNION_TAG = 'islands as (select chr, "start" as s, "end" as e from (' + _islands("tag", 1) + "))"
_CUTS = "cuts as (select sid, s.chr, s.s as a, s.e as z, greatest(s.s, i.s) as cs, least(s.e, i.e) as ce from site s join islands i on s.chr = i.chr and i.s <= s.e and i.e >= s.s)"


@query("q_segintersect", f"with {SITE}, {TAG}, {_UNION_TAG}, {_CUTS} " + 'select chr, sid, cast(cs as bigint) as "start", cast(ce as bigint) as "end" from cuts')
def segintersect(spark, d):
    t = Tables(spark, d)
    return I.intersection(t.site, t.tag, ["chr"], "sid")


@query("q_segmentdiff", f"with {SITE}, {TAG}, {_UNION_TAG}, {_CUTS}" + """, edges as (
    select chr, sid, coalesce(lag(ce) over (partition by sid order by cs) + 1, a) as s, cs - 1 as e from cuts
    union all select chr, sid, max(ce) + 1, max(z) from cuts group by chr, sid
    union all select chr, sid, s, e from site where sid not in (select sid from cuts))
  select chr, sid, cast(s as bigint) as "start", cast(e as bigint) as "end" from edges where s <= e""")
def segmentdiff(spark, d):
    t = Tables(spark, d)
    return I.difference(t.site, t.tag, ["chr"], "sid")


@query("q_findintron", f"with {TAG}, m as (" + _islands("tag", 1, keys="tid") + """) select tid, "end" + 1 as "start", nxt - 1 as "end" from (select *, lead("start") over (partition by tid order by "start") as nxt from m) where nxt is not null""")
def findintron(spark, d):
    return I.introns(Tables(spark, d).tag, ["tid"])


@query("q_seg2cvg", f"""with {SITE}, cell as (select chr, least(greatest(cast(round((s - 1) / 200.0) as bigint), 0), 49) as a, least(greatest(cast(round((e - 1) / 200.0) as bigint), 0), 49) as z from site where e >= 1 and s <= 10000),
  grid as (select distinct chr, b from site, range(0, 50) t(b)) select g.chr, cast(b * 200 + 1 as bigint) as pos, cast(count(a) as bigint) as depth from grid g left join cell c on c.chr = g.chr and c.a <= b and c.z >= b group by g.chr, b""")
def seg2cvg(spark, d):
    return I.coverage(Tables(spark, d).site, ["chr"], 1, 10_000, 50)


@query("q_catseq", f"""with {TAG}, ex as (select tid, s, max(e) as e from tag group by tid, s) select tid, s as "start", e as "end",
  cast(coalesce(sum(e - s + 1) over (partition by tid order by s rows between unbounded preceding and 1 preceding), 0) + 1 as bigint) as t_start, cast(sum(e - s + 1) over (partition by tid order by s rows unbounded preceding) as bigint) as t_end from ex""")
def catseq(spark, d):
    ex = Tables(spark, d).tag.groupBy("tid", "start").agg(F.max("end").alias("end"))
    return I.transcript_places(ex, ["tid"]).withColumns({c: F.col(c).cast("bigint") for c in ("t_start", "t_end")})


@query("q_segmask", f"""with {TAG}, ex as (select tid, s, max(e) as e from tag group by tid, s), p as (select tid, s, e, coalesce(sum(e - s + 1) over (partition by tid order by s rows between unbounded preceding and 1 preceding), 0) + 1 as a from ex)
  select tid, cast(greatest(a, 11) - a + s as bigint) as "start", cast(least(a + e - s, 40) - a + s as bigint) as "end" from p where greatest(a, 11) <= least(a + e - s, 40)""")
def segmask(spark, d):
    ex = Tables(spark, d).tag.groupBy("tid", "start").agg(F.max("end").alias("end"))
    windows = ex.select("tid").distinct().select("tid", F.lit(11).alias("w_start"), F.lit(30).alias("w_len"))
    return I.mask(ex, windows, ["tid"]).select("tid", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))


@query("q_segpileup")
def segpileup(spark, d):
    return I.lanes(Tables(spark, d).site, ["chr"], "sid")


@query("q_seglen", f'with {SITE} select sid, cast(e - s + 1 as bigint) as len from site')
def seglen(spark, d):
    return Tables(spark, d).site.select("sid", seg_length("start", "end").alias("len"))


@query("q_segcloest", f"""with {SITE}, {TAG} select x.sid, x.chr, x.s as "start", x.e as "end", cast(before.e as bigint) as previous, cast(after.s as bigint) as "next" from site x asof left join (select chr, e from tag) before on before.chr = x.chr and before.e < x.s asof left join (select chr, s from tag) after on after.chr = x.chr and after.s > x.e""")
def segcloest(spark, d):
    t = Tables(spark, d)
    return I.nearest_segments(t.site, t.tag, ["chr"], "sid").select("sid", "chr", "start", "end", "previous", "next")


@query("q_liftover", f"""with {SITE}, blocks as (select chr, range * 1000 as bs, range * 1000 + 899 as be, chr + 10 as to_key, range * 500 + 7 as ts from (select distinct chr from site), range(0, 300))
  select sid, to_key, cast(s - bs + ts as bigint) as lifted_start, cast(e - bs + ts as bigint) as lifted_end from site s left join blocks b on b.chr = s.chr and s >= bs and e <= be""")
def liftover(spark, d):
    t = Tables(spark, d)
    i = F.col("i")
    blocks = t.site.select("chr").distinct().withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(299).cast("bigint"))))
    blocks = blocks.select("chr", (i * 1000).alias("b_start"), (i * 1000 + 899).alias("b_end"), (F.col("chr") + 10).alias("to_key"), (i * 500 + 7).alias("to_start"))
    return I.lift(t.site, blocks, ["chr"], "sid").select("sid", "to_key", "lifted_start", "lifted_end")


@query("q_region_semijoin", f"with {SITE}, {TAG} select distinct tid, ln, chr, s as \"start\", e as \"end\" from tag where tid in (select t.tid from tag t join site s on s.chr = t.chr and t.s <= s.e and t.e >= s.s)")
def region_semijoin(spark, d):
    t = Tables(spark, d)
    reads = I.interval_join(t.site, t.tag, ["chr"]).select("tid").distinct()
    return t.tag.join(reads, "tid", "left_semi").distinct()


@query("q_bamreadcount", _JOIN + "select sid, cast(count(distinct tid) as bigint) as reads from pairs group by sid")
def bam_read_count(spark, d):
    t = Tables(spark, d)
    return I.interval_join(t.site, t.tag, ["chr"]).select("sid", "tid").distinct().groupBy("sid").agg(F.count("*").alias("reads"))


@query("q_flagship_dominant_site", f"""with {SITE}, {TAG}, gene as (select o_orderkey as gene, case when o_orderpriority = '1-URGENT' then 'protein_coding' else o_orderpriority end as gene_typ from orders),
  exons as (select tag.* from tag join gene on tid = gene where gene_typ <> 'protein_coding'),
  pairs as (select t.tid, s.sid, least(s.e, t.e) - greatest(s.s, t.s) + 1 as o from site s join exons t on s.chr = t.chr and t.s <= s.e and t.e >= s.s),
  total as (select tid, sid, sum(o) as o from pairs group by tid, sid),
  best as (select tid, sid, o, row_number() over (partition by tid order by o desc, sid) as r from total)
  select gene, gene_typ, cast(coalesce(sid, 0) as bigint) as site, cast(coalesce(o, 0) as bigint) as ovlp, coalesce(p_brand, '') as family,
    case when gene_typ = 'protein_coding' then 'cdgene' when sid is null then 'nonRT' else 'RT_' || p_brand end as class
  from gene left join (select * from best where r = 1) b on b.tid = gene left join part on p_partkey = sid""")
def flagship(spark, d):
    """Each gene's dominant overlapping element: overlap join, sum of overlaps, largest, attributes, left join with defaults, class."""
    t = Tables(spark, d)
    typ = F.when(F.col("o_orderpriority") == "1-URGENT", "protein_coding").otherwise(F.col("o_orderpriority"))
    gene = t.orders.select(F.col("o_orderkey").alias("gene"), typ.alias("gene_typ"))
    exons = t.tag.join(gene.where("gene_typ <> 'protein_coding'"), F.col("tid") == F.col("gene"), "left_semi")
    hits = I.interval_join(t.site, exons, ["chr"])
    total = hits.groupBy("tid", "sid").agg(F.sum(overlap_length("site_start", "site_end", "tag_start", "tag_end")).cast("bigint").alias("ovlp"))
    best = total.groupBy("tid").agg(F.min_by(F.struct(F.col("sid").alias("site"), "ovlp"), F.struct(-F.col("ovlp"), "sid")).alias("x"))
    best = best.select(F.col("tid").alias("gene"), "x.site", "x.ovlp").join(t.part.select(F.col("p_partkey").alias("site"), F.col("p_brand").alias("family")).hint("merge"), "site", "left")  # not broadcast: files are small, rows are many
    out = gene.join(best.withColumn("__hit", F.lit(True)), "gene", "left")
    out = fill_empty(out, ["site", "ovlp", "family"], F.col("__hit").isNotNull())
    cls = F.when(F.col("gene_typ") == "protein_coding", "cdgene").when(F.col("__hit").isNull(), "nonRT").otherwise(F.concat(F.lit("RT_"), "family"))
    return out.select("gene", "gene_typ", "site", "ovlp", "family", cls.alias("class"))


@query("q_rpkm", f"""with {TAG}, u as ({_islands("tag", 1, keys="tid")}), len as (select tid, sum("end" - "start" + 1) as len from u group by tid), c as (select l_orderkey as tid, l_returnflag as sample, sum(cast(l_quantity as bigint)) as n from lineitem group by all)
  select tid, sample, round(1e9 * n / sum(n) over (partition by sample) / len, 3) as rpkm from c join len using (tid)""")
def rpkm(spark, d):
    t = Tables(spark, d)
    length = I.segment_union(t.tag, ["tid"]).groupBy("tid").agg(F.sum(F.col("end") - F.col("start") + 1).alias("len"))
    counts = t.lineitem.groupBy(F.col("l_orderkey").alias("tid"), F.col("l_returnflag").alias("sample")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("n"))
    total = counts.groupBy("sample").agg(F.sum("n").alias("total"))
    return counts.join(total, "sample").join(length, "tid").select("tid", "sample", F.round(F.lit(1e9) * F.col("n") / F.col("total") / F.col("len"), 3).alias("rpkm"))


def _derived(t):
    """Exon tables, repeats and counts in the pipeline's shapes, from the interval relations."""
    orders = t.orders.select(F.col("o_orderkey").alias("tid"), F.col("o_custkey").alias("cust"), F.col("o_orderpriority").alias("prio"))
    exons = t.tag.join(orders, "tid").select(
        (F.col("chr") + 1).cast("int").alias("chrno"), F.col("start").alias("exn_start"), F.col("end").alias("exn_end"), F.concat(F.lit("MSTRG."), F.col("tid").cast("string")).alias("geneid"),
        F.when(F.col("ln") % 2 == 0, F.concat(F.lit("T"), (F.col("cust") % 50).cast("string"))).otherwise(F.concat(F.lit("MSTRG."), F.col("tid").cast("string"), F.lit(".1"))).alias("transid"), F.lit("").alias("gene_typ"),
    )
    ref = t.spark.range(50).select(F.concat(F.lit("T"), F.col("id").cast("string")).alias("transid"), F.concat(F.lit("G"), F.floor(F.col("id") / 2).cast("string")).alias("geneid"), F.when(F.col("id") % 10 < 2, "protein_coding").otherwise("lncRNA").alias("gene_typ"))
    reps = t.site.join(t.part.select(F.col("p_partkey").alias("sid"), "p_name", "p_brand", "p_type"), "sid").select((F.col("chr") + 1).cast("int").alias("chrno"), "start", "end", F.col("sid").alias("rep_recNo"), F.col("p_name").alias("rep_name"), F.col("p_brand").alias("rep_Fam"), F.col("p_type").alias("rep_subFam"), F.lit("+").alias("strand"))
    counts = t.lineitem.groupBy(F.concat(F.lit("MSTRG."), F.col("l_orderkey").cast("string")).alias("gene_STRid")).pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum(F.col("l_quantity").cast("bigint"))).fillna(0)
    return exons, ref, reps, counts.unpivot(["gene_STRid"], ["A", "N", "R"], "sample", "readnum")


@query("q_cryptic_pipeline", f"""with {SITE}, {TAG},
  m as (select tag.chr + 1 as chrno, s, e, 'MSTRG.' || tid as gene, case when ln % 2 = 0 then 'T' || (o_custkey % 50) else null end as trans from tag join orders on tid = o_orderkey),
  ref as (select 'T' || range as trans, 'G' || (range // 2) as geneid, case when range % 10 < 2 then 1 else 0 end as coding from range(0, 50)),
  k as (select gene, geneid, coding, max(coding) over (partition by gene) as anyc from m join ref using (trans)),
  v as (select gene, geneid, row_number() over (partition by gene order by count(*) desc, geneid) as r from k where coding = anyc group by gene, geneid),
  typ as (select geneid, min(case when coding = 1 then 'protein_coding' else 'lncRNA' end) as gene_typ from ref group by 1),
  g as (select gene, coalesce(any_value(v.geneid), gene) as geneid, coalesce(any_value(gene_typ), 'novel_detected') as gene_typ from (select distinct gene from m) x left join (select gene, geneid from v where r = 1) v using (gene) left join typ using (geneid) group by gene),
  o as (select gene, sid, sum(least(site.e, m.e) - greatest(site.s, m.s) + 1) as o from m join g using (gene) join site on site.chr + 1 = m.chrno and m.s <= site.e and m.e >= site.s where gene_typ <> 'protein_coding' group by gene, sid),
  b as (select gene, sid, row_number() over (partition by gene order by o desc, sid) as r from o),
  len as (select gene, sum("end" - "start" + 1) as len from ({_islands("m", 1, keys="gene")}) group by gene),
  c as (select 'MSTRG.' || l_orderkey as gene, sum(case when l_returnflag = 'A' then cast(l_quantity as bigint) else 0 end) as n from lineitem group by 1)
  select gene as "RAT_ID", p_name as dominant, 'RT_' || p_brand as family, cast(len as bigint) as len, round(1e9 * n / total / len, 2) as rpkm_a
  from g join len using (gene) join (select gene, n, sum(n) over () as total from c where gene in (select gene from g)) c using (gene) join (select * from b where r = 1) b using (gene) join part on p_partkey = sid where gene_typ <> 'protein_coding'""")
def cryptic_pipeline(spark, d):
    """The whole flagship pipeline on derived exon tables, repeats and counts."""
    from .cryptic import cryptic

    out = cryptic(*_derived(Tables(spark, d)))
    a = out.rpkm.where("sample = 'A'").select("RAT_ID", F.round("value", 2).alias("rpkm_a"))
    return out.info.select("RAT_ID", F.col("dominant_retrotransposon").alias("dominant"), "family", F.col("transcription_length").alias("len")).join(a, "RAT_ID")

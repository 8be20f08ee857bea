"""Queries of the statistics and the machine-learning helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats as S
from .catalogue import Tables, query

_EV = "ev as (select event_id, user_id, value, extract(hour from ts) as h, case when event_type = 'purchase' then 1 else 0 end as status from events where value is not null)"


def _events(t):
    return t.events.where("value is not null").select("event_id", "user_id", "value", F.hour("ts").alias("h"), (F.col("event_type") == "purchase").cast("int").alias("status"))


@query("q_survfit_km", f"""with {_EV}, c as (select h, count(*) as n, sum(status) as events from ev group by h), r as (select h, events, sum(n) over (order by h desc) as at_risk from c)
  select cast(h as bigint) as h, cast(at_risk as bigint) as at_risk, cast(events as bigint) as events, round(case when max(case when events = at_risk then 1 else 0 end) over (order by h) = 1 then 0.0 else exp(sum(case when events < at_risk then ln(1 - events / at_risk) else 0 end) over (order by h)) end, 6) as survival from r where events > 0""")
def survfit_km(spark, d):
    km = S.kaplan_meier(_events(Tables(spark, d)), "h", "status")
    return km.select(F.col("h").cast("bigint").alias("h"), "at_risk", "events", F.round("survival", 6).alias("survival"))


@query("q_logrank", f"""with {_EV}, c as (select h, count(*) filter (user_id % 2 = 0) as a, count(*) as n0, coalesce(sum(status) filter (user_id % 2 = 0), 0) as da, sum(status) as d from ev group by h),
  r as (select *, sum(a) over (order by h desc) as na, sum(n0) over (order by h desc) as n from c), s as (select sum(da) as o, sum(d * na / n) as e, sum(case when n > 1 then d * (na / n) * (1 - na / n) * (n - d) / (n - 1) else 0 end) as v from r where d > 0)
  select round((o - e) * (o - e) / v, 5) as chi2 from s""")
def logrank(spark, d):
    e = _events(Tables(spark, d)).withColumn("g", F.col("user_id") % 2 == 0)
    return S.log_rank(e, "h", "status", "g").select(F.round("chi2", 5).alias("chi2"))


@query("q_corspearman", """with x as (select l_quantity, l_extendedprice from lineitem), r as (select rank() over (order by l_quantity) + (count(*) over (partition by l_quantity) - 1) / 2.0 as a, rank() over (order by l_extendedprice) + (count(*) over (partition by l_extendedprice) - 1) / 2.0 as b from x) select round(corr(a, b), 6) as r from r""")
def corspearman(spark, d):
    return S.correlation(Tables(spark, d).lineitem, "l_quantity", "l_extendedprice", "spearman").select(F.round("r", 6).alias("r"))


@query("q_ttest", """with s as (select avg(o_totalprice) filter (o_orderstatus = 'F') as m1, avg(o_totalprice) filter (o_orderstatus <> 'F') as m2, var_samp(o_totalprice) filter (o_orderstatus = 'F') as v1, var_samp(o_totalprice) filter (o_orderstatus <> 'F') as v2, count(*) filter (o_orderstatus = 'F') as n1, count(*) filter (o_orderstatus <> 'F') as n2 from orders)
  select round(m1 - m2, 4) as difference, round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) as t from s""")
def ttest(spark, d):
    o = Tables(spark, d).orders.select("o_totalprice", (F.col("o_orderstatus") == "F").alias("g"))
    return S.t_test(o, "o_totalprice", "g").select(F.round("difference", 4).alias("difference"), F.round("t", 6).alias("t"))


@query("q_wilcoxtest", """with r as (select o_orderstatus = 'F' as g, rank() over (order by o_totalprice) + (count(*) over (partition by o_totalprice) - 1) / 2.0 as r from orders) select round(sum(r) filter (g) - count(*) filter (g) * (count(*) filter (g) + 1) / 2.0, 2) as w from r""")
def wilcoxtest(spark, d):
    o = Tables(spark, d).orders.select("o_totalprice", (F.col("o_orderstatus") == "F").alias("g"))
    return S.wilcoxon(o, "o_totalprice", "g").select(F.round("w", 2).alias("w"))


@query("q_cortest", "select round(corr(p_size, p_retailprice), 8) as r from part")
def cortest(spark, d):
    return S.correlation(Tables(spark, d).part, "p_size", "p_retailprice").select(F.round("r", 8).alias("r"))


@query("q_fishertest", "with n as (select count(*) filter (c_acctbal > 0 and c_mktsegment = 'BUILDING') as a, count(*) filter (c_acctbal > 0 and c_mktsegment <> 'BUILDING') as b, count(*) filter (c_acctbal <= 0 and c_mktsegment = 'BUILDING') as c, count(*) filter (c_acctbal <= 0 and c_mktsegment <> 'BUILDING') as d from customer) select round(a * d / (b * c), 6) as odds from n")
def fishertest(spark, d):
    c = Tables(spark, d).customer.select((F.col("c_acctbal") > 0).alias("x"), (F.col("c_mktsegment") == "BUILDING").alias("y"))
    return S.fisher(c, "x", "y").select(F.round("odds", 6).alias("odds"))


@query("q_binomtest", "select round(avg(case when c_acctbal > 4500 then 1.0 else 0.0 end), 8) as share from customer")
def binomtest(spark, d):
    return S.binomial(Tables(spark, d).customer.select((F.col("c_acctbal") > 4500).alias("x")), "x").select(F.round("share", 8).alias("share"))


@query("q_glm12test")
def glm12test(spark, d):
    return S.polynomial_test(Tables(spark, d).part, "p_size", "p_retailprice")


@query("q_survcoxph")
def survcoxph(spark, d):
    e = _events(Tables(spark, d)).withColumns({"even": (F.col("user_id") % 2).cast("double"), "v": F.col("value") / 100})
    return S.cox(e, "h", "status", ["even", "v"])


@query("q_kmeans")
def kmeans(spark, d):
    return S.kmeans(Tables(spark, d).embeddings, "embedding", 4)[0].select("vec_id", "cluster")


@query("q_pca")
def pca(spark, d):
    return S.principal_components(Tables(spark, d).embeddings, "embedding", 3)[0].select("vec_id", "scores")


@query("q_fastcluster")
def fastcluster(spark, d):
    return S.hierarchical(Tables(spark, d).embeddings, "vec_id", "embedding", 2.0, ["label"])


@query("q_goenrich")
def goenrich(spark, d):
    p = Tables(spark, d).part
    return S.enrichment(p.where("p_size > 40"), p, p.select("p_partkey", "p_brand"), "p_partkey", "p_brand")


@query("q_gsva", """with v as (select l_suppkey as g, l_returnflag as s, avg(l_quantity) as q from lineitem group by all), z as (select v.g, s, (q - m) / sd as z from v join (select g, avg(q) as m, stddev_samp(q) as sd from v group by g) using (g) where sd > 0)
  select cast(s_nationkey as bigint) as nation, s as sample, round(sum(z) / sqrt(count(*)), 4) as score from z join supplier on s_suppkey = g group by all""")
def gsva(spark, d):
    t = Tables(spark, d)
    v = t.lineitem.groupBy(F.col("l_suppkey").alias("g"), F.col("l_returnflag").alias("sample")).agg(F.avg("l_quantity").alias("q"))
    sets = t.supplier.select(F.col("s_suppkey").alias("g"), F.col("s_nationkey").cast("bigint").alias("nation"))
    return S.set_scores(v, sets, "g", "sample", "q", "nation").withColumn("score", F.round("score", 4))

"""Queries of user functions, type normalisation and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rows as R
from ..operators import tables as T
from ..operators import udf as U
from ..sources import text
from .catalogue import Tables, query


@query("q_rowfun", "select n_nationkey, n_nationkey * 2 + n_regionkey as y, length(n_name) as z from nation")
def rowfun(spark, d):
    n = Tables(spark, d).nation.select("n_nationkey", "n_regionkey", "n_name")
    return U.row_map(n, lambda k, r, s: (k * 2 + r, len(s)), ["n_nationkey", "n_regionkey", "n_name"], "y bigint, z bigint").select("n_nationkey", "y", "z")


@query("q_rowfunwith", "select n_nationkey, unnest(range(0, n_regionkey)) as i from nation")
def rowfunwith(spark, d):
    return U.row_expand(Tables(spark, d).nation.select("n_nationkey", "n_regionkey"), lambda r: ((i,) for i in range(r)), ["n_regionkey"], "i bigint", ["n_nationkey"])


@query("q_grpfun_python", "select c_nationkey, round(max(c_acctbal) - min(c_acctbal), 4) as value from customer group by 1")
def grpfun_python(spark, d):
    out = U.group_map(Tables(spark, d).customer, ["c_nationkey"], "c_acctbal", lambda x: x.max() - x.min())
    return out.withColumn("value", F.round("value", 4))


@query("q_slidwin_python", "select s_suppkey, value from (select s_suppkey, max(s_acctbal) over w as value, count(*) over w as n from supplier window w as (order by s_suppkey rows between 1 preceding and 1 following)) where n = 3")
def slidwin_python(spark, d):
    s = Tables(spark, d).supplier.withColumn("one", F.lit(1))
    return U.window_map(s, ["one"], ["s_suppkey"], "s_acctbal", 3, lambda x: x.max()).select("s_suppkey", "value")


@query("q_hashgrp", "select s_nationkey, string_agg(cast(s_suppkey as varchar), ',' order by s_suppkey) as keys from supplier group by 1")
def hashgrp(spark, d):
    m = U.key_map(Tables(spark, d).supplier, ["s_nationkey"], "s_suppkey")
    return m.select("s_nationkey", F.array_join(F.transform("values", lambda x: x.cast("string")), ",").alias("keys"))


@query("q_retype", "select cast(p_partkey as bigint) as p_partkey, cast(p_size as bigint) as p_size from part")
def retype(spark, d):
    return U.retype(Tables(spark, d).part.select("p_partkey", "p_size"), "int", "bigint")


@query("q_demissing", "select event_id, coalesce(nullif(event_type, 'click'), 'none') as event_type from events")
def demissing(spark, d):
    e = Tables(spark, d).events.select("event_id", F.when(F.col("event_type") != "click", F.col("event_type")).alias("event_type"))
    return U.without_nulls(e, {"event_type": F.lit("none")})


@query("q_randperm", "select cast(count(*) as bigint) as n, cast(min(o_orderkey) * 0 as bigint) as lo, cast(count(*) - 1 as bigint) as hi from orders")
def randperm(spark, d):
    p = U.shuffled_index(Tables(spark, d).orders, ["o_orderkey"], 7)
    return p.agg(F.count_distinct("place").alias("n"), F.min("place").cast("bigint").alias("lo"), F.max("place").cast("bigint").alias("hi"))


@query("q_getrow", "select r_regionkey, r_name from region where r_regionkey in (1, 3)")
def getrow(spark, d):
    return R.take_rows(Tables(spark, d).region.select("r_regionkey", "r_name"), [1, 3], "r_regionkey")


@query("q_reprow", "select r_name from region, range(0, 3)")
def reprow(spark, d):
    return R.repeat_rows(Tables(spark, d).region.select("r_name"), 3)


@query("q_splitdim", "select vec_id, round(embedding[1], 5) as e_1, round(embedding[2], 5) as e_2 from embeddings")
def splitdim(spark, d):
    e = T.split_array(Tables(spark, d).embeddings.select("vec_id", "embedding"), "embedding", 2, ["e_1", "e_2"])
    return e.select("vec_id", *(F.round(F.col(c), 5).alias(c) for c in ("e_1", "e_2")))


@query("q_firstrow", "select o_custkey, min(o_orderkey) as o_orderkey from orders group by 1")
def firstrow(spark, d):
    return R.first_rows(Tables(spark, d).orders.select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"])


@query("q_readtb", "select n_nationkey as id, n_name as name from nation")
def readtb(spark, d):
    """A typed table through its text form and back."""
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/strandloom-tsv-{uuid.uuid4().hex}"
    n = Tables(spark, d).nation.select("n_nationkey", "n_name").coalesce(1)
    text.write_table(n, path, "n_nationkey=>id,n_name=>name")
    return text.read_table(spark, path).select("id", "name")

"""A registry of queries with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


class Tables:
    """Parquet tables of a folder, and the interval relations derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = ship(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def site(self) -> DataFrame:
        p = self.part
        return p.select(F.col("p_partkey").alias("sid"), (F.col("p_partkey") % 5).alias("chr"), (F.col("p_partkey") * 10).alias("start"), (F.col("p_partkey") * 10 + F.col("p_size")).alias("end"))

    @property
    def tag(self) -> DataFrame:
        x = self.lineitem
        first = F.col("l_partkey") * 10 + F.col("l_linenumber")
        return x.select(F.col("l_orderkey").alias("tid"), F.col("l_linenumber").alias("ln"), (F.col("l_suppkey") % 5).alias("chr"), first.alias("start"), (first + F.col("l_quantity").cast("bigint")).alias("end"))


SITE = "site as (select p_partkey as sid, p_partkey % 5 as chr, p_partkey * 10 as s, p_partkey * 10 + p_size as e from part)"
TAG = "tag as (select l_orderkey as tid, l_linenumber as ln, l_suppkey % 5 as chr, l_partkey * 10 + l_linenumber as s, l_partkey * 10 + l_linenumber + cast(l_quantity as bigint) as e from lineitem)"

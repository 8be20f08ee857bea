"""What larger tables and odd rows showed: joins that were broadcast, frames that grew with the square, units beyond the SQL's."""

from __future__ import annotations

import contextlib
import io
import re

import duckdb
import pytest

from strandloom.operators.intervals import nearest_segments
from strandloom.plans import catalogue, interval_queries, table_queries  # noqa: F401

from .conftest import rows

DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("name", ["q_bamreadcount", "q_contain_join", "q_flagship_dominant_site", "q_minoverlap_join", "q_overlap_join", "q_region_semijoin", "q_segintersect", "q_segmentdiff", "q_stranded_join"])
def test_sites_are_not_broadcast(spark, name):
    """Files of a few MB hold millions of rows of sites and bins, more than a driver can hold."""
    assert not re.search(r"BroadcastHashJoin \[[^]]*\b(__bin|site)#", plan(catalogue.QUERIES[name](spark, DIR)))


def test_nearest_frames_grow_only(spark):
    """A frame up to the end of its key is read anew for each row, which takes the square of a chromosome's rows."""
    assert "unboundedfollowing" not in plan(catalogue.QUERIES["q_segcloest"](spark, DIR)).lower()


def test_nearest_over_blocks_ties_and_nulls(spark):
    a = [(1, 7, 100, 120), (1, 8, 5_000_000, 5_000_010), (2, 9, 1, 2), (None, 10, 50, 60), (1, 11, None, 60), (1, 12, 31, 49)]
    b = [(1, 10, 30), (1, 10, 30), (1, 90, 100), (1, 120, 130), (1, 300_000, 300_009), (None, 1, 2), (1, 50, None), (1, 9_000_000, 9_000_001)]
    site, tag = spark.createDataFrame(a, "chr int, sid int, start long, end long"), spark.createDataFrame(b, "chr int, start long, end long")
    want = [(1, 7, 100, 120, 30, 300_000), (1, 8, 5_000_000, 5_000_010, 300_009, 9_000_000), (2, 9, 1, 2, None, None), (None, 10, 50, 60, None, None), (1, 11, None, 60, None, 90), (1, 12, 31, 49, 30, 50)]
    assert rows(nearest_segments(site, tag, ["chr"], "sid")) == sorted(want, key=repr)


def test_saynum_beyond_a_million(spark, tmp_path):
    keys = [0, 1, 999, 1000, 1049, 1050, 999_949, 999_950, 999_999, 1_000_000, 1_199_949, 1_199_950, 3_000_049, 2_345_678_950]
    spark.createDataFrame([(k,) for k in keys], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    db = duckdb.connect()
    db.execute(f"create view part as select * from '{tmp_path}/part.parquet/*.parquet'")
    assert rows(catalogue.QUERIES["q_saynum"](spark, str(tmp_path))) == sorted(db.sql(catalogue.SQL["q_saynum"]).fetchall())

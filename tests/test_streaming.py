"""Streams of files: line batches and windowed counts."""

from __future__ import annotations

from strandloom.streaming.lines import each_batch, stream_counts, stream_lines

from .conftest import rows


def test_lines_in_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\ny\n")
    seen = []
    each_batch(stream_lines(spark, str(tmp_path / "in")), lambda df, i: seen.extend(r.value for r in df.collect()), str(tmp_path / "c")).awaitTermination(60)
    assert sorted(seen) == ["x", "y"]
    (tmp_path / "in" / "b.txt").write_text("z\n")
    each_batch(stream_lines(spark, str(tmp_path / "in")), lambda df, i: seen.extend(r.value for r in df.collect()), str(tmp_path / "c")).awaitTermination(60)
    assert sorted(seen) == ["x", "y", "z"]  # a restart goes on where it stopped


def test_counts_in_windows(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("cast(ts as timestamp) as ts", "event_type")
    events.write.parquet(str(tmp_path / "ev"))
    stream = stream_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "ev")), "ts", ["event_type"])
    stream.writeStream.outputMode("complete").format("memory").queryName("counted").trigger(availableNow=True).start().awaitTermination(60)
    want = events.groupBy("event_type").count()
    assert rows(spark.sql("select event_type, sum(n) from counted group by event_type")) == rows(want)

"""The corpus pipeline: each stage's decision on a small table, and the order that reaches the shards."""

from __future__ import annotations

import pytest

import corpus_pipeline
from strandloom.llm.common import materialise

from .helpers import words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    bench = words(7777, 40)
    docs, labels = [], []
    for i in range(400):
        bad = i % 8 == 0
        t = words(i, 60) + (" you stupid idiot, pathetic moron" if bad else "")
        docs.append((i, t, "en", "src0" if i % 3 else f"src{i % 5}", len(t)))
        labels.append((i, 1, int(bad)))
    docs += [(500, docs[1][1] + " tail", "en", "src1", 1), (501, docs[3][1], "en", None, 1), (502, words(900, 20) + " " + bench + " " + words(901, 20), "en", "src2", 1), (503, None, None, None, None), (504, "", "en", "src0", 0)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, bench)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, folder), name)
        ids[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert name == "sharding" or docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    toxic = {i for i in range(0, 400, 8)}
    assert len(ids["toxicity"] & toxic) <= 2 and len(ids["toxicity"]) >= 405 - 50 - 2
    assert ids["toxicity"] - ids["near_dedup"] == {500, 501}
    assert ids["near_dedup"] - ids["decontamination"] == {502}
    assert ids["decontamination"] == ids["mixing"] == ids["sharding"]
    assert docs.columns == [*columns, "shard", "slot"]
    assert docs.select("shard").distinct().count() <= 16


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 300 and out.select("shard", "slot").distinct().count() == out.count()


def test_shards_keep_the_mix(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    mixed = materialise(corpus_pipeline.mix(spark, docs, folder), "mixed")
    order = [r.doc_id for r in mixed.collect()]
    sharded = corpus_pipeline.shard(spark, mixed, folder)
    assert [r.doc_id for r in sorted(sharded.collect(), key=lambda r: (r.shard, r.slot))] == order

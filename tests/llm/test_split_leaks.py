"""Leaks that an added, missing or split token cuts into alignments, and items of few plain words."""

from __future__ import annotations

from strandloom.llm import decontamination

ITEM = "the baker sold forty warm loaves to her oldest neighbour before Alice walked past that small wooden bridge near our quiet river and counted every single boat 1,200 times again"
PLAIN = "a b c d e f g h i j k l m n o p q r s t u v w x y z aa bb cc dd".replace("c d", "cc2 d")
SUM = "What is 12 + 30?"


def found(spark, *texts):
    bench = spark.createDataFrame([(1, ITEM), (2, PLAIN), (3, SUM)], "item_id bigint, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {(r.doc_id, r.item_id): r for r in decontamination.leaks(docs, bench).collect()}


def test_a_token_more_or_less(spark):
    words = PLAIN.split()
    got = found(spark, " ".join([*words[:15], "inserted", *words[15:]]), " ".join(words[:14] + words[15:]), " ".join(words[:15]), " ".join([*words[:15], *["other"] * 40, *words[15:]]))
    assert set(got) == {(0, 2), (1, 2)} and got[0, 2].covered == 30 and got[1, 2].covered == 29
    assert got[0, 2].exact


def test_fillers_of_other_token_counts(spark):
    got = found(spark, "So " + ITEM.replace("Alice", "Mary Ann"), "So " + ITEM.replace("Alice", "Mary Ann").replace("1,200", "1 200"))
    assert set(got) == {(0, 1), (1, 1)} and got[0, 1].covered == got[0, 1].item_tokens == got[1, 1].covered + 2  # two tokens are too few for a window


def test_fillers_agree_across_alignments(spark):
    half = lambda name: f"then {name} brought seven red apples home from the old market"
    item = f"{half('Alice')} while {half('Alice')}"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    docs = spark.createDataFrame([(0, f"{half('Mary')} and while {half('Mary')}"), (1, f"{half('Mary')} and while {half('Bob')}")], "doc_id bigint, text string")
    assert [r.doc_id for r in decontamination.leaks(docs, bench).collect()] == [0]


def test_few_plain_words(spark):
    got = found(spark, "He asked: What is 12 + 30? Nobody knew.", "He asked: What is 13 + 31? Nobody knew.")
    assert set(got) == {(0, 3)} and got[0, 3].exact

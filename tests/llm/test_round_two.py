"""What the second round showed: time of op1, memory of the workers of toxicity, op7's tree without labels of pages (F12)."""

from __future__ import annotations

import contextlib
import io
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from strandloom.llm import queries, tokens, toxicity, urls
from strandloom.llm.trees import boost, isotonic


class Counting:
    """A tokenizer that tells how many texts it encoded as a whole."""

    def __init__(self, inner: Tokenizer):
        self.inner, self.model, self.to_str, self.texts = inner, inner.model, inner.to_str, 0

    def encode_batch_fast(self, texts, **how):
        self.texts += len(texts)
        return self.inner.encode_batch_fast(texts, **how)


def test_words_of_letters_go_to_the_model_alone():
    """Most different pieces are words of letters; a pretokenizer's pass over each took half of op1's time."""
    plain = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    counting, rng = Counting(plain), random.Random(3)
    pieces = tokens._Pieces(counting, "H", 0)
    words = ["".join(rng.choice("abcdeXYZéèÿßñŁɏªµ") for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    other = ["don't", "x1", "αβγ", "中文", "ɐb", "á", "½", "<|endoftext|>", ".x", ",y", "\nz", tokens.FIRST + "w", "é!", "_a", "٣"]
    got = pieces.of(list(dict.fromkeys(words + other)))
    assert counting.texts == len(other)
    want = pieces.encoded([p[1:] if p[0] == tokens.FIRST else p if p[0] in "\n.," else " " + p for p in dict.fromkeys(words + other)])
    assert got == want


def test_other_tokenizers_keep_their_own_way():
    assert not tokens._words_stay({"model": {"type": "WordPiece"}, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}})
    byte_level = {"model": {"type": "BPE"}, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}}
    assert tokens._words_stay(byte_level)
    assert not tokens._words_stay(byte_level | {"normalizer": {"type": "Lowercase"}})
    assert not tokens._words_stay(byte_level | {"added_tokens": [{"content": "word"}]})


def test_scored_rows_are_a_table_of_small_batches(spark):
    """Left to its reader's settings, each task of the pipeline's first stage sent 10,000 whole rows at once both ways."""
    x, y = np.zeros((4, len(toxicity.NAMES))), np.array([0.0, 1, 0, 1])
    x[:, 2] = y
    model = toxicity.Model({}, boost(x, y), isotonic(y, y))
    docs = spark.createDataFrame([(i, "some words") for i in range(50)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    with contextlib.redirect_stdout(io.StringIO()) as out:
        kept = toxicity.drop_toxic(docs, model, threshold=2.0)
        kept.explain()
    assert "MapInArrow" not in out.getvalue() and kept.count() == 50
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_term_counts_are_bounded_and_whole(monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_COUNTS", 40)
    texts = [f"word{chr(97 + i % 26)} other{chr(97 + i % 7)}" for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 2 for i in range(2000)]), pa.array([i // 2 % 2 for i in range(2000)])], ["text", "toxic", "fold"])
    parts = list(toxicity._term_counts([batch]))
    assert max(p.num_rows for p in parts) < 400 and len(parts) > 4
    got: dict = {}
    for p in parts:
        for term, at, n in zip(*(c.to_pylist() for c in p.columns), strict=True):
            got[term, at] = got.get((term, at), 0) + n
    want: dict = {}
    for i, text in enumerate(texts):
        for term in toxicity.terms_of(text):
            want[term, 2 * (i // 2 % 2) + i % 2] = want.get((term, 2 * (i // 2 % 2) + i % 2), 0) + 1
    assert got == want


def _web(spark, folder, labelled):
    """Documents, labels and pages: a host without a bad word whose /forum/ shows texts like the bad documents."""
    rng = random.Random(4)
    plain = lambda: " ".join(rng.choice(["river", "bridge", "winter", "garden", "music", "letter", "table"]) for _ in range(rng.randint(20, 90)))
    rude = lambda: "you are a pathetic moron, stupid idiot " + plain()
    junk = lambda: " ".join(f"{rng.randrange(10**6)} zzxq$ kkqv#" for _ in range(rng.randint(7, 30)))
    kinds = [(plain, 1, 0), (rude, 1, 1), (plain, 1, 0), (junk, 0, 0)]
    docs = [(i, kinds[i % 4][0]()) for i in range(240)]
    labels = [(i, *kinds[i % 4][1:]) for i in range(240)] + [(500, None, None), (None, 0, 1)]
    page = lambda text: f"<!-- idiot --><html><script>var moron;</script><p>{text}<br>&amp;</p><style>p"
    pages = [(i, f"https://news.host.org/forum/{i}", page(rude() if i % 2 else junk())) for i in range(20)] + [(20 + i, f"https://news.host.org/read/{i}", page(plain())) for i in range(20)]
    pages += [(40, "https://news.host.org/forum/40?x", None), (41, "https://news.host.org/read/41", ""), (42, "https://casino.host.org/read/1", page(plain())), (43, None, page(rude())), (44, "https://else.host.org/a", None)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels if labelled else [], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{folder}/pages.parquet")


def test_what_pages_show_decides_branches_of_any_host(spark, tmp_path):
    """No host word, no rule and no given label: the tree learns from the pages' texts, and judges pages without a text too."""
    _web(spark, tmp_path / "web", True)
    got = {r.page_id: r for r in queries.op7_urls(spark, str(tmp_path / "web")).collect()}
    assert len(got) == 45 and not any(r.rule for r in got.values())
    assert all(got[i].verdict == "block" and got[i].template == "/forum/{n}" for i in [*range(20), 40])
    assert all(got[i].verdict == "allow" for i in [*range(20, 40), 41, 44])
    assert got[42].verdict == "block" and got[43].host == "" and got[44].purity == urls.PRIOR


def test_without_labels_of_documents_only_host_words_mark_pages(spark, tmp_path):
    _web(spark, tmp_path / "bare", False)
    got = {r.page_id: r.verdict for r in queries.op7_urls(spark, str(tmp_path / "bare")).collect()}
    assert {i for i in got if got[i] == "block"} == {42} and len(got) == 45


def test_text_of_a_page():
    shown = lambda html: " ".join(urls.text_of(html).split())
    assert shown("<p a='b'>x &lt;y&gt; a < b<BR/>c</p><!-- no --><SCRIPT>if (a<b) no</Script >d<script-x>e<style>p{}") == "x <y> a < b c d e"
    assert shown(None) == shown("") == shown("<!-- open") == shown("<p") == shown("<script>no") == ""

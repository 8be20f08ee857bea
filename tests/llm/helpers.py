"""Small tables and brute-force models for the tests of the training-data operators."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, score string, v string, n string"


def words(seed, n, vocab=400):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) if r.random() < 0.5 else f"w{r.randrange(vocab)}" for _ in range(n))


def edited(text, seed, share=0.03):
    r = random.Random(seed)
    return " ".join(w if r.random() > share else f"x{r.randrange(1000)}" for w in text.split())


def corpus():
    """Texts with copies, near copies, shared passages, ties, nulls, blanks, one very long text, a repeated row."""
    base = [words(i, 120 + 10 * i) for i in range(8)]
    texts = list(base)
    texts += [base[0], base[0], base[1]]  # exact copies
    texts += [edited(base[2], i) for i in range(6)] + [edited(base[3], i, 0.06) for i in range(6)]
    passage = words(99, 90)
    texts += [words(200 + i, 20) + " " + passage + " " + words(300 + i, 20) for i in range(4)]
    texts += ["", None, "   ", "one", "one", "ONE", "two words", "a b c d", "a b c d", words(500, 4000)]
    out = [(i, t, "en", ["big", "big", "b", None][i % 4], len(t or ""), "s", "x", "y", "z") for i, t in enumerate(texts)]
    return out + [out[4], (None, base[5], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]


def frame(spark, data=None):
    return spark.createDataFrame(corpus() if data is None else data, DOCS).repartition(3)

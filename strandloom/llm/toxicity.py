"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features are densities of a fixed and a learned lexicon, lexicon hits near second-person words, capitals, punctuation
and obfuscation rates. The learned lexicon holds words and word beginnings that are far more frequent in toxic
training rows; it is cross-fitted, so no row's features come from its own label. Scoring reads each text once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import collected, materialise
from .trees import Boosted, Isotonic, boost, isotonic

#: Labelled rows to learn from: those with the smallest hashes, this many at most.
MAX_TRAIN = 12_000
#: Learned terms kept, by evidence.
MAX_TERMS = 3_000
#: Counts of terms that a worker holds before it hands them on.
MAX_COUNTS = 200_000
#: A term must be so frequent in toxic rows that chance would make it with a probability of exp(-EVIDENCE) at most.
EVIDENCE = 9.0
THRESHOLD = 0.3

# Insults and second-person words of four languages.
INSULTS = {
    "idiot", "moron", "stupid", "dumb", "loser", "scum", "trash", "garbage", "pathetic", "worthless", "disgusting", "clown", "fool", "ugly", "filthy",
    "vermin", "creep", "jerk", "bastard", "imbecile", "dummkopf", "trottel", "abschaum", "widerlich", "dreck", "arschloch", "crétin", "imbécile", "ordure",
    "salaud", "connard", "stupide", "minable", "idiota", "imbécil", "basura", "estúpido", "asqueroso", "escoria", "inútil",
}
SECOND_PERSON = {
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "sie", "tu", "toi", "te", "ton", "ta", "vous", "votre",
    "tú", "ti", "usted", "ustedes", "vos", "su",
}
_LEET = str.maketrans("013457@$!|", "oieastasil")
_LETTERS = re.compile(r"[^\W\d_]+")
_INNER = re.compile(r"[^\W\d_][\d@$!|*.\-_]+[^\W\d_]")
_PREFIXES = range(4, 9)
NAMES = [
    "words", "letters_a_word", "fixed_density", "fixed_hits", "learned_density", "learned_hits", "learned_top", "learned_sum", "learned_kinds", "near_you", "you_density", "capital_words",
    "all_capitals", "punctuation", "exclamations", "decorated", "inner_marks", "digits", "repeats", "lexicon_lines",
]


def core(word: str) -> str:
    """Its letters in lower case; digits and marks between letters are read as the letters they resemble."""
    word = word.lower()
    if _INNER.search(word):
        word = word.translate(_LEET)
    return "".join(_LETTERS.findall(word))


def terms_of(text: str) -> set[str]:
    out: set[str] = set()
    for w in set(map(core, set(text.split()))):
        if len(w) > 2:
            out.add(w + "$")
            out.update(w[:n] for n in _PREFIXES if len(w) >= n)
    return out


class _Codes(dict):
    """For a raw word: learned weight (16 bits), then fixed, second person, capital, capitals, decorated, inner marks, digit, '!', long (1 each), punctuation (18), letters (18).

    The counts of a long word stand in `long` until its text is done, at the place that its code names.
    """

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.long: list[tuple[int, int]] = []

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        c = core(word)
        weight = max([self.terms.get(c + "$", 0.0), *(self.terms.get(c[:n], 0.0) for n in _PREFIXES if len(c) >= n)]) if len(c) > 2 else 0.0
        marks = sum(not x.isalnum() for x in word)
        x = min(0xFFFF, int(weight * 1024))  # log odds of counts stay far below 64
        flags = (c in INSULTS, c in SECOND_PERSON, word[:1].isupper(), len(c) > 1 and word.isupper(), marks > 1 and not word[-1:].isalnum(), bool(_INNER.search(word)), any(map(str.isdigit, word)), "!" in word, len(word) > 0x3FFFF)
        for i, f in enumerate(flags):
            x |= f << (16 + i)
        if flags[-1]:  # rare, so not remembered
            self.long.append((marks, len(c)))
            return x | (len(self.long) - 1) << 25
        self[word] = x = x | marks << 25 | len(c) << 43
        return x


def features(text: str | None, codes: dict[str, int]) -> np.ndarray:
    words = (text or "").split()
    n = len(words)
    if not n:
        return np.zeros(len(NAMES))
    x = np.fromiter(map(codes.__getitem__, words), np.int64, n)
    weight, bit = (x & 0xFFFF) / 1024, lambda i: (x >> (16 + i)) & 1
    marks, letters = (x >> 25) & 0x3FFFF, x >> 43
    if bit(8).any():
        at = np.flatnonzero(bit(8))
        marks[at], letters[at] = np.array([codes.long[i] for i in (x[at] >> 25).tolist()]).T
        codes.long.clear()
    fixed, you, hit = bit(0), bit(1), weight > 0
    any_ = np.flatnonzero(hit | (fixed > 0))
    you_at = np.flatnonzero(you)
    near = 0.0
    if len(any_) and len(you_at):
        k = np.searchsorted(you_at, any_)
        gap = np.minimum(np.abs(any_ - you_at[np.minimum(k, len(you_at) - 1)]), np.abs(any_ - you_at[np.maximum(k - 1, 0)]))
        near = float((gap <= 5).sum()) / n
    kinds = len({words[i] for i in any_.tolist()})
    return np.array([
        np.log1p(n), letters.sum() / n, fixed.sum() / n, np.log1p(fixed.sum()), hit.sum() / n, np.log1p(hit.sum()), weight.max(), np.log1p(weight.sum()), np.log1p(kinds), near, you.sum() / n,
        bit(2).sum() / n, bit(3).sum() / n, marks.sum() / n, bit(7).sum() / n, bit(4).sum() / n, bit(5).sum() / n, bit(6).sum() / n, 1 - len(set(words)) / n, len(any_) and np.ptp(any_) / n,
    ])


@dataclass
class Model:
    terms: dict[str, float]
    trees: Boosted
    calibration: Isotonic

    def score(self, x: np.ndarray) -> np.ndarray:
        p = self.trees.predict(x)
        return 0.999 * self.calibration.predict(p) + 0.001 * p  # the last part keeps order within a pool


def held_out(key: str = "doc_id") -> Column:
    """Rows that are kept from training: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _term_counts(batches):
    counts = [Counter() for _ in range(4)]
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            for text, toxic, fold in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                counts[2 * fold + toxic].update(terms_of(text or ""))
            if sum(map(len, counts)) > MAX_COUNTS:
                yield from _counted(counts)
    yield from _counted(counts)


def _counted(counts: list[Counter]) -> Iterator[pa.RecordBatch]:
    """The counts so far, which are then forgotten: what a worker holds is bounded, and sums are taken later."""
    for at, own in enumerate(counts):
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.string()), pa.array([at] * len(own), pa.int32()), pa.array(list(own.values()), pa.int64())], ["term", "at", "n"])
        own.clear()


def _lexicon(rows: list, folds: tuple[int, ...], totals: dict[int, int]) -> dict[str, float]:
    pos_all, neg_all = (sum(totals.get(2 * f + y, 0) for f in folds) for y in (1, 0))
    out = {}
    for r in rows:
        pos, neg = sum(r[f"n{2 * f + 1}"] for f in folds), sum(r[f"n{2 * f}"] for f in folds)
        odds = np.log((pos + 0.5) / (pos_all + 1) * (neg_all + 1) / (neg + 0.5))
        share, usual = pos / max(pos + neg, 1), (pos_all + 1) / (pos_all + neg_all + 2)
        surprise = pos * np.log(max(share, 1e-9) / usual) + neg * np.log(max(1 - share, 1e-9) / (1 - usual))  # a bound on the tail
        if odds >= 1.5 and surprise >= EVIDENCE:
            out[r["term"]] = float(odds * min(1.0, pos / 8))
    return out


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_train: int = MAX_TRAIN) -> Model:
    """Learn from the labelled rows outside the held-out quarter, max_train of them at most (those of smallest hash).

    Null ids and labels teach nothing; a label that is given twice is toxic if one is; of texts that share an id the
    smallest is learned from. Without labels, or with one kind, scores are one constant. Other columns are not read.
    """
    ship(docs.sparkSession)
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key)).groupBy(F.col(key).cast("bigint").alias("id")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(max_train).withColumn("fold", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(2)).cast("int"))
    known = docs.sparkSession.createDataFrame(known.collect(), known.schema)  # at most max_train small rows
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(known), "id")
    rows = rows.groupBy("id", "toxic", "fold").agg(F.min("text").alias("text")).select("id", "text", "toxic", "fold")  # a repeated id gives one row
    counts = rows.select("text", "toxic", "fold").mapInArrow(_term_counts, "term string, at int, n bigint")
    sums = counts.groupBy("term").agg(*(F.sum(F.when(F.col("at") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(4)))
    totals = {2 * r["fold"] + r["toxic"]: r["n"] for r in known.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = totals.get(1, 0) + totals.get(3, 0), totals.get(0, 0) + totals.get(2, 0)
    rise = (F.expr("n1 + n3") + 0.5) / (pos + 1) * (neg + 1) / (F.expr("n0 + n2") + 0.5)
    terms = collected(sums.where(F.expr("n1 + n3 >= 3") & (rise > 4)).orderBy(F.desc(F.log(rise) * F.sqrt(F.expr("n1 + n3"))), "term").limit(MAX_TERMS))
    lexica = [_lexicon(terms, (1,), totals), _lexicon(terms, (0,), totals), _lexicon(terms, (0, 1), totals)]

    def featured(batches):
        codes = [_Codes(lexica[0]), _Codes(lexica[1])]
        for batch in batches:
            texts, folds = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            x = [features(t, codes[f]).tolist() for t, f in zip(texts, folds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.list_(pa.float64()))], ["id", "toxic", "x"])

    learnt = collected(rows.mapInArrow(featured, "id bigint, toxic int, x array<double>").orderBy("id"))
    x = np.array([r["x"] for r in learnt]).reshape(-1, len(NAMES))
    y = np.array([r["toxic"] for r in learnt], float)
    fold = np.arange(len(y)) % 4
    out = np.zeros(len(y))
    for f in range(4):
        out[fold == f] = boost(x[fold != f], y[fold != f]).predict(x[fold == f])
    return Model(lexica[2], boost(x, y), isotonic(out, y))


def _scored(model, text_at: int, keep_below: float | None):
    def run(batches):
        codes = _Codes(model.value.terms)
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                s = model.value.score(np.array([features(t, codes) for t in part.column(text_at).to_pylist()]).reshape(-1, len(NAMES)))
                if keep_below is None:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s, pa.float64())], ["id", "score"])
                else:
                    yield part.filter(pa.array(s < keep_below))
            pa.default_memory_pool().release_unused()

    return run


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, those that repeat an id too, each by its own text.

    A null or empty text is scored as a text without words. Other columns, whatever their names, are not read.
    """
    ship(docs.sparkSession)
    read = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    out = read.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model), 1, None), "id bigint, score double")
    return out.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that score below the threshold; null and empty texts as score() says.

    A table of its own, since a write by others would send 10,000 whole rows at once to and from the workers.
    """
    ship(docs.sparkSession)
    return materialise(docs.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text), threshold), docs.schema), "clean")


def mark(rows: DataFrame, model: Model, text: str, name: str, read: Callable[[str | None], str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows without their text, with 1 or 0 by their score in a column of this name; null where a text has no words and
    everywhere if the model has learnt no difference.

    read: makes the text to score of the column's, on the executors.
    """
    ship(rows.sparkSession)
    kept, shared = [c for c in rows.columns if c != text], rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        codes = _Codes(shared.value.terms)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                x = np.array([features(read(t) if read else t, codes) for t in part.column(len(kept)).to_pylist()]).reshape(-1, len(NAMES))
                unknown = (x[:, 0] == 0) | (not shared.value.trees.trees)  # the first feature grows with the words
                found = pa.array((shared.value.score(x) >= threshold).astype(np.int32), mask=unknown)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], found], [*kept, name])
            pa.default_memory_pool().release_unused()

    return rows.select(*kept, F.col(text).cast("string")).mapInArrow(run, rows.select(*kept, F.lit(None).cast("int").alias(name)).schema)

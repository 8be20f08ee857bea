"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders; windows of the resulting templates are hash-joined with those of the
benchmark items, and the fillers of placeholders must map one to one for a re-parameterised question to count. Alignments
that an added or missing token sets apart count together. A Bloom filter of fixed size keeps windows that no item has from
the shuffle; the join decides.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Tokens of a window, least tokens of it that are no placeholder, and the shortest item that is looked for.
WINDOW, LITERAL, SHORTEST = 8, 4, 4
#: Covered tokens that make a leak: this share of the item, or this many.
SHARE, ENOUGH = 0.6, 24
#: Tokens by which neighbouring alignments of one quotation may differ, and those that may stand for one filler.
NEAR, FILLER = 8, 4
#: log2 of the Bloom filter's bits.
BLOOM = 24

# Units that follow a number.
UNITS = {
    "%", "percent", "kg", "g", "mg", "lb", "lbs", "oz", "km", "m", "cm", "mm", "mi", "mile", "miles", "ft", "feet", "inch", "inches", "l", "ml", "liters", "litres", "gallons", "s", "sec", "seconds", "min", "minutes",
    "h", "hr", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "kmh", "mph", "dollars", "usd", "eur", "euro", "euros", "cents", "degrees", "c", "f", "kb", "mb", "gb", "tb", "hz", "khz", "mhz", "ghz", "v", "w", "kw",
}
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*(?:[a-z%°$€£]{0,3})", re.I)
_END = re.compile(r"[.!?:;][^\w]*$")
_NUM, _UNIT, _NAME = (np.int64(x << 4) for x in (101, 102, 103))
_M = np.uint64(0x9E3779B97F4A7C15)


class _Tokens(dict):
    """For a raw word: 60 bits of hash, then kind (0 word, 1 number, 2 unit after a number, 3 none), capital, sentence end."""

    def __missing__(self, raw: str) -> int:
        if len(self) > 300_000:
            self.clear()
        core = _EDGE.sub("", raw)
        kind = 3 if not core and raw != "%" else 1 if _NUMBER.fullmatch(core) else 2 if core.lower() in UNITS or raw == "%" else 0
        capital = core[:1].isupper() and not (len(core) > 1 and core.isupper())
        x = (xxhash.xxh3_64_intdigest(core.lower()) >> 5 << 4) | kind | capital << 2 | bool(_END.search(raw)) << 3
        self[raw] = x
        return x


def canonical(text: str | None, codes: _Tokens) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Raw tokens, template with names as placeholders, template with names as words, all as words, and marks of placeholders (1 number or unit, 2 name)."""
    raw = (text or "").split()
    x = np.fromiter(map(codes.__getitem__, raw), np.int64, len(raw))
    kept = (x & 3) != 3
    if not kept.all():
        raw = [raw[i] for i in np.flatnonzero(kept).tolist()]
        x = x[kept]
    kind = x & 3
    number = kind == 1
    unit = (kind == 2) & np.concatenate([[False], number[:-1]]) if len(x) else number
    inside = np.concatenate([[False], (x[:-1] & 8) == 0]) if len(x) else number
    name = (kind == 0) & ((x & 4) > 0) & inside
    plain = np.where(number, _NUM, np.where(unit, _UNIT, x >> 4 << 4))
    return raw, np.where(name, _NAME, plain), plain, x >> 4 << 4, np.where(number | unit, 1, np.where(name, 2, 0))


def _hashed(t: np.ndarray, w: int) -> np.ndarray:
    n = len(t) - w + 1
    acc = np.full(n, w, np.uint64)
    u = t.view(np.uint64)
    for j in range(w):
        acc = (acc ^ (acc >> np.uint64(29))) * _M + u[j : j + n]
    acc = (acc ^ (acc >> np.uint64(32))) * _M
    return acc ^ (acc >> np.uint64(29))


def windows(text: str | None, codes: _Tokens, w: int, least: int = LITERAL) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, marks, and for each window its place, hash and what are words in it (0 no placeholder, 1 names, 2 all)."""
    raw, typed, plain, verbatim, marks = canonical(text, codes)
    n = len(raw) - w + 1
    if n < 1:
        return raw, marks, *(np.empty(0, k) for k in (np.int64, np.uint64, np.int64))
    run = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    literal, named = run(marks == 0), run(marks == 2)
    enough = literal[w:] - literal[:-w] >= least
    at, few = np.flatnonzero(enough), np.flatnonzero(~enough)
    out = [(at, _hashed(typed, w)[at], np.zeros(len(at), np.int64))]
    words = np.flatnonzero(named[w:] - named[:-w] > 0)  # the same names, perhaps in other letters
    if len(words):
        out.append((words, _hashed(plain, w)[words], np.ones(len(words), np.int64)))
    if len(few):  # too little to know a template by: only as it stands
        out.append((few, _hashed(verbatim, w)[few], np.full(len(few), 2)))
    return raw, marks, *(np.concatenate(c) for c in zip(*out, strict=True))


def _spots(marks: np.ndarray, at: int, w: int, words: int) -> list[int]:
    return [i for i in range(w) if words < 2 and (marks[at + i] == 1 or (marks[at + i] == 2 and not words))]


def _fillers(raw: list[str], marks: np.ndarray, at: int, w: int, words: int) -> list[str]:
    return [_EDGE.sub("", raw[at + i]).lower() for i in _spots(marks, at, w, words)]


def _probes(h: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(h >> np.uint64(s)) & np.uint64((1 << bits) - 1) for s in (0, 20, 40)]


def _windowed(widths: list[int], bloom, bits: int, key: str):
    schema = pa.schema([("hash", pa.int64()), (key, pa.int64()), ("h", pa.int64()), ("at", pa.int32()), ("fill", pa.list_(pa.string())), ("spots", pa.list_(pa.int32()))])

    def run(batches):
        codes = _Tokens()
        for batch in batches:
            rows = []
            for id_, h, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for w in widths:
                    raw, marks, at, hashes, words = windows(text, codes, w)
                    if bloom is not None and len(at):
                        hit = np.logical_and.reduce([bloom.value[p] for p in _probes(hashes, bits)])
                        at, hashes, words = at[hit], hashes[hit], words[hit]
                    rows += [(x, id_, h, a, _fillers(raw, marks, a, w, p), _spots(marks, a, w, p) if bloom is None else None) for x, a, p in zip(hashes.view(np.int64).tolist(), at.tolist(), words.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return run


def _lengths(batches):
    codes = _Tokens()
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(canonical(t, codes)[0]) for t in batch.column(2).to_pylist()], pa.int32())], ["item_id", "h", "tokens"])


def _one_to_one(pairs: set[tuple[str, str]]) -> bool:
    return len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})


def _slots(places: set[tuple[int, int, str, str]]) -> set[tuple[str, str]] | None:
    """Fillers of item and document from (item's place, document's place, filler, filler): tokens that meet one token are one filler.

    None if a filler would have more than FILLER tokens. Where a join was seen in part only, the whole filler stands for it.
    """
    group: dict[tuple[int, int], list] = {}
    for x in places:
        ends = ((0, x[0]), (1, x[1]))
        merged = [x]
        for other in {id(group[e]): group[e] for e in ends if e in group}.values():
            merged += other
        for y in merged:
            group[0, y[0]] = group[1, y[1]] = merged
    pairs = set()
    for g in {id(g): g for g in group.values()}.values():
        a, b = {x[0]: x[2] for x in g}, {x[1]: x[3] for x in g}
        if max(a) - min(a) >= FILLER or max(b) - min(b) >= FILLER:
            return None
        pairs.add((" ".join(a[p] for p in sorted(a)), " ".join(b[p] for p in sorted(b))))
    part = lambda x, y: x != y and (y.startswith(x + " ") or y.endswith(" " + x))
    wide = [x for x in pairs if " " in x[0] + x[1]]
    return {(a, b) for a, b in pairs if not any(a == c and part(b, d) or b == d and part(a, c) for c, d in wide)}


def judge(tokens: int, found: list[dict], share: float = SHARE, enough: int = ENOUGH) -> tuple[int, bool, int] | None:
    """The best (covered, exact, slots) of an item in a document, by one alignment or by neighbouring ones together; None if none leaks."""
    by_shift: dict[int, list[dict]] = {}
    for x in found:
        by_shift.setdefault(x["at"] - x["item_at"], []).append(x)
    chain: list[tuple[int, set, set]] = []
    out: list[tuple[int, bool, int]] = []

    def weigh(covered: set[int], pairs: set[tuple[str, str]] | None) -> bool:
        fits = pairs is not None and ((exact := all(a == b for a, b in pairs)) or _one_to_one(pairs))
        if fits and (len(covered) >= tokens * share or len(covered) >= enough):
            out.append((len(covered), exact, len(pairs)))
        return fits

    def close() -> None:
        if len(chain) > 1:
            weigh(set().union(*(c for _, c, _ in chain)), _slots(set().union(*(p for _, _, p in chain))))
        chain.clear()

    for shift in sorted(by_shift):
        xs = by_shift[shift]
        covered = {i for x in xs for i in range(x["item_at"], x["item_at"] + x["w"])}
        places = {(x["item_at"] + i, x["at"] + i, a, b) for x in xs for i, a, b in zip(x["item_spots"], x["item_fill"], x["fill"], strict=True)}
        if chain and shift - chain[-1][0] > NEAR:
            close()
        if weigh(covered, {(a, b) for _, _, a, b in places}):
            chain.append((shift, covered, places))
    close()
    return max(out, default=None)


def _judged(share: float, enough: int):
    kinds = [("doc_id", pa.int64()), ("h", pa.int64()), ("item_id", pa.int64()), ("item_tokens", pa.int32()), ("covered", pa.int32()), ("slots", pa.int64()), ("exact", pa.bool_())]

    def run(batches):
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                if best := judge(x["item_tokens"], x["windows"], share, enough):
                    rows.append((x["doc_id"], x["h"], x["item_id"], x["item_tokens"], best[0], best[2], best[1]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(kinds)], names=[n for n, _ in kinds])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
          window: int = WINDOW, share: float = SHARE, enough: int = ENOUGH, bits: int = BLOOM) -> DataFrame:
    """For each document and item that leaks into it: doc_id, h (hash of its text), item_id, item_tokens, covered (item's
    tokens inside shared windows), slots (placeholders compared) and exact (no filler differs).

    Null and empty texts leak nothing, nor do items of fewer than SHORTEST tokens; items shorter than a window are looked
    for as a whole. Repeated rows and equal items are reported each. Other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).cast("bigint").alias("item_id"), F.xxhash64(item_text).alias("h"), F.col(item_text).cast("string").alias("text")).where("item_id is not null and text is not null").distinct()
    sized = materialise(items.mapInArrow(_lengths, "item_id bigint, h bigint, tokens int").where(F.col("tokens") >= SHORTEST), "items")
    widths = sorted({min(r[0], window) for r in sized.select(F.least("tokens", F.lit(window)).alias("w")).distinct().collect()})
    fields = "hash bigint, {} bigint, h bigint, at int, fill array<string>, spots array<int>"
    wanted = items.join(sized, ["item_id", "h"]).select("item_id", "h", "text", "tokens")
    parts = [wanted.where(F.least("tokens", F.lit(window)) == w).select("item_id", "h", "text").mapInArrow(_windowed([w], None, bits, "item_id"), fields.format("item_id")).withColumn("w", F.lit(w)) for w in widths]
    if not parts:
        return spark.createDataFrame([], "doc_id bigint, h bigint, item_id bigint, item_tokens int, covered int, slots bigint, exact boolean")
    known = parts[0]
    for p in parts[1:]:
        known = known.unionByName(p)
    known = materialise(known.select("hash", "item_id", F.col("h").alias("item_h"), F.col("at").alias("item_at"), F.col("fill").alias("item_fill"), F.col("spots").alias("item_spots"), "w"), "item-windows")
    mask = (1 << bits) - 1
    places = known.select(F.explode(F.array(*(F.shiftrightunsigned("hash", s).bitwiseAND(F.lit(mask)) for s in (0, 20, 40)))).alias("p")).distinct()
    words = places.groupBy((F.col("p") / 32).cast("int").alias("word")).agg(F.sum(F.expr("shiftleft(1L, cast(p % 32 as int))")).alias("set"))
    bloom = np.zeros(1 << (bits - 5), "<u4")  # bounded by `bits`, whatever the benchmark's size
    for r in words.collect():
        bloom[r["word"]] = r["set"]
    bloom = np.unpackbits(bloom.view(np.uint8), bitorder="little").view(bool)

    read = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("h"), F.col(text).cast("string").alias("text")).where("text is not null")
    seen = read.mapInArrow(_windowed(widths, spark.sparkContext.broadcast(bloom), bits, "doc_id"), fields.format("doc_id")).drop("spots")
    met = seen.join(known, "hash").where(F.size("fill") == F.size("item_fill"))
    met = met.groupBy("doc_id", "h", "item_id", "item_h").agg(F.collect_set(F.struct("at", "item_at", "w", "item_fill", "fill", "item_spots")).alias("windows"))
    met = met.join(sized.select("item_id", F.col("h").alias("item_h"), F.col("tokens").alias("item_tokens")), ["item_id", "item_h"])
    met = met.select("doc_id", "h", "item_id", "item_tokens", "windows").mapInArrow(_judged(share, enough), "doc_id bigint, h bigint, item_id bigint, item_tokens int, covered int, slots bigint, exact boolean")
    best = F.max(F.struct("covered", "exact", "slots", "item_tokens"))
    return met.groupBy("doc_id", "h", "item_id").agg(best.alias("x")).select("doc_id", "h", "item_id", "x.item_tokens", "x.covered", "x.slots", "x.exact")


def drop_leaked(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that have no leak. Rows are matched by id and text, null ids too."""
    bad = found.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h")).distinct()
    return docs.join(bad, docs[key].cast("bigint").eqNullSafe(bad["__id"]) & (F.xxhash64(docs[text]) == bad["__h"]), "left_anti")

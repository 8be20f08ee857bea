"""Removal of long byte strings that occur more than once: suffix arrays over the places where that can be.

1. Each text is cut by the smallest hashed k-byte string (anchor) of every window of `length` bytes. Two equal windows
   have equal anchors at equal offsets, so windows whose anchor occurs once in the corpus need no further look.
2. Windows of one anchor that follow each other form a context. A context that occurs twice is repeated as a whole.
3. The different contexts of an anchor are searched together by interval expansion on a Burrows-Wheeler transform
   (bwt.py), which gives the windows that occur in two of them. Before it, offset classes whose bytes around the anchor
   no other context has are cut off: their windows cannot occur twice.
4. An anchor with more than CAP different contexts is split by offset classes: windows of a class share a core of bytes,
   the core becomes the anchor, and classes narrow until a core is the window. No group of any size meets one task.
   Of words, the hashes of the windows are packed: each part of the contexts sends its different hashes to buckets, one
   row a bucket, and is answered with those that repeat.
5. The repeated windows go back to their documents as ranges, and the bytes that they cover are removed.

Passages of over 50 words that another document has too are found beside, by the same steps on words: windows of 51 words,
anchors of 8, contexts that hold the hashes of their windows. They are reported and not removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .bwt import repeated_starts
from .common import dealt, discard, for_all, hot_keys, materialise

LENGTH, ANCHOR = 400, 64
#: Different contexts of an anchor that are searched in one run, and bytes gathered for a run.
CAP, RUN_BYTES = 1000, 250_000
#: Widths of the offset classes of anchors above CAP.
WIDTHS = (32, 4, 1)
#: Words of a passage and of its anchors.
PASSAGE, PASSAGE_ANCHOR = 51, 8
#: Offset classes that are told apart before a search.
CLASSES = 8
#: Contexts of words in a part, and hashes of their windows in a bucket, where an anchor has more than CAP contexts.
PART_CONTEXTS, BUCKET_HASHES = 1000, 1 << 15
#: An anchor or context with more than this share of all rows is hot; its rows are dealt over several keys in joins.
HOT = 0.001
_SEGMENT, _LONG_WORD = 1 << 23, 1 << 16
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (_BASE, inverse)]
    return _powers[0], _powers[1]


_TABLE = np.random.default_rng(5).integers(0, 1 << 64, 256, np.uint64)


_SPACE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sums(values: np.ndarray) -> np.ndarray:
    up, _ = _power_tables(len(values))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)])])


def _cut(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the parts [start, end) of what sums was made of."""
    return _mixed((sums[end] - sums[start]) * _power_tables(len(sums))[1][start])


def _window_hashes(values: np.ndarray, k: int) -> np.ndarray:
    sums, (_, down) = _sums(values), _power_tables(len(values) + 1)
    return _mixed((sums[k:] - sums[:-k]) * down[: len(sums) - k])


def _smallest(h: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The place of the smallest (leftmost) of each w hashes that follow each other, and the first and last start that it serves."""
    n = len(h) - w + 1
    key = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)  # the leftmost of equal ones is smallest
    padded = np.full(-(-len(key) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(key)] = key
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    at = (np.minimum(back[:n], ahead[w - 1 : w - 1 + n]) & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return at[first], first, np.append(first[1:], n) - 1


def anchors(text: bytes, length: int = LENGTH, k: int = ANCHOR) -> list[tuple[int, int, int, int]]:
    """(anchor's hash, its place, first and last start of the windows that it is the anchor of), over all windows."""
    out = []
    for base in range(0, max(len(text) - length + 1, 0), _SEGMENT):  # parts of a very long text overlap by a window
        raw = np.frombuffer(text, np.uint8, min(_SEGMENT + length - 1, len(text) - base), base)
        h = _window_hashes(_TABLE[raw], k)
        at, first, last = _smallest(h, length - k + 1)
        out += zip(h[at].view(np.int64).tolist(), (at + base).tolist(), (first + base).tolist(), (last + base).tolist(), strict=True)
    return out


def word_hashes(text: bytes) -> np.ndarray:
    """A hash for each word; words are split at ASCII white space."""
    raw = np.frombuffer(text, np.uint8)
    edge = np.flatnonzero(np.diff((~_SPACE[raw]).view(np.int8), prepend=0, append=0))
    start, end = edge[::2], edge[1::2]
    out = np.empty(len(start), np.uint64)
    long = end - start > _LONG_WORD
    for i in np.flatnonzero(long).tolist():
        out[i] = xxhash.xxh3_64_intdigest(text[start[i] : end[i]])
    for base in range(0, len(raw), _SEGMENT):  # words that begin in this part
        own = np.arange(*np.searchsorted(start, [base, base + _SEGMENT]))
        own = own[~long[own]]
        if len(own):
            lo = int(start[own[0]])
            out[own] = _cut(_sums(_TABLE[raw[lo : int(end[own[-1]])]]), start[own] - lo, end[own] - lo)
    return out


def passage_windows(words: np.ndarray, length: int = PASSAGE) -> np.ndarray:
    """The hash of each window of so many words."""
    return np.concatenate([_window_hashes(words[i : i + _SEGMENT // 8 + length - 1], length) for i in range(0, max(len(words) - length + 1, 0), _SEGMENT // 8)] or [np.empty(0, np.uint64)])


def passage_anchors(words: np.ndarray, length: int = PASSAGE, k: int = PASSAGE_ANCHOR) -> list[tuple[int, int, int, int]]:
    """(anchor's hash, hash of its context, first and last start) of the windows of words."""
    out = []
    for base in range(0, max(len(words) - length + 1, 0), _SEGMENT // 8):
        part = words[base : base + _SEGMENT // 8 + length - 1]
        h = _window_hashes(part, k)
        at, first, last = _smallest(h, length - k + 1)
        c = _mixed(_cut(_sums(part), first, last + length) + (at - first).astype(np.uint64))
        out += zip(_mixed(h[at] + np.uint64(1)).view(np.int64).tolist(), c.view(np.int64).tolist(), (first + base).tolist(), (last + base).tolist(), strict=True)
    return out


def _digest(body: bytes, offset: int) -> int:
    return xxhash.xxh3_64_intdigest(body, offset & 0xFFFFFFFF) - (1 << 63)


def _anchored(length: int, k: int, passage: int):
    """Rows of contexts: of bytes, and of words, whose `at` is -1 and whose p0, p1 count words."""

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                if len(raw) >= length:
                    rows += [(g, _digest(raw[p0 : p1 + length], at - p0), doc_id, h, at, p0, p1) for g, at, p0, p1 in anchors(raw, length, k)]
                if len(raw) >= 2 * passage - 1:
                    rows += [(g, c, doc_id, h, -1, p0, p1) for g, c, p0, p1 in passage_anchors(word_hashes(raw), passage, min(PASSAGE_ANCHOR, passage))]
                if len(rows) > 50_000:
                    yield _rows(rows)
                    rows = []
            yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = [np.array([r[i] for r in rows], np.int64) for i in (0, 1)] + [[r[i] for r in rows] for i in range(2, 7)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["g", "c", "doc_id", "h", "at", "p0", "p1"])


_CONTEXT = [("g", pa.int64()), ("c", pa.int64()), ("off", pa.int64()), ("n", pa.int64()), ("doc", pa.int64()), ("body", pa.binary())]
_PART = [*_CONTEXT, ("og", pa.int64()), ("oc", pa.int64()), ("base", pa.int64())]
_CONTEXT_SQL = "g bigint, c bigint, off bigint, n bigint, doc bigint, body binary"


def _batch(rows: list[tuple], fields: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])


def _fetched(length: int, passage: int):
    """The contexts that are wanted of each text: its bytes, or (off = -1) the hashes of its windows of words."""
    fields = [*_CONTEXT, ("m", pa.int64())]

    def run(batches):
        for batch in batches:
            rows = []
            for text, doc, wanted in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = text.as_buffer().to_pybytes()
                windows = passage_windows(word_hashes(raw), passage) if any(x["at"] < 0 for x in wanted) else None
                for x in wanted:
                    if x["at"] < 0:
                        rows.append((x["g"], x["c"], -1, x["n"], doc, windows[x["p0"] : x["p1"] + 1].tobytes(), x["m"]))
                    else:
                        rows.append((x["g"], x["c"], x["at"] - x["p0"], x["n"], doc, raw[x["p0"] : x["p1"] + length], x["m"]))
                if len(rows) > 4000:
                    yield _batch(rows, fields)
                    rows = []
            yield _batch(rows, fields)

    return run


def _alive(group: list[tuple], length: int, core: int) -> list[tuple[int, int, int, bytes]]:
    """Of contexts (g, c, off, ...) of one anchor of `core` bytes the part (g, c, base, body) that may hold a shared window.

    A window that begins l bytes before the anchor holds all that its class of l holds, so contexts that share it share that.
    """
    side = length - core
    step = -(-(side + 1) // CLASSES)
    seen: dict[tuple, int] = {}
    keys = []
    for _, _, off, _, _, body in group:
        least, most = max(off - (len(body) - length), 0), min(off, side)  # of l
        own = [(j, xxhash.xxh3_64_intdigest(body[off - j * step : off + core + max(0, side - (j * step + step - 1))])) for j in range(least // step, most // step + 1)]
        keys.append((least, most, own))
        for k in own:
            seen[k] = seen.get(k, 0) + 1
    out = []
    for (g, c, off, _, _, body), (least, most, own) in zip(group, keys, strict=True):
        shared = [j for j, x in own if seen[j, x] > 1]
        if shared:
            lo, hi = off - min(most, shared[-1] * step + step - 1), off - max(least, shared[0] * step)
            out.append((g, c, lo, body[lo : hi + length]))
    return out


def _shared(group: list[tuple]) -> list[tuple[int, int, int, int]]:
    """Ranges (g, c, lo, hi) of the windows of words that contexts of two documents hold."""
    seen: dict[int, tuple[int, bool]] = {}
    windows = [np.frombuffer(x[5], np.uint64).tolist() for x in group]
    for (_, _, _, n, doc, _), hs in zip(group, windows, strict=True):
        for h in hs:
            old = seen.get(h)
            seen[h] = (doc, n > 1) if old is None else (doc, old[1] or n > 1 or old[0] != doc)
    return [(x[0], x[1], a, b) for x, hs in zip(group, windows, strict=True) for a, b in _stretches([i for i, h in enumerate(hs) if seen[h][1]])]


def _stretches(starts) -> list[tuple[int, int]]:
    starts = np.asarray(starts, np.int64)
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), starts[np.append(cut, len(starts) - 1)].tolist(), strict=True))


def _searched(length: int, core: int):
    """Ranges of repeated windows in the contexts of each anchor; rows arrive sorted by anchor."""
    fields = [(x, pa.int64()) for x in ("g", "c", "lo", "hi")]

    def run(batches):
        group: list[tuple] = []
        held: list[tuple] = []
        rows: list[tuple] = []
        size = 0

        def close():
            nonlocal size
            if group[0][2] < 0:
                rows.extend(_shared(group))
            else:
                some = _alive(group, length, core)
                held.extend(some)
                size += sum(len(x[3]) for x in some)
            group.clear()

        def search():
            nonlocal size
            for (g, c, base, _), starts in zip(held, repeated_starts([x[3] for x in held], length), strict=True):
                rows.extend((g, c, base + a, base + b) for a, b in _stretches(starts))
            held.clear()
            size = 0

        for batch in batches:
            for row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if group and row[0] != group[0][0]:
                    close()
                    if size > RUN_BYTES:
                        search()
                    if len(rows) > 20_000:
                        yield _batch(rows, fields)
                        rows.clear()
                group.append(row)
        if group:
            close()
        search()
        yield _batch(rows, fields)

    return run


def _refined(length: int, width: int):
    """Contexts cut into offset classes; the bytes that all windows of a class hold become the anchor."""

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for g, c, off, n, doc, body in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                own_anchor = g.to_bytes(8, "little", signed=True)
                starts = np.arange(len(body) - length + 1)
                classes = (off - starts) // width
                for j in np.unique(classes).tolist():
                    own = starts[classes == j]
                    lo, hi, begin = int(own[0]), int(own[-1]), off - j * width  # the latest start of the class
                    core = body[begin : begin - width + 1 + length]
                    part = body[lo : hi + length]
                    out.append((_digest(core + own_anchor, j), _digest(part, begin - lo), begin - lo, n, doc, part, g, c, lo))
                if len(out) > 4000:
                    yield _batch(out, _PART)
                    out = []
            yield _batch(out, _PART)

    return run


def _groups(batches):
    """Rows of one first value after the other; they arrive sorted by it."""
    group: list[tuple] = []
    for batch in batches:
        for row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if group and row[0] != group[0][0]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def _gathered(hashes: np.ndarray, docs: np.ndarray, twice: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different hashes, ascending, the smallest doc of each, and whether it has two docs or one that tells of two."""
    order = np.lexsort((docs, hashes))
    hashes, docs, twice = hashes[order], docs[order], twice[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    last = np.append(first[1:], len(hashes)) - 1
    return hashes[first], docs[first], np.logical_or.reduceat(twice, first) | (docs[first] != docs[last])


_PACKED = [("bucket", pa.int64()), ("source", pa.int64()), ("hashes", pa.binary()), ("docs", pa.binary()), ("twice", pa.binary())]


def _packed(buckets: int):
    """The different windows of a source's contexts (source, n, doc, body), a row for each bucket that has some."""

    def run(batches):
        for group in _groups(batches):
            counts = [len(x[3]) // 8 for x in group]
            docs = np.repeat(np.array([x[2] for x in group], np.int64), counts)
            hashes, docs, twice = _gathered(np.frombuffer(b"".join(x[3] for x in group), np.uint64), docs, np.repeat([x[1] > 1 for x in group], counts))
            bucket = (hashes >> np.uint64(16)) % np.uint64(buckets)
            own = [(int(j), bucket == j) for j in np.unique(bucket)]
            yield _batch([(j, group[0][0], hashes[x].tobytes(), docs[x].tobytes(), twice[x].tobytes()) for j, x in own], _PACKED)

    return run


def _answered(batches):
    """For each source the windows of a bucket that repeat."""
    for group in _groups(batches):
        hashes, docs, twice = (np.frombuffer(b"".join(x[i] for x in group), t) for i, t in ((2, np.uint64), (3, np.int64), (4, np.bool_)))
        every, _, several = _gathered(hashes, docs, twice)
        every = every[several]
        rows = [(x[1], own[np.isin(own, every)].tobytes()) for x in group for own in [np.frombuffer(x[2], np.uint64)]]
        yield _batch([x for x in rows if x[1]], [("source", pa.int64()), ("body", pa.binary())])


def _located(batches):
    """Ranges of the windows that repeat, from a source's answers (c is null) and its contexts (source, g, c, body)."""
    for group in _groups(batches):
        answers = np.frombuffer(b"".join(x[3] for x in group if x[2] is None), np.uint64)
        rows = [(g, c, a, b) for _, g, c, body in group if c is not None for a, b in _stretches(np.flatnonzero(np.isin(np.frombuffer(body, np.uint64), answers)))]
        yield _batch(rows, [(x, pa.int64()) for x in ("g", "c", "lo", "hi")])


def _settled_words(hot: DataFrame) -> DataFrame:
    """Ranges (g, c, lo, hi) of the windows of words that contexts of two documents hold, for anchors of any number of contexts.

    Equal windows have equal anchors, so windows are told apart by their own hashes alone. No task holds more than a
    part's contexts, or a bucket's hashes, of which each part sends the different ones only.
    """
    n, windows = hot.agg(F.count("*"), F.sum(F.expr("length(body) div 8"))).first()
    tasks = max(int(hot.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = hot.withColumn("source", F.pmod(F.xxhash64("g", "c"), F.lit(n // PART_CONTEXTS + 1)))
    packed = rows.select("source", "n", "doc", "body").repartition(tasks, "source").sortWithinPartitions("source")
    packed = packed.mapInArrow(_packed((windows or 0) // BUCKET_HASHES + 1), "bucket bigint, source bigint, hashes binary, docs binary, twice binary")
    answers = packed.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(_answered, "source bigint, body binary")
    none = F.lit(None).cast("bigint")
    both = answers.select("source", none.alias("g"), none.alias("c"), "body").unionByName(rows.select("source", "g", "c", "body"))
    return both.repartition(tasks, "source").sortWithinPartitions("source").mapInArrow(_located, "g bigint, c bigint, lo bigint, hi bigint")


def _settled(contexts: DataFrame, several: DataFrame, length: int, core: int, cap: int, widths: tuple[int, ...]) -> DataFrame:
    """Ranges (g, c, lo, hi) of windows found in two contexts or occurrences.

    contexts: one row for each (g, c) with off, n occurrences, doc and body; several: those of anchors with m > 1 contexts.
    """
    tasks = max(int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    few = several.where((F.col("m") > 1) & (F.col("m") <= cap)).drop("m").repartition(tasks, "g").sortWithinPartitions("g", "c")
    found = few.mapInArrow(_searched(length, core), "g bigint, c bigint, lo bigint, hi bigint")
    last = F.when(F.col("off") < 0, F.expr("length(body) div 8") - 1).otherwise(F.length("body") - length).cast("bigint")
    whole = contexts.where("n > 1").select("g", "c", F.lit(0).cast("bigint").alias("lo"), last.alias("hi"))
    out = materialise(found.unionByName(whole), "found")
    hot = several.where(F.col("m") > cap)
    words = hot.where("off < 0")
    if not words.isEmpty():
        out = out.unionByName(materialise(_settled_words(words), "found"))
    hot = hot.where("off >= 0")
    if widths and not hot.isEmpty():
        parts = materialise(hot.drop("m").mapInArrow(_refined(length, widths[0]), _CONTEXT_SQL + ", og bigint, oc bigint, base bigint"), "classes")
        distinct = parts.groupBy("g", "c").agg(F.first("off").alias("off"), F.sum("n").alias("n"), F.min("doc").alias("doc"), F.first("body").alias("body"))
        distinct = materialise(distinct, "contexts")
        again = distinct.groupBy("g").agg(F.count("*").alias("m")).where("m > 1")
        inner = _settled(distinct, distinct.join(again, "g"), length, length - widths[0] + 1, cap, widths[1:])
        back = parts.select("g", "c", "og", "oc", "base").join(inner, ["g", "c"]).select(F.col("og").alias("g"), F.col("oc").alias("c"), (F.col("base") + F.col("lo")).alias("lo"), (F.col("base") + F.col("hi")).alias("hi"))
        out = out.unionByName(materialise(back, "found"))
        discard(parts, distinct)
    return out


def _merged(ranges) -> list[list[int]]:
    spans: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], hi)
        else:
            spans.append([lo, hi])
    return spans


def _removed(length: int, passage: int):
    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text, ranges in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                spans = _merged((x["lo"], x["hi"] + length) for x in ranges or () if not x["words"])
                words = sum(b - a for a, b in _merged((x["lo"], x["hi"] + passage) for x in ranges or () if x["words"]))
                edges = [0, *(x for s in spans for x in s), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((doc_id, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), words > 0, words, spans))
            fields = [*((x, pa.int64()) for x in ("doc_id", "n_bytes", "n_removed", "n_spans")), ("kept_sha256", pa.string()), ("has_passage", pa.bool_()), ("passage_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64())))]
            yield _batch(rows, fields)

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, cap: int = CAP, passage: int = PASSAGE) -> DataFrame:
    """For each row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, has_passage, passage_words, spans ([start, end) of the removed runs).

    A byte goes if a string of `length` bytes that covers it starts anywhere else in the table too, in its own text or
    another row's. Strings never cross rows. passage_words are the words that lie in `passage` words which a row of
    another id or text has in the same order; they are not removed for it. A null text counts as empty; rows that repeat
    id and text each count, so their texts, if long enough, go as a whole, but have no passage by that. A null doc_id is
    kept as it is. Other columns are not read.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    texts = texts.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(b""))).alias("h"), "text")
    none = -(1 << 63)  # stands for a null id in joins
    core = min(anchor, length)
    rows = materialise(texts.select(F.coalesce("doc_id", F.lit(none)).alias("doc_id"), "h", "text").mapInArrow(_anchored(length, core, passage), "g bigint, c bigint, doc_id bigint, h bigint, at bigint, p0 bigint, p1 bigint"), "anchors")
    live = materialise(rows.groupBy("g").agg(F.count("*").alias("rows")).where("rows > 1"), "live")
    total = rows.count()
    hot, place = hot_keys(live, ["g"], HOT, total), F.struct("doc_id", "p0")
    rows, old = materialise(dealt(rows, hot, ["g"], place).join(for_all(live.select("g"), hot, ["g"]), ["g", "part"]).drop("part"), "live-anchors"), rows
    discard(old, live)
    least = F.min(F.struct("doc_id", "h", "at", "p0", "p1"))
    who = F.struct("doc_id", "h")
    times = F.when(F.min("at") < 0, F.when(F.min(who) < F.max(who), 2).otherwise(1)).otherwise(F.count("*")).cast("bigint")
    each = materialise(rows.groupBy("g", "c").agg(times.alias("n"), F.count("*").alias("rows"), least.alias("x")).select("g", "c", "n", "rows", "x.*"), "contexts")
    several = each.groupBy("g").agg(F.count("*").alias("m")).where("m > 1")
    mixed = dealt(each, hot, ["g"], F.col("c")).join(for_all(several, hot, ["g"]), ["g", "part"])
    wanted = mixed.groupBy("doc_id", "h").agg(F.collect_list(F.struct("g", "c", "at", "p0", "p1", "n", "m")).alias("wanted"))
    # Rows that repeat id and text share a fetch: the contexts are distinct again after it.
    held = texts.withColumn("doc_id", F.coalesce("doc_id", F.lit(none))).join(wanted, ["doc_id", "h"]).select("text", F.xxhash64("doc_id", "h").alias("doc"), "wanted")
    contexts = materialise(held.mapInArrow(_fetched(length, passage), _CONTEXT_SQL + ", m bigint").dropDuplicates(["g", "c"]), "bodies")
    found = _settled(contexts, contexts, length, core, cap, WIDTHS)
    whole = each.where("n > 1").select("g", "c", F.lit(0).cast("bigint").alias("lo"), (F.col("p1") - F.col("p0")).alias("hi"))
    found = materialise(found.unionByName(whole).distinct(), "found")
    hot = hot_keys(each, ["g", "c"], HOT, total)
    ranges = dealt(rows, hot, ["g", "c"], place).join(for_all(found, hot, ["g", "c"]), ["g", "c", "part"]).select("doc_id", "h", (F.col("p0") + F.col("lo")).alias("lo"), (F.col("p0") + F.col("hi")).alias("hi"), (F.col("at") < 0).alias("words"))
    ranges = materialise(ranges.groupBy("doc_id", "h").agg(F.collect_set(F.struct("words", "lo", "hi")).alias("ranges")), "ranges")
    discard(rows, each, contexts, found)
    out = texts.withColumn("id", F.coalesce("doc_id", F.lit(none))).join(ranges.withColumnRenamed("doc_id", "id"), ["id", "h"], "left")
    return out.select("doc_id", "text", "ranges").mapInArrow(_removed(length, passage), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, has_passage boolean, passage_words bigint, spans array<array<bigint>>")

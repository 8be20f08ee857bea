"""Token ids in binary files: ids ranked by corpus frequency, byte-aligned variable-length coding, separate control bytes.

File format. A token folder holds `blocks` and `ranks`, Parquet containers written by Spark's own committers (so any
store works and a lost executor's half-written part is never seen). A row of `blocks` is one block: part and seq give
its place in ascending doc_id order, first the number of ids before it in its part, and `block` these bytes:

    "SLT1", u32 flags (0), u64 documents, u64 ids, i64 doc_id of each document, u8 null mark of each doc_id,
    u64 ids of each document, control bytes, data bytes, u32 crc32 of all before

Each id is stored as its frequency rank in 1 to 4 little-endian bytes without leading zero bytes; its control code (length
minus one, 2 bits) is packed four to a control byte, first value lowest. `ranks` maps a rank to its id.
"""

from __future__ import annotations

import json
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import long_array, materialise

#: Ids of one block and of one part file, about.
BLOCK_IDS, PART_IDS = 1 << 18, 1 << 24
#: Pieces of text whose ids a worker keeps.
CACHE = 1_500_000
_MAGIC = b"SLT1"
_LEN = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3
_LENGTHS = (_LEN + 1).astype(np.uint8)
#: A piece that is empty or has white space where it was cut: then the cut would change the ids.
_SPACE = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_UNSAFE = rf"^(\x00|\n)?$|^[\x00\n]{_SPACE}|{_SPACE}$|^[\t\r\f\x0b\x1c-\x1f\x85\xa0\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]"
_ALNUM = np.array([chr(i).isalnum() and i < 128 for i in range(256)])
FIRST, LAST = "\x00", "\x01"
#: What a byte-level tokenizer writes for each byte, and the place after letters that are letters in all versions of Unicode.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: b for b in _SHOWN} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_SHOWN_LINES = _BYTES | {10: 10}
_BLANK, _LETTERS_END = chr(_BYTES[32]), "\u0250"
_own: dict = {}


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, "<u4")
    code = (v > 0xFF).astype(np.uint8)
    if small := not len(v) or v.max() <= 0xFFFF:
        v = v.astype("<u2")
    else:
        code += (v > 0xFFFF).view(np.uint8) + (v > 0xFFFFFF).view(np.uint8)
    kept = np.ones((len(v), 2 if small else 4), bool)
    for j in range(1, kept.shape[1]):
        np.greater_equal(code, j, out=kept[:, j])
    data = v.view(np.uint8)[kept.ravel()]
    padded = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    padded[: len(v)] = code
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    return control.tobytes(), data.tobytes()


def decode_values(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n values: a control byte looks up four lengths, whose running sum gives each value's place."""
    lengths = _LENGTHS[control].ravel()[:n]
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    v = data[at].astype(np.uint32)
    for j in range(1, int(lengths.max(initial=1))):  # bytes that a value has only if it is long enough
        longer = np.flatnonzero(lengths > j)
        v[longer] |= data[at[longer] + j].astype(np.uint32) << np.uint32(8 * j)
    return v


def pack_block(doc_ids: list[int | None], counts: list[int], ranks: np.ndarray) -> bytes:
    control, data = encode_values(ranks)
    head = _MAGIC + np.array([0], "<u4").tobytes() + np.array([len(counts), len(ranks)], "<u8").tobytes()
    ids = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() + bytes(d is None for d in doc_ids)
    body = head + ids + np.array(counts, "<u8").tobytes() + control + data
    return body + np.array([zlib.crc32(body)], "<u4").tobytes()


def unpack_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, ids of each document and all ranks of a block; raises ValueError on damage."""
    if block[:4] != _MAGIC or zlib.crc32(memoryview(block)[:-4]) != int(np.frombuffer(block[-4:], "<u4")[0]):
        raise ValueError("damaged token block")
    docs, n = (int(x) for x in np.frombuffer(block, "<u8", 2, 8))
    at = 24
    ids = np.frombuffer(block, "<i8", docs, at)
    nulls = np.frombuffer(block, np.uint8, docs, at := at + 8 * docs)
    counts = np.frombuffer(block, "<u8", docs, at := at + docs).astype(np.int64)
    control = np.frombuffer(block, np.uint8, -(-n // 4), at := at + 8 * docs)
    data = np.frombuffer(block[at + len(control) : -4], np.uint8)
    return [None if x else int(i) for i, x in zip(ids, nulls, strict=True)], counts, decode_values(control, data, n)


def _words_stay(t: dict) -> bool:
    """Whether this tokenizer makes one pretoken of a blank and letters, and nothing but its BPE model touches that."""
    pre, model = t.get("pre_tokenizer") or {}, t["model"]
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
    same = model.get("type") == "BPE" and not model.get("dropout") and not any(t.get(x) for x in ("normalizer", "post_processor", "truncation", "padding"))
    return plain and same and not any(x["content"].strip(" ").isalpha() or x["content"].isspace() for x in t.get("added_tokens") or [])


class _Pieces(dict):
    """Ids, as bytes, of pieces: words after a blank (keyed without it), from a line break, full stop or comma on (keyed
    with it), or first in a text (keyed with FIRST before them), and the end of a text."""

    def __init__(self, tokenizer, kind: str, end_id: int, size: int = 1 << 16):
        self.seen = np.zeros(size, np.int64)
        self.tokenizer, self.kind, self.end = tokenizer, kind, array(kind, [end_id]).tobytes()

        self.bare = tokenizer.model if _words_stay(json.loads(tokenizer.to_str())) else None

    def encoded(self, texts: list[str]) -> list[bytes]:
        return [array(self.kind, x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def fresh(self, new: list[str]) -> dict[str, bytes]:
        """Ids of new pieces. A word of letters after a blank is one pretoken, so the library's model gets it at once."""
        words = [p for p in new if p.isalpha() and max(p) < _LETTERS_END] if self.bare else []
        cut = self.bare.tokenize if self.bare else None
        shown = "\n".join(words).encode().decode("latin-1").translate(_SHOWN_LINES).split("\n") if words else []
        out = {p: array(self.kind, [t.id for t in cut(_BLANK + x)]).tobytes() for p, x in zip(words, shown, strict=True)}
        rest = [p for p in new if p not in out]
        out.update(zip(rest, self.encoded([p[1:] if p[0] == FIRST else p if p[0] in "\n.," else " " + p for p in rest]), strict=True))
        return out

    def of(self, pieces: list[str]) -> list[bytes]:
        """One call to the tokenizer for all new pieces."""
        found = list(map(self.get, pieces))
        new = [p for p, x in zip(pieces, found, strict=True) if x is None]
        if new:
            if len(self) + len(new) > CACHE:
                self.clear()
            fresh = self.fresh(new)
            self.update(fresh)
            found = [fresh[p] if x is None else x for p, x in zip(pieces, found, strict=True)]
        return found

    def count(self, each: pa.Array, times: np.ndarray) -> None:
        """Add the ids of pieces that occur so many times."""
        at = np.frombuffer(each.buffers()[1], np.int64, len(each) + 1)
        ids = np.frombuffer(each.buffers()[2], self.kind)[: at[-1] // np.dtype(self.kind).itemsize]
        n = np.bincount(ids, np.repeat(times, np.diff(at) // ids.itemsize))
        self.seen[: len(n)] += n.astype(np.int64)

    def all_of(self, texts: pa.Array) -> pa.Array:
        """Ids of each whole text with the end id, as bytes. Cut texts give the same ids, as no pretoken crosses a cut; each
        different piece of the batch is looked up once."""
        plain = [t or "" for t in texts.to_numpy(zero_copy_only=False).tolist()]
        marked = {i for i, t in enumerate(plain) if FIRST in t or LAST in t}
        words, coded, bad = _cut(["" if i in marked else t for i, t in enumerate(plain)] if marked else plain)
        odd = bad.tolist()  # empty texts are among them
        if odd:  # texts that cannot be cut are pieces by themselves, for this batch
            for i, ids in zip(odd, self.encoded([plain[i] for i in odd]), strict=True):
                plain[i] = LAST + str(i)
                self[plain[i]] = ids
            words, coded, _ = _cut(plain)
        self[LAST] = self.end
        each = pa.array(self.of(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        pieces = each.take(coded.indices)
        self.count(each, np.bincount(coded.indices.to_numpy(), minlength=len(each)))
        for i in odd:
            self.pop(plain[i], None)
        at = np.frombuffer(pieces.buffers()[1], np.int64, len(pieces) + 1)[words.offsets.to_numpy()]
        return pa.Array.from_buffers(pa.large_binary(), len(plain), [None, pa.py_buffer(at.tobytes()), pieces.buffers()[2]])


def _cut(plain: list[str]) -> tuple[pa.Array, pa.DictionaryArray, np.ndarray]:
    """Pieces of each text, the same flat and coded, and the texts that must not be cut."""
    marked = [t + " " + LAST if t[:1] == LAST else FIRST + t.replace("\n", " \n").replace(",", " ,").replace(".", " .") + " " + LAST for t in plain]
    words = pc.split_pattern(pa.array(marked, pa.large_string()), " ")
    coded = words.flatten().dictionary_encode()
    unsafe, follows, alnum = _edges(coded.dictionary)
    at, ends = coded.indices.to_numpy(), words.offsets.to_numpy()
    wrong = unsafe[at]
    wrong[1:] |= follows[at[1:]] & ~alnum[at[:-1]]  # a mark after another mark is one pretoken with it
    bad = np.logical_or.reduceat(wrong, ends[:-1]) if len(plain) else np.zeros(0, bool)
    own = np.array([t[:1] == LAST for t in plain], bool)
    return words, coded, np.flatnonzero(bad & ~own)


def _edges(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each piece: whether it is unsafe, begins with a full stop or comma, ends with a letter or digit. ASCII is read off
    the first and last bytes; only the rest meets a regular expression."""
    at = np.frombuffer(pieces.buffers()[1], np.int64, len(pieces) + 1)
    data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
    data = np.append(data, np.uint8(0))
    empty = at[1:] == at[:-1]
    first, last = data[at[:-1]], data[np.maximum(at[1:] - 1, 0)]
    unsafe, alnum = empty.copy(), _ALNUM[last] & ~empty
    look = np.flatnonzero(~empty & ((first < 33) | (first > 127) | (last < 33) | (last > 127)))
    if len(look):
        some = pieces.take(pa.array(look))
        unsafe[look] = pc.match_substring_regex(some, _UNSAFE).to_numpy(zero_copy_only=False)
        alnum[look] = pc.match_substring_regex(some, r"[\pL\pN]$").to_numpy(zero_copy_only=False)
    return unsafe, ((first == 44) | (first == 46)) & ~empty, alnum


def _tokenised(model, end_id: int, kind: str, size: int):
    """Ids of each row and, in a last row of each task, the counts of all its ids."""

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if _own.get("of") != hash(model.value):  # a worker keeps tokenizer and pieces for its later tasks
            _own.update(of=hash(model.value), pieces=_Pieces(Tokenizer.from_str(model.value), kind, end_id, size))
        pieces = _own["pieces"]
        pieces.seen[:] = 0
        names = ["doc_id", "row", "ids", "counts"]
        for batch in batches:
            if batch.num_rows:
                ids = pieces.all_of(batch.column(1)).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), ids, pa.nulls(len(ids), pa.binary())], names)
                pa.default_memory_pool().release_unused()
        none = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.nulls(1, pa.binary()), pa.array([pieces.seen.tobytes()], pa.binary())], names)

    return run


def _counted(size: int):
    def run(batches):
        n = np.zeros(size, np.int64)
        for batch in batches:
            for counts in batch.column(0):
                n += np.frombuffer(counts.as_buffer(), np.int64)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(n[at])], ["id", "n"])

    return run


def _packed(rank_of, kind: str):
    def run(batches):
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        ids, counts, ranks, held = [], [], [], 0

        def block():
            row = [part, seq, before, len(counts), held, pack_block(ids, counts, np.concatenate(ranks))]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], ["part", "seq", "first", "docs", "ids", "block"])

        for batch in batches:
            raw = batch.column(1).cast(pa.large_binary())
            at = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1 + raw.offset)[raw.offset :] // np.dtype(kind).itemsize
            r = rank_of.value[np.frombuffer(raw.buffers()[2], kind)[at[0] : at[-1]]]
            at = at - at[0]
            begin = 0
            for i, (doc_id, n) in enumerate(zip(batch.column(0).to_pylist(), np.diff(at).tolist(), strict=True), 1):
                ids.append(doc_id)
                counts.append(n)
                held += n
                if held >= BLOCK_IDS:
                    ranks.append(r[at[begin] : at[i]])
                    begin = i
                    yield block()
                    seq, before = seq + 1, before + held
                    ids, counts, ranks, held = [], [], [], 0
            ranks.append(r[at[begin] :])
        if counts:
            yield block()

    return run


def _unpacked(id_of, with_ids: bool):
    def run(batches):
        for batch in batches:
            for start, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc_ids, counts, ranks = unpack_block(raw.as_buffer().to_pybytes())
                ids = id_of.value[ranks].astype("<u4")
                ends = np.cumsum(counts)
                bytes_ = memoryview(ids.tobytes())
                crc = [zlib.crc32(bytes_[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                cols = [pa.array(doc_ids, pa.int64()), pa.array(start + ends - counts), pa.array(counts), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends])), pa.array(ids.astype(np.int64))).cast(pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, key: str = "doc_id", text: str = "text", end_id: int = 0) -> None:
    """Encode every whole text, append end_id, and write the ids below path in ascending doc_id order (nulls first).

    A null text counts as empty. Rows that share a doc_id come as they were scanned.
    An empty table gives folders without blocks. Other columns are not read.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        model = f.read()
    from tokenizers import Tokenizer

    size = max(Tokenizer.from_str(model).get_vocab(with_added_tokens=True).values(), default=0) + 1
    kind = "H" if max(size, end_id + 1) <= 1 << 16 else "I"
    size = max(size, end_id + 1)
    read = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = read.mapInArrow(_tokenised(spark.sparkContext.broadcast(model), end_id, kind, size), "doc_id bigint, row bigint, ids binary, counts binary")
    tokens = materialise(rows, "tokens", batch="16m", codec="snappy")
    counts = tokens.where("counts is not null").select("counts").mapInArrow(_counted(size), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    seen = counts.orderBy(F.desc("n"), "id").collect()  # at most the vocabulary
    id_of = np.array([r[0] for r in seen], np.uint32)
    rank_of = np.zeros(size, np.uint32)
    rank_of[id_of] = np.arange(len(id_of), dtype=np.uint32)
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(id_of)], "rank bigint, id bigint").coalesce(1).write.parquet(f"{path}/ranks")
    total = sum(r[1] for r in seen)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_IDS))
    ranged = tokens.where("ids is not null").select("doc_id", "row", "ids").repartitionByRange(parts, F.asc_nulls_first("doc_id"), "row").sortWithinPartitions(F.asc_nulls_first("doc_id"), "row")
    packed = ranged.select("doc_id", "ids").mapInArrow(_packed(spark.sparkContext.broadcast(rank_of), kind), "part bigint, seq bigint, first bigint, docs bigint, ids bigint, block binary")
    packed.write.option("compression", "zstd").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 and, if asked for, the ids, from the files."""
    blocks = spark.read.schema("part bigint, seq bigint, first bigint, docs bigint, ids bigint, block binary").parquet(f"{path}/blocks")
    ranks = spark.read.parquet(f"{path}/ranks").collect()  # at most the vocabulary
    id_of = np.zeros(len(ranks) + 1, np.uint32)
    for r in ranks:
        id_of[r["rank"]] = r["id"]
    sizes = {r[0]: r[1] for r in blocks.groupBy("part").agg(F.sum("ids")).collect()}  # one entry a file
    starts = np.concatenate([[0], np.cumsum([sizes.get(p, 0) for p in range(max(sizes, default=0) + 1)])])
    placed = blocks.select((F.get(long_array(starts.tolist()), F.col("part").cast("int")) + F.col("first")).alias("start"), "block")
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    return placed.mapInArrow(_unpacked(spark.sparkContext.broadcast(id_of), with_ids), schema)

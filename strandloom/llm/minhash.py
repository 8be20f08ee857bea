"""Near-duplicates by bottom-k sketches of one hash function.

A document's set of word shingles is hashed once; its sketch is the k smallest hashes. Inverted lists of the retained
hashes generate pairs, an estimate on the sketch of the union filters them, and the full sets confirm them. Equal sets
are one node from the start. Lists are indexed rarest value first and only as far as two sketches that overlap enough
must meet (a prefix filter); within a list a star around its most central member comes first, and only members that are
then still in different components are indexed more finely and paired, so a large group of copies costs about one
comparison a member.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import discard, materialise
from .components import components

#: Size of a sketch; sets of up to WHOLE values are kept whole, which makes their overlaps exact.
K, WHOLE = 64, 128
#: Chance that a link right at the threshold falls below the least overlap asked of two sketches.
MISS = 1e-9
#: Members that a list whose members are apart after the first stars may have to be paired at once.
SMALL_LIST = 16
#: As K and WHOLE, for the finer index of the members of larger lists.
FINE_K, FINE_WHOLE = 256, 512
#: Entries of a list that meet in one task's key.
SPREAD = 256
#: Keys over which the last pairing deals a list longer than that.
PARTS = 8
#: Node ids that may be broadcast, counted before.
BROADCAST_ROWS = 50_000
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _Words(dict):
    """Hashes of words, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 17:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, width: int, words: dict) -> np.ndarray:
    """Ascending distinct hashes of the shingles: A-Z lower-cased, words split at ASCII white space."""
    parts = (text or b"").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    w = min(width, len(parts))
    n = len(parts) - w + 1
    acc = np.full(n, w, np.uint64)
    for j in range(w):
        acc = _mixed(acc * _M1 + h[j : j + n])
    return np.unique(acc)


def _sketches(width: int, k: int):
    def run(batches):
        words = _Words()
        for batch in batches:
            ids, n, fp, sketch = batch.column(0), [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_buffer().to_pybytes() if text.is_valid else None, width, words)
                n.append(len(s))
                fp.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sketch.append(s[: k if len(s) > WHOLE else WHOLE].view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sketch)]), pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *sketch])))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(fp, pa.binary()), lists, batch.column(2)], ["doc_id", "n", "fp", "sketch", "text_hash"])

    return run


def _sets(width: int):
    """Sets of (nid, fp, text) rows; a row whose text has another set than fp, as it shares a doc_id only, gives none."""

    def run(batches):
        words = _Words()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                sets = [shingle_set(t.as_buffer().to_pybytes() if t.is_valid else None, width, words) for t in part.column(2)]
                kept = [xxhash.xxh3_128_digest(s.tobytes()) == fp.as_py() for s, fp in zip(sets, part.column(1), strict=True)]
                sets = [s.view(np.int64) for s, x in zip(sets, kept, strict=True) if x]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *sets])))
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(kept, pa.bool_())), lists], ["nid", "members"])

    return run


def least_overlap(k: int, share: float, miss: float = MISS) -> int:
    """The largest t so that at most `miss` of pairs at the threshold have fewer than t of k values in common."""
    below = 0.0
    for t in range(k + 1):
        below += math.comb(k, t) * share**t * (1 - share) ** (k - t)
        if below > miss:
            return max(t, 1)
    return k


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 2, percent: int = 80, k: int = K) -> DataFrame:
    """For each row of docs: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept, text_hash.

    Linked are documents whose sets have 100 * |intersection| >= percent * |union|. Null, empty and blank texts have
    an empty set and no link. Rows that repeat a doc_id are judged each by its own text. A row whose doc_id is null
    takes part in no group: its component is null and it is kept. Other columns of docs are not read.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    read = materialise(texts.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_sketches(width, k), "doc_id bigint, n bigint, fp binary, sketch array<bigint>, text_hash bigint"), "sketches")
    nodes = read.where("fp is not null and doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = materialise(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    rows = materialise(read.drop("sketch"), "rows")
    discard(read)
    links = _links(nodes, texts, rows, width, percent, k)
    labels = components(_union(links))
    discard(*links)
    named = nodes.select("nid", "fp", "rep").join(labels.withColumnRenamed("node", "nid"), "nid", "left")
    linked = named.where("label is not null")
    least = linked.groupBy("label").agg(F.min("rep").alias("least"))
    firsts = named.where("label is null").select("fp", F.col("rep").alias("least")).unionByName(linked.join(least, "label").select("fp", "least"))
    out = rows.select("doc_id", "n", "text_hash", F.when(F.col("doc_id").isNotNull(), F.col("fp")).alias("fp")).join(firsts, "fp", "left")
    component = F.coalesce("least", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), "text_hash")


def drop_duplicates(docs: DataFrame, groups: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that `groups` (of near_duplicates) keeps; of rows that repeat both id and text, one."""
    same = docs[key].cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text].cast("binary")) == F.col("__h"))
    bad = groups.where("not kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__h"))
    again = materialise(groups.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__h")).count().where("count > 1").drop("count"), "repeated")
    if again.isEmpty():
        return docs.join(bad, same, "left_anti")
    once = docs.join(again, same, "left_semi").withColumns({"__id": F.col(key).cast("bigint"), "__h": F.xxhash64(F.col(text).cast("binary"))}).dropDuplicates(["__id", "__h"])
    return docs.join(bad.unionByName(again), same, "left_anti").unionByName(once.select(*docs.columns))


def _index(nodes: DataFrame, percent: int, k: int, whole: int, miss: float) -> DataFrame:
    """nid, role, n, held, central and vs: the retained values (df, v) by which a node (nid, n, sketch) is indexed, rarest first.

    A whole set meets other whole sets, of which it must share percent of its own size, under its own values; a sketch
    meets sketches, of which it must share the least overlap, under their complements. Sets whose partners may be of
    either kind are indexed twice.
    """
    t = least_overlap(k, percent / 100, miss)
    full = nodes.where(F.col("n") <= whole).select("nid", "n", F.ceil(F.col("n") * percent / 100).cast("int").alias("need"), F.col("sketch").alias("vs"))
    cut = nodes.where(F.col("n") * 100 > whole * percent).select("nid", "n", F.least(F.lit(t), F.size("sketch")).alias("need"), F.transform(F.slice("sketch", 1, k), F.bitwise_not).alias("vs"))
    roles = full.withColumn("role", F.lit(0)).unionByName(cut.withColumn("role", F.lit(1)))
    df = roles.select(F.explode("vs").alias("v")).groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    shared = roles.select("nid", "role", F.explode("vs").alias("v")).join(df, "v").groupBy("nid", "role").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"))
    lists = shared.join(roles.select("nid", "role", "n", "need"), ["nid", "role"]).where(F.size("vs") >= F.col("need"))
    central = F.aggregate("vs", F.lit(0.0), lambda x, y: x + F.log2(y.df))  # most shares with most others
    vs = F.slice("vs", 1, F.size("vs") - F.col("need") + 1)
    held = F.when(F.col("role") == 0, F.size("vs").cast("bigint"))  # of a whole set, the values that another set has
    return materialise(lists.select("nid", "role", "n", held.alias("held"), central.alias("central"), vs.alias("vs")), "lists")


def _entries(lists: DataFrame) -> DataFrame:
    """A row for each list v that a node is in; room is the largest overlap with a set that has none of its rarer values.

    A list whose value df nodes hold is dealt over `parts` keys, SPREAD entries each, so that no list is one task's.
    An entry names its row of lists by (nid, role) and does not repeat vs, whose size would be squared by that.
    """
    room = F.coalesce(F.col("held") - F.col("place"), F.col("n"))
    out = lists.select("*", F.posexplode("vs").alias("place", "x")).withColumns({"room": room, "v": F.col("x.v"), "parts": F.expr(f"x.df div {SPREAD} + 1")})
    return out.withColumn("part", F.pmod(F.xxhash64("nid"), F.col("parts"))).drop("held", "place", "x", "vs")


def _on_all_parts(lists: DataFrame) -> DataFrame:
    """Rows of one a list (v, parts) for each part of the list."""
    return lists.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).drop("parts")


def _links(nodes: DataFrame, texts: DataFrame, rows: DataFrame, width: int, percent: int, k: int) -> list[DataFrame]:
    """Tables of confirmed pairs that connect every component: a star in each list of the sketches; where members are still apart,
    all pairs of short lists, and for the members of long ones a finer index of the same kind, its stars, and the pairs
    that are apart after that."""
    t = least_overlap(k, percent / 100)
    lists = _index(nodes, percent, k, WHOLE, MISS)
    tiny = F.when(F.col("n") <= WHOLE, F.transform("sketch", lambda x: (x.bitwiseAND(F.lit(0xFFFF)) - 0x8000).cast("smallint")))
    high = F.when(F.col("n") * 100 > WHOLE * percent, F.transform(F.slice("sketch", 1, k), lambda x: F.shiftrightunsigned(x, 33).cast("int")))
    twice = sum(F.coalesce(F.size(x) - F.size(F.array_distinct(x)), F.lit(0)) for x in (tiny, high))  # values that fall together there
    sketches = materialise(nodes.join(lists.select("nid").distinct(), "nid", "left_semi").select("nid", "n", twice.alias("twice"), tiny.alias("tiny"), high.alias("sketch")), "short")
    sets: list[DataFrame] = []
    found: list[DataFrame] = []

    def want(ids: DataFrame) -> None:
        """Full sets of these nodes, if they are not there yet."""
        for old in sets:
            ids = ids.join(old.select("nid"), "nid", "left_anti")
        wanted = materialise(ids.join(nodes.select("nid", "fp", F.col("rep").alias("doc_id")), "nid"), "wanted")
        if n := wanted.count():
            sets.append(_set_table(texts, rows, wanted, n, width))
        discard(wanted)

    def look(pairs: DataFrame) -> None:
        pairs = pairs.select(F.least("nid_a", "nid_b").alias("a"), F.greatest("nid_a", "nid_b").alias("b")).distinct()
        looked = _estimated(pairs, sketches, percent, k, t)
        want(looked.select(F.col("a").alias("nid")).unionByName(looked.select(F.col("b").alias("nid"))).distinct())
        found.append(_confirmed(looked, _union(sets), percent) if sets else looked)
        if sets:
            discard(looked)

    def apart(lists: DataFrame) -> DataFrame:
        """Rows (list v, member, label) of the lists whose members have different labels, with the list's size m and its commonest label."""
        labels = components(_union(found))
        known = lists.join(labels.withColumnRenamed("node", "nid"), "nid", "left").withColumn("label", F.coalesce("label", "nid"))
        each = _entries(known)
        named = each.groupBy("v", "parts", "label").agg(F.count("*").alias("c"))
        mixed = named.groupBy("v", "parts").agg(F.max(F.struct("c", "label")).alias("main"), F.sum("c").alias("m")).where("main.c < m").select("v", "parts", "m", "main.label").withColumnRenamed("label", "main")
        out = materialise(each.join(_on_all_parts(mixed), ["v", "part"]), "apart")
        discard(labels)
        return out

    look(_star(_entries(lists.withColumn("label", F.col("nid"))), percent))
    rest = apart(lists)
    if rest.isEmpty():
        discard(rest, lists, sketches, *sets)
        return found
    look(_pairs(rest.where(F.col("m") <= SMALL_LIST), percent))  # a bounded number of pairs for each entry
    members = materialise(rest.where(F.col("m") > SMALL_LIST).select("nid").distinct(), "members")
    discard(rest, lists)
    if members.isEmpty():
        discard(members, sketches, *sets)
        return found
    want(members)
    finer = _union(sets).join(members, "nid", "left_semi").select("nid", F.size("members").cast("bigint").alias("n"), F.when(F.size("members") <= FINE_WHOLE, F.col("members")).otherwise(F.slice("members", 1, FINE_K)).alias("sketch"))
    lists = _index(finer, percent, FINE_K, FINE_WHOLE, MISS)
    rest = apart(lists)
    look(_star(rest, percent))
    discard(rest)
    rest = apart(lists)
    if not rest.isEmpty():  # all that are left, each pair in the first list that has both
        look(_pairs(rest.join(lists.select("nid", "role", "vs"), ["nid", "role"]), percent, "vs").where("v = get(array_intersect(vs_a.v, vs_b.v), 0)"))
    discard(rest, lists, members, sketches, *sets)
    return found


def _side(lists: DataFrame, side: str, *more: str) -> DataFrame:
    return lists.select("v", "part", *(F.col(c).alias(f"{c}_{side}") for c in ("nid", "n", "room", "label", *more)))


def _fits(percent: int) -> str:
    return f"label_a <> label_b and least(n_a, n_b) * 100 >= greatest(n_a, n_b) * {percent} and least(room_a, room_b) * {100 + percent} >= {percent} * (n_a + n_b)"


def _pairs(lists: DataFrame, percent: int, *more: str) -> DataFrame:
    """All pairs of a list's members of different labels: members of other labels than the list's commonest, with all."""
    lists = lists.withColumn("parts", F.expr(f"if(m > {SPREAD}, {PARTS}L, 1L)")).withColumn("part", F.pmod(F.xxhash64("nid"), F.col("parts")))
    a = _side(_on_all_parts(lists.where("label <> main").drop("part")), "a", *more)
    return a.join(_side(lists, "b", *more, "main"), ["v", "part"]).where("label_b = main_b or nid_a < nid_b").where(_fits(percent))


def _star(lists: DataFrame, percent: int) -> DataFrame:
    """Each list's most central member with all others of another label."""
    center = lists.groupBy("v", "parts").agg(F.max(F.struct("central", *(F.col(c).alias(f"{c}_a") for c in ("nid", "n", "room", "label")))).alias("x"))
    center = _on_all_parts(center.select("v", "parts", "x.nid_a", "x.n_a", "x.room_a", "x.label_a"))
    return center.join(_side(lists, "b"), ["v", "part"]).where(_fits(percent))


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for x in tables[1:]:
        out = out.unionByName(x)
    return out


def _set_table(texts: DataFrame, rows: DataFrame, wanted: DataFrame, n: int, width: int) -> DataFrame:
    """The full sets of the n wanted nodes (nid, fp, doc_id), made anew from their texts."""
    few = F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted  # 32 bytes a row
    out = materialise(texts.join(few, "doc_id").select("nid", "fp", "text").mapInArrow(_sets(width), "nid bigint, members array<bigint>"), "sets")
    if rows.select("doc_id", "fp").join(few, ["doc_id", "fp"]).count() > n:  # rows that repeat both id and text
        again = out
        out = materialise(again.groupBy("nid").agg(F.first("members").alias("members")), "sets")
        discard(again)
    return out


def _estimated(pairs: DataFrame, sketches: DataFrame, percent: int, k: int, t: int) -> DataFrame:
    """The pairs (a, b) that the estimate on the sketch of the union lets pass.

    Whole sets hold 16 bits of their values, sketches of the smallest the high 31. Common values that fall together there
    count once in an intersection, but no more of them than fall together in either; so the count plus that never falls short.
    """
    for side in "ab":
        pairs = pairs.join(sketches.toDF(side, f"n_{side}", f"twice_{side}", f"tiny_{side}", f"sketch_{side}"), side)
    whole = f"greatest(n_a, n_b) <= {WHOLE}"  # then the sketches are the sets
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    smallest = F.array_intersect(F.array_intersect("sketch_a", "sketch_b"), union)
    shared = F.when(F.expr(whole), F.size(F.array_intersect("tiny_a", "tiny_b"))).otherwise(F.size(smallest)) + F.least("twice_a", "twice_b")
    pairs = pairs.withColumn("shared", shared)
    return materialise(pairs.where(f"if({whole}, shared * 100 >= {percent} * (n_a + n_b - shared), shared >= {t})").select("a", "b"), "looked")


def _confirmed(looked: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    both = looked
    for side in "ab":
        both = both.join(sets.toDF(side, f"in_{side}"), side)
    both = both.withColumn("i", F.size(F.array_intersect("in_a", "in_b")))
    return materialise(both.where(f"i * 100 >= {percent} * (size(in_a) + size(in_b) - i)").select("a", "b"), "confirmed")

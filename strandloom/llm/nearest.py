"""Approximate nearest neighbours on randomly rotated one-bit codes.

Each unit vector is rotated by one random orthogonal matrix; the signs are its code, and the inner product of the vector
with its own code is the correction scalar. The inner product with a query is estimated from code, scalar and rotated
query; its error is bounded by a multiple of sqrt((1 - c^2) / c^2 / (d - 1)). Vectors whose upper bound reaches the best
exact scores so far are reranked with the original vectors in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Rows of a block of vectors and of a block of queries; a pair of blocks meets in one task. Each vector is sent once for
#: each block of queries, so that one is the larger.
BLOCK, QUERY_BLOCK = 4096, 16384
#: Width of the error bound: about this many standard deviations.
EPSILON = 3.5


def rotation(d: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def _matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.float64)


def _indexed(d: int):
    def run(batches):
        p = rotation(d)
        for batch in batches:
            v = _matrix(batch.column(1), d)
            turned = (v / np.sqrt((v * v).sum(1))[:, None]) @ p
            c = np.abs(turned).sum(1) / np.sqrt(d)
            codes = np.packbits(turned > 0, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in codes], pa.binary()), pa.array(c), batch.column(1)], ["vec_id", "code", "c", "v"])

    return run


def _found(d: int, k: int, epsilon: float):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:
            return schema.empty_table()
        ids = vectors["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, v = ids[order], _matrix(vectors["v"], d)[order]
        codes = np.frombuffer(b"".join(vectors["code"].to_pylist()), np.uint8).reshape(len(ids), -1)[order]
        signs = np.unpackbits(codes, axis=1, count=d).astype(np.float32) * 2 - 1
        c = vectors["c"].to_numpy()[order]
        error = epsilon * np.sqrt(np.maximum(1 - c * c, 0) / (c * c) / max(d - 1, 1)) + 1e-6
        norms = np.sqrt((v * v).sum(1))
        q_ids, q = queries["vec_id"].to_numpy(), _matrix(queries["v"], d)
        q_norms = np.sqrt((q * q).sum(1))
        turned = ((q / q_norms[:, None]) @ rotation(d)).astype(np.float32)
        out: list[tuple[np.ndarray, ...]] = []
        for i in range(0, len(q_ids), 256):
            estimates = (signs @ turned[i : i + 256].T / np.sqrt(d)).T / c
            for j, est in enumerate(estimates, i):
                est[ids == q_ids[j]] = -np.inf
                n = min(len(est), 4 * k)
                first = np.argpartition(-est, n - 1)[:n]

                def exact(at, j=j):
                    return (v[at] * q[j]).sum(1) / (norms[at] * q_norms[j])

                s = exact(first)[est[first] > -np.inf]
                floor = np.sort(s)[-k] if len(s) >= k else -np.inf
                at = np.flatnonzero((est + error >= floor) & (est > -np.inf))  # in ascending vec_id
                s = exact(at)
                best = np.argsort(-s, kind="stable")[:k]
                out.append((np.full(len(best), q_ids[j]), ids[at[best]], s[best]))
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], schema=schema)

    return run


def nearest(vectors: DataFrame, queries: DataFrame | str, k: int = 5, key: str = "vec_id", vector: str = "embedding", epsilon: float = EPSILON) -> DataFrame:
    """For each query the k nearest rows by cosine: query_id, rank (from 1), vec_id, score.

    queries: an SQL condition on rows of `vectors`, or a table of its own with the same two columns. Rows with a null
    id, or whose vector is null, zero, or holds null or non-finite numbers, take no part, nor do vectors of another
    length than the commonest. Rows with the query's own id are not its neighbours. Ties go to the smaller id; a
    repeated id may appear once for each of its rows. Other columns are not read.
    """
    spark = vectors.sparkSession

    def sound(df: DataFrame) -> DataFrame:
        v = F.col(vector).cast("array<double>")
        df = df.select(F.col(key).cast("bigint").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
        finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.where(F.coalesce(finite, F.lit(False))).where(F.exists("v", lambda x: x != 0))

    rows = sound(vectors)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if lengths is None:
        return spark.createDataFrame([], result)
    d = lengths["d"]
    index = materialise(rows.where(F.size("v") == d).mapInArrow(_indexed(d), "vec_id bigint, code binary, c double, v array<double>").withColumn("at", F.monotonically_increasing_id()), "codes")
    asked = index.where(queries).select("vec_id", "v") if isinstance(queries, str) else sound(queries).where(F.size("v") == d)
    blocks, q_blocks = -(-index.count() // BLOCK), max(1, -(-asked.count() // QUERY_BLOCK))
    # Blocks go by place, so that rows that repeat an id are apart.
    base = index.withColumn("b", F.pmod(F.xxhash64("at"), F.lit(blocks))).drop("at").withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    ask = asked.withColumn("q", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(q_blocks)).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    near = base.groupBy("b", "q").cogroup(ask.groupBy("b", "q")).applyInArrow(_found(d, k, epsilon), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

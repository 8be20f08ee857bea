"""Shared pieces of the training-data operators: shared scratch folder, stable intermediate tables, literals."""

from __future__ import annotations

import atexit
import json
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..session import ship


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir; a temporary one where it is unset and all run in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strandloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a table of the scratch folder, in whatever store it lies."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: Settings of a write: small Arrow batches keep Python workers small; Spark removes a write's shuffle files as it ends.
_WRITE = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.execution.arrow.maxRecordsPerBatch": "8192",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
_lock = threading.Lock()
_writers: dict[int, tuple[int, dict[str, str]]] = {}
_left: list[tuple[SparkSession, str]] = []


@atexit.register
def _sweep() -> None:
    for spark, path in _left:
        try:
            delete(spark, path)
        except Exception:  # the session may have ended before
            return


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch folder, removed when the driver's process ends."""
    path = f"{scratch_dir(spark)}/strandloom-{name}-{uuid.uuid4().hex}"
    _left.append((spark, path))
    return path


@contextmanager
def _writing(spark: SparkSession, batch: str):
    """The settings of a write; the first writer of a session keeps what was set, the last one sets it again."""
    with _lock:
        n, kept = _writers.get(id(spark), (0, None))
        kept = kept or {k: spark.conf.get(k) for k in _WRITE}
        _writers[id(spark)] = n + 1, kept
        for k, v in (_WRITE | {"spark.sql.execution.arrow.maxBytesPerBatch": batch}).items():
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _lock:
            n, kept = _writers.pop(id(spark))
            if n > 1:
                _writers[id(spark)] = n - 1, kept
            else:
                for k, v in kept.items():
                    spark.conf.set(k, v)


def materialise(df: DataFrame, name: str, batch: str = "8m", codec: str = "zstd") -> DataFrame:
    """Write df as Parquet below the scratch folder and read it back.

    Cuts the lineage: what follows reads files that survive a lost executor, and rows keep the values they were
    first given. The table is removed when the driver's process ends, or by discard().
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _writing(spark, batch):
        df.write.option("compression", codec).parquet(path)
    return tabled(spark.read.schema(df.schema).parquet(path), path)


def collected(df: DataFrame, batch: str = "8m") -> list[Row]:
    """The few rows of df, made with the settings of a write."""
    with _writing(df.sparkSession, batch):
        return df.collect()


def tabled(df: DataFrame, path: str | None) -> DataFrame:
    """df, whose rows lie in the table at path, so that discard() finds it."""
    df._strandloom_path = path
    return df


def discard(*tables: DataFrame | None) -> None:
    """Remove materialised tables that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_strandloom_path", None):
            delete(df.sparkSession, path)


def stated(spark: SparkSession, rows: list[dict], schema: str, name: str) -> DataFrame:
    """The driver's rows as a table of JSON lines below the scratch folder: no literal in the plan, nothing to send again."""
    path = scratch_path(spark, name)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where)
    for i in range(0, len(rows), 10_000):
        out.write("".join(json.dumps(x) + "\n" for x in rows[i : i + 10_000]).encode())
    out.close()
    return tabled(spark.read.schema(schema).json(path), path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def long_array(values) -> Column:
    """A foldable array<bigint> literal of any length."""
    values = list(values)
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def json_literal(value, schema: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), schema)


def upper_bound(array: Column, n: int, below) -> Column:
    """How many of the array's n ascending entries satisfy below(entry): a binary search as a fold, without a join."""
    steps = []
    step = 1 << max(n, 1).bit_length()
    while step:
        steps.append(step)
        step >>= 1
    return F.aggregate(
        long_array(steps), F.lit(0).cast("bigint"),
        lambda at, s: F.when((at + s <= n) & below(F.get(array, (F.least(at + s, F.lit(max(n, 1))) - 1).cast("int"))), at + s).otherwise(at),
    )


#: Keys over which the rows of a hot key are dealt.
PARTS = 64


def hot_keys(counts: DataFrame, keys: list[str], share: float, total: int | None = None) -> DataFrame:
    """Of (keys, rows) those that hold more than this share of all rows, so at most 1 / share of them; no table of the driver grows."""
    total = counts.agg(F.sum("rows")).first()[0] or 0 if total is None else total
    found = counts.where(F.col("rows") > max(share * total, 1)).select(*keys, F.lit(True).alias("is_hot"))
    return counts.sparkSession.createDataFrame(found.collect(), found.schema)


def dealt(rows: DataFrame, hot: DataFrame, keys: list[str], by: Column) -> DataFrame:
    """With `part`, by which rows of hot keys are dealt over PARTS keys; that of all others is 0."""
    return rows.join(F.broadcast(hot), keys, "left").withColumn("part", F.when(F.col("is_hot"), F.pmod(F.xxhash64(by), F.lit(PARTS))).otherwise(0).cast("int")).drop("is_hot")


def for_all(rows: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """With `part`: the few rows of hot keys once for each."""
    parts = F.when(F.col("is_hot"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    return rows.join(F.broadcast(hot), keys, "left").withColumn("part", F.explode(parts)).drop("is_hot")

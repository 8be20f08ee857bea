"""A store of named tables with metadata and a note, and file listings."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Store:
    """A folder of Parquet tables, one for each name, with a JSON note and metadata beside them, in any file system of Spark."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def save(self, readme: str | None = None, meta: dict | None = None, rewrite: bool = False, **tables: DataFrame) -> None:
        for name, df in tables.items():
            df.write.mode("overwrite" if rewrite else "error").parquet(f"{self.path}/{name}.parquet")
        if readme is not None or meta is not None:
            notes = self._notes() | ({"readme": readme} if readme is not None else {}) | {"meta": {**self._notes().get("meta", {}), **(meta or {})}}
            self.spark.createDataFrame([(json.dumps(notes),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/_notes")

    def _fs(self):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _notes(self) -> dict:
        fs, where = self._fs()
        note = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_notes")
        return json.loads(self.spark.read.text(f"{self.path}/_notes").first()["value"]) if fs.exists(where) and fs.exists(note) else {}

    def names(self) -> list[str]:
        fs, where = self._fs()
        return sorted(s.getPath().getName().removesuffix(".parquet") for s in fs.listStatus(where) if s.getPath().getName().endswith(".parquet")) if fs.exists(where) else []

    def load(self, name: str, columns: list[str] | None = None) -> DataFrame:
        df = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return df.select(*columns) if columns else df

    def look(self) -> dict[str, list[tuple[str, str]]]:
        return {n: self.load(n).dtypes for n in self.names()}

    def meta(self) -> dict:
        return self._notes().get("meta", {})

    def readme(self) -> str:
        return self._notes().get("readme", "")

    def delete(self, *names: str) -> None:
        fs, _ = self._fs()
        for n in names:
            fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}.parquet"), True)


def files(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """path, name, length and modificationTime of the files of a folder whose names match."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    out = reader.load(path).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modificationTime")
    return out.where(F.col("name").rlike(pattern)) if pattern else out

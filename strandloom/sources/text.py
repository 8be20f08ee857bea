"""Typed tab-separated tables, labelled matrices, line scans, sinks."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Header marks. n and f read empty fields and NA as 0 and NaN, X drops the column, T keeps quotes.
MARKS = {"N": "bigint", "n": "bigint", "F": "double", "f": "double", "B": "boolean", "S": "string", "T": "string", "C": "string", "X": None}
NA = ["", "NA", "na", "N/A", "NaN", "nan", "Inf", "null", "NULL"]
_MARK = re.compile(r"^([NnFfBSTCX])::(.*)$")


def parse_header(line: str, sep: str = "\t") -> list[tuple[str, str, bool]]:
    """(name, mark, joined to the column before) of each field; a last "..." or "<<<" takes all further fields."""
    out = []
    for field in line.removeprefix("#:: ").rstrip("\r\n").split(sep):
        joined = field.startswith("<") and field != "<<<"
        m = _MARK.match(field[1:] if joined else field)
        out.append((m[2], m[1], joined) if m else (field[1:] if joined else field, "", joined))
    return out


def _typed(x: Column, mark: str) -> Column:
    kind = MARKS.get(mark, "string")
    if mark == "n":
        x = F.when(x.isin(NA), "0").otherwise(x)
    if mark == "f":
        x = F.when(x.isin(NA), "NaN").otherwise(x)
    if mark == "B":
        return F.when(F.lower(x).isin("true", "t", "1", "yes"), True).when(F.lower(x).isin("false", "f", "0", "no"), False).otherwise(F.raise_error(F.concat(F.lit("no boolean: "), x)).cast("boolean"))
    if mark == "C":
        return F.when(F.length(x) == 1, x).otherwise(F.raise_error(F.concat(F.lit("no single character: "), x)).cast("string"))
    if mark in ("", "S"):
        return F.regexp_replace(x, '^"(.*)"$', "$1")
    return x.cast(kind)


def read_table(spark: SparkSession, path: str, sep: str = "\t", header: str | None = None, skip: int = 0, infer: bool = False) -> DataFrame:
    """A typed table from text, gzip or not. The header is the argument or the first line that is no comment ("#:: " marks
    a header inside a comment). Rows of another width are errors; lines that begin with # are comments. `_rid` keeps order."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("_rid"))
    head_line = None
    if header is None:
        start = max((r["_rid"] for r in lines.orderBy("_rid").limit(skip).collect()), default=-1) if skip else -1
        head = F.col("value").startswith("#:: ") | ((F.col("value") != "") & ~F.col("value").startswith("#"))
        head_line = next(iter(lines.where((F.col("_rid") > start) & head).orderBy("_rid").limit(1).collect()), None)
        if head_line is None:
            raise ValueError("no header")
        header = head_line["value"]
    fields = parse_header(header, sep)
    last = fields[-1][0]
    open_ended = last in ("...", "<<<")
    named = fields[:-1] if open_ended else fields
    body = lines.where(~F.col("value").startswith("#") & (F.col("value") != ""))
    if head_line is not None:
        body = body.where(F.col("_rid") > head_line["_rid"])
    elif skip:
        first = [r["_rid"] for r in lines.orderBy("_rid").limit(skip).collect()]
        body = body.where(F.col("_rid") > max(first, default=-1))
    parts = F.split("value", re.escape(sep), -1)
    wide = F.size(parts) >= len(named) if open_ended else F.size(parts) == len(named)
    checked = F.when(wide, parts).otherwise(F.raise_error(F.concat(F.lit("wrong number of fields: "), F.col("value"))).cast("array<string>"))
    body = body.select("_rid", checked.alias("p"))
    columns: list[tuple[str, list[Column]]] = []
    for i, (name, mark, joined) in enumerate(named):
        if mark == "X":
            continue
        x = _typed(F.get("p", F.lit(i)), mark or (columns and joined and "F") or "")
        if joined and columns:
            columns[-1][1].append(x)
        else:
            columns.append((name, [x]))
    if last == "<<<" and columns:
        name, xs = columns[-1]
        mark = named[-1][1]
        rest = F.transform(F.slice("p", len(named) + 1, F.greatest(F.size("p") - len(named), F.lit(0))), lambda v: _typed(v, mark))
        columns[-1] = (name, [F.concat(F.array(*xs), rest)])
        out = body.select("_rid", *(x[0].alias(n) if n == name else (F.array(*x).alias(n) if len(x) > 1 else x[0].alias(n)) for n, x in columns))
    else:
        out = body.select("_rid", *(F.array(*x).alias(n) if len(x) > 1 else x[0].alias(n) for n, x in columns))
    return infer_types(out, [n for (n, _), (_, m, _) in zip(columns, named, strict=False) if not m]) if infer else out


def infer_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text columns as boolean, bigint or double where every value allows it: one aggregate, then casts."""
    columns = [c for c in columns if dict(df.dtypes)[c] == "string"]
    if not columns:
        return df
    tests = {"boolean": lambda c: F.lower(c).isin("true", "false"), "bigint": lambda c: F.col(c).try_cast("bigint").isNotNull() & ~F.col(c).contains("."), "double": lambda c: F.col(c).try_cast("double").isNotNull()}
    found = df.agg(*(F.coalesce(F.bool_and(f(c)), F.lit(False)).alias(f"{c}:{k}") for c in columns for k, f in tests.items())).first()
    return df.withColumns({c: F.col(c).cast(next((k for k in tests if found[f"{c}:{k}"]), "string")) for c in columns})


def write_table(df: DataFrame, path: str, spec: str | None = None, sep: str = "\t", with_type: bool = True, mode: str = "error") -> None:
    """A table as text with typed header marks; spec "a=>b,c" selects and renames, else all columns by name."""
    from ..operators.tables import select_as

    df = select_as(df, spec) if spec else df.select(*sorted(df.columns))
    mark = {"bigint": "N::", "int": "N::", "double": "F::", "float": "F::", "boolean": "B::"}
    names = {c: (mark.get(k, "") if with_type else "") + c for c, k in df.dtypes}
    df.toDF(*names.values()).write.mode(mode).csv(path, sep=sep, header=True, quote="", escape="")


def read_matrix(spark: SparkSession, path: str, sep: str = "\t", skip: int = 0, ignore: str | None = None, column_head: bool = True, name: str = "column", value: str = "value") -> DataFrame:
    """A labelled matrix (first column row heads, first line column heads) in long form: row, column, value."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("_rid"))
    if ignore:
        lines = lines.where(~F.col("value").startswith(ignore))
    if skip:
        lines = lines.where(F.col("_rid") > max((r["_rid"] for r in lines.orderBy("_rid").limit(skip).collect()), default=-1))
    first = lines.orderBy("_rid").limit(1).first()
    heads = first["value"].split(sep)[1:] if column_head and first else []
    body = lines.where(F.col("_rid") > first["_rid"]) if column_head and first else lines
    parts = body.select("_rid", F.split("value", re.escape(sep), -1).alias("p"))
    cell = parts.select("_rid", F.get("p", F.lit(0)).alias("row"), F.posexplode(F.slice("p", 2, F.size("p") - 1)).alias("i", "v"))
    label = F.get(F.array(*map(F.lit, heads)), F.col("i")) if heads else (F.col("i") + 1).cast("string")
    return cell.select("row", label.alias(name), F.col("v").cast("double").alias(value))


def matrix_rows(df: DataFrame, row: str, column: str, value: str, columns: list[str], corner: str = "") -> DataFrame:
    """A long matrix as labelled rows for a sink."""
    return df.groupBy(F.col(row).alias(corner or row)).pivot(column, columns).agg(F.first(value))


def line_map(spark: SparkSession, path: str, f: Callable, schema: str | T.StructType, skip: int = 0, ignore: str | None = None, each: int = 1, limit: int = 0) -> DataFrame:
    """f(line or list of lines) -> rows, over the lines of a text, in parallel; with each > 1 lines come in numbered chunks."""
    from pyspark.sql import Window

    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("_rid"))
    if ignore:
        lines = lines.where(~F.col("value").startswith(ignore))
    if skip or limit:
        kept = lines.orderBy("_rid").offset(skip)
        lines = kept.limit(limit) if limit else kept
    if each > 1:
        lines = lines.withColumn("__c", F.floor((F.row_number().over(Window.orderBy("_rid")) - 1) / each))
        lines = lines.groupBy("__c").agg(F.transform(F.array_sort(F.collect_list(F.struct("_rid", "value"))), lambda x: x.value).alias("value"))

    def run(frames):
        import pandas as pd

        names = [x.name for x in kinds.fields]
        for pdf in frames:
            rows = [r for v in pdf["value"] for r in (f(v if isinstance(v, str) else list(v)) or ())]
            yield pd.DataFrame(rows, columns=names)

    kinds = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return lines.select("value").mapInPandas(run, kinds)


def write_lines(df: DataFrame, column: str, path: str, append: bool = False) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("append" if append else "error").text(path)

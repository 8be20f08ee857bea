"""Equi-joins with default values, lookups, membership, replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import fill_empty, first_rows


def _unique(df: DataFrame, keys: list[str]) -> bool:
    return df.groupBy(*keys).count().where("count > 1").isEmpty()


def table_join(a: DataFrame, b: DataFrame, on: list[str] | list[tuple[str, str]], fill: str = "none", expand: str = "AB", a_order: list[str] | None = None, b_order: list[str] | None = None,
               a_unique: bool = False, b_unique: bool = False, a_full: bool = False, b_full: bool = False, a_prefix: str = "", b_prefix: str = "", keep_null: bool = False) -> DataFrame:
    """The table join. fill names the side that is completed: none (inner), B (left), A (right), AB (full outer).

    expand: AB all pairs, A the first b for each a, none one pair for each key ("first" by a_order or b_order). Filled
    columns hold their type's empty value, or null with keep_null; nulls of matched rows are kept. The unique options
    demand that matched rows of that side do not fan out, the full options that each row matches. Columns of b that a
    has too need a prefix.
    """
    pairs = [(k, k) if isinstance(k, str) else k for k in on]
    a_keys, b_keys = [p[0] for p in pairs], [p[1] for p in pairs]
    if expand in ("A", "none"):
        b = first_rows(b, b_keys, b_order or [c for c in b.columns if c not in b_keys])
    if expand == "none":
        a = first_rows(a, a_keys, a_order or [c for c in a.columns if c not in a_keys])
    if a_unique and not _unique(b.join(a.select(*(F.col(x).alias(y) for x, y in pairs)).distinct(), b_keys, "left_semi"), b_keys):
        raise ValueError("rows of a match more than one row of b")
    if b_unique and not _unique(a.join(b.select(*(F.col(y).alias(x) for x, y in pairs)).distinct(), a_keys, "left_semi"), a_keys):
        raise ValueError("rows of b match more than one row of a")
    left = a.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(a_keys)), F.lit(True).alias("__a"), *(F.col(c).alias(f"{a_prefix}{c}" if c not in a_keys else c) for c in a.columns if c not in a_keys))
    right = b.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(b_keys)), F.lit(True).alias("__b"), *(F.col(c).alias(f"{b_prefix}{c}") for c in b.columns if c not in b_keys))
    how = {"none": "inner", "B": "left", "A": "right", "AB": "full"}[fill]
    clash = (set(left.columns) & set(right.columns)) - {f"__k{i}" for i in range(len(pairs))}
    if clash:
        raise ValueError(f"columns of both tables need a prefix: {sorted(clash)}")
    out = left.join(right, [f"__k{i}" for i in range(len(pairs))], how)
    if a_full or b_full:
        whole = left.join(right, [f"__k{i}" for i in range(len(pairs))], "full")
        for flag, side, other in ((a_full, "a", "__b"), (b_full, "b", "__a")):
            if flag and not whole.where(F.col(other).isNull()).isEmpty():
                raise ValueError(f"rows of {side} without a match")
    if not keep_null:
        if fill in ("B", "AB"):
            out = fill_empty(out, [c for c in right.columns if not c.startswith("__")], F.col("__b").isNotNull())
        if fill in ("A", "AB"):
            out = fill_empty(out, [c for c in left.columns if not c.startswith("__")], F.col("__a").isNotNull())
    rest = [c for c in out.columns if not c.startswith("__")]
    return out.select(*(F.col(f"__k{i}").alias(k) for i, k in enumerate(a_keys)), *rest)


def lookup(df: DataFrame, keys: list[str], source: DataFrame, source_keys: list[str], values: list[str], default: Column | None = None, empty: bool = False, safe: bool = False, order_by: list[str] | None = None) -> DataFrame:
    """The values at the first match of each row's key. A miss gets `default`, the empty value, or else is an error."""
    found = source.groupBy(*source_keys)
    first = F.min_by(F.struct(*values), F.struct(*(order_by or values)))
    if safe:
        many = F.min(F.struct(*values)).eqNullSafe(F.max(F.struct(*values)))
        first = F.when(many, first).otherwise(F.raise_error(F.lit("ambiguous key")).cast(source.select(F.struct(*values).alias("x")).schema["x"].dataType))
    found = found.agg(first.alias("__v")).select(*(F.col(k).alias(f"__{i}") for i, k in enumerate(source_keys)), "__v")
    on = [F.col(k) == F.col(f"__{i}") for i, k in enumerate(keys)]
    out = df.join(found, on, "left").withColumns({v: F.col(f"__v.{v}") for v in values}).withColumn("__hit", F.col("__0").isNotNull())
    if empty:
        out = fill_empty(out, values, F.col("__hit"))
    else:
        kinds = {f.name: f.dataType for f in source.schema}
        miss = {v: default if default is not None else F.raise_error(F.lit("no match for a key")).cast(kinds[v]) for v in values}
        out = out.withColumns({v: F.when(F.col("__hit"), F.col(v)).otherwise(miss[v]) for v in values})
    return out.select(*(c for c in df.columns if c not in values), *values)


def replace_values(value: Column, pairs: dict, others: Column | None = None) -> Column:
    """Remap by a small literal map; values that are not in it stay, or become `others`."""
    table = F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(table, value), value if others is None else others)


def replace_by_table(df: DataFrame, column: str, source: DataFrame, old: str, new: str, others: Column | None = None) -> DataFrame:
    """Remap by a table of any size, first pair by the new value."""
    pairs = source.groupBy(F.col(old).alias("__old")).agg(F.min(new).alias("__new"))
    out = df.join(pairs, F.col(column) == F.col("__old"), "left")
    kept = F.col(column) if others is None else others
    return out.withColumn(column, F.when(F.col("__old").isNotNull(), F.col("__new")).otherwise(kept)).drop("__old", "__new")


def members(a: DataFrame, b: DataFrame, on: list[tuple[str, str]], negate: bool = False) -> DataFrame:
    """Rows of a whose key b has (or has not)."""
    keys = b.select(*(F.col(y).alias(x) for x, y in on)).distinct()
    return a.join(keys, [x for x, _ in on], "left_anti" if negate else "left_semi")


def member_flag(a: DataFrame, b: DataFrame, on: list[tuple[str, str]], name: str = "is_member") -> DataFrame:
    keys = b.select(*(F.col(y).alias(x) for x, y in on)).distinct().withColumn(name, F.lit(True))
    return a.join(keys, [x for x, _ in on], "left").withColumn(name, F.coalesce(name, F.lit(False)))


def member_index(a: DataFrame, b: DataFrame, on: list[tuple[str, str]], position: str, name: str = "index") -> DataFrame:
    """The position of the first match in b, 0 if there is none."""
    first = b.groupBy(*(F.col(y).alias(x) for x, y in on)).agg(F.min(position).alias(name))
    return a.join(first, [x for x, _ in on], "left").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))


def index_pairs(a: DataFrame, b: DataFrame, on: list[tuple[str, str]], a_row: str, b_row: str, unique_b: bool = False) -> DataFrame:
    """(key, a_row, b_row) of all matches; with unique_b the first b for each a."""
    right = b.select(*(F.col(y).alias(x) for x, y in on), F.col(b_row).alias("b_row"))
    if unique_b:
        right = right.groupBy(*(x for x, _ in on)).agg(F.min("b_row").alias("b_row"))
    return a.select(*(x for x, _ in on), F.col(a_row).alias("a_row")).join(right, [x for x, _ in on])


def intersect_pairs(a: DataFrame, b: DataFrame, on: list[tuple[str, str]], a_row: str, b_row: str) -> DataFrame:
    """One pair of first rows for each common key."""
    left = a.groupBy(*(x for x, _ in on)).agg(F.min(a_row).alias("a_row"))
    right = b.groupBy(*(F.col(y).alias(x) for x, y in on)).agg(F.min(b_row).alias("b_row"))
    return left.join(right, [x for x, _ in on])


def combinations(*tables: DataFrame) -> DataFrame:
    """All combinations of the rows of small dimension tables; the result is as large as the product asked for."""
    out = tables[0]
    for t in tables[1:]:
        out = out.crossJoin(t)
    return out

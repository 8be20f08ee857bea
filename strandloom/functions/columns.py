"""Scalar column functions: default values, chromosome codes, interval arithmetic, strings, numbers as text, sequences."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def empty_value(kind: T.DataType) -> Column:
    """The value that stands for "nothing" in a type: 0, false, NaN, "" or, for nested types, an empty one."""
    match kind:
        case T.BooleanType():
            return F.lit(False)
        case T.FloatType() | T.DoubleType():
            return F.lit(float("nan")).cast(kind)
        case T.IntegralType() | T.DecimalType():
            return F.lit(0).cast(kind)
        case T.StringType():
            return F.lit("")
        case T.ArrayType():
            return F.array().cast(kind)
        case T.MapType():
            return F.create_map().cast(kind)
    return F.lit(None).cast(kind)


# ---- genome ------------------------------------------------------------------------------------------------------

# Chromosomes that are not plain numbers, and their codes.
CHROMOSOMES = {"I": 1, "II": 2, "III": 3, "IV": 4, "V": 5, "X": 31, "Y": 32, "M": 41, "MT": 41, "MtDNA": 41, "2a": 51, "2b": 52, "2A": 51, "2B": 52}


def chr_code(name: ColumnLike) -> Column:
    """Code of a chromosome name, with or without a chr, Chr or CHROMOSOME_ prefix; 0 for others."""
    bare = F.regexp_replace(_c(name), "^(chr|Chr|CHR|CHROMOSOME_)", "")
    special = F.create_map(*[x for k, v in CHROMOSOMES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(special, bare), F.when(bare.rlike(r"^[0-9]{1,9}$"), bare).cast("int"), F.lit(0))


def chr_name(code: ColumnLike, prefix: str = "chr", worm: bool = False) -> Column:
    """Inverse of chr_code; roman numerals for the worm."""
    names = {31: "X", 32: "Y", 41: "M", 51: "2a", 52: "2b"} | ({1: "I", 2: "II", 3: "III", 4: "IV", 5: "V", 31: "X", 41: "MtDNA"} if worm else {})
    named = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    return F.concat(F.lit(prefix), F.coalesce(F.element_at(named, _c(code).cast("int")), _c(code).cast("string")))


def seg_length(start: ColumnLike, end: ColumnLike, check: bool = True) -> Column:
    """end - start + 1; 0 for the empty segment (0, 0); an error for other segments below 1."""
    n = _c(end) - _c(start) + 1
    bad = F.raise_error(F.lit("segment shorter than 1")).cast("bigint") if check else n
    return F.when((_c(start) == 0) & (_c(end) == 0), F.lit(0).cast("bigint")).when(n < 1, bad).otherwise(n).cast("bigint")


def overlap_length(a_start: ColumnLike, a_end: ColumnLike, b_start: ColumnLike, b_end: ColumnLike) -> Column:
    return F.least(_c(a_end), _c(b_end)) - F.greatest(_c(a_start), _c(b_start)) + 1


def sam_strand(flag: ColumnLike, paired: bool = False) -> Column:
    """+ or - from bit 16 of the flag; the second mate (bit 128) counts reversed when paired."""
    minus = _c(flag).bitwiseAND(16) != 0
    if paired:
        minus = minus != (_c(flag).bitwiseAND(128) != 0)
    return F.when(minus, "-").otherwise("+")


# ---- sequences ---------------------------------------------------------------------------------------------------


def reverse_complement(seq: ColumnLike) -> Column:
    return F.reverse(F.translate(_c(seq), "ACGTUNacgtun", "TGCAANtgcaan"))


def cigar_segments(cigar: ColumnLike, start: ColumnLike) -> Column:
    """Reference segments of an alignment as array<struct<start,end>>: N splits, M and D advance, I, S and H do not."""
    cigar = _c(cigar)
    lengths = F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+)[A-Z=]"), F.lit(1)), lambda x: x.cast("bigint"))
    ops = F.regexp_extract_all(cigar, F.lit(r"\d+([A-Z=])"), F.lit(1))
    seg = "array<struct<start:bigint,end:bigint>>"
    zero = F.struct(_c(start).cast("bigint").alias("at"), _c(start).cast("bigint").alias("open"), F.array().cast(seg).alias("done"))

    def step(acc, x):
        n, op = x["lengths"], x["ops"]
        closed = F.when(acc.at > acc.open, F.concat(acc.done, F.array(F.struct(acc.open.alias("start"), (acc.at - 1).alias("end"))))).otherwise(acc.done)
        return (
            F.when(op.isin("M", "D"), F.struct((acc.at + n).alias("at"), acc.open.alias("open"), acc.done.alias("done")))
            .when(op == "N", F.struct((acc.at + n).alias("at"), (acc.at + n).alias("open"), closed.alias("done")))
            .when(op.isin("I", "S", "H"), acc)
            .otherwise(F.raise_error(F.concat(F.lit("unsupported CIGAR operation "), op)).cast("struct<at:bigint,open:bigint,done:" + seg + ">"))
        )

    def last(acc):
        return F.when(acc.at > acc.open, F.concat(acc.done, F.array(F.struct(acc.open.alias("start"), (acc.at - 1).alias("end"))))).otherwise(acc.done)

    return F.aggregate(F.arrays_zip(lengths.alias("lengths"), ops.alias("ops")), zero, step, last)


def reading_frames(seq: str) -> list[tuple[int, int]]:
    """(start, end), 1-based, of each ATG and the last stop that letters alone join to it in frame: one pass over the text."""
    a = np.frombuffer(seq.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(a) < 6:
        return []
    x, y, z = a[:-2], a[1:-1], a[2:]
    first, second, third = ({c: v == ord(c) for c in "ATG"} for v in (x, y, z))
    letter = (a >= ord("A")) & (a <= ord("Z"))
    start = first["A"] & second["T"] & third["G"]
    stop = first["T"] & ((second["A"] & (third["A"] | third["G"])) | (second["G"] & third["A"]))
    broken = ~(letter[:-2] & letter[1:-1] & letter[2:])
    found = []
    for frame in range(3):
        starts, stops, breaks = (np.flatnonzero(v[frame::3]) for v in (start, stop, broken))
        upto = np.append(breaks, len(a))[np.searchsorted(breaks, starts)]
        last = np.append(-1, stops)[np.searchsorted(stops, upto)]
        found += [(3 * i + frame + 1, 3 * j + frame + 3) for i, j in zip(starts.tolist(), last.tolist(), strict=True) if j > i]
    return sorted(found)


def orfs(seq: ColumnLike) -> Column:
    """Open reading frames from each ATG to the last in-frame stop, as array<struct<start,end>> (1-based)."""

    @F.pandas_udf("array<struct<start:bigint,end:bigint>>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: None if s is None else [{"start": i, "end": j} for i, j in reading_frames(s)])

    return run(F.upper(_c(seq)))


# ---- strings -----------------------------------------------------------------------------------------------------


def contains_any(value: ColumnLike, needles: list[str], how: str = "contains") -> Column:
    """Whether the value contains, starts with, ends with or matches any of the needles."""
    tests = {"contains": lambda n: _c(value).contains(n), "startswith": lambda n: _c(value).startswith(n), "endswith": lambda n: _c(value).endswith(n), "regex": lambda n: _c(value).rlike(n)}
    out = F.lit(False)
    for n in needles:
        out = out | tests[how](n)
    return out


def first_match(values: ColumnLike, needle: str, how: str = "contains") -> Column:
    """struct<value,index>: the first array element that matches and its 1-based place; (null, 0) if none does."""
    index = F.array_position(F.transform(_c(values), lambda x: contains_any(x, [needle], how)), True)
    return F.struct(F.when(index > 0, F.get(_c(values), (index - 1).cast("int"))).alias("value"), index.cast("bigint").alias("index"))


def cut(value: ColumnLike, spec: str, sep: str = "-") -> Column:
    """Pick parts of a split text: "2", "-2" (from the end is "end", "end-1"), "2:end", "1,3"; a trailing + joins with +.

    A leading character that is no digit, colon or letter names the separator: "-2:end+" splits at "-" and joins with "+".
    """
    if spec and not spec[0].isalnum() and spec[0] != ":":
        sep, spec = spec[0], spec[1:]
    join = sep
    if spec and not spec[-1].isalnum():
        join, spec = spec[-1], spec[:-1]
    parts = F.split(_c(value), "\\Q" + sep + "\\E")

    def place(x: str) -> Column:
        x = x.strip()
        return F.size(parts) - F.lit(int(x[4:] or 0)) if x.startswith("end") else F.lit(int(x))

    picked = []
    for piece in spec.split(","):
        if ":" in piece:
            a, b = piece.split(":")
            picked.append(F.slice(parts, place(a), F.greatest(place(b) - place(a) + 1, F.lit(0))))
        else:
            picked.append(F.array(F.element_at(parts, place(piece))))
    return F.array_join(F.concat(*picked), join)


def template(pattern: str, *values: ColumnLike) -> Column:
    """"$1-$2" with the values in place of $1, $2, ...; $$ is a dollar sign."""
    out, rest = [], pattern
    while rest:
        head, dollar, rest = rest.partition("$")
        if head:
            out.append(F.lit(head))
        if not dollar:
            break
        if rest[:1] == "$":
            out.append(F.lit("$"))
            rest = rest[1:]
            continue
        digits = len(rest) - len(rest.lstrip("0123456789"))
        out.append(_c(values[int(rest[:digits]) - 1]).cast("string"))
        rest = rest[digits:]
    return F.concat(*out) if out else F.lit("")


def number_text(x: ColumnLike, min_digits: int = 0, max_decimals: int | None = None, fill: str = "0") -> Column:
    """A number as text: whole values without decimals, others rounded if asked, padded on the left."""
    x = _c(x).cast("double")
    x = F.round(x, max_decimals) if max_decimals is not None else x
    text = F.when(x == F.floor(x), F.floor(x).cast("string")).otherwise(x.cast("string"))
    return F.when(F.length(text) < min_digits, F.lpad(text, min_digits, fill)).otherwise(text)


def si_number(x: ColumnLike, decimals: int = 1, largest: str = "T") -> Column:
    """A number with an SI prefix, at most the largest: 1500 is 1.5k, 0.002 is 2m, and up to M 2000000000 is 2000M."""
    units = ["p", "n", "u", "m", "", "k", "M", "G", "T"]
    x = _c(x).cast("double")
    power = F.when(x == 0, 0).otherwise(F.least(F.greatest(F.floor(F.log10(F.abs(x)) / 3 + 1e-12), F.lit(-4)), F.lit(units.index(largest) - 4)))
    unit = F.element_at(F.array(*map(F.lit, units)), (power + 5).cast("int"))
    return F.concat(number_text(x / F.pow(F.lit(1000.0), power), max_decimals=decimals), unit)


def to_int(x: ColumnLike) -> Column:
    """Text or number to bigint, also from "1.0"; null where that is no number."""
    return _c(x).try_cast("double").cast("bigint")

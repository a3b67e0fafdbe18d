"""Names, predicates, day casts and row fingerprints as Spark column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Full-precision formats, so that rendering a timestamp never drops microseconds.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Any constant will do, so long as it stays the same.
_SECOND_SEED = 0x5DEECE66D

# String literals, names in backticks, and quoted names, whichever begins first.
_QUOTED = re.compile(r"""'(?:[^'\\]|\\.|'')*'|`[^`]*`|"(?:[^"]|"")*\"""", re.S)

_JSON_OPTIONS = {
    "timestampFormat": TIMESTAMP_FORMAT,
    "timestampNTZFormat": TIMESTAMP_NTZ_FORMAT,
    "ignoreNullFields": "false",
}


def backticked(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """The column called ``name``, which may be given bare or ``"Quoted"`` as in SQL.

    Dots and spaces in the name are part of the name.
    """
    if len(name) > 1 and name[0] == name[-1] and name[0] in "\"`":
        name = name[1:-1].replace(name[0] * 2, name[0])
    return F.col(backticked(name))


def quoted_names(text: str, names: Iterable[str]) -> str:
    """SQL text with ``"Name"`` rewritten to a Spark identifier for the given columns.

    Outside ANSI identifier mode Spark reads ``"Name"`` as a string literal, which
    would silently turn a filter on a column into a filter on a constant. Names are found whatever
    their case, an exact one first; a name that is no column raises. What stands in string
    literals or in backticks is left alone.
    """
    held = list(names)

    def resolved(token: re.Match) -> str:
        if not token[0].startswith('"'):
            return token[0]
        wanted = token[0][1:-1].replace('""', '"')
        found = [n for n in held if n == wanted] or [n for n in held if n.lower() == wanted.lower()]
        if len(found) != 1:
            raise ValueError(f"{token[0]} names {len(found) or 'none'} of the columns {held}")
        return backticked(found[0])

    return _QUOTED.sub(resolved, text)


def predicate(text: str, names: Iterable[str]) -> Column:
    return F.expr(quoted_names(text, names))


def day_of(name: str, dtype: T.DataType, fmt: str | None = None, lenient: bool = False) -> Column:
    """The calendar day of a date, timestamp or text column.

    Text is parsed with ``fmt`` when given, else as an ISO date or timestamp.
    ``lenient`` turns text that is not a date into null instead of failing the job.
    """
    col = column(name)
    if not isinstance(dtype, T.StringType):
        return F.to_date(col)
    if fmt is None:
        return col.try_cast("date") if lenient else col.cast("date")
    return F.try_to_date(col, fmt) if lenient else F.to_date(col, fmt)


def _canonical(col: Column, dtype: T.DataType) -> Column:
    """``col`` with one representation per value: maps in key order, no negative zero."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col + F.lit(0.0).cast(dtype)
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _canonical(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        entry = T.StructType(
            [T.StructField("key", dtype.keyType), T.StructField("value", dtype.valueType)]
        )
        by_key = F.array_sort(
            F.map_entries(col),
            lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0),
        )
        return F.transform(by_key, lambda x: _canonical(x, entry))
    if isinstance(dtype, T.StructType):
        fields = [_canonical(col[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    return col


def fingerprint(df: DataFrame) -> Column:
    """Two 64-bit hashes of the whole row, as a struct that is never null.

    Rows of one schema agree in it if they are equal, nulls included, and otherwise differ but
    for a chance of 2^-128, so rows can be matched by shuffling 16 bytes in place of the row.
    """
    values = [column(f.name) for f in df.schema.fields]
    hashed = [_hash_input(c, f.dataType) for c, f in zip(values, df.schema.fields)]
    # Spark's hash skips nulls, so which columns are null is hashed as well, 62 to a number.
    nulls = [
        reduce(add, [F.isnull(c).cast("long") * (1 << i) for i, c in enumerate(values[at : at + 62])])
        for at in range(0, len(values), 62)
    ]
    return F.struct(
        F.xxhash64(*nulls, *hashed).alias("a"),
        F.xxhash64(F.lit(_SECOND_SEED), *nulls, *hashed).alias("b"),
    )


def _hash_input(col: Column, dtype: T.DataType) -> Column:
    """``col`` as something whose hash tells all its values apart.

    Nulls inside arrays and structs would be skipped too; as JSON text they are not.
    """
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(_canonical(col, dtype), _JSON_OPTIONS)
    if isinstance(dtype, T.VariantType):
        return F.to_json(col)
    return _canonical(col, dtype)


def rendered(col: Column, dtype: T.DataType) -> Column:
    """``col`` as readable text, for difference reports."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(_canonical(col, dtype), _JSON_OPTIONS)
    if isinstance(dtype, T.BinaryType):
        return F.hex(col)
    if isinstance(dtype, T.TimestampType):
        # With its offset, since local times repeat when clocks are set back.
        return F.date_format(col, TIMESTAMP_FORMAT)
    return _canonical(col, dtype).cast("string")


def comparable(dtype: T.DataType) -> bool:
    """Whether values of a type can be ordered and hashed."""
    if isinstance(dtype, T.StructType):
        return all(comparable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return comparable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))

"""Projection-level operators: flatten, select, rename, header rules, casts,
outer union by name and the removal of all-null columns.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierlake import config


def q(name: str) -> str:
    """Back-quote a column name so blanks, dots and parentheses are literal."""
    return "`" + name.replace("`", "``") + "`"


# --- P1: flatten nested objects ---------------------------------------------

def flatten(df: DataFrame, sep: str = ".", prefix_roots: bool = True) -> DataFrame:
    """Replace every struct column by its leaves, named ``parent<sep>child``.

    Arrays and maps stay as they are. A NULL parent gives NULL leaves. Pure
    projection, so it sits inside the scan's codegen stage.
    """
    out = []

    def walk(path: list[str], dtype: T.DataType):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(path + [f.name], f.dataType)
        else:
            ref = F.col(q(path[0]))
            for p in path[1:]:
                ref = ref.getField(p)
            out.append(ref.alias(sep.join(path) if prefix_roots else path[-1]))

    for f in df.schema.fields:
        walk([f.name], f.dataType)
    return df.select(*out)


# --- P2, P3, P8, P9: select, rename, drop ------------------------------------

def pick(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep ``columns`` in the given order. Absent columns are an error, as in
    the feeds: the column lists are the contract with the source."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not in input: {missing}")
    return df.select(*[F.col(q(c)) for c in columns])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by dict; names not present are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


# --- P4: header normalisation -------------------------------------------------

_NON_ALNUM = re.compile(r"[^0-9A-Za-z]+")


def header_rule(raw: str) -> str:
    """Runs of non-alphanumerics become one ``_``; no leading/trailing ``_``."""
    return _NON_ALNUM.sub("_", raw).strip("_")


def export_header_map(headers: list[str] | None = None,
                      overrides: dict[str, str] | None = None) -> dict[str, str]:
    headers = config.EXPORT_HEADERS if headers is None else headers
    overrides = config.EXPORT_HEADER_OVERRIDES if overrides is None else overrides
    return {h: overrides.get(h, header_rule(h)) for h in headers}


def normalise_headers(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename the known export headers; unknown headers are kept unchanged and
    known headers that are absent are ignored."""
    return rename(df, export_header_map() if mapping is None else mapping)


# --- P5: bulk cast to text ----------------------------------------------------

def cast_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Cast the listed columns that are present to STRING; NULL stays NULL."""
    columns = config.EXPORT_TEXT_COLUMNS if columns is None else columns
    todo = {c: F.col(q(c)).cast("string") for c in columns
            if c in df.columns and not isinstance(df.schema[c].dataType, T.StringType)}
    return df.withColumns(todo) if todo else df


# --- U2: union all by name, missing columns as NULL ---------------------------

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBER = _WHOLE + (T.FloatType, T.DoubleType, T.DecimalType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both: equal types stay, whole numbers
    meet in bigint, other numbers in double, dates and stamps in a stamp
    without zone; everything else meets in text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return T.LongType()
    if isinstance(a, _NUMBER) and isinstance(b, _NUMBER):
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def common_schema(schemas: list[T.StructType]) -> T.StructType:
    """Outer union by name in order of first appearance, each column with the
    common type of all schemas that have it."""
    merged: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            merged[f.name] = common_type(merged[f.name], f.dataType) if f.name in merged else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in merged.items()])


def union_outer(frames: list[DataFrame]) -> DataFrame:
    """Union all by column name; a column missing from a frame is NULL there,
    one that has different types is cast to their :func:`common_type`. Column
    order is order of first appearance. Balanced pairing keeps the plan depth
    logarithmic in the number of frames."""
    if not frames:
        raise ValueError("union_outer needs at least one frame")
    types = {f.name: f.dataType for f in common_schema([df.schema for df in frames]).fields}
    level = []
    for df in frames:
        unlike = {f.name: F.col(q(f.name)).cast(types[f.name]) for f in df.schema.fields if f.dataType != types[f.name]}
        level.append(df.withColumns(unlike) if unlike else df)
    while len(level) > 1:
        nxt = [level[i].unionByName(level[i + 1], allowMissingColumns=True)
               for i in range(0, len(level) - 1, 2)]
        if len(level) % 2:
            nxt.append(level[-1])
        level = nxt
    return level[0]


# --- P6: drop columns that are NULL everywhere -------------------------------

def non_null_columns(df: DataFrame, order_by: str | None = None,
                     exclude: tuple[str, ...] = ()) -> list[str]:
    """Columns with at least one non-NULL value, ordered by the first group
    (smallest ``order_by`` value) where they have one, then by position.

    One aggregate job with partial aggregation: each task reduces its rows to
    one row of counts (or minima), so the shuffle is one row per task.
    """
    cols = [c for c in df.columns if c != order_by and c not in exclude]
    if not cols:
        return []
    if order_by is None:
        aggs = [F.count(F.col(q(c))).alias(f"c{i}") for i, c in enumerate(cols)]
    else:
        aggs = [F.min(F.when(F.col(q(c)).isNotNull(), F.col(q(order_by)))).alias(f"c{i}")
                for i, c in enumerate(cols)]
    row = df.agg(*aggs).first()
    if order_by is None:
        return [c for i, c in enumerate(cols) if row[f"c{i}"] > 0]
    firsts = [(row[f"c{i}"], i, c) for i, c in enumerate(cols) if row[f"c{i}"] is not None]
    return [c for _, _, c in sorted(firsts)]


def drop_empty_columns(df: DataFrame, order_by: str | None = None,
                       keep: tuple[str, ...] = (), firsts: dict | None = None) -> DataFrame:
    """Drop every column that is NULL in all rows (``keep`` is never dropped).

    A column survives iff it is non-NULL in some group, so one pass over the
    union decides the same column set as a per-group drop followed by the
    union. The output schema depends on the data, so this runs one eager
    aggregate; the caller should hand in a frame that is cheap to re-read
    (a scan, or a checkpointed frame). A frame without rows keeps its columns.
    Who knows the smallest ``order_by`` value with a non-NULL value of every
    column, say from file footers, gives them as ``firsts`` (columns without
    one left out): then ``df`` is not read here.
    """
    if firsts:
        at = [c for c in df.columns if c in firsts and c != order_by and c not in keep]
        survivors = sorted(at, key=lambda c: (firsts[c], at.index(c)))
    else:
        survivors = non_null_columns(df, order_by=order_by, exclude=keep)
    if not survivors and df.isEmpty():
        survivors = [c for c in df.columns if c != order_by and c not in keep]
    return df.select(*[F.col(q(c)) for c in list(keep) + survivors])

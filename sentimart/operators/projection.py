"""Projections: nested extraction (P1), reorder (P2), rename (P3), drop
(P4), dict-cell parsing (P6), struct flattening (P7), ``*`` plus
expressions (P8), count casts (P9/P10)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pyliteral import literal_to_json

# Quoted strings that the JVM JSON reader (single quotes and
# backslash-anything allowed) reads exactly like ``ast.literal_eval``: no
# control characters, and only the escapes both languages share.  All
# repetitions are possessive: the JVM matches those in a loop, so long
# strings do not deepen its stack.
_PLAIN = "(?:" + "|".join(rf"{q}(?:[^{q}\\\x00-\x1F]++|\\[\\nrt'\"u])*+{q}" for q in "'\"") + ")"
# Cells of such strings, numbers, brackets and constants are read in the
# JVM; anything else (``\x41``, ``\U...``, tuples ...) takes the Python
# fallback.
_READ_IN_JVM = rf"^(?:{_PLAIN}|[\s{{}}\[\],:0-9.+-]++|[eE][0-9+-]|True|False|None|true|false|null)*+$"
_CONSTANTS = {"True": "true", "False": "false", "None": "null"}
_JSON_OPTS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true",
              "mode": "PERMISSIVE"}


def _json_constants(cell: Column) -> Column:
    """Python's constants outside quotes as those of JSON.  Each match
    starts where the last one ended and passes whole strings, so nothing
    inside quotes is touched."""
    for word, json in _CONSTANTS.items():
        before = rf"\G((?:{_PLAIN}|[^'\"{word[0]}])*+)"
        cell = F.regexp_replace(cell, before + word, "$1" + json)
    return cell


def nested_extract(df: DataFrame, fields: Mapping[str, str | Column]) -> DataFrame:
    """``alias -> dotted path`` (or expression); nested column pruning
    keeps the Parquet scan to exactly these leaves."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k)
                       for k, v in fields.items()])


def project_reorder(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Select / reorder to a fixed column list (case-insensitive)."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename; keys absent from the frame are ignored (like pandas)."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns (absent names are ignored)."""
    return df.drop(*columns)


def star_plus(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """``SELECT *, expr AS name ...``."""
    return df.select("*", *[e.alias(n) for n, e in exprs.items()])


def parse_struct_column(df: DataFrame, column: str, schema: T.StructType,
                        out: str | None = None) -> DataFrame:
    """Parse a dict held as text (JSON, or a Python literal) into a
    struct with ``schema``; fields missing from the cell are NULL.

    One projection, one pass: cells that JSON parsing (single quotes,
    backslash escapes allowed) reads exactly like Python are parsed in the
    JVM; only the others are handed to the Arrow UDF, which receives NULL
    for every fast-path row (so its cost is a null-column transfer there).
    Unreadable cells give NULL fields; :func:`unreadable_cells` lists them.
    """
    return df.withColumn(out or column, F.from_json(_as_json(F.col(column)), schema, _JSON_OPTS))


def _as_json(cell: Column) -> Column:
    fast_ok = cell.isNull() | cell.rlike(_READ_IN_JVM)
    return F.when(fast_ok, _json_constants(cell)).otherwise(literal_to_json(F.when(~fast_ok, cell)))


def unreadable_cells(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """The rows of ``df`` whose dict cell in ``column`` is neither NULL nor
    readable as ``schema``: the rejects of :func:`parse_struct_column`."""
    bad = "__unreadable"
    options = {**_JSON_OPTS, "columnNameOfCorruptRecord": bad}
    parsed = F.from_json(_as_json(F.col(column)), T.StructType([*schema.fields, T.StructField(bad, T.StringType())]),
                         options)
    return (df.withColumn(bad, parsed)
            .where(F.col(column).isNotNull() & (F.col(bad).isNull() | F.col(f"{bad}.{bad}").isNotNull())).drop(bad))


def _leaves(dtype: T.DataType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """The paths of a struct's leaves; a name may hold dots itself."""
    if isinstance(dtype, T.StructType):
        return [leaf for f in dtype.fields for leaf in _leaves(f.dataType, (*path, f.name))]
    return [path]


def _quoted(path: Sequence[str]) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in path)


def flatten_struct(df: DataFrame, column: str, keep_prefix: bool = False) -> DataFrame:
    """Replace struct ``column`` by one column per leaf named by its
    dotted path below the struct (``thumbnails.maxres.url``), like
    ``json_normalize`` glued beside the row.  Stays within the row: no
    join, no shuffle."""
    dtype = df.schema[column].dataType
    cols = [F.col(_quoted([c])) for c in df.columns if c != column]
    for leaf in _leaves(dtype):
        name = ".".join(leaf)
        cols.append(F.col(_quoted([column, *leaf])).alias(f"{column}.{name}" if keep_prefix else name))
    return df.select(*cols)


# types as they are written in an inferred schema, where a field's name may
# be one of these words (it is followed by a colon)
_INFERRED_TYPE = re.compile(r"(?:(?<=: )|(?<=<)|^)(OBJECT<>|OBJECT<|VARIANT|VOID|DECIMAL\(\d+,\d+\))(?!:)")
_QUOTED_NAME = re.compile(r"(`(?:[^`]|``)*`)")


def _declared(inferred: str) -> str:
    """An inferred type as one that a parser can be given: decimals become
    doubles; what has no single type, or only nulls, is text."""
    def one(m: re.Match) -> str:
        word = m.group(1)
        return "STRUCT<" if word == "OBJECT<" else "DOUBLE" if word.startswith("DECIMAL") else "STRING"
    return "".join(part if i % 2 else _INFERRED_TYPE.sub(one, part)
                   for i, part in enumerate(_QUOTED_NAME.split(inferred)))


def discover_schemas(df: DataFrame, columns: Sequence[str]) -> dict[str, T.StructType]:
    """The schemas that the dict cells of ``columns`` have between them,
    found in one aggregation: every task merges the types of its cells
    (NULL, whole number, number, text ... up to "several", which is read as
    text) and the results are merged, so they depend neither on the order
    nor on the partitions.  Fields are in the order of their names; cells
    that are not dicts have no part in it."""
    def inferred(column: str) -> Column:
        value = F.from_json(_as_json(F.col(_quoted([column]))), "variant", _JSON_OPTS)
        return F.schema_of_variant_agg(F.when(F.schema_of_variant(value).startswith("OBJECT<"), value))
    found = df.agg(*(inferred(c).alias(f"s{i}") for i, c in enumerate(columns))).first()
    out = {}
    for i, column in enumerate(columns):
        ddl = _declared(found[f"s{i}"] or "VOID")
        out[column] = T.StructType.fromDDL(f"s {ddl}")["s"].dataType if ddl.startswith("STRUCT<") else T.StructType([])
    return out


def flatten_discovered(df: DataFrame, columns: Sequence[str], keep_prefix: bool = False) -> DataFrame:
    """P7 without a given schema: the dict cells of ``columns`` become one
    column a leaf that any of them has, glued beside the row.  One scan
    finds the schemas, the parse is within the row.  A field that a cell
    lacks is NULL; a column without any dict disappears."""
    schemas = discover_schemas(df, columns)
    for column in columns:
        if not schemas[column].fields:
            df = df.drop(column)
            continue
        df = flatten_struct(parse_struct_column(df, column, schemas[column]), column, keep_prefix)
    return df


def cast_counts(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """Text counts -> BIGINT.  Default ``try_cast`` (junk -> NULL);
    ``strict=True`` uses an ANSI cast, which fails the job on junk."""
    def conv(c: str) -> Column:
        col = F.col(f"`{c}`")
        return col.cast("bigint") if strict else col.try_cast("bigint")
    return df.withColumns({c: conv(c) for c in columns})


def count_rejects(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What :func:`cast_counts` turns into NULL: (column_name, n_good,
    n_rejected) for each of ``columns``, in one aggregation over the table;
    NULLs are neither."""
    def kinds(c: str) -> Column:
        col = F.col(f"`{c}`")
        number = col.try_cast("bigint")
        return F.struct(F.lit(c).alias("column_name"), F.count(number).alias("n_good"),
                        F.count_if(col.isNotNull() & number.isNull()).alias("n_rejected"))
    return df.agg(F.array(*[kinds(c) for c in columns]).alias("kinds")).select(F.inline("kinds"))

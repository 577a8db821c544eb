"""File sources: nested Parquet scan (S1), CSV scans with one shared
dialect (S2, S3, S6), typed strict / tolerant loads (S4, S5, S7), file
selection by suffix (S8, S9, O3) and the source label of a row (S13).

Whole directories are scanned in one job (no per-file driver loop and no
listing cap); the file a row came from is the ``_metadata.file_path``
column, so file-level selection is an ordinary filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import open_files, scratch_path

CORRUPT = "_corrupt_record"
KIND = "_load_kind"

# One CSV dialect for both directions (S6): comma, one header line,
# optional double-quote enclosure with doubled quotes, multi-line cells,
# blanks kept (writers would otherwise strip leading / trailing blanks),
# NULL as an empty unquoted field and '' as "".
CSV_DIALECT: dict[str, str] = {
    "header": "true", "sep": ",", "quote": '"', "escape": '"',
    "multiLine": "true", "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false", "nullValue": "", "emptyValue": '""',
    "encoding": "UTF-8",
}
# Readers: an unquoted empty field is NULL, a quoted "" is the empty
# string.  (Spark compares every parsed token with ``nullValue``, so a
# reader ``nullValue`` of "" would turn "" into NULL as well; a NUL
# character never occurs in the text we write.)
_READ_EXTRA = {"emptyValue": "", "nullValue": "\u0000"}


def scan_parquet(spark: SparkSession, path: str | Sequence[str],
                 schema: T.StructType | None = None) -> DataFrame:
    """Scan a whole Parquet directory (or several).  With ``schema``
    the footer schema is not trusted: missing fields read as NULL."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return r.parquet(*paths)


def scan_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
             glob: str | None = "*.csv", recursive: bool = False,
             **options: str) -> DataFrame:
    """Headered CSV with the shared dialect and an explicit schema
    (never inferred).  ``multiLine`` cells make each file one split, so
    producers should write many bounded files rather than one large one."""
    r = spark.read.schema(schema).options(**CSV_DIALECT).options(**_READ_EXTRA)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    r = r.options(**options)
    paths = [path] if isinstance(path, str) else list(path)
    return r.csv(paths)


def load_csv_table(spark: SparkSession, path: str | Sequence[str],
                   schema: T.StructType, glob: str | None = "*.csv",
                   recursive: bool = True) -> tuple[DataFrame, DataFrame]:
    """S4/S5 core: positional load into a typed schema -> (good, bad).

    Columns are taken by position (the header line is skipped, its names
    ignored).  Every column is parsed and the result materialised to
    Parquet in the session's shared folder *before* anything else reads
    it, so a malformed cell is detected no matter which columns a later
    query uses (CSV column pruning would otherwise hide it).  ``bad``
    holds the raw text of rows with a cell that does not fit its type or
    a wrong number of fields.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    raw = scan_csv(spark, path, full, glob=glob, recursive=recursive,
                   mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                   enforceSchema="true")
    out = scratch_path(spark, "load")
    # routed as they are written: readers open the folder of their kind only
    with open_files(spark, 2):
        (raw.withColumn(KIND, F.when(F.col(CORRUPT).isNull(), "good").otherwise("rejected"))
         .write.mode("overwrite").partitionBy(KIND).parquet(out))
    loaded = spark.read.schema(T.StructType([*full.fields, T.StructField(KIND, T.StringType())])).parquet(out)
    good = loaded.where(F.col(KIND) == "good").drop(CORRUPT, KIND)
    bad = loaded.where(F.col(KIND) == "rejected").select(CORRUPT)
    return good, bad


class LoadError(ValueError):
    pass


def load_strict(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                glob: str | None = "*.csv") -> DataFrame:
    """Typed load that aborts on the first bad row (``ON_ERROR`` =
    abort): raises :class:`LoadError` with a sample of bad rows, and nothing
    of the load stays.  All columns are parsed, since all are stored."""
    from ..sinks.files import remove_path
    raw = scan_csv(spark, path, schema, glob=glob, recursive=True, mode="FAILFAST", enforceSchema="true")
    out = scratch_path(spark, "load")
    try:
        raw.write.parquet(out)
    except Exception as e:
        remove_path(spark, out)
        if "MALFORMED" not in str(e):
            raise
        full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        bad = scan_csv(spark, path, full, glob=glob, recursive=True, mode="PERMISSIVE",
                       columnNameOfCorruptRecord=CORRUPT, enforceSchema="true").where(F.col(CORRUPT).isNotNull())
        sample = bad.limit(3).collect()
        raise LoadError("malformed rows, e.g. " + "; ".join(repr(r[CORRUPT]) for r in sample)) from e
    return spark.read.schema(schema).parquet(out)


def load_skip_bad(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                  glob: str | None = "*.csv") -> DataFrame:
    """Typed load that skips bad rows (``ON_ERROR = CONTINUE``)."""
    good, _ = load_csv_table(spark, path, schema, glob)
    return good


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Attach the path of the file each row was read from."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def source_label(path: Column | str) -> Column:
    """Label of the unit a row came from: the value of the innermost
    ``key=value`` folder when the data is partitioned, else the file's
    base name without its extension."""
    p = F.col(path) if isinstance(path, str) else path
    # a label is asked for in every row: the patterns see the last two names
    # alone, as over a whole path they try each of its places as a start
    last_two = F.substring_index(p, "/", -2)
    folder = F.when(F.contains(last_two, F.lit("/")), F.substring_index(last_two, "/", 1))
    part = F.when(F.contains(folder, F.lit("=")), F.regexp_extract(folder, r"[^/=]+=([^/]+)", 1))
    base = F.regexp_extract(F.substring_index(p, "/", -1), r"([^/]+?)(\.[^./]*)?$", 1)
    return F.when(part != "", part).otherwise(base)


def suffix_of(label: Column | str, pattern: str = r"_(\d+)$") -> Column:
    """Number at the end of a label (``a_10`` -> 10); NULL when absent or
    too large (``try_cast``)."""
    c = F.col(label) if isinstance(label, str) else label
    digits = F.regexp_extract(c, pattern, 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def filter_by_suffix(df: DataFrame, label: Column | str, start: int, end: int,
                     pattern: str = r"_(\d+)$") -> DataFrame:
    """Keep rows whose label ends with ``_<n>``, ``start <= n < end``;
    labels without such a suffix are excluded.  On a partition column this
    is a partition filter: unselected folders are never opened."""
    n = suffix_of(label, pattern)
    return df.where(n.isNotNull() & (n >= start) & (n < end))


def sort_by_suffix(df: DataFrame, label: Column | str,
                   pattern: str = r"_(\d+)$") -> DataFrame:
    """O3: order by the numeric suffix (``_9`` before ``_10``), then label."""
    c = F.col(label) if isinstance(label, str) else label
    return df.orderBy(suffix_of(c, pattern).asc_nulls_last(), c.asc())


def list_files(spark: SparkSession, path: str, glob: str | None = "*.parquet") -> DataFrame:
    """(path, length, modified) of every file below a folder, without
    a cap and without opening one: the contents are not asked for."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def select_files(files: DataFrame, start: int | None = None, end: int | None = None,
                 seen: DataFrame | None = None) -> DataFrame:
    """The files whose name ends with ``_<n>``, ``start <= n < end``
    (without bounds: all), and which ``seen`` does not have: a file that has
    changed its length or time since counts as another."""
    if start is not None and end is not None:
        files = filter_by_suffix(files, source_label("path"), start, end)
    if seen is not None:
        files = files.join(seen.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")
    return files


def require_nonempty(df: DataFrame, what: str = "selection") -> DataFrame:
    """Fail fast when nothing was selected (one ``limit(1)`` job)."""
    if df.isEmpty():
        raise LoadError(f"empty {what}")
    return df

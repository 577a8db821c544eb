"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import contextvars
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from ..sinks.files import remove_path

_ROWS = 256
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: the tables' ASCII white space, as a Java regular expression class
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A stored table, pruned to the columns an operator reads."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


@contextlib.contextmanager
def _shuffles_dropped(spark: SparkSession):
    """While a result is being stored, its shuffle files go as soon as it
    is written: the stored copy replaces them."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class _Scope:
    """The folders that were stored inside, and those of them that stay."""

    def __init__(self):
        self.paths: list[str] = []
        self.kept: list[str] = []


_scopes: contextvars.ContextVar[tuple[_Scope, ...]] = contextvars.ContextVar("scopes", default=())


@contextlib.contextmanager
def intermediates(spark: SparkSession):
    """What ``stored`` writes inside is removed at the end, all of it if the
    block fails, else all but what it was told to keep; that belongs to the
    block around this one, if there is any.  Frames that leave the block may
    read only what is kept."""
    scope = _Scope()
    token = _scopes.set((*_scopes.get(), scope))
    try:
        yield scope
    except BaseException:
        scope.kept = []
        raise
    finally:
        _scopes.reset(token)
        for path in scope.paths:
            if path not in scope.kept:
                remove_path(spark, path)
        if _scopes.get():
            _scopes.get()[-1].paths.extend(scope.kept)


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Cut lineage: write to a new folder below the session's shared
    folder (``spark.checkpoint.dir``) and read back.  What was written
    survives the loss of executors; nothing is kept on their disks.  Within
    ``intermediates`` it goes at the end of the block unless ``keep``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    for scope in _scopes.get()[-1:]:
        scope.paths.append(path)
        if keep:
            scope.kept.append(path)
    with _shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """Each text of an Arrow string column as UTF-8 bytes (null: empty);
    few of them are Python objects at a time."""
    for at in range(0, len(column), _ROWS):
        for value in column.slice(at, _ROWS).cast(pa.large_binary()).to_pylist():
            yield value or b""


def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, for functions that answer a batch of
    texts with a batch of texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def in_pieces(values: Iterable, size, most: int) -> Iterator[list]:
    """Consecutive values in lists whose sizes sum to about ``most``; a
    larger single value makes a list of its own."""
    piece, total = [], 0
    for v in values:
        n = size(v)
        if piece and total + n > most:
            yield piece
            piece, total = [], 0
        piece.append(v)
        total += n
    if piece:
        yield piece

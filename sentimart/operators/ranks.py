"""Rows by their ranks (O5) without sorting the table.

The keys at the two ends of a rank range are found by counting: some keys
of the current key range are drawn as splitters, one aggregation counts the
rows between them, and the range shrinks to the buckets that hold the two
ranks.  Each round reads the order columns only, collects as many rows as
there are splitters and shrinks the range about that many times; a last
scan, with the key range pushed down, reads the payload of what is left.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .windowing import add_ordinal

SPLITTERS = 63
#: rows that are numbered in one task
SMALL = 50_000


def _literal(values: Sequence, types: Sequence[T.DataType]) -> Column:
    return F.struct(*(F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(values, types))))


def _bucket(key: Column, splitters: Sequence[Column], first: int = 0) -> Column:
    """2i for a key between splitters i - 1 and i, 2i + 1 for one equal to
    splitter i, by a tree of comparisons."""
    if not splitters:
        return F.lit(2 * first)
    middle = len(splitters) // 2
    return (F.when(key < splitters[middle], _bucket(key, splitters[:middle], first))
            .when(key == splitters[middle], F.lit(2 * (first + middle) + 1))
            .otherwise(_bucket(key, splitters[middle + 1:], first + middle + 1)))


@dataclass(frozen=True)
class _Range:
    """Keys between two bounds (None: no bound), which belong to the range
    or not; ``rows`` rows, ``before`` others below them."""
    names: Sequence[str]
    types: Sequence[T.DataType]
    low: tuple | None = None
    high: tuple | None = None
    with_low: bool = False
    with_high: bool = False
    before: int = 0
    rows: int | None = None

    @property
    def one_key(self) -> bool:
        return self.low is not None and self.low == self.high

    def key(self) -> Column:
        return F.struct(*(F.col(f"`{n}`").alias(f"k{i}") for i, n in enumerate(self.names)))

    def filter(self, df: DataFrame) -> DataFrame:
        """Rows in the range.  Comparisons of the leading column alone are
        what a Parquet scan can use; NULL is the smallest key."""
        lead, kind, key = F.col(f"`{self.names[0]}`"), self.types[0], self.key()
        if self.low is not None:
            low = _literal(self.low, self.types)
            df = df.where(key >= low if self.with_low else key > low)
            if self.low[0] is not None:
                df = df.where(lead >= F.lit(self.low[0]).cast(kind))
        if self.high is not None:
            high = _literal(self.high, self.types)
            df = df.where(key <= high if self.with_high else key < high)
            if self.high[0] is None:
                df = df.where(lead.isNull())
            else:
                below = lead <= F.lit(self.high[0]).cast(kind)
                df = df.where(lead.isNull() | below if self.low is None or self.low[0] is None else below)
        return df

    def to(self, other: _Range) -> _Range:
        """From this range's low end to another's high end."""
        return replace(self, high=other.high, with_high=other.with_high, rows=other.before + other.rows - self.before)

    def divided(self, df: DataFrame, start: int, stop: int, splitters: int) -> list[_Range]:
        """The range in parts, single keys and what lies between them, as
        far as they hold ranks of ``[start, stop)``.  One scan draws
        splitters, one counts; both read the order columns only."""
        rows, key = self.filter(df.select(*(F.col(f"`{n}`") for n in self.names))), self.key()
        drawn = rows.select(key.alias("key")).orderBy(F.rand(17)).limit(splitters)
        at = [tuple(r) for r in drawn.agg(F.array_sort(F.collect_set("key")).alias("keys")).first()["keys"]]
        counts = {r["bucket"]: r["n"] for r in rows.select(
            _bucket(key, [_literal(s, self.types) for s in at]).alias("bucket"))
            .groupBy("bucket").agg(F.count("*").alias("n")).collect()}
        out, upto = [], self.before
        for b in sorted(counts):
            i, single = divmod(b, 2)
            if single:
                part = replace(self, low=at[i], high=at[i], with_low=True, with_high=True)
            else:
                part = self
                if i > 0:
                    part = replace(part, low=at[i - 1], with_low=False)
                if i < len(at):
                    part = replace(part, high=at[i], with_high=False)
            if upto < stop and upto + counts[b] > start:
                out.append(replace(part, before=upto, rows=counts[b]))
            upto += counts[b]
        return out


def _parts(df: DataFrame, keys: _Range, start: int, stop: int, splitters: int, small: int) -> list[_Range]:
    """Ranges that hold the ranks ``[start, stop)`` between them, each with
    no more than ``small`` rows, hardly more than are asked for, or one key."""
    while True:
        found = keys.divided(df, start, stop, splitters)
        if not found:
            return []
        whole = found[0].to(found[-1])
        if whole.rows <= max(small, 2 * (stop - start)):
            return [whole]
        if len(found) > 1:          # the two ends are narrowed apart
            first, last = found[0], found[-1]
            middle = [found[1].to(found[-2])] if len(found) > 2 else []
            return (_part(df, first, start, first.before + first.rows, splitters, small) + middle
                    + _part(df, last, last.before, stop, splitters, small))
        if found[0].one_key:
            return found
        keys = found[0]


def _part(df, keys, start, stop, splitters, small) -> list[_Range]:
    if keys.one_key or keys.rows <= max(small, 2 * (stop - start)):
        return [keys]
    return _parts(df, keys, start, stop, splitters, small)


def _range(df: DataFrame, names: Sequence[str], before: int = 0) -> _Range:
    return _Range(tuple(names), tuple(df.schema[n].dataType for n in names), before=before)


def rank_slice(df: DataFrame, order_by: Sequence[str], start: int, stop: int, name: str = "ordinal",
               splitters: int = SPLITTERS, small: int = SMALL) -> DataFrame:
    """The rows with 0-based ranks ``[start, stop)`` in ascending order
    of the columns ``order_by`` (NULLs first), with their rank in ``name``.

    Rows that are equal in ``order_by`` are ranked by a hash of all their
    columns, so only rows that are equal altogether are interchangeable.
    Fewer rows than ``stop`` give what there is."""
    out = df.sparkSession.createDataFrame([], T.StructType([*df.schema.fields, T.StructField(name, T.LongType())]))
    tie = "__tie"
    order = [F.col(f"`{n}`").asc_nulls_first() for n in (*order_by, tie)]

    def numbered(rows: DataFrame, n: int, before: int) -> DataFrame:
        if n <= small:
            rows = rows.withColumn(name, (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint"))
        else:
            rows = add_ordinal(rows, order, name)
        return (rows.withColumn(name, F.col(name) + F.lit(before))
                .where((F.col(name) >= start) & (F.col(name) < stop)).drop(tie))
    hashed = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
    for part in _parts(df, _range(df, order_by), start, stop, splitters, small) if stop > start else []:
        rows = part.filter(df).withColumn(tie, hashed)
        if not part.one_key or part.rows <= small:
            out = out.unionByName(numbered(rows, part.rows, part.before))
            continue
        # very many rows share a key: their hashes are narrowed in turn
        low, high = max(start, part.before), min(stop, part.before + part.rows)
        for equal in _parts(rows, _range(rows, [tie], part.before), low, high, splitters, small):
            some, n, before = equal.filter(rows), equal.rows, equal.before
            if equal.one_key and n > small:          # equal altogether: any of them do
                before = max(low, before)
                n = min(high, equal.before + n) - before
                some = some.limit(n)
            out = out.unionByName(numbered(some, n, before))
    return out

"""Where and why a tolerant CSV load refuses rows.

The files are read as lines, split into blocks like any text, so one large
file is many tasks.  What a line is depends on what came before it in its
file: the number of lines, and whether a quoted cell is open.  Both add up
over blocks - a count, and the parity of the quotes - so a first scan takes
one row a block, prefix sums over a file's blocks give each block its
start, and the second scan numbers lines and puts records together.  Only
records of several lines are grouped.  A record is parsed as the load
parses it, and compared with its texts to find the column that failed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import _READ_EXTRA, CORRUPT, CSV_DIALECT

_LINES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("value", pa.string()),
                    ("inside", pa.bool_()), ("odd", pa.bool_()), ("even_start", pa.int64()), ("odd_start", pa.int64())])
_LINES_SQL = "file string, block long, at long, value string, inside boolean, odd boolean, even_start long, odd_start long"
_BLOCKS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("n_lines", pa.int64()), ("odd", pa.bool_()),
                     ("even_start", pa.int64()), ("odd_start", pa.int64())])
_BLOCKS_SQL = "file string, block long, n_lines long, odd boolean, even_start long, odd_start long"


class _Block:
    """Lines of one block so far: how many, the parity of their quotes, and
    the last line before which the parity was even, or odd."""

    def __init__(self, file: str, block: int):
        self.key, self.n, self.odd, self.even_start, self.odd_start = (file, block), 0, False, -1, -1

    def add(self, quotes: np.ndarray) -> tuple[np.ndarray, ...]:
        """For more lines, by their numbers of quotes: place, whether an odd
        number of quotes precedes, own parity, and the two last starts."""
        own = quotes % 2 == 1
        total = np.cumsum(own) + self.odd
        inside = np.concatenate([[self.odd], total[:-1] % 2 == 1]).astype(bool)
        at = np.arange(self.n, self.n + len(own))
        even = np.maximum.accumulate(np.concatenate([[self.even_start], np.where(inside, -1, at)]))[1:]
        odd = np.maximum.accumulate(np.concatenate([[self.odd_start], np.where(inside, at, -1)]))[1:]
        self.n, self.odd = self.n + len(own), bool(total[-1] % 2)
        self.even_start, self.odd_start = int(even[-1]), int(odd[-1])
        return at, inside, own, even, odd


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut where the file or the block changes."""
    block, file = batch.column("block").to_numpy(), batch.column("file")
    same = pc.equal(file.slice(1), file.slice(0, len(file) - 1)).to_numpy(zero_copy_only=False) if len(file) > 1 else np.zeros(0, bool)
    cuts = [0, *(np.flatnonzero((block[1:] != block[:-1]) | ~same.astype(bool)) + 1).tolist(), len(block)]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def _read(batches, summary: bool):
    held: _Block | None = None

    def row(b: _Block) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip((*b.key, b.n, b.odd, b.even_start, b.odd_start), _BLOCKS)], schema=_BLOCKS)
    for batch in batches:
        if not batch.num_rows:
            continue
        for some in _runs(batch):
            key = (some.column("file")[0].as_py(), some.column("block")[0].as_py())
            if held is None or held.key != key:
                if held is not None and summary:
                    yield row(held)
                held = _Block(*key)
            quotes = pc.count_substring(some.column("value"), CSV_DIALECT["quote"]).to_numpy()
            at, inside, own, even, odd = held.add(quotes)
            if not summary:
                yield pa.RecordBatch.from_arrays(
                    [some.column("file"), some.column("block"), pa.array(at), some.column("value"), pa.array(inside),
                     pa.array(own), pa.array(even), pa.array(odd)], schema=_LINES)
    if held is not None and summary:
        yield row(held)


def numbered_records(spark: SparkSession, path: str | Sequence[str], glob: str | None = "*.csv") -> DataFrame:
    """(file, line, text) of every record of CSV files: the line it begins
    on, from 1, and its raw text.  Header and blank lines are no records.  A
    record is held whole, as by a CSV reader."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    text = reader.text([path] if isinstance(path, str) else list(path))
    text = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    blocks = text.mapInArrow(lambda b: _read(b, True), _BLOCKS_SQL)
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # an odd number of quotes before a block turns its parities round
    flipped = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1
    first = F.coalesce(F.sum("n_lines").over(before), F.lit(0))
    last = F.when(F.col("flipped"), F.col("odd_start")).otherwise(F.col("even_start"))
    blocks = (blocks.withColumns({"flipped": flipped, "first": first})
              .withColumn("last_start", F.when(last >= 0, F.col("first") + last))
              .withColumn("open_start", F.last("last_start", ignorenulls=True).over(before))
              .select("file", "block", "flipped", "first", "open_start"))
    lines = text.mapInArrow(lambda b: _read(b, False), _LINES_SQL).join(blocks, ["file", "block"])
    start = F.when(F.col("flipped"), F.col("odd_start")).otherwise(F.col("even_start"))
    lines = lines.select(
        "file", "value", (F.col("first") + F.col("at")).alias("at"), (F.col("inside") != F.col("flipped")).alias("inside"), "odd",
        F.when(start >= 0, F.col("first") + start).otherwise(F.col("open_start")).alias("start"))
    single = lines.where(~F.col("inside") & ~F.col("odd")).select("file", F.col("at").alias("start"), F.col("value").alias("text"))
    several = (lines.where(F.col("inside") | F.col("odd")).groupBy("file", "start")
               .agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"))
               .select("file", "start", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("text")))
    return (single.unionByName(several).where((F.col("start") > 0) & (F.trim("text") != ""))
            .select("file", (F.col("start") + 1).alias("line"), "text"))


def _n_fields(text: Column) -> Column:
    """Fields of a record: separators outside quotes, and one."""
    bare = F.regexp_replace(text, '"(?:[^"]|"")*+"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(CSV_DIALECT["sep"]), F.lit(""))) + 1


def located_rejects(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                    glob: str | None = "*.csv") -> DataFrame:
    """(file, line, column_name, reason, text) of every record that
    :func:`sentimart.sources.files.load_skip_bad` skips: the line it begins
    on and the first column whose text does not fit its type, or NULL where
    the number of fields is wrong."""
    options = {**CSV_DIALECT, **_READ_EXTRA, "header": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    typed = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    records = numbered_records(spark, path, glob).withColumns({
        "typed": F.from_csv("text", typed.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options),
        "texts": F.from_csv("text", texts.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options),
        "n": _n_fields(F.col("text"))})
    bad = records.where(F.col(f"typed.{CORRUPT}").isNotNull())
    width = len(schema.fields)
    failed = F.coalesce(*(F.when(F.col(f"texts.`{f.name}`").isNotNull() & F.col(f"typed.`{f.name}`").isNull(),
                                 F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("kind"),
                                          F.col(f"texts.`{f.name}`").alias("value"))) for f in schema.fields))
    wrong = F.col("n") != width
    return bad.withColumn("failed", failed).select(
        "file", "line", F.when(~wrong, F.col("failed.name")).alias("column_name"),
        F.when(F.col("n") < width, F.format_string(f"%d fields of {width}", "n"))
        .when(wrong, F.format_string(f"%d fields for {width}", "n"))
        .when(F.col("failed").isNotNull(), F.concat(F.lit("not a "), F.col("failed.kind"), F.lit(": "), F.col("failed.value")))
        .otherwise("malformed").alias("reason"), "text")

"""Paged acquisition (S11): entities whose items come page by page, as a
Spark data source.

A page store is what a crawler leaves, or what a remote API serves: pages
of at most ``page_size`` items, each with the token of the page after it.
Its index names every span of pages - a file here, a cursor of an API -
with its first and last page.  The reader plans one input partition a span
from that index alone, so entities are neither listed on the driver nor
walked one by one, and an entity with a third of all pages is read by many
tasks.  A run may be bounded (a quota of pages a task); the next one
resumes behind the pages that have landed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from ..operators.windowing import add_ordinal

# --- fixed values (items per page of the two original fetches) ---
IDS_PER_PAGE = 50
COMMENTS_PER_PAGE = 100
# --- end of fixed values ---
SPAN_PAGES = 1_000       # pages of a file of the store, at most
_BATCH_PAGES = 64        # pages in memory at a time

#: columns of a fetched row before the item's own
PLACE = T.StructType([
    T.StructField("entity", T.StringType()), T.StructField("page", T.LongType()),
    T.StructField("next_token", T.StringType()), T.StructField("ordinal", T.LongType()),
    T.StructField("span", T.StringType()), T.StructField("at", T.LongType())])


def store_pages(items: DataFrame, entity: str, order_by: Sequence[Column], path: str,
                page_size: int = COMMENTS_PER_PAGE, span_pages: int = SPAN_PAGES) -> None:
    """Lay ``items`` out as pages below ``path``: (entity, page, next_token,
    first, items), and the index of their files.

    An item's place within its entity comes from the ordinals of the whole
    table (range partitions and their offsets) less its entity's smallest,
    so a hot entity is numbered by as many tasks as hold it; the groups that
    are collected are pages.  Rows with a NULL entity are left out."""
    spark = items.sparkSession
    fields = [c for c in items.columns if c != entity]
    keyed = items.where(F.col(entity).isNotNull()).select(
        F.col(entity).cast("string").alias("entity"), F.struct(*fields).alias("item"),
        F.struct(*order_by).alias("__order"))
    numbered = add_ordinal(keyed, [F.col("entity"), F.col("__order")], "__n").drop("__order")
    spans = numbered.groupBy("entity").agg(F.min("__n").alias("__first"), F.count("*").alias("__items"))
    placed = numbered.join(spans, "entity").withColumn("__at", F.col("__n") - F.col("__first"))
    page = F.floor(F.col("__at") / page_size).cast("bigint")
    pages = (placed.withColumn("page", page).groupBy("entity", "page", "__items")
             .agg(F.sort_array(F.collect_list(F.struct("__at", "item"))).alias("__rows"))
             .select("entity", "page",
                     F.when((F.col("page") + 1) * page_size < F.col("__items"), (F.col("page") + 1).cast("string"))
                     .alias("next_token"),
                     (F.col("page") * page_size).alias("first"),
                     F.transform("__rows", lambda r: r["item"]).alias("items")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (pages.repartitionByRange(n, "entity", "page").sortWithinPartitions("entity", "page")
     .write.mode("overwrite").option("maxRecordsPerFile", span_pages).parquet(f"{path}/pages"))
    where = F.struct("entity", "page")
    (spark.read.parquet(f"{path}/pages").select("entity", "page", F.size("items").alias("n"),
                                                F.col("_metadata.file_path").alias("span"))
     .groupBy("span").agg(F.count("*").alias("n_pages"), F.sum("n").alias("n_items"),
                          F.min(where)["entity"].alias("first_entity"), F.max(where)["entity"].alias("last_entity"))
     .write.mode("overwrite").parquet(f"{path}/index"))


def item_schema(spark: SparkSession, path: str) -> T.StructType:
    """The fields of a stored item."""
    return spark.read.parquet(f"{path}/pages").schema["items"].dataType.elementType


@dataclass
class Span(InputPartition):
    """A file of pages, from its page ``at`` on, ``pages`` of them."""
    file: str
    at: int
    pages: int


def _columns(uri: str, names: Sequence[str] | None = None) -> list[dict]:
    """A small stored table, read where no Spark session is."""
    fs, path = pafs.FileSystem.from_uri(uri)
    return ds.dataset(path, filesystem=fs, format="parquet", exclude_invalid_files=True).to_table(names).to_pylist()


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.options, self.schema = options, schema
        self.wanted: set[str] | None = None

    def partitions(self) -> Sequence[InputPartition]:
        landed = {r["span"]: r["pages"] for r in _columns(self.options["landed"])} if self.options.get("landed") else {}
        quota = int(self.options.get("pages_per_task", 0)) or None
        out = []
        for r in _columns(f"{self.options['path']}/index"):
            if self.wanted is not None and not any(r["first_entity"] <= w <= r["last_entity"] for w in self.wanted):
                continue
            at = landed.get(r["span"], 0)
            left = r["n_pages"] - at
            if left > 0:
                out.append(Span(r["span"], at, min(left, quota or left)))
        return out

    def read(self, span: Span) -> Iterator[pa.RecordBatch]:
        if span is None:                 # planned without partitions: nothing is left
            return
        fs, path = pafs.FileSystem.from_uri(span.file)
        at, end = 0, span.at + span.pages
        with fs.open_input_file(path) as f:
            for batch in pq.ParquetFile(f).iter_batches(_BATCH_PAGES):
                if at >= end:
                    return
                low, high = max(span.at - at, 0), min(end - at, batch.num_rows)
                if low < high:
                    yield self._rows(batch.slice(low, high - low), span.file, at + low)
                at += batch.num_rows

    def _rows(self, pages: pa.RecordBatch, file: str, at: int) -> pa.RecordBatch:
        number = pa.array(range(at, at + pages.num_rows), pa.int64())
        pages = pages.append_column("at", number)
        if self.wanted is not None:
            pages = pages.filter(pc.is_in(pages.column("entity"), pa.array(sorted(self.wanted), pa.string())))
        items = pages.column("items")
        rows, item = pc.list_parent_indices(items), items.flatten()
        def repeat(name):
            return pages.column(name).take(rows)
        starts = pa.array(items.offsets, pa.int64()) if isinstance(items, pa.LargeListArray) else items.offsets.cast(pa.int64())
        within = pc.subtract(pa.array(range(len(item)), pa.int64()),
                                     pc.subtract(starts.slice(0, len(items)), starts[0]).take(rows))
        columns = {"entity": repeat("entity"), "page": repeat("page"), "next_token": repeat("next_token"),
                   "ordinal": pc.add(repeat("first"), within),
                   "span": pa.array([file] * len(item), pa.string()), "at": repeat("at")}
        return pa.RecordBatch.from_arrays(
            [*(columns[f.name] for f in PLACE.fields), *item.flatten()], names=[f.name for f in self.schema.fields])


class FilteringPageReader(PageReader):
    """The reader where Spark hands filters to Python data sources."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Entities asked for choose the spans by the index and the pages
        within; Spark checks them again."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("entity",):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = values if self.wanted is None else self.wanted & values
            yield f


class PageSource(DataSource):
    """``spark.read.format("pages").schema(...).option("path", store)``."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        kind = FilteringPageReader if self.options.get("pushdown") == "true" else PageReader
        return kind(dict(self.options), schema)


def paged_fetch(spark: SparkSession, path: str, pages_per_task: int | None = None, landed: str | None = None) -> DataFrame:
    """Every page of every entity of the store at ``path`` (all are
    kept, not only the last): entity, page, next_token, the item's ordinal
    in its entity, the span and place of its page, and the item's fields.

    ``pages_per_task`` bounds a run; ``landed`` is the table of
    :func:`landed_pages` of earlier runs, behind which this one goes on.
    Filters on ``entity`` choose spans by the index where the session has
    ``spark.sql.python.filterPushdown.enabled`` (elsewhere Spark filters
    what was read)."""
    spark.dataSource.register(PageSource)
    item = item_schema(spark, path)
    reader = (spark.read.format("pages").schema(T.StructType([*PLACE.fields, *item.fields])).option("path", path)
              .option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false").lower()))
    if pages_per_task:
        reader = reader.option("pages_per_task", str(pages_per_task))
    if landed:
        reader = reader.option("landed", landed)
    return reader.load()


def landed_pages(rows: DataFrame, path: str) -> str:
    """Write how far each span has been read, by the fetched rows that have
    been stored; a task's pages land in order and all or none, so its last
    page tells.  Returns ``path``."""
    rows.groupBy("span").agg((F.max("at") + 1).alias("pages")).write.mode("overwrite").parquet(path)
    return path

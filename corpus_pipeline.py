"""Corpus pipeline over ``documents``: five stages, each one operator of
``sentimart.llm`` over all its predecessor kept.

A stage is ``function(spark, docs, sf_dir) -> DataFrame``; its result is
written as Parquet in the session's shared folder and read again as the
next stage's ``docs``.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentimart.llm.common import intermediates, stored, table
from sentimart.llm.decontaminate import benchmark_overlap
from sentimart.llm.line_dedup import dedup_lines
from sentimart.llm.mixing import mix
from sentimart.llm.queries import MIX_WEIGHTS, source_domain
from sentimart.llm.simhash import simhash_heads
from sentimart.llm.toxicity import score_toxicity
from sentimart.session import ship_package
from sentimart.sinks.files import remove_path

#: SQL cannot express the classifier, the fingerprints and the line edits;
#: the stages are tested against brute force instead
ORACLE_SQL = None


def _whole(docs: DataFrame) -> DataFrame:
    """Every row as one column, beside its doc_id: no name can clash."""
    return docs.select(F.struct("*").alias("document"), "doc_id")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents predicted toxic.  Null and empty texts stay."""
    ship_package(spark)
    scored = score_toxicity(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return scored.filter("predicted = 0").select("document.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that an earlier line repeats within one edit (lines of
    fewer than 20 characters: exactly), and documents of which nothing but
    white space is left by that.  ``n_chars`` follows the new text;
    untouched documents stay as they are."""
    ship_package(spark)
    out = dedup_lines(docs, min_exact=1)
    touched = F.col("n_removed") > 0
    left = F.regexp_replace("kept_text", r"[\x20\x09-\x0D]+", "") != ""
    new = {"text": F.when(touched, F.col("kept_text")).otherwise(F.col("document.text")),
           "n_chars": F.when(touched, F.char_length("kept_text")).otherwise(F.col("document.n_chars")).cast("long")}
    return out.filter(~touched | left).select(
        *(new.get(c, F.col("document").getField(c)).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the smallest doc_id, of each SimHash
    group.  Different texts under one doc_id are documents of their own (in
    one group, that with the smallest hash of the text stays); of rows that
    repeat doc_id and text one stays, picked by a hash of all columns; rows
    without a doc_id cannot be told apart and stay."""
    ship_package(spark)
    kept = stored(simhash_heads(docs.filter("doc_id is not null")), "kept").hint("shuffle_hash")
    keyed = docs.select(F.struct("*").alias("document"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64("text").alias("text_key"))
    met = keyed.join(kept, ["doc_id", "text_key"])
    once = met.filter("rows = 1").select("document.*")
    repeated = (met.filter("rows > 1").groupBy("doc_id", "text_key")
                .agg(F.min_by("document", F.xxhash64("document")).alias("document")).select("document.*"))
    return once.unionByName(repeated).unionByName(docs.filter("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item."""
    ship_package(spark)
    found = benchmark_overlap(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.filter("n_hit = 0").select("document.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Selects documents by the target weights, as many tokens as there are:
    a row (the columns of documents, ``domain``, ``epoch``) for each epoch a
    document is in; input columns of these two names are replaced.  Each row
    has its own place, also where rows share a doc_id; rows equal in all
    columns are interchangeable, and as many of them come out as were
    chosen.  Rows with a null doc_id, which the other stages keep, and rows
    without a token are left out."""
    names = [c for c in docs.columns if c not in ("domain", "epoch")]
    row = F.struct(*names)
    keyed = docs.select("doc_id", "text", "lang", "source", F.xxhash64(row).alias("row_key"), row.alias("document"))
    chosen = mix(keyed, source_domain(), MIX_WEIGHTS, fraction=1.0, keep=["row_key"])
    once = keyed.groupBy("row_key").agg(F.first("document").alias("document"))
    return (once.join(chosen.select("row_key", "domain", "epoch"), "row_key")
            .select(*(F.col("document").getField(c).alias(c) for c in names), "domain", "epoch"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the ``documents`` table.  What a stage
    stored goes when its result is written, and that when the next one's
    is; only the last one's stays."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with intermediates(spark) as written:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
        for path in before:
            remove_path(spark, path)
        before = written.kept[-1:]
    return docs

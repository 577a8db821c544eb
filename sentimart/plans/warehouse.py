"""Warehouse tables: ``fn_videos`` (C6) and ``fn_comments``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import video_category, video_link
from ..operators.windowing import dedup_by_key, total_order
from ..schemas import FN_COMMENTS_COLUMNS, FN_VIDEOS_COLUMNS, SENTINEL, TABLES
from ..sources.files import load_skip_bad, load_strict


def fn_videos(videos: DataFrame) -> DataFrame:
    """Category (F5) and watch link (X11) added, one row per video.

    The dedup runs on the widened rows, so its total-order tie-break sees
    every column; category and link are functions of columns already in
    the order, so they never change the survivor.
    """
    enriched = videos.select("*", video_category("guest").alias("videocategory"),
                             video_link("videoid").alias("videolink"))
    return dedup_by_key(enriched, "videoid").select(*FN_VIDEOS_COLUMNS)


def fn_comments(comments: DataFrame) -> DataFrame:
    """One row per comment id (W1, deterministic survivor).

    Failed rows (no emotion, or the sentinel) lose to a classified copy of
    the same comment, so a retried comment never stays failed in the table
    (N12)."""
    failed_last = F.when(F.col("emotion").isNull() | (F.col("emotion") == SENTINEL), 1).otherwise(0).asc()
    order = total_order(comments, ["commentid"], first=[failed_last])
    return dedup_by_key(comments, "commentid", order).select(*FN_COMMENTS_COLUMNS)


def load_warehouse(spark, locations: dict[str, str]) -> dict[str, DataFrame]:
    """Typed tables from their CSV folders, columns by position.

    ``channel``, ``videos`` and ``topics`` abort on any malformed row
    (S4); ``comments`` skips malformed rows (S5), as the original load
    did.  Each table is materialised right after parsing (see
    ``load_csv_table``)."""
    out = {}
    for name, path in locations.items():
        loader = load_skip_bad if name == "comments" else load_strict
        out[name] = loader(spark, path, TABLES[name])
    return out

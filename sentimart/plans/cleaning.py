"""Cleaning steps for channel (C1) and video (C2) records.

Both are one narrow stage: parse the dict cells (P6), flatten them beside
the row (P7), clean strings, rename, cast.  Nothing shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import (guest_prefix, iso_date_prefix, remove_newlines,
                              strip_ws, title_prefix, to_date_lenient)
from ..operators.projection import (cast_counts, flatten_struct,
                                    parse_struct_column, project_reorder,
                                    rename_columns)
from ..schemas import CHANNEL, VIDEOS

S = T.StringType()


def _st(*fields) -> T.StructType:
    return T.StructType([f if isinstance(f, T.StructField) else T.StructField(f, S)
                         for f in fields])


def _nested(name: str, *path_then_leaf: str) -> T.StructField:
    *path, leaf = path_then_leaf
    inner: T.DataType = _st(leaf)
    for p in reversed(path):
        inner = T.StructType([T.StructField(p, inner)])
    return T.StructField(name, inner)


# Fields read from the video API's dict cells.
VIDEO_CELLS = {
    "snippet": _st("publishedAt", "title", "description",
                   _nested("thumbnails", "maxres", "url")),
    "statistics": _st("viewCount", "likeCount", "commentCount"),
    "contentDetails": _st("duration"),
}
# Fields read from the channel API's dict cells.
CHANNEL_CELLS = {
    "snippet": _st("title", "description", "customUrl", "publishedAt", "country",
                   _nested("thumbnails", "high", "url")),
    "statistics": _st("viewCount", "subscriberCount", "videoCount"),
    "contentDetails": _st(_nested("relatedPlaylists", "uploads")),
}

VIDEO_RENAMES = {"id": "videoid", "thumbnails.maxres.url": "thumbnailimageurl",
                 "publishedAt": "publishedat", "viewCount": "viewscount",
                 "likeCount": "likescount", "commentCount": "commentscount"}
VIDEO_OUTPUT = ["videoid", "title", "guest", "description", "publishedat",
                "duration", "thumbnailimageurl", "viewscount", "likescount",
                "commentscount"]

CHANNEL_RENAMES = {"id": "channelid", "title": "channeltitle",
                   "customUrl": "channelcustomurl", "publishedAt": "publishedat",
                   "country": "channelcountry", "viewCount": "viewscount",
                   "subscriberCount": "subscribercount", "videoCount": "videoscount",
                   "thumbnails.high.url": "channelthumbnailurl"}
CHANNEL_OUTPUT = ["channelid", "channeltitle", "description", "channelcustomurl",
                  "publishedat", "channelcountry", "viewscount", "subscribercount",
                  "videoscount", "channelthumbnailurl"]


def parse_and_flatten(raw: DataFrame, cells: dict[str, T.StructType]) -> DataFrame:
    """P6 + P7 for every dict cell: text cells are parsed, struct cells
    are projected to the fields read; then each is flattened in place."""
    df = raw
    for name, schema in cells.items():
        if isinstance(df.schema[name].dataType, T.StringType):
            df = parse_struct_column(df, name, schema)
        df = flatten_struct(df, name)
    return df


def clean_videos(raw: DataFrame) -> DataFrame:
    """Raw video records -> the cleaned video file's 10 columns.

    ``title`` is the stripped title cut at the first ``|`` (not
    re-stripped); ``guest`` is the stripped title cut at the first ``:``,
    or ``'N/A'``; counts are BIGINT (junk -> NULL); the date keeps only its
    first 10 characters; a missing thumbnail stays NULL.
    """
    flat = parse_and_flatten(raw, VIDEO_CELLS)
    stripped = strip_ws("title")
    cleaned = flat.withColumns({
        "publishedAt": to_date_lenient(iso_date_prefix("publishedAt")),
        "description": strip_ws("description"),
        "guest": guest_prefix(stripped),
        "title": title_prefix(stripped),
        "id": F.col("id").cast("string"),
    })
    renamed = rename_columns(cleaned, VIDEO_RENAMES)
    return cast_counts(project_reorder(renamed, VIDEO_OUTPUT),
                       ["viewscount", "likescount", "commentscount"])


def clean_channel(raw: DataFrame) -> DataFrame:
    """Raw channel records -> the cleaned channel file's 10 columns
    (date prefix, newlines removed from the description; all of a
    multi-page fetch is kept, not only the last page)."""
    flat = parse_and_flatten(raw, CHANNEL_CELLS)
    cleaned = flat.withColumns({
        "publishedAt": iso_date_prefix("publishedAt"),
        "description": remove_newlines("description"),
    })
    return project_reorder(rename_columns(cleaned, CHANNEL_RENAMES), CHANNEL_OUTPUT)


def as_table(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Positional load of a cleaned frame into a declared table schema
    (S7): column i takes field i's name and type; text that does not fit
    the type becomes NULL (``try_cast``)."""
    cols = []
    for src, f in zip(df.columns, schema.fields):
        c = F.col(f"`{src}`")
        if isinstance(f.dataType, T.DateType):
            c = to_date_lenient(c.cast("string"))
        elif not isinstance(f.dataType, T.StringType):
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def videos_table(raw: DataFrame) -> DataFrame:
    return as_table(clean_videos(raw), VIDEOS)


def channel_table(raw: DataFrame) -> DataFrame:
    return as_table(clean_channel(raw), CHANNEL)

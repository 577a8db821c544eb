"""Table schemas, label domain and sentinel values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the original job's for equal results) ---
# Sentinel written in place of a label when a comment could not be classified.
SENTINEL = "Error-Unable to parse emotion"
# The three sentiment labels counted by the percentage mart.
SENTIMENTS = ["positive", "negative", "neutral"]
# The 28 emotion labels offered to the classifier.
EMOTIONS = [
    "admiration", "amusement", "anger", "annoyance", "approval", "caring",
    "confusion", "curiosity", "desire", "disappointment", "disapproval",
    "disgust", "embarrassment", "excitement", "fear", "gratitude", "grief",
    "joy", "love", "nervousness", "optimism", "pride", "realization",
    "relief", "remorse", "sadness", "surprise", "neutral",
]
# Prefix of the watch link derived from a video id.
VIDEO_LINK_PREFIX = "https://www.youtube.com/watch?v="
# Comments per classifier call; attempts per call.
BATCH_SIZE = 20
MAX_ATTEMPTS = 3
# Title cut: the title ends before the first TITLE_SEP, the guest is the text
# before the first GUEST_SEP, or NO_GUEST when the title has none.
TITLE_SEP = "|"
GUEST_SEP = ":"
NO_GUEST = "N/A"
# Columns of the two deduplicated tables, in order.
FN_VIDEOS_COLUMNS = ["videoid", "title", "guest", "videocategory", "videolink",
                     "description", "publisheddate", "duration",
                     "thumbnailimageurl", "viewcount", "likescount",
                     "commentscount"]
FN_COMMENTS_COLUMNS = ["commentid", "videoid", "publishedat", "textoriginal",
                       "emotion", "sentimentnature", "authordisplayname",
                       "authorprofileimageurl", "authorchannelurl",
                       "likecount", "totalreplycount"]
# --- end of fixed values ---

S, L, D = T.StringType(), T.LongType(), T.DateType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


CHANNEL = _schema(
    ("channelid", S), ("channeltitle", S), ("description", S),
    ("channelcustomurl", S), ("publisheddate", D), ("channelcountry", S),
    ("viewscount", L), ("subscriberscount", L), ("videoscount", L),
    ("channelthumbnailurl", S))

VIDEOS = _schema(
    ("videoid", S), ("title", S), ("guest", S), ("description", S),
    ("publisheddate", D), ("duration", S), ("thumbnailimageurl", S),
    ("viewcount", L), ("likescount", L), ("commentscount", L))

COMMENTS = _schema(
    ("commentid", S), ("videoid", S), ("publishedat", D),
    ("textoriginal", S), ("emotion", S), ("sentimentnature", S),
    ("authordisplayname", S), ("authorprofileimageurl", S),
    ("authorchannelurl", S), ("likecount", L), ("totalreplycount", L))

TOPICS = _schema(("videoid", S), ("topic", S))

# Table name -> declared schema (loaded by position, header ignored).
TABLES = {"channel": CHANNEL, "videos": VIDEOS, "comments": COMMENTS,
          "topics": TOPICS}

# Nested comment-thread record as delivered by the comment API (fields read).
COMMENT_THREAD = T.StructType([
    T.StructField("id", S),
    T.StructField("snippet", T.StructType([
        T.StructField("videoId", S),
        T.StructField("totalReplyCount", L),
        T.StructField("topLevelComment", T.StructType([
            T.StructField("snippet", T.StructType([
                T.StructField("publishedAt", S),
                T.StructField("textOriginal", S),
                T.StructField("authorDisplayName", S),
                T.StructField("authorProfileImageUrl", S),
                T.StructField("authorChannelUrl", S),
                T.StructField("likeCount", L),
            ])),
        ])),
    ])),
])

# Flat comment row produced by the extractor (before classification).
FLAT_COMMENT = _schema(
    ("commentid", S), ("videoid", S), ("publishedat", S),
    ("textoriginal", S), ("authordisplayname", S),
    ("authorprofileimageurl", S), ("authorchannelurl", S),
    ("likecount", L), ("totalreplycount", L))

# Classified comment as written to the processed / failed CSV folders.
CLASSIFIED_COMMENT = _schema(
    ("commentid", S), ("videoid", S), ("publishedat", S),
    ("textoriginal", S), ("emotion", S), ("sentimentnature", S),
    ("authordisplayname", S), ("authorprofileimageurl", S),
    ("authorchannelurl", S), ("likecount", L), ("totalreplycount", L))

def with_field(schema: T.StructType, name: str, dtype: T.DataType = S) -> T.StructType:
    """Copy of ``schema`` plus one nullable field (``StructType.add``
    mutates in place, which would corrupt these shared constants)."""
    return T.StructType(list(schema.fields) + [T.StructField(name, dtype, True)])


ALL_STRING_CLASSIFIED = T.StructType(
    [T.StructField(f.name, S, True) for f in CLASSIFIED_COMMENT.fields])

"""Declared schemas: nothing is inferred from data."""

from pyspark.sql import types as T

_TEXT = T.StringType()
_LONG = T.LongType()
_BOOL = T.BooleanType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# One collected comment and one collected submission, as delivered in JSON lines.
COMMENT_JSON = _struct(
    ("id", _TEXT), ("link_id", _TEXT), ("parent_id", _TEXT), ("body", _TEXT), ("score", _LONG),
    ("total_awards_received", _LONG), ("gilded", _LONG), ("author", _TEXT),
    ("author_flair_text", _TEXT), ("created_utc", _LONG),
)
SUBMISSION_JSON = _struct(
    ("id", _TEXT), ("subreddit", _TEXT), ("title", _TEXT), ("selftext", _TEXT), ("url", _TEXT),
    ("score", _LONG), ("upvote_ratio", T.DoubleType()), ("num_comments", _LONG),
    ("total_awards_received", _LONG), ("gilded", _LONG), ("author", _TEXT),
    ("author_flair_text", _TEXT), ("is_self", _BOOL), ("domain", _TEXT),
    ("link_flair_text", _TEXT), ("over_18", _BOOL), ("spoiler", _BOOL), ("created_utc", _LONG),
    ("comments", T.ArrayType(COMMENT_JSON)),
)

RAW_POST = _struct(
    ("id", _TEXT), ("type", _TEXT), ("subreddit", _TEXT), ("title", _TEXT), ("text", _TEXT),
    ("url", _TEXT), ("score", _LONG), ("upvote_ratio", T.DoubleType()), ("num_comments", _LONG),
    ("total_awards", _LONG), ("gilded", _LONG), ("author", _TEXT), ("author_flair", _TEXT),
    ("is_self", _BOOL), ("domain", _TEXT), ("link_flair", _TEXT), ("over_18", _BOOL),
    ("spoiler", _BOOL), ("tickers", _TEXT), ("has_ticker", _BOOL), ("sentiment", _TEXT),
    ("vader_compound", T.DoubleType()), ("created_at", T.TimestampType()), ("parent_id", _TEXT),
    ("post_id", _TEXT),
)

REQUEST = _struct(("id", _LONG), ("text", _TEXT), ("model", _TEXT))

#: The written report: sections by sentiment, community and column are maps.
_DOUBLE = T.DoubleType()
_BY_NAME = lambda kind: T.MapType(_TEXT, kind)
REPORT_JSON = _struct(
    ("total_posts", _LONG),
    ("sentiment_distribution", _BY_NAME(_struct(("count", _LONG), ("percentage", _DOUBLE)))),
    ("subreddit_breakdown", _BY_NAME(_BY_NAME(_LONG))),
    ("numeric_stats", _BY_NAME(_struct(*[(s, _DOUBLE) for s in ("mean", "median", "std", "min", "max", "q25", "q75")]))),
    ("top_words", _BY_NAME(T.ArrayType(_TEXT))),
    ("available_plots", T.ArrayType(_TEXT)),
)

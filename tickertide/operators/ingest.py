"""Collected submissions and comments to one table of enriched posts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.functions.text import is_blank, trim_space
from tickertide.functions.tickers import extract_tickers, has_ticker, ticker_list
from tickertide.operators.keyed import first_per_key, join_on_skewed_key, top_per_key
from tickertide.operators.lexicon import score_sentiment
from tickertide.schemas import RAW_POST
from tickertide.settings import COMMENTS_PER_POST, POSTS_PER_COMMUNITY, REMOVED_BODIES
from tickertide.sources.handover import materialise


def full_text(title="title", body="selftext") -> Column:
    """Title and body in one text, trimmed."""
    empty = F.lit("")
    return trim_space(F.concat(F.coalesce(F.col(title), empty), F.lit(" "), F.coalesce(F.col(body), empty)))


def created_at(seconds="created_utc") -> Column:
    """Epoch seconds to a timestamp; missing means now."""
    return F.coalesce(F.timestamp_seconds(seconds), F.current_timestamp())


def _or(name: str, default) -> Column:
    return F.coalesce(F.col(name), F.lit(default)).alias(name)


def project_submissions(submissions: DataFrame) -> DataFrame:
    """Every field with its default, in the raw post schema."""
    return submissions.select(
        _or("id", ""),
        F.lit("post").alias("type"),
        "subreddit",
        _or("title", ""),
        full_text().alias("text"),
        _or("url", ""),
        _or("score", 0),
        "upvote_ratio",
        _or("num_comments", 0),
        F.coalesce("total_awards_received", F.lit(0)).alias("total_awards"),
        _or("gilded", 0),
        _or("author", "[deleted]"),
        F.col("author_flair_text").alias("author_flair"),
        _or("is_self", True),
        _or("domain", ""),
        F.col("link_flair_text").alias("link_flair"),
        _or("over_18", False),
        _or("spoiler", False),
        created_at().alias("created_at"),
    )


def drop_removed(comments: DataFrame, body: str = "body") -> DataFrame:
    """Without empty, deleted and removed comments."""
    return comments.filter(~is_blank(body) & ~trim_space(body).isin(*REMOVED_BODIES))


def project_comments(comments: DataFrame) -> DataFrame:
    """Comments that already carry post_id and subreddit, in the raw post schema."""
    return drop_removed(comments).select(
        _or("id", ""),
        F.lit("comment").alias("type"),
        "subreddit",
        F.lit("").alias("title"),
        trim_space("body").alias("text"),
        F.lit("").alias("url"),
        _or("score", 0),
        F.lit(None).cast("double").alias("upvote_ratio"),
        F.lit(0).cast("long").alias("num_comments"),
        F.coalesce("total_awards_received", F.lit(0)).alias("total_awards"),
        _or("gilded", 0),
        _or("author", "[deleted]"),
        F.col("author_flair_text").alias("author_flair"),
        F.lit(True).alias("is_self"),
        F.lit("").alias("domain"),
        F.lit(None).cast("string").alias("link_flair"),
        F.lit(False).alias("over_18"),
        F.lit(False).alias("spoiler"),
        created_at().alias("created_at"),
        _or("parent_id", ""),
        "post_id",
    )


def flatten_comments(submissions: DataFrame) -> DataFrame:
    """Nested comments to rows with post_id and the post's community."""
    with_comments = submissions.filter(F.col("num_comments") > 0)
    return with_comments.select(
        F.col("id").alias("post_id"), "subreddit", F.explode("comments").alias("c")
    ).select("post_id", "subreddit", "c.*")


def attach_comments(
    comments: DataFrame, posts: DataFrame, post_key: str = "post_id"
) -> DataFrame:
    """Flat comments meet their posts (unique ids) and inherit the community.

    One post may own a large share of all comments, so hot posts are split off.
    """
    owners = posts.filter(F.col("num_comments") > 0).select(F.col("id").alias(post_key), "subreddit")
    return join_on_skewed_key(comments, owners, post_key)


def top_comments(comments: DataFrame, k: int = COMMENTS_PER_POST) -> DataFrame:
    return top_per_key(comments, ["post_id"], [F.col("score").desc(), F.col("id")], k)


def keep_top_comments(submissions: DataFrame, k: int = COMMENTS_PER_POST) -> DataFrame:
    """The same for nested comments, inside each post's row: nothing is shuffled."""
    ranked = F.array_sort(F.transform("comments", lambda c: F.struct(
        c["score"].isNull().alias("unscored"), (-c["score"]).alias("down"), c["id"].alias("id"), c.alias("comment"))))
    return submissions.withColumn("comments", F.transform(F.slice(ranked, 1, k), lambda x: x["comment"]))


def latest_posts(posts: DataFrame, k: int = POSTS_PER_COMMUNITY, time: str = "created_at") -> DataFrame:
    return top_per_key(posts, ["subreddit"], [F.col(time).desc(), F.col("id")], k)


def union_posts(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """One table; the fields only comments have are null for posts."""
    return posts.unionByName(comments, allowMissingColumns=True)


def first_of_each_id(posts: DataFrame) -> DataFrame:
    return first_per_key(posts, ["id"], ["created_at", "type"])


def add_tickers(posts: DataFrame, text: str = "text") -> DataFrame:
    found = posts.withColumn("_tickers", extract_tickers(text))
    return found.withColumns(
        {"tickers": ticker_list("_tickers"), "has_ticker": has_ticker("_tickers")}
    ).drop("_tickers")


def _mentions(posts: DataFrame) -> DataFrame:
    symbols = F.filter(F.split("tickers", ","), lambda t: t != "")
    return posts.select("subreddit", F.explode(symbols).alias("ticker"))


def distinct_tickers(posts: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of distinct tickers over the run."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return _mentions(posts).agg(count("ticker").alias("unique_tickers"))


def ticker_mentions(posts: DataFrame) -> DataFrame:
    return _mentions(posts).groupBy("subreddit").agg(F.count(F.lit(1)).alias("mentions"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, null left out."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column)
    return counted.agg(F.count(F.lit(1)).alias("n"))


def distinct_communities(posts: DataFrame) -> DataFrame:
    return posts.select("subreddit").distinct()


def enrich(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Tickers and sentiment of posts and comments, in the raw post column order."""
    scored = score_sentiment(add_tickers(posts), lexicon)
    return scored.select(*[c for c in RAW_POST.names if c in scored.columns])


def collect_posts(submissions: DataFrame, lexicon: DataFrame) -> DataFrame:
    """The collection job: latest posts, their top comments, one enriched row per id."""
    # written, because posts and comments are both taken from it
    latest = materialise(keep_top_comments(latest_posts(submissions, time="created_utc")), "latest-posts")
    comments = flatten_comments(latest)
    rows = union_posts(project_submissions(latest), project_comments(comments))
    # ids first: text work is done once per kept row
    return enrich(first_of_each_id(rows), lexicon)

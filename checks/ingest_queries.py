"""Checks of sources, sinks and ingest."""

from pyspark.sql import functions as F

from checks.registry import check, time_text, times_as_text
from checks.text_queries import TICKERS_SQL, rules_sql
from checks.views_sql import pairs, with_views
from tickertide.functions.wordlists import SEED_LEXICON
from tickertide.operators import ingest as I
from tickertide.operators import lexicon as L
from tickertide.operators import wrangle as W
from tickertide.schemas import RAW_POST
from tickertide.sources import files
from tickertide.sources import sample_views as V
from tickertide.sources.handover import new_path


@check("raw_table_count", "SELECT count(*) AS n FROM documents")
def raw_table_count(spark, folder):
    path = new_path(spark, "raw")
    files.write_raw(V.posts(spark, folder), path)
    return files.count_raw(spark, path)


_RAW = f"""
SELECT CAST(id AS VARCHAR) AS id, type, subreddit, text, score, num_comments, {time_text('created_at')} AS created_at, sentiment
FROM posts"""
_RAW_COLUMNS = ["id", "type", "subreddit", "text", "score", "num_comments", "created_at", "sentiment"]


@check("raw_csv_scan", with_views(_RAW, "posts"))
def raw_csv_scan(spark, folder):
    path = new_path(spark, "csv")
    posts = V.posts(spark, folder).withColumn("id", F.col("id").cast("string"))
    stamped = posts.select(*_RAW_COLUMNS).withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    stamped.write.csv(path, header=True, escape='"')
    schema = type(RAW_POST)([f for c in _RAW_COLUMNS for f in RAW_POST if f.name == c])
    return times_as_text(files.read_raw_csv(spark, path, schema))


@check("processed_table_scan", with_views("SELECT id, sentiment, text FROM labelled", "labelled"))
def processed_table_scan(spark, folder):
    path = new_path(spark, "processed")
    files.write_processed(W.drop_copies(W.drop_missing(V.posts(spark, folder))), path)
    return files.read_processed(spark, path).select("id", "sentiment", "text")


def _nested(spark, folder):
    """Submissions with nested comments, most fields absent, as a collector would deliver them."""
    comments = V.thread_comments(spark, folder).groupBy("post_id").agg(
        F.collect_list(F.struct(F.col("id").cast("string").alias("id"), "body", "score", "created_utc")).alias("comments")
    )
    posts = V.thread_posts(spark, folder)
    joined = posts.join(comments, posts["id"] == comments["post_id"], "left")
    return joined.select(
        posts["id"].cast("string").alias("id"), "subreddit", F.lit("T").alias("title"), F.col("text").alias("selftext"),
        "score", "num_comments", "created_utc", "comments",
    )


def _landed(spark, folder):
    path = new_path(spark, "json")
    _nested(spark, folder).write.json(path)
    return files.read_submissions(spark, path)


@check(
    "landed_json_defaults",
    with_views(
        """
SELECT CAST(id AS VARCHAR) AS id, 'post' AS type, subreddit, 'T' AS title, regexp_replace('T ' || text, '^\\s+|\\s+$', '', 'g') AS text,
       '' AS url, score, num_comments, 0 AS total_awards, 0 AS gilded, '[deleted]' AS author, true AS is_self, '' AS domain,
       false AS over_18, false AS spoiler, strftime(to_timestamp(created_utc) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S.%f') AS created_at
FROM thread_posts""", "thread_posts",
    ),
)
def landed_json_defaults(spark, folder):
    posts = I.project_submissions(_landed(spark, folder))
    return times_as_text(posts.drop("upvote_ratio", "author_flair", "link_flair"))


@check(
    "landed_json_comments",
    with_views(
        """
SELECT CAST(id AS VARCHAR) AS id, CAST(post_id AS VARCHAR) AS post_id, subreddit, regexp_replace(body, '^\\s+|\\s+$', '', 'g') AS text, score
FROM kept_comments""", "kept_comments",
    ),
)
def landed_json_comments(spark, folder):
    comments = I.project_comments(I.flatten_comments(_landed(spark, folder)))
    return comments.select("id", "post_id", "subreddit", "text", "score")


@check("ingest_full_text", "SELECT doc_id, regexp_replace(source || ' ' || text, '^\\s+|\\s+$', '', 'g') AS out FROM documents")
def full_text(spark, folder):
    return V.table(spark, folder, "documents").select("doc_id", I.full_text("source", "text").alias("out"))


def _owned(spark, folder):
    return I.attach_comments(V.thread_comments(spark, folder), V.thread_posts(spark, folder))


@check("ingest_attach_comments", with_views("SELECT id, post_id, subreddit, score FROM owned_comments", "owned_comments"))
def attach_comments(spark, folder):
    return _owned(spark, folder).select("id", "post_id", "subreddit", "score")


@check("ingest_drop_removed", with_views("SELECT id, body FROM kept_comments", "kept_comments"))
def drop_removed(spark, folder):
    return I.drop_removed(_owned(spark, folder)).select("id", "body")


@check(
    "ingest_top_comments",
    with_views(
        """
SELECT id, post_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY score DESC, id) AS rn FROM kept_comments) WHERE rn <= 2""",
        "kept_comments",
    ),
)
def top_comments(spark, folder):
    return I.top_comments(I.drop_removed(_owned(spark, folder)), 2).select("id", "post_id", "score")


@check(
    "ingest_latest_posts",
    with_views(
        """
SELECT id, subreddit FROM (
  SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY created_at DESC NULLS LAST, id) AS rn FROM posts) WHERE rn <= 7""",
        "posts",
    ),
)
def latest_posts(spark, folder):
    return I.latest_posts(V.posts(spark, folder), 7).select("id", "subreddit")


def _both(spark, folder):
    posts = V.thread_posts(spark, folder).withColumn("type", F.lit("post"))
    comments = I.drop_removed(_owned(spark, folder)).select(
        "id", F.lit("comment").alias("type"), "subreddit", F.col("body").alias("text"), "score",
        F.lit(0).cast("long").alias("num_comments"), "created_utc", "post_id",
    )
    return I.union_posts(posts, comments)


@check(
    "ingest_union",
    with_views("SELECT id, type, subreddit, score, num_comments, coalesce(post_id, -1) AS post_id FROM merged", "merged"),
)
def union(spark, folder):
    return _both(spark, folder).select(
        "id", "type", "subreddit", "score", "num_comments", F.coalesce("post_id", F.lit(-1)).alias("post_id")
    )


@check(
    "ingest_first_of_each_id",
    with_views(
        """
SELECT id, type, score, created_utc FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_utc, type) AS rn FROM (
    SELECT id, type, score, created_utc FROM merged
    UNION ALL SELECT id // 2, 'repost', score + 1, created_utc + 7 - id % 15 FROM merged)) WHERE rn = 1""",
        "merged",
    ),
)
def first_of_each_id(spark, folder):
    rows = _both(spark, folder).select("id", "type", "score", F.timestamp_seconds("created_utc").alias("created_at"), "created_utc")
    again = rows.select(
        F.expr("id div 2").alias("id"), F.lit("repost").alias("type"), (F.col("score") + 1).alias("score"),
        (F.col("created_utc") + 7 - F.col("id") % 15).alias("created_utc"),
    ).withColumn("created_at", F.timestamp_seconds("created_utc"))
    return I.first_of_each_id(rows.unionByName(again)).select("id", "type", "score", "created_utc")


@check(
    "ingest_created_at",
    with_views("SELECT id, strftime(to_timestamp(created_utc) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S.%f') AS created_at FROM turns", "turns"),
)
def created_at(spark, folder):
    turns = V.thread_turns(spark, folder)
    return times_as_text(turns.select("id", I.created_at().alias("created_at")))


@check(
    "ingest_value_counts",
    with_views(
        """
SELECT 'sentiment' AS column_name, sentiment AS value, count(*) AS n FROM posts WHERE sentiment IS NOT NULL GROUP BY sentiment
UNION ALL SELECT 'type', type, count(*) FROM merged GROUP BY type
UNION ALL SELECT 'subreddit', subreddit, 1 FROM posts GROUP BY subreddit""", "posts", "merged",
    ),
)
def value_counts(spark, folder):
    posts = V.posts(spark, folder)

    def named(table, column):
        return table.select(F.lit(column).alias("column_name"), F.col(column).alias("value"), F.col("n").cast("long").alias("n"))

    found = named(I.value_counts(posts, "sentiment"), "sentiment")
    found = found.unionByName(named(I.value_counts(_both(spark, folder), "type"), "type"))
    return found.unionByName(named(I.distinct_communities(posts).withColumn("n", F.lit(1)), "subreddit"))


@check(
    "collect_job",
    with_views("", "kept_comments").rstrip() + f""",
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY created_utc DESC, CAST(id AS VARCHAR)) AS rn FROM thread_posts) WHERE rn <= 100),
best AS (
  SELECT c.* FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY score DESC NULLS LAST, CAST(id AS VARCHAR)) AS rn FROM thread_comments) c
  JOIN latest p ON p.id = c.post_id WHERE c.rn <= 25),
every AS (
  SELECT CAST(id AS VARCHAR) AS id, 'post' AS type, subreddit, regexp_replace('T ' || text, '^\\s+|\\s+$', '', 'g') AS text, created_utc, CAST(NULL AS VARCHAR) AS post_id FROM latest
  UNION ALL
  SELECT CAST(k.id AS VARCHAR), 'comment', k.subreddit, regexp_replace(k.body, '^\\s+|\\s+$', '', 'g'), k.created_utc, CAST(k.post_id AS VARCHAR)
  FROM kept_comments k JOIN best b ON b.id = k.id AND b.post_id = k.post_id),
collected AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_utc, type) AS rn FROM every) WHERE rn = 1),
seed AS (SELECT * FROM (VALUES {pairs(SEED_LEXICON)}) t(term, valence)),
scored AS ({rules_sql("collected", "seed")})
SELECT id, type, subreddit, array_to_string(t, ',') AS tickers, len(t) > 0 AS has_ticker,
       CASE WHEN vader_compound >= 0.05 THEN 'positive' WHEN vader_compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment, vader_compound, post_id
FROM (SELECT *, {TICKERS_SQL} AS t FROM collected) JOIN scored USING (id)""",
)
def collect_job(spark, folder):
    return I.collect_posts(_landed(spark, folder), L.seed_lexicon(spark)).select(
        "id", "type", "subreddit", "tickers", "has_ticker", "sentiment", "vader_compound", "post_id"
    )

"""Checks of wrangling, statistics and chart data."""

from functools import lru_cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import check, rounded, time_text, times_as_text
from checks.views_sql import with_views, words
from tickertide.operators import charts as C
from tickertide.operators import stats as S
from tickertide.operators import wrangle as W
from tickertide.plans.modelling import write_report_days, write_report_of_days
from tickertide.plans.preprocess import preprocess
from tickertide.sources import files
from tickertide.sources import sample_views as V
from tickertide.sources.handover import materialise, new_path

SENTIMENTS = "(VALUES (0, 'positive'), (1, 'neutral'), (2, 'negative')) o(position, sentiment)"


def labelled(spark, folder):
    return W.drop_copies(W.drop_missing(V.posts(spark, folder)))


def derive(spark, folder):
    return W.add_derived_columns(W.add_full_clean(labelled(spark, folder), V.lemmas(spark)))


@lru_cache(maxsize=4)
def derived(spark, folder):
    """Texts are cleaned once; statistics, charts and features read the written table."""
    return materialise(derive(spark, folder), "derived")


@check("wrangle_drop_missing", with_views("SELECT id, sentiment FROM posts WHERE text IS NOT NULL AND sentiment IS NOT NULL", "posts"))
def drop_missing(spark, folder):
    return W.drop_missing(V.posts(spark, folder)).select("id", "sentiment")


@check("wrangle_drop_copies", with_views(f"SELECT id, score, sentiment, {time_text('created_at')} AS created_at FROM labelled", "labelled"))
def drop_copies(spark, folder):
    return times_as_text(labelled(spark, folder).select("id", "score", "sentiment", "created_at"))


@check(
    "wrangle_derived_columns",
    with_views(
        "SELECT id, text_length, word_count, clean_length, clean_wc, engagement, hour_of_day, day_of_week FROM derived", "derived"
    ),
)
def derived_columns(spark, folder):
    return derive(spark, folder).select(
        "id", "text_length", "word_count", "clean_length", "clean_wc", "engagement", "hour_of_day", "day_of_week"
    )


@check("wrangle_long_texts", with_views("SELECT id, clean_wc FROM derived WHERE clean_wc >= 60", "derived"))
def long_texts(spark, folder):
    return W.keep_long_texts(derived(spark, folder), 60).select("id", "clean_wc")


_EVENT_FENCE = """
SELECT event_id, value FROM events, (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
WHERE value >= a - 1.5 * (b - a) AND value <= b + 1.5 * (b - a)"""


@check("wrangle_fence_decimal", _EVENT_FENCE)
def fence_decimal(spark, folder):
    return W.keep_within_fence(V.table(spark, folder, "events"), "value").select("event_id", "value")


@check(
    "wrangle_fence_score",
    with_views(
        """
SELECT id, score FROM posts, (SELECT quantile_cont(score, 0.25) AS a, quantile_cont(score, 0.75) AS b FROM posts)
WHERE score >= a - 1.5 * (b - a) AND score <= b + 1.5 * (b - a)""", "posts",
    ),
)
def fence_score(spark, folder):
    return W.keep_within_fence(V.posts(spark, folder), "score").select("id", "score")


@check("wrangle_chained_fences", with_views("SELECT id, score, num_comments FROM by_comments", "by_comments"))
def chained_fences(spark, folder):
    kept = W.keep_long_texts(derived(spark, folder), 3)
    return W.keep_within_fence(W.keep_within_fence(kept, "score"), "num_comments").select("id", "score", "num_comments")


@check(
    "wrangle_deviation",
    with_views(
        """
SELECT id, coalesce(x, -1) AS x FROM (SELECT id, nullif(score, 36) AS x FROM posts),
  (SELECT avg(x) AS m FROM (SELECT nullif(score, 36) AS x FROM posts)),
  (SELECT stddev_pop(coalesce(x, m2)) AS s FROM (SELECT nullif(score, 36) AS x FROM posts), (SELECT avg(nullif(score, 36)) AS m2 FROM posts))
WHERE abs(coalesce(x, m) - m) / s < 2""", "posts",
    ),
)
def deviation(spark, folder):
    posts = V.posts(spark, folder).withColumn("x", F.nullif("score", F.lit(36)))
    return W.keep_within_deviation(posts, "x", 2.0).select("id", F.coalesce("x", F.lit(-1)).alias("x"))


@check(
    "wrangle_encode_sentiment",
    with_views("SELECT id, coalesce(CASE sentiment WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 END, -1) AS sentiment_label FROM posts", "posts"),
)
def encode_sentiment(spark, folder):
    return W.encode_sentiment(V.posts(spark, folder)).select("id", F.coalesce("sentiment_label", F.lit(-1)).alias("sentiment_label"))


@check(
    "preprocess_job",
    with_views("SELECT id, cleaned_text, clean_wc, score, num_comments, text_length, engagement, sentiment_label FROM processed", "processed"),
)
def preprocess_job(spark, folder):
    return preprocess(V.posts(spark, folder), V.lemmas(spark)).posts.select(
        "id", "cleaned_text", "clean_wc", "score", "num_comments", "text_length", "engagement", "sentiment_label"
    )


@check(
    "preprocess_accounting",
    with_views(
        """
SELECT step, lag(n) OVER (ORDER BY i) AS rows_in, n AS rows_out FROM (
  SELECT 0 AS i, 'input' AS step, count(*) AS n FROM posts
  UNION ALL SELECT 1, 'missing', count(*) FROM posts WHERE text IS NOT NULL AND sentiment IS NOT NULL
  UNION ALL SELECT 2, 'copies', count(*) FROM labelled
  UNION ALL SELECT 3, 'short', count(*) FROM long_enough
  UNION ALL SELECT 4, 'score_fence', count(*) FROM by_score
  UNION ALL SELECT 5, 'comment_fence', count(*) FROM by_comments
  UNION ALL SELECT 6, 'length_deviation', count(*) FROM processed) QUALIFY step <> 'input'""", "processed", "posts",
    ),
)
def preprocess_accounting(spark, folder):
    return preprocess(V.posts(spark, folder), V.lemmas(spark)).accounting


# --- statistics ---------------------------------------------------------------------------


@check("stats_shape", with_views("SELECT count(*) AS n_rows, 9 AS n_columns FROM posts", "posts"))
def shape(spark, folder):
    return S.shape(V.posts(spark, folder))


@check(
    "stats_sentiment_shares",
    with_views(
        """
SELECT 'all' AS base, sentiment, count(*) AS count, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM posts), 6) AS percentage
FROM posts WHERE sentiment IS NOT NULL GROUP BY sentiment
UNION ALL
SELECT 'known', sentiment, count(*), round(count(*) * 100.0::DOUBLE / (SELECT count(sentiment) FROM posts), 6)
FROM posts WHERE sentiment IS NOT NULL GROUP BY sentiment""", "posts",
    ),
)
def sentiment_shares(spark, folder):
    posts = V.posts(spark, folder)
    of_all = S.sentiment_shares(posts).withColumn("base", F.lit("all"))
    return rounded(of_all.unionByName(S.sentiment_shares(posts, of_all_rows=False).withColumn("base", F.lit("known"))))


@check("stats_community_counts", with_views("SELECT subreddit, count(*) AS count FROM posts GROUP BY subreddit", "posts"))
def community_counts(spark, folder):
    return S.community_counts(V.posts(spark, folder))


def _describe_sql(columns, source):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS median,
round(quantile_cont({c}, 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM {source}"""
        for c in columns
    ).replace(" AS column", ' AS "column"')


@check(
    "stats_describe_numeric",
    with_views(_describe_sql(["score", "num_comments", "text_length", "word_count", "engagement"], "derived"), "derived"),
)
def describe_numeric(spark, folder):
    return rounded(S.describe_numeric(derived(spark, folder)))


@check("stats_describe_decimal", _describe_sql(["value"], "events"))
def describe_decimal(spark, folder):
    return rounded(S.describe_numeric(V.table(spark, folder, "events"), ["value"]))


@check(
    "stats_report_numbers",
    with_views(_describe_sql(["score", "num_comments", "word_count", "engagement"], "derived"), "derived"),
)
def report_numbers(spark, folder):
    return rounded(S.describe_numeric(derived(spark, folder), ["score", "num_comments", "upvote_ratio", "word_count", "engagement"]))


@check(
    "stats_missing_values",
    with_views(
        """
SELECT * FROM (
  SELECT 'sentiment' AS "column", count(*) - count(sentiment) AS missing FROM posts
  UNION ALL SELECT 'score', count(*) - count(score) FROM posts UNION ALL SELECT 'text', count(*) - count(text) FROM posts
  UNION ALL SELECT 'created_at', count(*) - count(created_at) FROM posts) WHERE missing > 0""", "posts",
    ),
)
def missing_values(spark, folder):
    return S.missing_values(V.posts(spark, folder))


_WORDS = "(SELECT sentiment, unnest(string_split(cleaned_text, ' ')) AS word FROM derived)"


@check(
    "stats_token_totals",
    with_views(
        f"""
SELECT count(*) AS total_tokens, count(DISTINCT word) AS unique_tokens,
       round(count(*)::DOUBLE / greatest((SELECT count(*) FROM derived), 1), 2) AS avg_per_doc FROM {_WORDS} WHERE word <> ''""", "derived",
    ),
)
def token_totals(spark, folder):
    return S.token_totals(derived(spark, folder))


@check("stats_top_tokens", with_views(f"SELECT word AS token, count(*) AS n FROM {_WORDS} WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 10", "derived"))
def top_tokens(spark, folder):
    return S.top_tokens(derived(spark, folder))


@check("stats_total_posts", with_views("SELECT count(*) AS total_posts FROM posts", "posts"))
def total_posts(spark, folder):
    return S.total_posts(V.posts(spark, folder))


@check(
    "stats_community_sentiments",
    with_views("SELECT subreddit, sentiment, count(*) AS count FROM posts WHERE sentiment IS NOT NULL GROUP BY ALL", "posts"),
)
def community_sentiments(spark, folder):
    return S.community_sentiments(V.posts(spark, folder))


def _top_words_sql(k):
    return f"""
SELECT sentiment, word, n FROM (
  SELECT sentiment, word, count(*) AS n, row_number() OVER (PARTITION BY sentiment ORDER BY count(*) DESC, word) AS rn
  FROM {_WORDS} WHERE word <> '' GROUP BY sentiment, word) WHERE rn <= {k}"""


@check("stats_top_words", with_views(_top_words_sql(20), "derived"))
def top_words(spark, folder):
    return S.top_words(derived(spark, folder), 20)


@check(
    "stats_report",
    with_views(
        f"""
SELECT (SELECT count(*) FROM derived) AS total_posts,
       (SELECT string_agg(sentiment || ' ' || count || ' ' || percentage, '; ' ORDER BY sentiment) FROM (
          SELECT sentiment, count(*) AS count, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM derived), 2) AS percentage
          FROM derived GROUP BY sentiment)) AS sentiment_distribution,
       (SELECT string_agg(subreddit || ' ' || sentiment || ' ' || n, '; ' ORDER BY subreddit, sentiment) FROM (
          SELECT subreddit, sentiment, count(*) AS n FROM derived GROUP BY ALL)) AS subreddit_breakdown,
       (SELECT string_agg(sentiment || ' ' || w, '; ' ORDER BY sentiment) FROM (
          SELECT sentiment, string_agg(word, ' ' ORDER BY n DESC, word) AS w FROM ({_top_words_sql(20)}) GROUP BY sentiment)) AS top_words""",
        "derived",
    ),
)
def report(spark, folder):
    built = S.build_report(derived(spark, folder))

    def listed(column, text):
        return F.array_join(F.array_sort(F.transform(F.map_entries(column), text)), "; ")

    nested = F.flatten(
        F.transform(
            F.map_entries("subreddit_breakdown"),
            lambda c: F.transform(
                F.map_entries(c["value"]), lambda s: F.concat_ws(" ", c["key"], s["key"], s["value"].cast("string"))
            ),
        )
    )
    return built.select(
        "total_posts",
        listed("sentiment_distribution", lambda e: F.concat_ws(" ", e["key"], e["value"]["count"].cast("string"), e["value"]["percentage"].cast("string"))).alias("sentiment_distribution"),
        F.array_join(F.array_sort(nested), "; ").alias("subreddit_breakdown"),
        listed(F.map_filter("top_words", lambda _, w: F.size(w) > 0), lambda e: F.concat_ws(" ", e["key"], F.array_join(e["value"], " "))).alias("top_words"),
    )


_REPORT_STATS = ["mean", "median", "std", "min", "max", "q25", "q75"]
_REPORT_NUMBERS = ["score", "num_comments", "word_count", "engagement"]


_REPORT_SQL = with_views(
    f"""
SELECT 'total_posts' AS part, '' AS name, count(*)::DOUBLE AS value FROM derived
UNION ALL SELECT 'count', sentiment, count(*) FROM derived GROUP BY sentiment
UNION ALL SELECT 'percentage', sentiment, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM derived), 2) FROM derived GROUP BY sentiment
UNION ALL SELECT 'community', subreddit || '|' || sentiment, count(*) FROM derived GROUP BY subreddit, sentiment
UNION ALL SELECT 'word', sentiment || '|' || word, row_number() OVER (PARTITION BY sentiment ORDER BY n DESC, word) - 1 FROM ({_top_words_sql(20)})
UNION ALL SELECT 'plot', unnest({S.REPORT_PLOTS}), unnest(range({len(S.REPORT_PLOTS)}))
UNION ALL SELECT 'number', "column" || '|' || stat, round(value, 2) FROM (
  UNPIVOT ({_describe_sql(_REPORT_NUMBERS, "derived")}) ON {", ".join(_REPORT_STATS)} INTO NAME stat VALUE value)""",
    "derived",
)


def _report_fields(found):
    """(part, name, value) of every field of a stored report."""

    def rows(part, entries):
        return found.select(F.explode(entries).alias("e")).select(F.lit(part).alias("part"), F.col("e.name").alias("name"), F.col("e.value").cast("double").alias("value"))

    def entry(name, value):
        return F.struct(name.alias("name"), value.cast("double").alias("value"))

    shares, numbers = F.map_entries("sentiment_distribution"), F.map_entries("numeric_stats")
    nested = F.flatten(F.transform(F.map_entries("subreddit_breakdown"), lambda c: F.transform(F.map_entries(c["value"]), lambda s: entry(F.concat_ws("|", c["key"], s["key"]), s["value"]))))
    words = F.flatten(F.transform(F.map_entries("top_words"), lambda w: F.transform(w["value"], lambda x, i: entry(F.concat_ws("|", w["key"], x), i))))
    stats = F.flatten(F.transform(numbers, lambda n: F.array(*[entry(F.concat_ws("|", n["key"], F.lit(s)), n["value"][s]) for s in _REPORT_STATS])))
    parts = [
        rows("total_posts", F.array(entry(F.lit(""), F.col("total_posts")))), rows("count", F.transform(shares, lambda e: entry(e["key"], e["value"]["count"]))),
        rows("percentage", F.transform(shares, lambda e: entry(e["key"], e["value"]["percentage"]))), rows("community", nested), rows("word", words),
        rows("plot", F.transform("available_plots", lambda p, i: entry(p, i))), rows("number", stats),
    ]
    return reduce(DataFrame.unionByName, parts)


@check("report_scan", _REPORT_SQL)
def report_scan(spark, folder):
    """Every field of the stored report, read again."""
    path = new_path(spark, "report")
    files.write_report(S.report_json(derived(spark, folder)), path)
    return _report_fields(files.read_report(spark, path))


@check("report_of_days", _REPORT_SQL)
def report_of_days(spark, folder):
    """The same report from parts per day; the days of the later half are written again, which must change nothing."""
    parts, path, posts = new_path(spark, "report-days"), new_path(spark, "report"), derived(spark, folder)
    write_report_days(posts, parts)
    middle = posts.agg(F.date_format(F.timestamp_seconds(F.avg(F.unix_seconds("created_at"))), "yyyy-MM-dd")).first()[0]
    if middle:
        write_report_days(posts, parts, since=middle)
    write_report_of_days(spark, parts, path)
    return _report_fields(files.read_report(spark, path))


# --- chart data ---------------------------------------------------------------------------


@check(
    "chart_sentiment_distribution",
    with_views(f"SELECT o.position, o.sentiment, count(p.id) AS count FROM {SENTIMENTS} LEFT JOIN posts p USING (sentiment) GROUP BY ALL", "posts"),
)
def sentiment_distribution(spark, folder):
    return C.sentiment_distribution(V.posts(spark, folder))


def _pivot_sql(key, name, source):
    columns = ", ".join(f"count(*) FILTER (sentiment = '{s}') AS {s}" for s in ("positive", "neutral", "negative"))
    return f"SELECT {key} AS {name}, {columns} FROM {source} WHERE sentiment IS NOT NULL GROUP BY 1"


_LONG_CLEAN = "(SELECT * FROM cleaned WHERE len(string_split(cleaned_text, ' ')) >= 5)"


@check("chart_sentiment_by_community", with_views(_pivot_sql("subreddit", "subreddit", _LONG_CLEAN), "cleaned"))
def sentiment_by_community(spark, folder):
    """Of texts with at least five words after cleaning, so that the cleaning is part of the plan."""
    posts = W.add_full_clean(labelled(spark, folder), V.lemmas(spark))
    return C.sentiment_by_community(W.keep_long_texts(posts, 5))


@check(
    "chart_word_weights",
    with_views(
        f"SELECT sentiment, word, n, round(n::DOUBLE / max(n) OVER (PARTITION BY sentiment), 6) AS weight FROM ({_top_words_sql(200)})", "derived"
    ),
)
def word_weights(spark, folder):
    return rounded(C.word_weights(derived(spark, folder)))


@check("chart_sentiment_over_time", with_views(_pivot_sql("strftime(created_at, '%Y-%m-%d')", "date", "posts"), "posts"))
def sentiment_over_time(spark, folder):
    return C.sentiment_over_time(V.posts(spark, folder)).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@check(
    "chart_sentiment_over_time_dense",
    with_views(
        f"""
SELECT strftime(d.day, '%Y-%m-%d') AS date, coalesce(positive, 0) AS positive, coalesce(neutral, 0) AS neutral, coalesce(negative, 0) AS negative
FROM (SELECT unnest(generate_series(min(created_at::DATE), max(created_at::DATE), INTERVAL 1 DAY)) AS day FROM posts WHERE sentiment IS NOT NULL) d
LEFT JOIN ({_pivot_sql("created_at::DATE", "day", "posts")}) p ON p.day = d.day""", "posts",
    ),
)
def sentiment_over_time_dense(spark, folder):
    return C.sentiment_over_time(V.posts(spark, folder), dense=True).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@check("chart_hourly_sentiment", with_views(_pivot_sql("hour(created_at)", "hour", "posts"), "posts"))
def hourly_sentiment(spark, folder):
    return C.hourly_sentiment(V.posts(spark, folder))


@check(
    "chart_score_distribution",
    with_views(
        """
SELECT sentiment, i / 20.0::DOUBLE AS share, round(quantile_cont(score, 0.05 * i), 6) AS score FROM posts, range(0, 21) r(i)
WHERE sentiment IS NOT NULL GROUP BY sentiment, i""".replace(
            "quantile_cont(score, 0.05 * i)",
            "list_sort(list(score))[CAST(floor(i * (count(*) - 1) / 20.0) AS BIGINT) + 1] + (list_sort(list(score))"
            "[CAST(ceil(i * (count(*) - 1) / 20.0) AS BIGINT) + 1] - list_sort(list(score))[CAST(floor(i * (count(*) - 1) / 20.0) AS BIGINT) + 1])"
            " * (i * (count(*) - 1) / 20.0::DOUBLE - floor(i * (count(*) - 1) / 20.0::DOUBLE))",
        ), "posts",
    ),
)
def score_distribution(spark, folder):
    return rounded(C.score_distribution(V.posts(spark, folder)))


@check(
    "chart_comment_box",
    with_views(
        """
SELECT sentiment, round(q1, 6) AS q1, round(m, 6) AS median, round(q3, 6) AS q3,
       min(num_comments) FILTER (num_comments BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
       max(num_comments) FILTER (num_comments BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
       count(*) FILTER (num_comments NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM posts JOIN (SELECT sentiment, quantile_cont(num_comments, 0.25) AS q1, quantile_cont(num_comments, 0.5) AS m,
                        quantile_cont(num_comments, 0.75) AS q3 FROM posts WHERE sentiment IS NOT NULL GROUP BY sentiment) USING (sentiment)
GROUP BY sentiment, q1, m, q3""", "posts",
    ),
)
def comment_box(spark, folder):
    return rounded(C.comment_box(V.posts(spark, folder)))


@check(
    "chart_mean_engagement",
    with_views(f"SELECT o.position, o.sentiment, round(avg(score + num_comments), 6) AS mean_engagement FROM {SENTIMENTS} LEFT JOIN posts p USING (sentiment) GROUP BY ALL", "posts"),
)
def mean_engagement(spark, folder):
    posts = V.posts(spark, folder).withColumn("engagement", F.col("score") + F.col("num_comments"))
    return rounded(C.mean_engagement(posts))


@check(
    "chart_score_comment_bins",
    with_views(
        """
SELECT sentiment, CAST(floor(score / 10) * 10 AS BIGINT) AS score_bin, CAST(floor(num_comments / 10) * 10 AS BIGINT) AS comment_bin, count(*) AS n
FROM posts WHERE sentiment IS NOT NULL GROUP BY ALL""", "posts",
    ),
)
def score_comment_bins(spark, folder):
    return C.score_comment_bins(V.posts(spark, folder))


def _histogram_sql(source, column, bins, key=None):
    group = f"{key}, " if key else ""
    where = f" AND d.{key} = e.{key}" if key else ""
    return f"""
SELECT {f'e.{key} AS {key}, ' if key else ''}e.bin, round(e.bin_low, 6) AS bin_low, round(e.bin_high, 6) AS bin_high, count(d.{column}) AS n
FROM (SELECT {group}i AS bin, low + (high - low) / {bins} * i AS bin_low, low + (high - low) / {bins} * (i + 1) AS bin_high FROM (
        SELECT {group}CAST(min({column}) AS DOUBLE) - CASE WHEN min({column}) = max({column}) THEN 0.5 ELSE 0 END AS low,
               CAST(max({column}) AS DOUBLE) + CASE WHEN min({column}) = max({column}) THEN 0.5 ELSE 0 END AS high
        FROM {source} {f'GROUP BY {key}' if key else ''}), range(0, {bins}) r(i)) e
LEFT JOIN {source} d ON d.{column} >= e.bin_low AND (d.{column} < e.bin_high OR e.bin = {bins - 1}){where}
GROUP BY ALL"""


@check("chart_word_count_histogram", with_views(_histogram_sql("derived", "word_count", 10, "sentiment"), "derived"))
def word_count_histogram(spark, folder):
    return rounded(C.word_count_histogram(derived(spark, folder)))


@check("chart_engagement_histogram", with_views(_histogram_sql("derived", "engagement", 40), "derived"))
def engagement_histogram(spark, folder):
    return rounded(C.engagement_histogram(derived(spark, folder)))


def _ngram_sql(term_source):
    return f"""
SELECT sentiment, term, n FROM (
  SELECT sentiment, term, count(*) AS n, row_number() OVER (PARTITION BY sentiment ORDER BY count(*) DESC, term) AS rn
  FROM ({term_source}) WHERE term <> '' GROUP BY sentiment, term) WHERE rn <= 15"""


@check("chart_top_unigrams", with_views(_ngram_sql(f"SELECT sentiment, word AS term FROM {_WORDS}"), "derived"))
def top_unigrams(spark, folder):
    return C.top_ngrams(derived(spark, folder), 1)


@check(
    "chart_top_bigrams",
    with_views(
        _ngram_sql(
            "SELECT sentiment, w[i] || ' ' || w[i + 1] AS term FROM (SELECT sentiment, w, unnest(range(1, len(w))) AS i "
            "FROM (SELECT sentiment, string_split(cleaned_text, ' ') AS w FROM derived))"
        ), "derived",
    ),
)
def top_bigrams(spark, folder):
    return C.top_ngrams(derived(spark, folder), 2)


@check(
    "chart_radar",
    with_views(
        """
SELECT sentiment, metric, round(mean, 6) AS mean,
       round((mean - min(mean) OVER (PARTITION BY metric)) / (max(mean) OVER (PARTITION BY metric) - min(mean) OVER (PARTITION BY metric) + 1e-9), 6) AS normalised
FROM (
  SELECT sentiment, unnest(['score', 'num_comments', 'engagement', 'word_count']) AS metric,
         unnest([avg(score), avg(num_comments), avg(engagement), avg(word_count)]) AS mean FROM derived GROUP BY sentiment)""", "derived",
    ),
)
def radar(spark, folder):
    return rounded(C.radar(derived(spark, folder)))

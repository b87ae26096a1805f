"""Checks of monitoring metrics and streams."""

from pyspark.sql import functions as F

from checks.model_queries import _tables, _trained
from checks.registry import check, rounded, time_text, times_as_text
from checks.views_sql import with_views
from tickertide.operators import evaluate as E
from tickertide.operators import ingest as I
from tickertide.operators import lexicon as L
from tickertide.operators import metrics as P
from tickertide.operators import models as M
from tickertide.settings import COLLECT_SECONDS_BOUNDS, COMPOUND_BOUNDS, LATENCY_BOUNDS, STAGE_SECONDS_BOUNDS
from tickertide.sources import sample_views as V
from tickertide.sources.handover import new_path
from tickertide.streaming import jobs


def events(spark, folder):
    return V.metric_events(spark, folder)


def of_kind(spark, folder, kind):
    return events(spark, folder).filter(F.col("kind") == kind)


def _totals(name, kind, labels):
    columns = ", ".join(labels)

    @check(name, with_views(f"SELECT {columns}, count(*) AS total FROM metric WHERE kind = '{kind}' GROUP BY ALL", "metric"))
    def run(spark, folder):
        return P.totals(events(spark, folder), kind, labels)


_totals("metric_posts_total", "post_scraped", ["subreddit"])
_totals("metric_errors_total", "scrape_error", ["subreddit", "error_type"])
_totals("metric_rate_limit_total", "rate_limit_hit", ["subreddit"])
_totals("metric_predictions_total", "prediction", ["model", "predicted_sentiment"])


@check("metric_comments_total", with_views("SELECT subreddit, count(*) AS total FROM owned_comments GROUP BY subreddit", "owned_comments"))
def comments_total(spark, folder):
    owned = I.attach_comments(V.thread_comments(spark, folder), V.thread_posts(spark, folder))
    return P.totals(owned.withColumn("kind", F.lit("comment_scraped")), "comment_scraped", ["subreddit"])


@check(
    "metric_sentiments_total",
    with_views("SELECT subreddit, sentiment, count(*) AS total FROM posts WHERE sentiment IS NOT NULL GROUP BY ALL", "posts"),
)
def sentiments_total(spark, folder):
    labelled = V.posts(spark, folder).filter(F.col("sentiment").isNotNull()).withColumn("kind", F.lit("post_labelled"))
    return P.totals(labelled, "post_labelled", ["subreddit", "sentiment"])


@check(
    "metric_compound_histogram",
    f"""
SELECT event_type, CASE WHEN b.le = 'infinity'::DOUBLE THEN 1e9 ELSE b.le END AS le, count(*) FILTER (c <= b.le) AS n, count(*) AS total, round(sum(c), 6) AS sum
FROM (SELECT event_type, (value - 50) / sqrt((value - 50) * (value - 50) + 15) AS c FROM events),
     (VALUES {", ".join(f"({le}::DOUBLE)" for le in [*COMPOUND_BOUNDS, "'infinity'"])}) b(le) GROUP BY event_type, b.le""",
)
def compound_histogram(spark, folder):
    scored = V.table(spark, folder, "events").select("event_type", L.compound_score(F.col("value") - 50).alias("c"))
    return rounded(P.histogram(scored, "c", COMPOUND_BOUNDS, ["event_type"]).withColumn("le", F.least("le", F.lit(1e9))))


@check(
    "metric_collect_histogram",
    f"""
SELECT CASE WHEN b.le = 'infinity'::DOUBLE THEN 1e9 ELSE b.le END AS le, count(*) FILTER (value <= b.le) AS n, count(*) AS total, round(sum(value), 6) AS sum
FROM events, (VALUES {", ".join(f"({le}::DOUBLE)" for le in [*COLLECT_SECONDS_BOUNDS, "'infinity'"])}) b(le) GROUP BY b.le""",
)
def collect_histogram(spark, folder):
    runs = V.table(spark, folder, "events").select(F.col("value").alias("seconds"))
    return rounded(P.histogram(runs, "seconds", COLLECT_SECONDS_BOUNDS, []).withColumn("le", F.least("le", F.lit(1e9))))


@check(
    "metric_prediction_sentiments",
    with_views(
        "SELECT " + ", ".join(f"count(*) FILTER (predicted_sentiment = '{s}') AS {s}" for s in ("positive", "neutral", "negative"))
        + " FROM metric WHERE kind = 'prediction'", "metric",
    ),
)
def prediction_sentiments(spark, folder):
    return P.prediction_totals(events(spark, folder))


def _bounds(bounds):
    return ", ".join(f"({le}::DOUBLE)" for le in [*bounds, "'infinity'"])


@check(
    "metric_latency_histogram",
    with_views(
        f"""
SELECT model, CASE WHEN b.le = 'infinity'::DOUBLE THEN 1e9 ELSE b.le END AS le, count(*) FILTER (latency_s <= b.le) AS n, count(*) AS total, round(sum(latency_s), 6) AS sum
FROM metric, (VALUES {_bounds(LATENCY_BOUNDS)}) b(le) WHERE kind = 'prediction' GROUP BY model, b.le""", "metric",
    ),
)
def latency_histogram(spark, folder):
    found = P.histogram(of_kind(spark, folder, "prediction"), "latency_s", LATENCY_BOUNDS, ["model"])
    return rounded(found.withColumn("le", F.least("le", F.lit(1e9))))


_BUCKETS = f"""
SELECT {{labels}}, b.le, count(*) FILTER (latency_s <= b.le) AS n, count(*) AS total
FROM {{source}}, (VALUES {_bounds(LATENCY_BOUNDS)}) b(le) GROUP BY ALL"""


def _quantile_sql(labels, source):
    return f"""
SELECT {labels}, CASE WHEN le = 'infinity'::DOUBLE THEN {LATENCY_BOUNDS[-1]}::DOUBLE
       ELSE lower + (le - lower) * coalesce((total * 0.95::DOUBLE - before) / nullif(n - before, 0), 0) END AS quantile
FROM (SELECT *, coalesce(lag(le) OVER w, 0) AS lower, coalesce(lag(n) OVER w, 0) AS before
      FROM ({_BUCKETS.format(labels=labels, source=source)}) WINDOW w AS (PARTITION BY {labels} ORDER BY le))
WHERE n >= total * 0.95::DOUBLE QUALIFY row_number() OVER (PARTITION BY {labels} ORDER BY le) = 1"""


@check(
    "metric_latency_p95",
    with_views(f"SELECT model, round(quantile, 6) AS quantile FROM ({_quantile_sql('model', '(SELECT * FROM metric WHERE kind = ' + chr(39) + 'prediction' + chr(39) + ')')})", "metric"),
)
def latency_p95(spark, folder):
    return rounded(P.bucket_quantile(of_kind(spark, folder, "prediction"), "latency_s", LATENCY_BOUNDS, ["model"]))


_HOURS = f"{time_text('w')} AS window_start, {time_text('w + INTERVAL 1 HOUR')} AS window_end"


@check(
    "metric_rate",
    with_views(
        f"SELECT {_HOURS}, subreddit, count(*) AS n, round(count(*) / 3600::DOUBLE, 6) AS rate FROM (SELECT *, date_trunc('hour', ts) AS w FROM metric WHERE kind = 'post_scraped') GROUP BY w, subreddit",
        "metric",
    ),
)
def rate(spark, folder):
    return times_as_text(rounded(P.windowed_rate(of_kind(spark, folder, "post_scraped"), ["subreddit"], "1 hour")))


@check(
    "metric_rate_by_model",
    with_views(
        f"SELECT {_HOURS}, model, round(count(*) / 3600::DOUBLE, 6) AS rate FROM (SELECT *, date_trunc('hour', ts) AS w FROM metric WHERE kind = 'prediction') GROUP BY w, model",
        "metric",
    ),
)
def rate_by_model(spark, folder):
    rates = P.windowed_rate(of_kind(spark, folder, "prediction"), ["model", "predicted_sentiment"], "1 hour")
    return times_as_text(rounded(P.summed_rate(rates, ["model"])))


@check(
    "metric_sliding_increase",
    with_views(
        f"""
SELECT {time_text('w')} AS window_start, {time_text('w + INTERVAL 6 HOUR')} AS window_end, subreddit, count(*) AS increase
FROM (SELECT subreddit, date_trunc('hour', ts) - i * INTERVAL 1 HOUR AS w FROM metric, range(0, 6) r(i) WHERE kind = 'scrape_error') GROUP BY w, subreddit""",
        "metric",
    ),
)
def sliding_increase(spark, folder):
    return times_as_text(P.sliding_increase(of_kind(spark, folder, "scrape_error"), ["subreddit"], "6 hours", "1 hour"))


@check(
    "metric_sliding_increase_minutes",
    with_views(
        f"""
SELECT {time_text('w')} AS window_start, {time_text('w + INTERVAL 5 MINUTE')} AS window_end, subreddit, count(*) AS increase
FROM (SELECT subreddit, date_trunc('minute', ts) - i * INTERVAL 1 MINUTE AS w FROM metric, range(0, 5) r(i) WHERE kind = 'scrape_error') GROUP BY w, subreddit""",
        "metric",
    ),
)
def sliding_increase_minutes(spark, folder):
    """The documented five minutes, every minute."""
    return times_as_text(P.sliding_increase(of_kind(spark, folder, "scrape_error"), ["subreddit"]))


@check(
    "metric_rate_minutes",
    with_views(
        f"""
SELECT {time_text('w')} AS window_start, {time_text('w + INTERVAL 1 MINUTE')} AS window_end, subreddit, count(*) AS n, round(count(*) / 60::DOUBLE, 6) AS rate
FROM (SELECT *, date_trunc('minute', ts) AS w FROM metric WHERE kind = 'api_request') GROUP BY w, subreddit""",
        "metric",
    ),
)
def rate_minutes(spark, folder):
    """The documented one minute."""
    return times_as_text(rounded(P.windowed_rate(of_kind(spark, folder, "api_request"), ["subreddit"])))


@check("metric_latest_time", with_views(f"SELECT subreddit, {time_text('max(ts)')} AS last_ts FROM metric GROUP BY subreddit", "metric"))
def latest_time(spark, folder):
    return times_as_text(P.latest_time(events(spark, folder)))


def _spans(spark, folder):
    micros = F.unix_micros("ts") + F.round(F.col("latency_s") * 1e9).cast("long")
    return events(spark, folder).select(F.col("ts").alias("started_at"), F.timestamp_micros(micros).alias("ended_at"))


_ACTIVE = """
SELECT ts, CAST(sum(sum(change)) OVER (ORDER BY ts) AS BIGINT) AS active FROM (
  SELECT ts, 1 AS change FROM metric
  UNION ALL SELECT make_timestamp(epoch_us(ts) + CAST(round(latency_s * 1e9) AS BIGINT)), -1 FROM metric) GROUP BY ts"""


@check("metric_in_progress", with_views(f"SELECT {time_text('ts')} AS ts, active FROM ({_ACTIVE})", "metric"))
def in_progress(spark, folder):
    return times_as_text(P.in_progress(_spans(spark, folder)))


@check("metric_peak_in_progress", with_views(f"SELECT max(active) AS peak FROM ({_ACTIVE})", "metric"))
def peak_in_progress(spark, folder):
    return P.peak_in_progress(_spans(spark, folder))


def _alert_sql(rule, kind, label, steps, condition, hold):
    return f"""
SELECT '{rule}' AS rule, label, {time_text('min(tick)')} AS pending_at, {time_text(f'min(tick) + {hold} * INTERVAL 1 HOUR')} AS firing_at, {time_text('max(tick)')} AS last_at
FROM (SELECT *, sum(CASE WHEN on_ THEN 0 ELSE 1 END) OVER (PARTITION BY label ORDER BY tick) AS stretch FROM (
  SELECT label, tick, {condition} AS on_ FROM (
    SELECT s.label, s.tick, sum(coalesce(n, 0)) OVER (PARTITION BY s.label ORDER BY s.tick ROWS BETWEEN {steps - 1} PRECEDING AND CURRENT ROW) AS value
    FROM (SELECT label, unnest(generate_series(first_at, (SELECT max(date_trunc('hour', ts)) FROM metric), INTERVAL 1 HOUR)) AS tick
          FROM (SELECT {label} AS label, min(date_trunc('hour', ts)) AS first_at FROM metric WHERE kind = '{kind}' GROUP BY 1)) s
    LEFT JOIN (SELECT {label} AS label, date_trunc('hour', ts) AS tick, count(*) AS n FROM metric WHERE kind = '{kind}' GROUP BY ALL) c USING (label, tick))))
WHERE on_ GROUP BY label, stretch HAVING count(*) > {hold}"""


def _latency_alert_sql(hold):
    rolling = f"""(SELECT s.label, s.tick, m.latency_s FROM (
      SELECT label, unnest(generate_series(first_at, (SELECT max(date_trunc('hour', ts)) FROM metric), INTERVAL 1 HOUR)) AS tick
      FROM (SELECT model AS label, min(date_trunc('hour', ts)) AS first_at FROM metric WHERE kind = 'prediction' GROUP BY 1)) s
      JOIN metric m ON m.kind = 'prediction' AND m.model = s.label AND date_trunc('hour', m.ts) BETWEEN s.tick - INTERVAL 5 HOUR AND s.tick)"""
    spine = """(SELECT label, unnest(generate_series(first_at, (SELECT max(date_trunc('hour', ts)) FROM metric), INTERVAL 1 HOUR)) AS tick
      FROM (SELECT model AS label, min(date_trunc('hour', ts)) AS first_at FROM metric WHERE kind = 'prediction' GROUP BY 1))"""
    return f"""
SELECT 'latency' AS rule, label, {time_text('min(tick)')} AS pending_at, {time_text(f'min(tick) + {hold} * INTERVAL 1 HOUR')} AS firing_at, {time_text('max(tick)')} AS last_at
FROM (SELECT *, sum(CASE WHEN on_ THEN 0 ELSE 1 END) OVER (PARTITION BY label ORDER BY tick) AS stretch FROM (
  SELECT label, tick, coalesce(quantile > 1.0, false) AS on_ FROM {spine} LEFT JOIN ({_quantile_sql('label, tick', rolling)}) USING (label, tick)))
WHERE on_ GROUP BY label, stretch HAVING count(*) > {hold}"""


@check(
    "metric_alert_rules",
    with_views(
        " UNION ALL ".join(
            [
                _alert_sql("errors", "scrape_error", "subreddit || '|' || error_type", 6, "value > 0", 2),
                _alert_sql("no_posts", "post_scraped", "subreddit", 2, "value = 0", 1),
                _alert_sql("rate_limits", "rate_limit_hit", "subreddit", 6, "value > 5", 2),
                _alert_sql("requests", "api_request", "subreddit", 1, "value / 3600::DOUBLE > 0.0002", 1),
                _latency_alert_sql(2),
            ]
        ), "metric",
    ),
)
def alert_rules(spark, folder):
    """One-hour steps, because the event table is sparse."""
    holds = {"errors": 2, "no_posts": 1, "rate_limits": 2, "requests": 1, "latency": 2}
    limits = {"requests": 0.0002}
        # these events have no method, endpoint and status
    labels = {"requests": ["subreddit"]}
    return times_as_text(P.alert_rules(events(spark, folder), LATENCY_BOUNDS, "1 hour", 6, 2, holds, limits, labels))


@check(
    "metric_model_gauges",
    with_views(
        """
SELECT model AS model_name, round(arg_max(latency_s, event_id), 6) AS accuracy, round(arg_max(latency_s / 2, event_id), 6) AS f1_score, max(event_id) AS trained_at
FROM metric WHERE kind = 'prediction' GROUP BY model""", "metric",
    ),
)
def model_gauges(spark, folder):
    history = of_kind(spark, folder, "prediction").select(
        F.col("model").alias("model_name"), F.col("latency_s").alias("accuracy"), (F.col("latency_s") / 2).alias("f1_score"),
        F.col("event_id").alias("trained_at"),
    )
    return rounded(P.model_gauges(history))


@check("metric_evaluated_model_gauges", with_views("SELECT model_name, round(accuracy, 6) AS accuracy, round(f1_score, 6) AS f1_score FROM after_metrics", "after_metrics"))
def evaluated_model_gauges(spark, folder):
    """The gauges of two training runs of which the second counts."""
    runs = [E.model_metrics(V.predictions(spark, folder, right)).withColumn("trained_at", F.lit(right)) for right in (5, 6)]
    return rounded(P.model_gauges(runs[0].unionByName(runs[1])).drop("trained_at"))


@check(
    "metric_stage_histogram",
    f"""
SELECT stage, CASE WHEN b.le = 'infinity'::DOUBLE THEN 1e9 ELSE b.le END AS le, count(*) FILTER (seconds <= b.le) AS n, count(*) AS total, round(sum(seconds), 6) AS sum
FROM (SELECT event_type AS stage, value AS seconds FROM events), (VALUES {_bounds(STAGE_SECONDS_BOUNDS)}) b(le) GROUP BY stage, b.le""",
)
def stage_histogram(spark, folder):
    stages = V.table(spark, folder, "events").select(F.col("event_type").alias("stage"), F.col("value").alias("seconds"))
    return rounded(P.histogram(stages, "seconds", STAGE_SECONDS_BOUNDS, ["stage"]).withColumn("le", F.least("le", F.lit(1e9))))


@check("metric_run_outcomes", "SELECT CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status, count(*) AS total FROM events GROUP BY 1")
def run_outcomes(spark, folder):
    runs = V.table(spark, folder, "events").select(
        F.lit("run").alias("kind"), F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("status")
    )
    return P.totals(runs, "run", ["status"])


# --- streams ------------------------------------------------------------------------------


def _event_stream(spark, folder):
    """The event table as a stream."""
    return V.stream(spark, folder, "events")


def _written(spark, query, path):
    query.awaitTermination()
    return spark.read.parquet(path)


@check("stream_first_arrivals", "SELECT count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total FROM events")
def stream_first_arrivals(spark, folder):
    """Every event twice, the copy a minute later: each id comes out once."""
    stream = V.as_metric_events(_event_stream(spark, folder)).withColumnRenamed("event_id", "id")
    doubled = stream.withColumn("_late", F.explode(F.array(F.lit(0), F.lit(60))))
    doubled = doubled.withColumn("ts", F.col("ts") + F.make_dt_interval(secs=F.col("_late").cast("decimal(18,6)"))).drop("_late")
    path = new_path(spark, "arrivals")
    query = jobs.append_to(jobs.first_arrivals(doubled, "1 hour", "ts"), path, path + "-checkpoint", available_now=True)
    found = _written(spark, query, path)
    return found.agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("total"))


@check(
    "stream_window_counts",
    with_views(f"SELECT {_HOURS}, subreddit, count(*) AS n FROM (SELECT *, date_trunc('hour', ts) AS w FROM metric) GROUP BY w, subreddit", "metric"),
)
def stream_window_counts(spark, folder):
    stream = jobs.counted_windows(V.as_metric_events(_event_stream(spark, folder)), ["subreddit"], "1 hour", "1 hour")
    path = new_path(spark, "windows")
    jobs.upsert_windows(stream, path, path + "-checkpoint", ["subreddit"], "1 hour", available_now=True, compact_every=1).awaitTermination()
    return times_as_text(jobs.latest_windows(spark, path, ["subreddit"]))


@check(
    "stream_sliding_increase",
    with_views(
        f"""
SELECT {time_text('w')} AS window_start, {time_text('w + INTERVAL 6 HOUR')} AS window_end, subreddit, count(*) AS increase
FROM (SELECT subreddit, date_trunc('hour', ts) - i * INTERVAL 1 HOUR AS w FROM metric, range(0, 6) r(i) WHERE kind = 'scrape_error'),
     (SELECT max(ts) - INTERVAL 1 HOUR AS watermark FROM metric WHERE kind = 'scrape_error')
WHERE w + INTERVAL 6 HOUR <= watermark GROUP BY w, subreddit""",
        "metric",
    ),
)
def stream_sliding_increase(spark, folder):
    """Sums over panes, appended when a window has closed."""
    stream = V.as_metric_events(_event_stream(spark, folder)).filter("kind = 'scrape_error'")
    path = new_path(spark, "increases")
    query = jobs.append_to(jobs.finished_increases(stream, ["subreddit"], "6 hours", "1 hour", "1 hour"), path, path + "-checkpoint", available_now=True)
    return times_as_text(_written(spark, query, path))


@check("stream_scored_posts", "SELECT doc_id AS id, 'logistic_regression' AS model_used, true AS sound FROM documents")
def stream_scored_posts(spark, folder):
    """Every document is scored once by the stored model; no model is marked best, so it is logistic regression."""
    tables = _tables(spark, folder)
    name, model = M.load_best_model(spark, _trained(spark, folder, "logistic_regression")[1])
    documents = V.stream(spark, folder, "documents")
    scored = jobs.scored_posts(documents.withColumnRenamed("doc_id", "id"), model, name, tables.weights, tables.numeric, V.lemmas(spark))
    path = new_path(spark, "scored")
    found = _written(spark, jobs.append_to(scored, path, path + "-checkpoint", available_now=True), path)
    total = F.col("positive") + F.col("neutral") + F.col("negative")
    return found.select("id", "model_used", ((F.abs(total - 1) < 1e-3) & F.col("sentiment").isNotNull()).alias("sound"))

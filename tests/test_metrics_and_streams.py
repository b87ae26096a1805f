from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickertide.operators import metrics as P
from tickertide.plans.feature_tables import build_features
from tickertide.operators.models import base_models, score_texts
from tickertide.streaming import jobs

START = datetime(2024, 1, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


def test_bucket_quantile(spark):
    rows = [("a", x) for x in [0.5] * 90 + [1.5] * 10] + [("b", 9.0), ("c", None)]
    events = spark.createDataFrame(rows, "model string, latency double")
    found = {r["model"]: r["quantile"] for r in P.bucket_quantile(events, "latency", [1.0, 2.0], ["model"]).collect()}
    assert found == {"a": pytest.approx(1.5), "b": 2.0}


def test_in_progress(spark):
    spans = spark.createDataFrame([(at(0), at(5)), (at(1), at(2)), (at(2), at(3)), (at(4), None)], "started_at timestamp, ended_at timestamp")
    found = [(r["ts"], r["active"]) for r in P.in_progress(spans).orderBy("ts").collect()]
    assert found == [(at(0), 1), (at(1), 2), (at(2), 2), (at(3), 1), (at(4), 2), (at(5), 1)]
    assert P.peak_in_progress(spans).first()["peak"] == 2


def test_alert_hold_times(spark):
    rows = [(at(m), "scrape_error", "s", None, None) for m in (0, 20, 21)] + [(at(m), "post_scraped", "s", None, None) for m in (0, 30)]
    rows += [(at(40), "scrape_error", "other", None, None)]
    events = spark.createDataFrame(rows, "ts timestamp, kind string, subreddit string, model string, latency_s double")
    found = [
        (r["rule"], r["label"], r["pending_at"], r["firing_at"], r["last_at"])
        for r in P.alert_rules(events, [1.0]).orderBy("rule", "label", "pending_at").collect()
    ]
    assert found == [
        # the last event of any kind is at minute 40
        ("errors", "s", at(0), at(1), at(4)),
        ("errors", "s", at(20), at(21), at(25)),
        ("no_posts", "s", at(10), at(20), at(29)),
    ]


def plain_alerts(minutes, last, steps, limit, hold):
    """Stretches of (pending, last) minutes in which more than `limit` events lie in the last `steps` minutes."""
    counts, out, start = [0] * (last + 1), [], None
    for m in minutes:
        counts[m] += 1
    first = min(minutes)
    for m in range(first, last + 2):
        on = m <= last and sum(counts[max(first, m - steps + 1) : m + 1]) > limit
        if on and start is None:
            start = m
        if not on and start is not None:
            if m - start > hold:
                out.append((start, m - 1))
            start = None
    return out


@pytest.mark.parametrize("range_steps", [10, 13, 64, 4096])
def test_stretches_cross_ranges(spark, range_steps):
    import random

    rng = random.Random(range_steps)
    # sparse, dense and very long stretches
    minutes = [m for m in range(700) if rng.random() < (0.05 if m % 200 < 100 else 0.9)]
    other = [3, 500]
    rows = [(at(m), "scrape_error", s, None, None, 0.0) for s, ms in (("a", minutes), ("b", other)) for m in ms]
    events = spark.createDataFrame(rows, "ts timestamp, kind string, subreddit string, error_type string, model string, latency_s double")
    last = max(minutes + other)
    found = sorted((r["label"], r["pending_at"], r["last_at"]) for r in P.alert_rules(events, [1.0], range_steps=range_steps).collect())
    wanted = [(f"{s}|", at(a), at(b)) for s, ms in (("a", minutes), ("b", other)) for a, b in plain_alerts(ms, last, 5, 0, 1)]
    assert found == sorted(wanted) and len(found) > 5
    with pytest.raises(ValueError):
        P.rolling_counts(events, ["subreddit"], "1 minute", 9, range_steps=8)


@pytest.fixture
def all_partitions(spark):
    """Partitions of few rows stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_long_series_is_many_tasks(spark, all_partitions):
    year = spark.range(0, 365 * 24 * 60, 7).select((F.lit(START).cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("ts"), F.lit("s").alias("k"))
    rolled = P.rolling_counts(year, ["k"], "1 minute", 5)
    fired = P.firing(rolled, ["k"], F.col("value") > 0, 1, "r", "1 minute")
    # at minutes 7i to 7i + 4 an event lies in the last five minutes
    assert fired.count() == 365 * 24 * 60 // 7
    spread = rolled.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in spread) == 365 * 24 * 60 // 7 * 7 + 1
    assert len(spread) >= 6 and max(r["count"] for r in spread) < 0.4 * 365 * 24 * 60


def test_alerts_see_outages(spark):
    rows = [(at(0), "post_scraped", "s", None, None), (at(0), "scrape_error", "s", None, None)]
    rows += [(at(m), "prediction", None, "m", 0.1) for m in range(0, 61)]
    events = spark.createDataFrame(rows, "ts timestamp, kind string, subreddit string, model string, latency_s double")
    found = {r["rule"]: r for r in P.alert_rules(events, [1.0]).collect()}
    assert (found["no_posts"]["pending_at"], found["no_posts"]["firing_at"], found["no_posts"]["last_at"]) == (at(10), at(20), at(60))
    assert (found["errors"]["pending_at"], found["errors"]["firing_at"], found["errors"]["last_at"]) == (at(0), at(1), at(4))
    assert set(found) == {"no_posts", "errors"}


def test_alert_series_are_told_apart(spark):
    rows = [(at(m), "scrape_error", "s", "E1" if m else "E2", None, None) for m in (0, 5)] + [(at(30), "post_scraped", "s", None, None, None)]
    events = spark.createDataFrame(rows, "ts timestamp, kind string, subreddit string, error_type string, model string, latency_s double")
    found = [(r["rule"], r["label"], r["last_at"]) for r in P.alert_rules(events, [1.0]).orderBy("label").collect()]
    assert found == [("errors", "s|E1", at(9)), ("errors", "s|E2", at(4))]


def test_large_dictionary_on_a_stream(spark, tmp_path):
    from tickertide.functions.text import clean_tokens
    from tickertide.operators.lemmas import lemmatise

    lemmas = spark.range(25_000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("token"), F.concat(F.lit("l"), F.col("id").cast("string")).alias("lemma"))
    posts = spark.range(40).select("id", F.concat_ws(" ", F.concat(F.lit("w"), (F.col("id") * 600).cast("string")), F.lit("other w7")).alias("text"), (F.col("id") % 2).cast("int").alias("day"))
    write_days(posts, str(tmp_path / "in"), 2)
    score = lambda df: lemmatise(df, clean_tokens("text"), lemmas, "out")
    stream = stream_of(spark, str(tmp_path / "in"), posts.drop("day").schema)
    jobs.append_scored(stream, score, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    found = sorted((r["id"], r["out"]) for r in spark.read.parquet(str(tmp_path / "out")).select("id", "out").collect())
    assert found == sorted((r["id"], r["out"]) for r in score(posts).select("id", "out").collect())
    assert found[1][1] == ["l600", "other", "l7"]


def write_days(df, folder, days):
    for day in range(days):
        df.filter(F.col("day") == day).drop("day").coalesce(1).write.parquet(f"{folder}/day={day}")


@pytest.fixture
def posts(spark):
    base = spark.range(400).select(
        "id", (F.lit(START).cast("timestamp") + F.make_dt_interval(mins=(F.col("id") * 18).cast("int"))).alias("created_at"),
        F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("subreddit"),
    )
    return base.withColumn("day", F.datediff("created_at", F.lit("2024-01-01")))


def stream_of(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)


def test_stream_dedup_equals_batch(spark, posts, tmp_path):
    replay = posts.filter("id % 20 = 0").withColumn("created_at", F.col("created_at") + F.expr("interval 10 minutes"))
    write_days(posts.unionByName(replay), str(tmp_path / "in"), 5)
    schema = posts.drop("day").schema
    stream = jobs.first_arrivals(stream_of(spark, str(tmp_path / "in"), schema), "2 days")
    jobs.append_to(stream, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["id"] for r in found.collect()) == list(range(400))


def test_stream_windows_equal_batch_and_drop_late_rows(spark, posts, tmp_path):
    events = posts.withColumnRenamed("created_at", "ts")
    late = events.filter("id = 3").withColumn("day", F.lit(5))
    sentinel = events.filter("id = 399").withColumns({"ts": F.col("ts") + F.expr("interval 40 days"), "day": F.lit(6), "subreddit": F.lit("end")})
    write_days(events.unionByName(late).unionByName(sentinel), str(tmp_path / "in"), 7)
    stream = stream_of(spark, str(tmp_path / "in"), events.drop("day").schema)
    counted = jobs.counted_windows(stream, ["subreddit"], "1 hour", "12 hours")
    jobs.append_to(counted, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).filter("subreddit <> 'end'")
    wanted = P.windowed_counts(events, ["subreddit"], "1 hour")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_stream_upserts_equal_batch(spark, posts, tmp_path):
    events = posts.withColumnRenamed("created_at", "ts")
    write_days(events, str(tmp_path / "in"), 5)
    stream = stream_of(spark, str(tmp_path / "in"), events.drop("day").schema)
    counted = jobs.increased_windows(stream, ["subreddit"], "6 hours", "1 hour", "12 hours")
    jobs.upsert_windows(counted, str(tmp_path / "out"), str(tmp_path / "cp"), ["subreddit"], "12 hours", available_now=True).awaitTermination()
    found = jobs.latest_windows(spark, str(tmp_path / "out"), ["subreddit"])
    wanted = P.sliding_increase(events, ["subreddit"], "6 hours", "1 hour")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_window_table_is_bounded_by_open_windows(spark, tmp_path):
    from tickertide.streaming.upserts import WindowTable

    table = WindowTable(spark, str(tmp_path / "t"), ["k"])
    wanted, sizes = {}, []
    for number in range(50):
        # each batch changes its own hour and, while the delay lasts, the two before
        rows = [(at(60 * h), at(60 * h + 60), k, number) for h in range(max(0, number - 2), number + 1) for k in "ab"]
        wanted.update({r[:3]: r[3] for r in rows})
        batch = spark.createDataFrame(rows, "window_start timestamp, window_end timestamp, k string, n int").coalesce(1)
        # batch 23 is a compaction; it and a batch between two are repeated
        for _ in range(2 if number in (23, 30) else 1):
            table.add(batch, number, "2 hours", 4)
        if number in (0, 3, 23, 24, 30, 49):
            assert {(r[0], r[1], r[2]): r[3] for r in table.read().collect()} == {k: v for k, v in wanted.items()}
        sizes.append((len(table.numbers("deltas", "batch")), len(table.numbers("open", "upto")), len(table.numbers("manifest", "upto"))))
    assert max(s[0] for s in sizes) <= 8 and max(s[1] for s in sizes) <= 2 and max(s[2] for s in sizes) <= 2
    assert spark.read.parquet(str(tmp_path / "t" / "open" / "upto=47")).count() <= 2 * 4
    closed = spark.read.parquet(str(tmp_path / "t" / "closed"))
    assert closed.count() == closed.select("window_start", "k").distinct().count() >= 2 * 44
    with pytest.raises(FileNotFoundError):
        WindowTable(spark, str(tmp_path / "none"), ["k"]).read()


def test_a_crash_before_the_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    from tickertide.streaming.upserts import WindowTable

    table = WindowTable(spark, str(tmp_path / "t"), [])
    batch = lambda h: spark.createDataFrame([(at(60 * h), at(60 * h + 60), h)], "window_start timestamp, window_end timestamp, n int").coalesce(1)
    for number in range(3):
        table.add(batch(number), number, "1 hour", 2)
    # closed and open windows of batch 3 are written, the manifest is not
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(WindowTable, "_finish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        table.add(batch(3), 3, "1 hour", 2)
    assert table.numbers("closed", "upto") == [1, 3] and table.numbers("manifest", "upto") == [1]
    assert sorted(r["n"] for r in table.read().collect()) == [0, 1, 2, 3]
    table.add(batch(3), 3, "1 hour", 2)
    assert sorted(r["n"] for r in table.read().collect()) == [0, 1, 2, 3]


def test_panes_on_a_stream(spark, posts, tmp_path):
    events = posts.withColumnRenamed("created_at", "ts")
    late = events.filter("id = 3").withColumn("day", F.lit(5))
    sentinel = events.filter("id = 399").withColumns({"ts": F.col("ts") + F.expr("interval 40 days"), "day": F.lit(6), "subreddit": F.lit("end")})
    last = sentinel.withColumns({"ts": F.col("ts") + F.expr("interval 40 days"), "day": F.lit(7)})
    write_days(events.unionByName(late).unionByName(sentinel).unionByName(last), str(tmp_path / "in"), 8)
    stream = stream_of(spark, str(tmp_path / "in"), events.drop("day").schema)
    counted = jobs.finished_increases(stream, ["subreddit"], "6 hours", "1 hour", "12 hours")
    query = jobs.append_to(counted, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).filter("subreddit <> 'end'")
    wanted = P.sliding_increase(events, ["subreddit"], "6 hours", "1 hour")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    with pytest.raises(ValueError):
        P.pane_counts(events, ["subreddit"], "5 hours", "2 hours")


def test_stream_scores_equal_batch(spark, tmp_path):
    words = F.array(F.lit("crash loss"), F.lit("report day"), F.lit("rally gain"))
    label = (F.col("id") % 3).cast("int")
    names = F.array(*[F.lit(n) for n in ("negative", "neutral", "positive")])
    rows = spark.range(60).select("id", label.alias("sentiment_label"), F.get(names, label).alias("sentiment"), F.get(words, label).alias("cleaned_text"), (F.col("id") % 5).alias("score"))
    tables = build_features(rows)
    model = base_models(60)["naive_bayes"].fit(tables.features)
    texts = rows.select("id", F.initcap("cleaned_text").alias("text"), F.lit(0).alias("day"))
    write_days(texts, str(tmp_path / "in"), 1)
    stream = stream_of(spark, str(tmp_path / "in"), texts.drop("day").schema)
    scored = jobs.scored_posts(stream, model, "naive_bayes", tables.weights, tables.numeric)
    jobs.append_to(scored, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    wanted = score_texts(texts.drop("day"), model, "naive_bayes", tables.weights, tables.numeric)
    found = spark.read.parquet(str(tmp_path / "out")).select(*wanted.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_a_table_streams_from_one_file_or_a_folder_of_parts(spark, tmp_path):
    from tickertide.sources import sample_views as V
    from tickertide.streaming.jobs import append_to

    rows = spark.range(20).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    parts, single = tmp_path / "parts", tmp_path / "single"
    rows.repartition(3).write.parquet(str(parts / "documents.parquet"))
    rows.write.parquet(str(parts / "labels.parquet"))
    single.mkdir()
    rows.toPandas().to_parquet(single / "documents.parquet")
    for folder in (parts, single):
        out = str(folder / "out")
        append_to(V.stream(spark, str(folder), "documents"), out, out + "-checkpoint", available_now=True).awaitTermination()
        assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, rows.collect()))

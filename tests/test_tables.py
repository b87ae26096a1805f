import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickertide.operators import charts as C
from tickertide.operators import ingest as I
from tickertide.operators import keyed as K
from tickertide.operators import lexicon as L
from tickertide.operators import ordered as O
from tickertide.operators import stats as S
from tickertide.operators import wrangle as W
from tickertide.plans.modelling import write_report_days, write_report_of_days
from tickertide.schemas import RAW_POST
from tickertide.sources import files


def test_first_per_key_for_any_partitioning(spark):
    rows = [("a", 2, 5), ("a", 1, 7), ("a", None, 9), ("b", 3, 1), ("b", 3, 0)]
    table = spark.createDataFrame(rows, "k string, o int, v int")
    for parts in (1, 17):
        found = K.first_per_key(table.repartition(parts), ["k"], ["o"], copies="n")
        assert sorted(map(tuple, found.collect())) == [("a", None, 9, 3), ("b", 3, 0, 2)]


def test_first_of_wide_rows(spark, tmp_path):
    rows = [("a", 2, 5), ("a", 1, 7), ("a", None, 9), ("b", 3, 1), ("b", 3, 1), (None, 1, 1), (None, 0, 2), ("c", 1, 1)]
    table = spark.createDataFrame(rows, "k string, o int, v int").withColumn("m", F.create_map(F.lit("x"), F.col("v")))
    for parts in (1, 3, 17):
        path = str(tmp_path / str(parts))
        table.repartition(parts).write.parquet(path)
        # a scan, a filtered scan, and rows that are in no file
        for given in (spark.read.parquet(path), spark.read.parquet(path).filter("v > 0").withColumn("o", F.col("o") + 0), table.repartition(parts)):
            found = K.first_of_wide_rows(given, F.col("k"), ["o"], "n")
            assert found.columns == ["k", "o", "v", "m", "n"]
            assert sorted((r["k"] or "", r["o"], r["v"], r["m"]["x"], r["n"]) for r in found.collect()) == [("", 0, 2, 2, 2), ("a", None, 9, 9, 3), ("b", 3, 1, 1, 2), ("c", 1, 1, 1, 1)]
    assert K.first_of_wide_rows(table.limit(0), F.col("k"), ["o"]).count() == 0


def test_join_on_a_hot_key(spark):
    many = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    one = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        found = K.join_on_skewed_key(many, one, "k", how).select("id", "k", "v")
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, many.join(one, "k", how).select("id", "k", "v").collect()), key=str)


def test_running_sums(spark):
    import random

    rng = random.Random(3)
    rows = [(rng.choice("xxxxy"), round(rng.expovariate(1), 6), rng.randrange(5)) for _ in range(3000)]
    table = spark.createDataFrame(rows, "k string, o double, s int").groupBy("k", "o").agg(F.sum("s").alias("s"))
    found = {(r["k"], r["o"]): r["running_s"] for r in O.running_sums(table, ["k"], "o", ["s"]).collect()}
    for key in "xy":
        total = 0
        for r in sorted((r for r in table.collect() if r["k"] == key), key=lambda r: r["o"]):
            total += r["s"]
            assert found[(key, r["o"])] == total


@pytest.mark.parametrize("values", [[1.0, 2.0, 3.0, 4.0], [5.0], [1.0, 1.0, 1.0, 9.5], [None, 2.0, 4.0]])
def test_exact_quantiles(spark, values):
    table = spark.createDataFrame([(v,) for v in values], "x double")
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = O.exact_quantiles(table, "x", shares).first()[0]
    wanted = table.select(F.percentile("x", F.array(*[F.lit(s) for s in shares]))).first()[0]
    assert found == pytest.approx(wanted)


def test_fence_and_deviation_edges(spark):
    same = spark.createDataFrame([(5,), (5,), (5,), (None,), (9,)], "x int")
    assert [r["x"] for r in W.keep_within_fence(same, "x").collect()] == [5, 5, 5]
    constant = spark.createDataFrame([(5,), (5,)], "x int")
    assert W.keep_within_deviation(constant, "x").count() == 0
    assert W.keep_within_deviation(constant, "x", on_constant="keep").count() == 2
    nulls = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert W.keep_within_deviation(nulls, "x", 1.0).count() == 1
    empty = constant.filter("x > 9")
    assert W.keep_within_fence(empty, "x").count() == 0 and W.keep_within_deviation(empty, "x").count() == 0


def test_derived_columns(spark):
    rows = [("été  ok", "ok", 3, 4, datetime(2024, 1, 1, 13, 5)), ("", "", None, 4, None)]
    posts = spark.createDataFrame(rows, "text string, cleaned_text string, score int, num_comments int, created_at timestamp")
    first, second = W.add_derived_columns(posts).collect()
    assert (first["text_length"], first["word_count"], first["clean_wc"], first["engagement"]) == (7, 2, 1, 7)
    assert (first["hour_of_day"], first["day_of_week"]) == (13, "Monday")
    assert (second["word_count"], second["clean_wc"], second["engagement"]) == (0, 0, None)
    assert "hour_of_day" not in W.add_derived_columns(posts.drop("created_at")).columns


def test_submissions_and_comments(spark, tmp_path):
    comments = [{"id": f"c{i}", "body": f"text {i}", "score": i % 28, "created_utc": 1700000000 + i} for i in range(30)]
    comments += [{"id": "gone", "body": "[removed]", "score": 99}, {"id": "blank", "body": " \n", "score": 98}, {"id": "c0", "body": "later copy", "created_utc": 1800000000}]
    posts = [
        {"id": "p1", "subreddit": "s", "title": " Hello ", "selftext": "$AAPL good", "num_comments": 30, "created_utc": 1700000000, "comments": comments},
        {"id": "p2", "subreddit": "s", "comments": comments[:1]},
    ]
    (tmp_path / "a.json").write_text("\n".join(json.dumps(p) for p in posts))
    submissions = files.read_submissions(spark, str(tmp_path))
    lexicon = L.seed_lexicon(spark)
    rows = {r["id"]: r for r in I.collect_posts(submissions, lexicon).collect()}
    assert set(rows["p1"].__fields__) == set(RAW_POST.names)
    assert rows["p1"]["text"] == "Hello  $AAPL good" and rows["p1"]["tickers"] == "AAPL" and rows["p1"]["sentiment"] == "positive"
    assert rows["p1"]["created_at"] == datetime(2023, 11, 14, 22, 13, 20)
    assert (rows["p2"]["author"], rows["p2"]["score"], rows["p2"]["is_self"], rows["p2"]["text"]) == ("[deleted]", 0, True, "")
    # 25 best of the comments; the removed and blank ones take their places before they are dropped
    kept = [r for r in rows.values() if r["type"] == "comment"]
    assert len(kept) == 23 and all(r["post_id"] == "p1" and r["subreddit"] == "s" for r in kept)
    assert rows["p1"]["parent_id"] is None


def test_csv_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,score,created_at\n1,"two\nlines ""q""",3,2024-01-01 10:00:00\n2,NA,,\n3,null,x,2024-01-01\n')
    schema = type(RAW_POST)([RAW_POST[c] for c in ("id", "text", "score", "created_at")])
    rows = files.read_raw_csv(spark, str(tmp_path), schema).orderBy("id").collect()
    assert rows[0]["text"] == 'two\nlines "q"' and rows[0]["score"] == 3
    assert rows[1]["text"] is None and rows[1]["score"] is None and rows[1]["created_at"] is None
    assert rows[2]["text"] is None and rows[2]["score"] is None
    with pytest.raises(FileNotFoundError):
        files.read_raw_csv(spark, str(tmp_path / "none"))


def small_posts(spark):
    rows = [
        ("positive", "a", "good good day", 1, 2), ("positive", "a", "good night", 3, 4), ("neutral", "b", "plain day", 5, 6),
        (None, "b", "x", 7, 8),
    ]
    return spark.createDataFrame(rows, "sentiment string, subreddit string, cleaned_text string, score int, num_comments int")


def test_report_shape(spark):
    posts = W.add_derived_columns(small_posts(spark).withColumn("text", F.col("cleaned_text")))
    report = json.loads(S.report_json(posts).first()["value"])
    assert set(report) == {"total_posts", "sentiment_distribution", "subreddit_breakdown", "numeric_stats", "top_words", "available_plots"}
    assert report["total_posts"] == 4
    assert report["sentiment_distribution"]["positive"] == {"count": 2, "percentage": 50.0}
    assert report["subreddit_breakdown"] == {"a": {"positive": 2}, "b": {"neutral": 1}}
    assert set(report["numeric_stats"]) == {"score", "num_comments", "word_count", "engagement"}
    assert set(report["numeric_stats"]["score"]) == {"mean", "median", "std", "min", "max", "q25", "q75"}
    assert report["numeric_stats"]["score"]["median"] == 4.0 and report["numeric_stats"]["score"]["std"] == 2.58
    assert report["top_words"] == {"positive": ["good", "day", "night"], "neutral": ["day", "plain"], "negative": []}
    assert len(report["available_plots"]) == 15


def test_report_reads_its_table_once(spark, tmp_path):
    path = str(tmp_path / "posts")
    W.add_derived_columns(small_posts(spark).withColumn("text", F.col("cleaned_text"))).write.parquet(path)
    for method in ("exact", "approx"):
        plan = S.report_parts(spark.read.parquet(path), method=method)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "partial_count" in plan
    with pytest.raises(ValueError):
        S.report_parts(spark.read.parquet(path), method="other")


def _report_of(spark, path):
    return json.loads((sorted(Path(path).glob("part*"))[0]).read_text())


def test_report_of_days_equals_whole(spark, tmp_path):
    rows = spark.range(3000).select(
        "id", F.element_at(F.array(*[F.lit(s) for s in ("positive", "neutral", "negative")]), (F.col("id") % 3 + 1).cast("int")).alias("sentiment"),
        F.when(F.col("id") % 50 > 0, F.concat(F.lit("c"), (F.col("id") % 7).cast("string"))).alias("subreddit"),
        F.concat_ws(" ", F.lit("day"), F.concat(F.lit("w"), (F.col("id") % 41).cast("string"))).alias("cleaned_text"),
        F.when(F.col("id") % 9 > 0, (F.col("id") * 37) % 1001).cast("int").alias("score"), F.lit(None).cast("int").alias("num_comments"),
        F.when(F.col("id") % 100 > 0, F.timestamp_seconds(1_700_000_000 + F.col("id") * 300)).alias("created_at"),
    )
    whole = json.loads(S.report_json(rows).first()["value"])
    assert whole["total_posts"] == 3000 and whole["numeric_stats"]["num_comments"] == {}
    for method in ("exact", "approx"):
        parts, path = str(tmp_path / f"parts-{method}"), str(tmp_path / f"report-{method}")
        # the first run sees a part of the third day; the second replaces that day and adds the others
        write_report_days(rows.filter("id < 800 or created_at is null"), parts, method=method)
        day = rows.filter("id = 799").select(F.to_date("created_at").cast("string")).first()[0]
        for _ in range(2):
            write_report_days(rows, parts, since=day, method=method)
        write_report_of_days(spark, parts, path)
        merged = _report_of(spark, path)
        numbers, wanted = merged.pop("numeric_stats"), dict(whole)
        exact = wanted.pop("numeric_stats")
        assert merged == wanted
        if method == "exact":
            assert numbers == exact
        else:
            assert all(numbers["score"][s] == pytest.approx(exact["score"][s], abs=0.011) for s in ("mean", "std", "min", "max"))
            # scores are spread evenly over 0 to 1000: 1 % of the ranks is 10
            assert all(abs(numbers["score"][s] - exact["score"][s]) <= 10 for s in ("q25", "median", "q75"))
        write_report_of_days(spark, parts, path, first=day, last=day)
        assert 0 < _report_of(spark, path)["total_posts"] <= 288


def test_report_of_nothing(spark):
    posts = W.add_derived_columns(small_posts(spark).withColumn("text", F.col("cleaned_text"))).filter("score > 99")
    report = json.loads(S.report_json(posts).first()["value"])
    assert report["total_posts"] == 0 and report["subreddit_breakdown"] == {} and set(report["numeric_stats"]) == {"score", "num_comments", "word_count", "engagement"}


def test_chart_edges(spark):
    posts = small_posts(spark)
    assert [(r["sentiment"], r["count"]) for r in C.sentiment_distribution(posts).collect()] == [("positive", 2), ("neutral", 1), ("negative", 0)]
    assert C.top_ngrams(posts, 1).count() == 0
    assert {r["sentiment"] for r in C.top_ngrams(posts, 1, min_texts=2).collect()} == {"positive"}
    means = {r["sentiment"]: r["mean_engagement"] for r in C.mean_engagement(posts).collect()}
    assert means == {"positive": 2.0, "neutral": 5.0, "negative": None}
    bins = C.word_count_histogram(posts.withColumn("word_count", F.lit(4))).filter("sentiment = 'neutral'").collect()
    assert len(bins) == 10 and sum(r["n"] for r in bins) == 1 and bins[0]["bin_low"] == 3.5


def test_missing_values(spark):
    assert [tuple(r) for r in S.missing_values(small_posts(spark)).collect()] == [("sentiment", 1)]


def test_rejected_input_is_listed(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text("id,score\n1,3\n2,x\n3,x\n4,NA\ny,5\n")
    found = {tuple(r) for r in files.rejected_cells(spark, str(tmp_path / "csv"), _schema("id bigint, score bigint")).collect()}
    assert found == {("score", "bigint", "x", 2), ("id", "bigint", "y", 1)}
    (tmp_path / "json").mkdir()
    (tmp_path / "json" / "a.json").write_text('{"id": "a"}\n{"id": \nnot json\nnot json\n\n[1]\n')
    assert {tuple(r) for r in files.rejected_lines(spark, str(tmp_path / "json")).collect()} == {('{"id": ', 1), ("not json", 2), ("[1]", 1)}


def _schema(ddl):
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(ddl)

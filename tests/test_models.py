import math

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from tickertide.functions.vectors import sparse_vector
from tickertide.operators import evaluate as E
from tickertide.operators import features as X
from tickertide.operators import models as M
from tickertide.plans.feature_tables import build_features
from tickertide.plans.modelling import train_and_compare, tune_and_compare


@pytest.fixture(scope="module")
def processed(spark):
    """Three classes that their words tell apart, with some noise."""
    words = F.array(F.lit("crash fear loss"), F.lit("meeting report day"), F.lit("rally gain profit"))
    rows = spark.range(150).withColumn("sentiment_label", (F.col("id") % 3).cast("int"))
    return rows.select(
        "id", "sentiment_label", F.get(F.array(*[F.lit(n) for n in ("negative", "neutral", "positive")]), "sentiment_label").alias("sentiment"),
        F.concat_ws(" ", F.get(words, "sentiment_label"), F.concat(F.lit("w"), (F.col("id") % 7).cast("string")), F.lit("common")).alias("cleaned_text"),
        (F.col("id") % 11).alias("score"), F.lit(4).alias("num_comments"),
    )


@pytest.fixture(scope="module")
def tables(processed):
    return build_features(processed)


def test_split_is_exact_and_stable(processed):
    found = []
    for parts in (1, 17):
        split = X.stratified_split(processed.repartition(parts))
        assert {tuple(r) for r in split.groupBy("sentiment_label", "split").count().collect()} == {
            (c, s, n) for c in range(3) for s, n in (("test", 10), ("train", 40))
        }
        found.append(sorted(r["id"] for r in split.filter("split = 'test'").collect()))
    assert found[0] == found[1]


def test_folds_are_even(processed):
    sizes = X.stratified_folds(processed).groupBy("sentiment_label", "fold").count().collect()
    assert len(sizes) == 15 and {r["count"] for r in sizes} == {10}


def test_tiny_class_has_no_test_row(spark):
    rows = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, None)], "id long, sentiment_label int")
    assert {r["split"] for r in X.stratified_split(rows).collect()} == {"train"}


def test_tfidf_by_hand(spark):
    train = spark.createDataFrame([(1, "up up down"), (2, "up flat"), (3, "flat flat")], "id long, cleaned_text string")
    vocabulary = X.fit_vocabulary(train, max_doc_share=1.0)
    assert [(r["term"], r["idx"], r["tf"], r["df"]) for r in vocabulary.orderBy("idx").collect()] == [("flat", 0, 3, 2), ("up", 1, 3, 2)]
    model = X.TermWeights.from_table(vocabulary)
    vector = model.add_vector(spark.createDataFrame([(9, "Up up flat new")], "id long, cleaned_text string")).first()["tfidf"]
    a, b = 1.0, 1 + math.log(2)
    assert vector.toArray() == pytest.approx([a / math.hypot(a, b), b / math.hypot(a, b)])
    none = model.add_vector(spark.createDataFrame([(9, "new")], "id long, cleaned_text string")).first()["tfidf"]
    assert none.size == 2 and none.numNonzeros() == 0
    # a term in too many documents is left out
    assert X.fit_vocabulary(train, max_doc_share=0.5).count() == 0


def test_scaler_edges(spark):
    train = spark.createDataFrame([(1, 5), (3, 5), (None, 5)], "score int, num_comments int")
    test = spark.createDataFrame([(6, 7)], "score int, num_comments int")
    scaled, names = X.apply_scaler(test, X.fit_scaler(train))
    assert names == ["scaled_score", "scaled_num_comments"]
    assert tuple(scaled.select(*names).first()) == (2.0, 2.0)


def test_sparse_vector(spark):
    v = spark.range(1).select(sparse_vector(4, F.array(F.lit(1), F.lit(3)), F.array(F.lit(0.1), F.lit(1e-17))).alias("v")).first()["v"]
    assert (v.size, list(v.indices), list(v.values)) == (4, [1, 3], [0.1, 1e-17])


def test_feature_dimension(tables):
    row = tables.features.first()
    assert row["features"].size == len(tables.weights.terms) + len(tables.numeric)
    assert "common" not in tables.weights.terms and "crash fear" in tables.weights.terms


def test_stored_vectors_are_the_assembled_ones(spark, tables, processed, monkeypatch, tmp_path):
    from pyspark.sql import DataFrameWriter

    from tickertide.plans import feature_tables

    split = X.stratified_split(processed)
    scaled, numeric = X.apply_scaler(split, tables.scaler)
    # a number below 0 is kept in one vector and cut in the other
    scaled = scaled.withColumn(numeric[0], F.col(numeric[0]) - 0.5)
    plans = []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, write=DataFrameWriter.parquet: plans.append(self._df._jdf.queryExecution().optimizedPlan().toString()) or write(self, path))
    stored = feature_tables.write_vectors(tables.weights.add_stored(scaled), numeric, str(tmp_path / "vectors"))
    assert len(plans) == 1 and "from_json" not in plans[0] and "to_json" not in plans[0]
    assembled = M.with_feature_blocks(tables.weights.add_vector(scaled), numeric)
    wanted = {r["id"]: r for r in assembled.collect()}
    for r in stored.collect():
        for c in ("features", "features_nonnegative"):
            assert r[c].size == wanted[r["id"]][c].size and list(r[c].toArray()) == list(wanted[r["id"]][c].toArray())
    assert any(min(r["features"].toArray()) < 0 for r in wanted.values())


def test_train_tune_store_and_score(spark, tables, tmp_path):
    small = {"random_forest": {"numTrees": 5, "maxDepth": 4}, "logistic_regression": {"maxIter": 30}}
    folder = str(tmp_path)
    trained = train_and_compare(tables, small, folder)
    for row in trained.comparison.collect():
        assert row["accuracy"] > 0.6 and row["training_time"] >= 0
    p = trained.predictions
    assert p.count() == 3 * 30
    assert p.filter(F.abs(F.col("p0") + F.col("p1") + F.col("p2") - 1) > 1e-6).count() == 0

    assert M.load_best_model(spark, folder)[0] == "logistic_regression"
    spaces = {
        "naive_bayes": lambda e: ParamGridBuilder().addGrid(e.smoothing, [0.1, 1.0]).build(),
        "logistic_regression": lambda e: ParamGridBuilder().addGrid(e.regParam, [0.01, 5.0]).build(),
    }
    tuned = tune_and_compare(tables, spaces, list(spaces), small, folder)
    search = tuned.searches["naive_bayes"].collect()
    assert len(search) == 2 and sum(r["is_best"] for r in search) == 1
    assert {(r["name"], r["kind"]) for r in M.choose_models(M.registry(spark, folder)).collect()} == {
        ("best", "best"), ("logistic_regression", "tuned"), ("naive_bayes", "tuned"), ("random_forest", "base"),
    }
    with pytest.raises(FileNotFoundError):
        M.load_model(spark, folder, "random_forest", "tuned")
    with pytest.raises(ValueError):
        M.load_model(spark, folder, "svm")

    name, model = M.load_best_model(spark, folder)
    texts = spark.createDataFrame([(1, "Rally! gain, profit"), (2, "a crash: fear and loss"), (3, "It is")], "id long, text string")
    rows = M.score_texts(texts, model, name, tables.weights, tables.numeric).orderBy("id").collect()
    assert [r["sentiment"] for r in rows[:2]] == ["positive", "negative"]
    assert rows[2]["cleaned_text"] == "it is" and rows[2]["word_count"] == 2
    for r in rows:
        assert r["confidence"] == max(r["positive"], r["neutral"], r["negative"])
        assert r["positive"] + r["neutral"] + r["negative"] == pytest.approx(1, abs=2e-4)


def test_linear_expressions_equal_transform(spark, tables):
    for name in ("logistic_regression", "naive_bayes"):
        model = M.base_models(120)[name].fit(tables.features.filter("split = 'train'"))
        column = "features_nonnegative" if name == "naive_bayes" else "features"
        wanted = {r["id"]: r["probability"] for r in M.class_scores(model, tables.features).select("id", "probability").collect()}
        found = tables.features.select("id", M.softmax_of(M.linear_form(model), F.unwrap_udt(column)).alias("p")).collect()
        assert len(found) == 150
        for r in found:
            assert r["p"] == pytest.approx(wanted[r["id"]], abs=1e-9)


def test_requests_of_all_models_are_scored_in_one_pass(spark, tables, tmp_path):
    small = {"random_forest": {"numTrees": 5, "maxDepth": 4}, "logistic_regression": {"maxIter": 30}}
    folder, path = str(tmp_path / "models"), str(tmp_path / "requests")
    fitted = train_and_compare(tables, small, folder).models
    M.mark_best(spark, folder, "random_forest")
    texts = ["Rally! gain, profit", "a crash: fear and loss", "nothing known here", "It is", "w1 w2 common day"]
    names = ["best", None, "logistic_regression", "naive_bayes", "random_forest", "svm"]
    rows = [(10 * i + j, t, m) for i, t in enumerate(texts) for j, m in enumerate(names)]
    spark.createDataFrame(rows, "id long, text string, model string").write.parquet(path)
    scored, rejected = M.score_requests(spark.read.parquet(path), folder, tables.weights, tables.numeric)
    assert scored._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r["reason"] for r in rejected.collect()} == {"unknown_model"} and rejected.count() == 5
    used = {"best": "random_forest"}
    found = {r["id"]: r for r in scored.collect()}
    assert len(found) == 25
    for name, model in fitted.items():
        alone = M.score_texts(spark.read.parquet(path), model, name, tables.weights, tables.numeric)
        for r in alone.collect():
            if r["id"] in found and used.get(found[r["id"]]["model"], found[r["id"]]["model"]) == name:
                assert tuple(found[r["id"]])[:-1] == tuple(r) and found[r["id"]]["model_used"] == name
    # the same by ML vectors
    forest = M.score_texts(spark.read.parquet(path).filter("id = 4"), fitted["random_forest"], "random_forest", tables.weights, tables.numeric).first()
    vectors = tables.weights.add_vector(spark.createDataFrame([(4, "rally gain profit")], "id long, cleaned_text string"))
    blocks = M.with_feature_blocks(vectors.withColumns({c: F.lit(0.0) for c in tables.numeric}), tables.numeric)
    wanted = M.class_scores(fitted["random_forest"], blocks).first()["probability"]
    assert [forest["negative"], forest["neutral"], forest["positive"]] == [round(p, 4) for p in wanted]


def test_grids(tables):
    assert len(M.forest_draws()) == 30 and M.forest_draws() == M.forest_draws()
    models = M.base_models(100)
    assert len(M.grid("logistic_regression", models["logistic_regression"], 100)) == 10
    assert len(M.grid("naive_bayes", models["naive_bayes"], 100)) == 6
    assert len(M.grid("random_forest", models["random_forest"], 100)) == 30


def test_requests(spark):
    rows = [(1, "ok text", None), (2, "ab", "best"), (3, "   ", "best"), (4, "a" * 5001, "x"), (5, " " + "a" * 4999, "naive_bayes"), (6, None, "best")]
    checked = M.check_requests(spark.createDataFrame(rows, "id long, text string, model string"))
    reasons = {r["id"]: r["reason"] for r in checked.collect()}
    assert reasons == {1: "", 2: "text_too_short", 3: "text_blank", 4: "text_too_long,unknown_model", 5: "", 6: "text_too_short"}
    assert {r["id"]: len(r["text"]) for r in M.valid_requests(checked).collect()} == {1: 7, 5: 4999}
    assert M.rejected_requests(checked).count() == 4


def table(spark, rows):
    return spark.createDataFrame(rows, "model_name string, id long, label int, prediction int, p0 double, p1 double, p2 double")


def test_undefined_metrics_are_zero(spark):
    predictions = table(spark, [("m", 1, 0, 0, 0.9, 0.1, 0.0), ("m", 2, 1, 0, 0.6, 0.4, 0.0)])
    report = {r["label"]: r for r in E.class_report(predictions).collect()}
    assert (report[0]["precision"], report[0]["recall"]) == (0.5, 1.0)
    assert (report[1]["precision"], report[1]["f1_score"], report[1]["support"]) == (0.0, 0.0, 1)
    assert report[2]["support"] == 0
    metrics = E.model_metrics(predictions).first()
    assert metrics["accuracy"] == 0.5 and metrics["macro_recall"] == 0.5
    percent = {(r["label"], r["prediction"]): r["percent"] for r in E.confusion_percent(predictions).collect()}
    assert percent[(1, 0)] == 100.0 and percent[(2, 2)] is None
    auc = {r["class"]: r["auc"] for r in E.roc_auc(predictions).collect()}
    assert auc == {0: 1.0, 1: 1.0, 2: None}


def test_roc_starts_at_the_origin(spark):
    predictions = table(spark, [("m", 1, 0, 0, 0.9, 0.1, 0.0), ("m", 2, 1, 0, 0.9, 0.1, 0.0), ("m", 3, 1, 1, 0.2, 0.8, 0.0)])
    points = [(r["fpr"], r["tpr"]) for r in E.roc_points(predictions).filter("class = 0").orderBy(F.desc("threshold")).collect()]
    assert points == [(0.0, 0.0), (0.5, 1.0), (1.0, 1.0)]


def test_best_model_ties(spark):
    rows = [("b", 0.8, 0.7, 0.8, 0.75), ("a", 0.8, 0.7, 0.8, 0.75), ("c", 0.7, 0.9, 0.8, 0.75)]
    comparison = spark.createDataFrame(rows, "model_name string, accuracy double, precision double, recall double, f1_score double")
    assert E.best_model(comparison).first()["model_name"] == "a"


def test_tuning_queries_search_the_documented_grids(spark, tables, monkeypatch):
    from checks import QUERIES, model_queries

    searched = {}

    def tune(name, train, space=None, estimator=None, **_):
        points = space or M.grid(name, estimator, train.count())
        searched[name] = points
        params = [(name, str({p.name: v for p, v in point.items()}), 0.5, i == 0) for i, point in enumerate(points)]
        quick = M.base_models(train.count())["naive_bayes"].fit(train)
        return quick, spark.createDataFrame(params, "model_name string, params string, mean_f1 double, is_best boolean")

    monkeypatch.setattr(M, "tune", tune)
    monkeypatch.setattr(model_queries, "_tables", lambda spark, folder: tables)
    model_queries._tuned.cache_clear()
    try:
        table = QUERIES["model_search_table"](spark, "made").groupBy("model_name").count().collect()
        compared = QUERIES["model_tuned_comparison"](spark, "made").collect()
    finally:
        model_queries._tuned.cache_clear()
    assert {r["model_name"]: r["count"] for r in table} == {"logistic_regression": 10, "naive_bayes": 6, "random_forest": 30}
    assert {p[e] for p in searched["logistic_regression"] for e in p if e.name == "maxIter"} == {500, 1000}
    assert {p[e] for p in searched["random_forest"] for e in p if e.name == "numTrees"} == {100, 200, 300}
    assert {r["model_name"] for r in compared} == set(searched) and all(0 <= r["f1_score"] <= 1 for r in compared)


def test_forests_are_fitted_in_no_more_tasks_than_cores(tables):
    """A task makes the statistics of all nodes of a pass, so tasks beyond the cores repeat that work."""
    seen = []

    class Seen(RandomForestClassifier):
        def _fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))
            return super()._fit(rows)

    train = tables.features.filter("split = 'train'").repartition(20)
    forest = Seen(numTrees=2, maxDepth=2, labelCol="sentiment_label")
    models, _ = M.train_all(train, {"random_forest": forest})
    assert seen == [(8, train.count())] and models["random_forest"].getNumTrees == 2

"""Checks of features, models and evaluation."""

from functools import lru_cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import check, rounded
from checks.table_queries import derived
from checks.views_sql import clean, quoted, tokens, with_views
from tickertide.functions.wordlists import STOPWORDS
from tickertide.operators import evaluate as E
from tickertide.operators import features as X
from tickertide.operators import models as M
from tickertide.operators import search as S
from tickertide.operators import wrangle as W
from tickertide.operators.stats import label_counts
from tickertide.plans.feature_tables import build_features
from tickertide.plans.modelling import train_and_compare, tune_and_compare
from tickertide.settings import MODEL_NAMES
from tickertide.sources import files
from tickertide.sources import sample_views as V
from tickertide.sources.handover import materialise, new_path


@lru_cache(maxsize=4)
def usable(spark, folder):
    """The written processed table, as the feature job reads it."""
    return materialise(W.encode_sentiment(X.drop_blank_texts(derived(spark, folder))), "processed")


@check("feature_drop_blank", with_views("SELECT id FROM derived WHERE length(trim(cleaned_text)) > 0", "derived"))
def drop_blank(spark, folder):
    return X.drop_blank_texts(derived(spark, folder)).select("id")


@check("feature_split", with_views("SELECT id, sentiment_label, split FROM split", "split"))
def split(spark, folder):
    return X.stratified_split(usable(spark, folder)).select("id", "sentiment_label", "split")


@check("feature_folds", with_views("SELECT id, sentiment_label, fold FROM split", "split"))
def folds(spark, folder):
    return X.stratified_folds(usable(spark, folder)).select("id", "sentiment_label", "fold")


@check("feature_term_counts", with_views("SELECT id, term, tf FROM term_counts", "term_counts"))
def term_counts(spark, folder):
    return X.term_counts(usable(spark, folder))


def _train(spark, folder):
    return X.stratified_split(usable(spark, folder)).filter("split = 'train'")


@check("feature_vocabulary", with_views("SELECT term, idx, tf, df, round(idf, 6) AS idf FROM vocabulary", "vocabulary"))
def vocabulary(spark, folder):
    return rounded(X.fit_vocabulary(_train(spark, folder)))


@lru_cache(maxsize=4)
def _split_table(spark, folder):
    return materialise(X.stratified_split(usable(spark, folder)), "split")


@lru_cache(maxsize=4)
def _weights(spark, folder):
    return X.TermWeights.from_table(X.fit_vocabulary(_split_table(spark, folder).filter("split = 'train'")))


@check("feature_weights", with_views("SELECT id, CAST(idx AS INT) AS idx, round(weight, 6) AS weight FROM weights", "weights"))
def weights(spark, folder):
    return rounded(_weights(spark, folder).weights_table(_split_table(spark, folder), ["id"]))


@check(
    "feature_vectors",
    with_views("SELECT id, count(*) AS n, round(sum(weight), 6) AS total, max(idx) AS last_idx FROM weights GROUP BY id", "weights"),
)
def vectors(spark, folder):
    """The weights as ML vectors, taken apart again."""
    vectors = _weights(spark, folder).add_vector(_split_table(spark, folder))
    parts = vectors.select("id", F.unwrap_udt("tfidf").alias("v")).filter(F.size("v.indices") > 0)
    return rounded(
        parts.select(
            "id", F.size("v.indices").alias("n"), F.aggregate("v.values", F.lit(0.0), lambda t, x: t + x).alias("total"),
            F.array_max("v.indices").alias("last_idx"),
        )
    )


_NUMERIC = ["score", "num_comments", "engagement", "word_count", "clean_wc", "text_length"]


@check(
    "feature_scaled_numbers",
    with_views(
        "SELECT id, " + ", ".join(
            f"round(coalesce((coalesce({c}, 0) - lo_{c}) / nullif(hi_{c} - lo_{c}, 0)::DOUBLE, coalesce({c}, 0) - lo_{c}), 6) AS scaled_{c}" for c in _NUMERIC
        ) + " FROM split, (SELECT " + ", ".join(f"min(coalesce({c}, 0)) AS lo_{c}, max(coalesce({c}, 0)) AS hi_{c}" for c in _NUMERIC)
        + " FROM split WHERE split = 'train')", "split",
    ),
)
def scaled_numbers(spark, folder):
    table = _split_table(spark, folder)
    scaled, names = X.apply_scaler(table, X.fit_scaler(table.filter("split = 'train'")))
    return rounded(scaled.select("id", *names))


@check(
    "feature_top_terms",
    with_views(
        "SELECT term, round(sum(weight) / (SELECT count(*) FROM split), 6) AS mean_weight FROM weights GROUP BY term ORDER BY sum(weight) DESC, term LIMIT 20",
        "weights",
    ),
)
def top_terms(spark, folder):
    table, model = _split_table(spark, folder), _weights(spark, folder)
    documents = table.agg(F.count(F.lit(1)).alias("n")).scalar()
    return rounded(X.top_terms(model.weights_table(table, ["id"]), model.as_table(spark), documents))


@check(
    "feature_top_terms_by_sentiment",
    with_views(
        """
SELECT sentiment, term, round(m, 6) AS mean_weight FROM (
  SELECT sentiment, term, sum(weight) / docs AS m, row_number() OVER (PARTITION BY sentiment ORDER BY sum(weight) / docs DESC, term) AS rn
  FROM weights JOIN split USING (id) JOIN (SELECT sentiment, count(*) AS docs FROM split GROUP BY sentiment) USING (sentiment)
  GROUP BY sentiment, term, docs) WHERE rn <= 15""", "weights",
    ),
)
def top_terms_by_sentiment(spark, folder):
    return rounded(X.top_terms_by_sentiment(_split_table(spark, folder), _weights(spark, folder)))


@check(
    "model_likelihoods",
    with_views(
        """
SELECT label, idx, round(ln((w + 1) / (sum(w) OVER (PARTITION BY label) + (SELECT count(*) FROM vocabulary))), 6) AS log_likelihood
FROM (SELECT sentiment_label AS label, CAST(idx AS INT) AS idx, sum(weight) AS w FROM weights JOIN split USING (id) GROUP BY ALL)""", "weights",
    ),
)
def likelihoods(spark, folder):
    model = _weights(spark, folder)
    table = _split_table(spark, folder).withColumnRenamed("sentiment_label", "label")
    return rounded(M.likelihoods(model.weights_table(table, ["label"]), len(model.terms)))


# --- trained models: SQL has what must hold for any fit -----------------------------------

_LABELS_SQL = "SELECT split, sentiment_label, count(*) AS n FROM split GROUP BY ALL"
_MODELS_SQL = "(SELECT unnest(['logistic_regression', 'naive_bayes', 'random_forest']) AS model_name)"


@lru_cache(maxsize=4)
def _tables(spark, folder):
    return build_features(usable(spark, folder))


@lru_cache(maxsize=4)
def _trained(spark, folder, *names):
    """The base models with their documented parameters, or those of them that a query reads."""
    path = new_path(spark, "models")
    return train_and_compare(_tables(spark, folder), folder=path, names=list(names) or MODEL_NAMES), path


def _sound(p, prediction, classes=3):
    """Probabilities sum to 1 and the prediction has the largest."""
    total = F.aggregate(p, F.lit(0.0), lambda t, x: t + x)
    return (F.size(p) == classes) & (F.abs(total - 1) < 1e-6) & (F.get(p, prediction.cast("int")) == F.array_max(p))


@check("feature_job", with_views(_LABELS_SQL, "split"))
def feature_job(spark, folder):
    """Label counts per split of the stored features."""
    path = new_path(spark, "features")
    files.write_features(_tables(spark, folder).features, path)
    return label_counts(files.read_features(spark, path))


@check(
    "feature_label_counts",
    with_views("SELECT split, sentiment_label, count(*) AS n FROM split GROUP BY ALL", "split"),
)
def label_counts_per_split(spark, folder):
    return label_counts(_split_table(spark, folder))


@check("model_train_all", with_views(f"SELECT model_name, n, true AS agrees, true AS timed FROM {_MODELS_SQL}, (SELECT count(*) AS n FROM split WHERE split = 'test')", "split"))
def train_all(spark, folder):
    """The comparison table agrees with the predictions on all test rows."""
    trained = _trained(spark, folder)[0]
    hits = F.round(F.avg((F.col("label") == F.col("prediction")).cast("double")), 4)
    counted = trained.predictions.groupBy("model_name").agg(F.count(F.lit(1)).alias("n"), hits.alias("_hits"))
    both = counted.join(trained.comparison, "model_name")
    return both.select("model_name", "n", (F.abs(F.col("_hits") - F.col("accuracy")) < 2e-4).alias("agrees"), (F.col("training_time") >= 0).alias("timed"))


@check(
    "model_predictions",
    with_views(f"SELECT model_name, id, sentiment_label AS label, true AS sound FROM {_MODELS_SQL}, split WHERE split = 'test'", "split"),
)
def model_predictions(spark, folder):
    found = _trained(spark, folder)[0].predictions
    p = F.array("p0", "p1", "p2")
    return found.select("model_name", "id", F.col("label").cast("int").alias("label"), _sound(p, F.col("prediction")).alias("sound"))


# the vectors of the models in long form: terms, then scaled numbers not below 0
_FEATURES = f"""
feature_values AS (
  SELECT id, CAST(idx AS BIGINT) AS idx, weight AS value FROM weights
  UNION ALL
  SELECT id, (SELECT count(*) FROM vocabulary) + j AS idx, greatest(v, 0) AS value FROM (
    SELECT id, unnest(range({len(_NUMERIC)})) AS j, unnest([{", ".join(f"coalesce((coalesce({c}, 0) - lo_{c}) / nullif(hi_{c} - lo_{c}, 0)::DOUBLE, coalesce({c}, 0) - lo_{c})" for c in _NUMERIC)}]) AS v
    FROM split, (SELECT {", ".join(f"min(coalesce({c}, 0)) AS lo_{c}, max(coalesce({c}, 0)) AS hi_{c}" for c in _NUMERIC)} FROM split WHERE split = 'train'))
  WHERE v <> 0),
dimension AS (SELECT count(*) + {len(_NUMERIC)} AS d FROM vocabulary)"""


def _with_features(tables: str, body: str) -> str:
    """A query over the feature values and further tables made from them."""
    views = with_views("", "weights")
    return f"{views.rstrip()},{_FEATURES}{',' if tables else ''}{tables}\n{body}"


@check(
    "feature_combined_vectors",
    _with_features("", """
SELECT split.split, feature_values.id, CAST(idx AS INT) AS idx, round(value, 6) AS value FROM feature_values JOIN split USING (id)"""),
)
def combined_vectors(spark, folder):
    """Index and weight of every value of the stored vectors that the models read."""
    path = new_path(spark, "features")
    files.write_features(_tables(spark, folder).features, path)
    stored = files.read_features(spark, path)
    return rounded(S.entries(stored, "features_nonnegative", ["split", "id"]))


# the fitted Naive Bayes model, in closed form
_BAYES = """
sums AS (
  SELECT label, idx, coalesce(s, 0) AS s
  FROM (SELECT DISTINCT idx FROM feature_values), (VALUES (0), (1), (2)) c(label)
  LEFT JOIN (SELECT sentiment_label AS l, idx AS i, sum(value) AS s FROM feature_values JOIN split USING (id) WHERE split = 'train' GROUP BY ALL)
    ON l = label AND i = idx),
norms AS (SELECT label, ln(sum(s) + (SELECT d FROM dimension)) AS norm FROM sums GROUP BY label),
priors AS (SELECT sentiment_label AS label, ln(count(*) + 1.0::DOUBLE) - ln((SELECT count(*) FROM split WHERE split = 'train') + 3.0::DOUBLE) AS prior
           FROM split WHERE split = 'train' GROUP BY 1)"""


@check(
    "model_naive_bayes_scores",
    _with_features(
        f"""{_BAYES},
joint AS (
  SELECT f.id, s.label, any_value(prior) + sum(value * (ln(s + 1) - norm)) AS score
  FROM feature_values f JOIN split p ON p.id = f.id AND p.split = 'test' JOIN sums s USING (idx) JOIN norms n ON n.label = s.label JOIN priors r ON r.label = s.label
  GROUP BY f.id, s.label),
shares AS (SELECT id, label, exp(score - max(score) OVER (PARTITION BY id)) AS e FROM joint)""",
        """
SELECT id, any_value(sentiment_label) AS label, round(sum(e) FILTER (shares.label = 0) / sum(e), 6) AS p0,
       round(sum(e) FILTER (shares.label = 1) / sum(e), 6) AS p1, round(sum(e) FILTER (shares.label = 2) / sum(e), 6) AS p2
FROM shares JOIN split USING (id) GROUP BY id""",
    ),
)
def naive_bayes_scores(spark, folder):
    """Class probabilities of the test rows by the fitted Naive Bayes model."""
    found = _trained(spark, folder, "naive_bayes")[0].predictions
    return rounded(found.select("id", F.col("label").cast("int").alias("label"), "p0", "p1", "p2"))


@lru_cache(maxsize=4)
def _folds(spark, folder):
    return materialise(X.stratified_folds(_tables(spark, folder).features.filter("split = 'train'")), "folds")


@check(
    "model_search_naive_bayes",
    _with_features(
        f"""
train AS (
  SELECT id, sentiment_label AS label, (rn > round(0.2 * n))::INT + (rn > round(0.4 * n))::INT + (rn > round(0.6 * n))::INT + (rn > round(0.8 * n))::INT AS fold
  FROM (SELECT id, sentiment_label, row_number() OVER (PARTITION BY sentiment_label ORDER BY md5(CAST(id AS VARCHAR) || '|42')) AS rn,
               count(*) OVER (PARTITION BY sentiment_label) AS n FROM split WHERE split = 'train')),
points AS (SELECT unnest({M.SMOOTHINGS}) AS smoothing),
folds AS (SELECT DISTINCT fold FROM train),
own AS (SELECT fold, label, idx, sum(value) AS s FROM feature_values JOIN train USING (id) GROUP BY ALL),
whole AS (SELECT label, idx, sum(s) AS s FROM own GROUP BY ALL),
sums AS (
  SELECT fold, label, idx, greatest(coalesce(w.s, 0) - coalesce(o.s, 0), 0) AS s
  FROM folds CROSS JOIN (VALUES (0), (1), (2)) c(label) CROSS JOIN (SELECT DISTINCT idx FROM own) i
  LEFT JOIN whole w USING (label, idx) LEFT JOIN own o USING (fold, label, idx)),
norms AS (SELECT fold, label, sum(s) AS total FROM sums GROUP BY ALL),
priors AS (SELECT *, sum(n) OVER (PARTITION BY fold) AS rows FROM (
  SELECT f.fold, t.label, count(*) FILTER (t.fold <> f.fold) AS n FROM folds f, train t GROUP BY f.fold, t.label)),
joint AS (
  SELECT t.id, t.fold, t.label, s.label AS guess, p.smoothing,
         any_value(ln(r.n + p.smoothing) - ln(r.rows + 3 * p.smoothing)) + sum(v.value * (ln(s.s + p.smoothing) - ln(n.total + p.smoothing * d))) AS score
  FROM feature_values v JOIN train t USING (id) JOIN sums s ON s.fold = t.fold AND s.idx = v.idx JOIN norms n ON n.fold = t.fold AND n.label = s.label
  JOIN priors r ON r.fold = t.fold AND r.label = s.label, points p, dimension
  GROUP BY t.id, t.fold, t.label, s.label, p.smoothing),
guesses AS (SELECT smoothing, fold, label, CAST(arg_max(guess, (score, -guess)) AS INT) AS prediction FROM joint GROUP BY id, smoothing, fold, label),
cells AS (
  SELECT smoothing, fold, c.c, count(*) FILTER (label = c.c AND prediction = c.c) AS tp, count(*) FILTER (prediction = c.c) AS predicted,
         count(*) FILTER (label = c.c) AS support FROM guesses, (VALUES (0), (1), (2)) c(c) GROUP BY smoothing, fold, c.c),
scores AS (SELECT smoothing, fold, sum(support * coalesce(2.0::DOUBLE * tp / nullif(predicted + support, 0), 0)) / sum(support) AS f1 FROM cells GROUP BY smoothing, fold)""",
        "SELECT CAST(smoothing AS DOUBLE) AS smoothing, round(avg(f1), 6) AS mean_f1 FROM scores GROUP BY smoothing",
    ),
)
def search_naive_bayes(spark, folder):
    """Mean F1 of every documented smoothing over the folds."""
    means = S.search_bayes(_folds(spark, folder), M.SMOOTHINGS, "features_nonnegative")
    return rounded(spark.createDataFrame(list(zip(M.SMOOTHINGS, means)), "smoothing double, mean_f1 double"))


@lru_cache(maxsize=4)
def _tuned(spark, folder):
    """Searches over the documented grids on all train rows; stored apart from the base models."""
    path = new_path(spark, "tuned-models")
    return tune_and_compare(_tables(spark, folder), folder=path), path


@check(
    "model_tune",
    with_views(f"SELECT model_name, 1 AS best, true AS sound FROM {_MODELS_SQL} WHERE (SELECT count(*) FROM split) > 0", "split"),
)
def model_tune(spark, folder):
    """One best point per model, with the highest mean F1."""
    searches = reduce(DataFrame.unionByName, _tuned(spark, folder)[0].searches.values())
    best = F.max(F.when(F.col("is_best"), F.col("mean_f1")))
    return searches.groupBy("model_name").agg(
        F.count_if("is_best").cast("int").alias("best"), ((best == F.max("mean_f1")) & (F.min("mean_f1") > 0) & (best <= 1)).alias("sound"))


@check("model_tuned_evaluation", with_views(f"SELECT model_name, n FROM {_MODELS_SQL}, (SELECT count(*) AS n FROM split WHERE split = 'test')", "split"))
def tuned_evaluation(spark, folder):
    return _tuned(spark, folder)[0].predictions.groupBy("model_name").agg(F.count(F.lit(1)).alias("n"))


@check("model_search_table")
def search_table(spark, folder):
    """Every point of every grid with its mean F1."""
    return rounded(reduce(DataFrame.unionByName, _tuned(spark, folder)[0].searches.values()))


@check("model_tuned_comparison")
def tuned_comparison(spark, folder):
    """Metrics of the tuned models on the test rows."""
    return rounded(_tuned(spark, folder)[0].comparison)


_REQUEST_ROWS = """
(SELECT doc_id AS id, text AS t FROM documents UNION ALL
 SELECT -doc_id - 1, CASE doc_id % 13 WHEN 1 THEN substr(text, 1, 2) WHEN 2 THEN '   ' WHEN 3 THEN repeat('a', 5001) ELSE repeat('a', 5000) END
 FROM documents WHERE doc_id % 13 BETWEEN 1 AND 4)"""
_REQUESTS_SQL = f"""
SELECT id, model, concat_ws(',', CASE WHEN length(t) < 3 THEN 'text_too_short' WHEN length(t) > 5000 THEN 'text_too_long'
         WHEN trim(t) = '' THEN 'text_blank' END, CASE WHEN model = 'other' THEN 'unknown_model' END) AS reason
FROM (SELECT *, ['best', 'logistic_regression', 'naive_bayes', 'random_forest', 'other'][CAST((id % 5 + 5) % 5 AS INT) + 1] AS model FROM {_REQUEST_ROWS})"""


@check("model_score_texts", f"SELECT id, model, true AS sound FROM ({_REQUESTS_SQL}) WHERE reason = ''")
def score_texts(spark, folder):
    """Each valid request scored by the model it names; all four names occur."""
    tables = _tables(spark, folder)
    scored, _ = M.score_requests(V.requests(spark, folder), _trained(spark, folder)[1], tables.weights, tables.numeric, V.lemmas(spark))
    most = F.greatest("positive", "neutral", "negative")
    named = F.when(F.col("sentiment") == "positive", F.col("positive")).when(F.col("sentiment") == "neutral", F.col("neutral")).otherwise(F.col("negative"))
    used = F.when(F.col("model") == "best", "logistic_regression").otherwise(F.col("model"))
    total = F.col("positive") + F.col("neutral") + F.col("negative")
    sound = (named == most) & (F.abs(total - 1) < 1e-3) & (F.abs(F.col("confidence") - most) < 1e-9) & (F.col("model_used") == used)
    return scored.select("id", "model", sound.alias("sound"))


@check(
    "model_score_naive_bayes",
    _with_features(
        f"""{_BAYES},
asked AS (
  SELECT id, trim(t) AS text FROM (SELECT *, (id % 5 + 5) % 5 AS model_at FROM {_REQUEST_ROWS})
  WHERE model_at = 2 AND length(t) BETWEEN 3 AND 5000 AND trim(t) <> ''),
request_tokens AS (
  SELECT a.id, a.pos, coalesce(m.lemma, a.token) AS token
  FROM (SELECT id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM (
          SELECT id, list_filter({tokens(clean('text'))}, lambda t: length(t) >= 3 AND t NOT IN ({quoted(STOPWORDS)})) AS toks FROM asked)) a
  LEFT JOIN lemma_table m ON m.token = a.token),
request_words AS (
  SELECT id, string_split(coalesce(c, lower(text)), ' ') AS w
  FROM asked LEFT JOIN (SELECT id, string_agg(token, ' ' ORDER BY pos) AS c FROM request_tokens GROUP BY id) USING (id)),
request_terms AS (
  SELECT id, term, count(*) AS tf FROM (
    SELECT id, unnest(w) AS term FROM request_words UNION ALL
    SELECT id, w[i] || ' ' || w[i + 1] FROM (SELECT id, w, unnest(range(1, len(w))) AS i FROM request_words)) GROUP BY id, term),
request_weights AS (
  SELECT id, idx, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS value
  FROM (SELECT id, v.idx, (1 + ln(t.tf)) * v.idf AS w FROM request_terms t JOIN vocabulary v USING (term))),
request_scores AS (
  SELECT id, r.label, any_value(prior) + coalesce(sum(value * (ln(s + 1) - norm)), 0) AS score
  FROM asked CROSS JOIN priors r JOIN norms n ON n.label = r.label LEFT JOIN request_weights USING (id)
  LEFT JOIN sums ON sums.label = r.label AND sums.idx = request_weights.idx GROUP BY id, r.label),
request_shares AS (SELECT id, label, exp(score - max(score) OVER (PARTITION BY id)) AS e FROM request_scores)""",
        """
SELECT id, round(sum(e) FILTER (label = 2) / sum(e), 4) AS positive, round(sum(e) FILTER (label = 1) / sum(e), 4) AS neutral,
       round(sum(e) FILTER (label = 0) / sum(e), 4) AS negative, round(max(e) / sum(e), 4) AS confidence,
       ['negative', 'neutral', 'positive'][arg_max(label, e) + 1] AS sentiment FROM request_shares GROUP BY id""",
    ),
)
def score_naive_bayes(spark, folder):
    """Scores of the requests that name Naive Bayes, among requests for all models; model_score_texts has all models stored."""
    tables = _tables(spark, folder)
    scored, _ = M.score_requests(V.requests(spark, folder), _trained(spark, folder, "naive_bayes")[1], tables.weights, tables.numeric, V.lemmas(spark))
    return scored.filter("model = 'naive_bayes'").select("id", "positive", "neutral", "negative", "confidence", "sentiment")


@check("model_check_requests", _REQUESTS_SQL)
def check_requests(spark, folder):
    return M.check_requests(V.requests(spark, folder)).select("id", "model", "reason")


@check(
    "model_choose",
    with_views(
        """
SELECT name, kind, path FROM (
  SELECT name, kind, path, row_number() OVER (PARTITION BY name ORDER BY CASE kind WHEN 'best' THEN 0 WHEN 'tuned' THEN 1 ELSE 2 END, path) AS rn
  FROM (SELECT model || '_' || (user_id // 3) AS name, ['base', 'tuned', 'base', 'best'][CAST(event_id % 4 AS INT) + 1] AS kind, 'p' || event_id AS path
        FROM metric JOIN (SELECT event_id, user_id FROM events) USING (event_id))) WHERE rn = 1""", "metric",
    ),
)
def choose(spark, folder):
    events = V.table(spark, folder, "events").select("event_id", "user_id")
    kinds = F.array(*[F.lit(k) for k in ("base", "tuned", "base", "best")])
    stored = V.metric_events(spark, folder).join(events, "event_id").select(
        F.concat_ws("_", "model", F.expr("user_id div 3").cast("string")).alias("name"),
        F.get(kinds, (F.col("event_id") % 4).cast("int")).alias("kind"), F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("path"),
    )
    return M.choose_models(stored)


@check(
    "model_compare_sample",
    with_views(
        """
SELECT model_name, id, ['negative', 'neutral', 'positive'][label + 1] AS actual, ['negative', 'neutral', 'positive'][prediction + 1] AS predicted,
       label = prediction AS matches FROM predictions ORDER BY id, model_name LIMIT 3""", "predictions",
    ),
)
def compare_sample(spark, folder):
    return M.compare_sample(V.predictions(spark, folder))


# --- evaluation ---------------------------------------------------------------------------

_CELLS = """
SELECT model_name, a.a AS label, b.b AS prediction, count(*) FILTER (p.label = a.a AND p.prediction = b.b) AS n
FROM predictions p, (VALUES (0), (1), (2)) a(a), (VALUES (0), (1), (2)) b(b) GROUP BY ALL"""


@check("eval_confusion", with_views(_CELLS, "predictions"))
def confusion(spark, folder):
    return E.confusion(V.predictions(spark, folder))


@check(
    "eval_confusion_percent",
    with_views(f"SELECT model_name, label, prediction, n, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY model_name, label), 6) AS percent FROM ({_CELLS})", "predictions"),
)
def confusion_percent(spark, folder):
    return rounded(E.confusion_percent(V.predictions(spark, folder)))


@check(
    "eval_class_report",
    with_views(
        f"""
SELECT model_name, label, round(coalesce(tp / nullif(predicted, 0), 0), 6) AS precision, round(coalesce(tp / nullif(support, 0), 0), 6) AS recall,
       round(coalesce(2 * tp / nullif(support + predicted, 0), 0), 6) AS f1_score, support
FROM (SELECT model_name, label, CAST(sum(n) FILTER (prediction = label) AS BIGINT) AS tp, CAST(sum(n) AS BIGINT) AS support FROM ({_CELLS}) GROUP BY ALL)
JOIN (SELECT model_name, prediction AS label, CAST(sum(n) AS BIGINT) AS predicted FROM ({_CELLS}) GROUP BY ALL) USING (model_name, label)""",
        "predictions",
    ),
)
def class_report(spark, folder):
    return rounded(E.class_report(V.predictions(spark, folder)).drop("hits", "predicted"))


_METRICS = ["accuracy", "precision", "recall", "f1_score"]


@check(
    "eval_model_metrics",
    with_views(
        "SELECT model_name, support, " + ", ".join(f"round({m}, 6) AS {m}" for m in [*_METRICS, "macro_precision", "macro_recall", "macro_f1_score"])
        + " FROM after_metrics", "after_metrics",
    ),
)
def model_metrics(spark, folder):
    return rounded(E.model_metrics(V.predictions(spark, folder)))


_COMPARISON = "SELECT model_name, " + ", ".join(f"round({m}, 4) AS {m}" for m in _METRICS) + " FROM after_metrics"


@check("eval_comparison_table", with_views(_COMPARISON, "after_metrics"))
def comparison(spark, folder):
    return E.comparison_table(V.predictions(spark, folder))


@check(
    "eval_tuning_table",
    with_views(
        """
SELECT b.model_name, round(b.accuracy, 4) AS before_accuracy, round(a.accuracy, 4) AS after_accuracy, round(b.f1_score, 4) AS before_f1,
       round(a.f1_score, 4) AS after_f1, round(a.f1_score - b.f1_score, 4) AS improvement,
       CASE WHEN a.f1_score > b.f1_score THEN 'up' WHEN a.f1_score < b.f1_score THEN 'down' ELSE 'same' END AS direction
FROM before_metrics b JOIN after_metrics a USING (model_name)""", "before_metrics", "after_metrics",
    ),
)
def tuning(spark, folder):
    return E.tuning_table(V.predictions(spark, folder, 5), V.predictions(spark, folder, 6))


_SCORES = """
SELECT model_name, c.c AS class, CASE c.c WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END AS score, CAST(label = c.c AS INT) AS hit
FROM predictions, (VALUES (0), (1), (2)) c(c)"""


@check(
    "eval_roc_points",
    with_views(
        f"""
SELECT DISTINCT model_name, class, round(score, 6) AS threshold,
       round(sum(1 - hit) OVER w / sum(1 - hit) OVER (PARTITION BY model_name, class), 6) AS fpr,
       round(sum(hit) OVER w / sum(hit) OVER (PARTITION BY model_name, class), 6) AS tpr
FROM ({_SCORES}) WINDOW w AS (PARTITION BY model_name, class ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        "predictions",
    ),
)
def roc_points(spark, folder):
    return rounded(E.roc_points(V.predictions(spark, folder), origin=False))


@check(
    "eval_roc_auc",
    with_views(
        f"""
SELECT model_name, class, round((sum(r) FILTER (hit = 1) - p * (p + 1) / 2) / (p * n), 6) AS auc FROM (
  SELECT *, rank() OVER (PARTITION BY model_name, class ORDER BY score) + (count(*) OVER (PARTITION BY model_name, class, score) - 1) / 2 AS r,
         sum(hit) OVER (PARTITION BY model_name, class) AS p, sum(1 - hit) OVER (PARTITION BY model_name, class) AS n FROM ({_SCORES}))
GROUP BY model_name, class, p, n""", "predictions",
    ),
)
def roc_auc(spark, folder):
    return rounded(E.roc_auc(V.predictions(spark, folder)))


@check(
    "eval_metric_bars",
    with_views(
        f"SELECT model_name, metric, value, value >= 0.8 AS above_threshold FROM (UNPIVOT ({_COMPARISON}) ON accuracy, precision, recall, f1_score INTO NAME metric VALUE value)",
        "after_metrics",
    ),
)
def metric_bars(spark, folder):
    return E.metric_bars(E.comparison_table(V.predictions(spark, folder)))


@check("eval_best_model", with_views(f"SELECT * FROM ({_COMPARISON}) ORDER BY f1_score DESC, accuracy DESC, precision DESC, model_name LIMIT 1", "after_metrics"))
def best_model(spark, folder):
    return E.best_model(E.comparison_table(V.predictions(spark, folder)))

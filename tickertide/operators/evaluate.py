"""Metrics over a predictions table (model_name, id, label, prediction, p0, p1, p2)."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.operators.ordered import running_sums

LABELS = [0, 1, 2]
METRICS = ["accuracy", "precision", "recall", "f1_score"]
GOOD_FROM = 0.80


def confusion(predictions: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, label, prediction, n) with all nine cells; one shuffle of counts per model."""
    keys = keys or ["model_name"]
    label, prediction = F.col("label").cast("int"), F.col("prediction").cast("int")
    cells = [(a, b) for a in LABELS for b in LABELS]
    counts = [F.count_if((label == a) & (prediction == b)).alias(f"_{a}{b}") for a, b in cells]
    rows = [
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(f"_{a}{b}").alias("n"))
        for a, b in cells
    ]
    return predictions.groupBy(*keys).agg(*counts).select(*keys, F.inline(F.array(*rows)))


def confusion_percent(predictions: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Share of each actual label; null for a label that never occurs."""
    keys = keys or ["model_name"]
    of_label = F.sum("n").over(Window.partitionBy(*keys, "label"))  # three cells
    return confusion(predictions, keys).withColumn("percent", F.try_divide(F.col("n"), of_label) * 100)


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def class_report(predictions: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """precision, recall, f1_score, support per class; 0 where undefined."""
    keys = keys or ["model_name"]
    cells = confusion(predictions, keys)
    row, column = Window.partitionBy(*keys, "label"), Window.partitionBy(*keys, "prediction")
    # nine cells per model
    marked = cells.withColumns({"_actual": F.sum("n").over(row), "_predicted": F.sum("n").over(column)})
    hits = marked.filter(F.col("label") == F.col("prediction"))
    precision, recall = _ratio(F.col("n"), F.col("_predicted")), _ratio(F.col("n"), F.col("_actual"))
    return hits.select(
        *keys, "label", precision.alias("precision"), recall.alias("recall"),
        _ratio(2 * F.col("n"), F.col("_predicted") + F.col("_actual")).alias("f1_score"),
        F.col("_actual").alias("support"), F.col("_predicted").alias("predicted"), F.col("n").alias("hits"),
    )


def model_metrics(predictions: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Accuracy, support-weighted and macro precision, recall and F1 per model."""
    keys = keys or ["model_name"]
    per_class = class_report(predictions, keys)
    total = F.sum("support")
    weighted = [(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in ("precision", "recall", "f1_score")]
    # the plain mean runs over the classes that occur as label or prediction
    seen = (F.col("support") > 0) | (F.col("predicted") > 0)
    macro = [F.avg(F.when(seen, F.col(m))).alias(f"macro_{m}") for m in ("precision", "recall", "f1_score")]
    return per_class.groupBy(*keys).agg(
        (F.sum("hits") / total).alias("accuracy"), *weighted, *macro, total.alias("support")
    )


def comparison_table(predictions: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """One row per model with 4-decimal metrics and, if given, training_time."""
    table = model_metrics(predictions).select("model_name", *[F.round(m, 4).alias(m) for m in METRICS])
    return table if times is None else table.join(times, "model_name", "left")


def tuning_table(before: DataFrame, after: DataFrame) -> DataFrame:
    """Before and after tuning per model: accuracy, F1, difference, direction."""
    b = model_metrics(before).select("model_name", F.col("accuracy").alias("_ba"), F.col("f1_score").alias("_bf"))
    a = model_metrics(after).select("model_name", F.col("accuracy").alias("_aa"), F.col("f1_score").alias("_af"))
    change = F.col("_af") - F.col("_bf")
    direction = F.when(change > 0, "up").when(change < 0, "down").otherwise("same")
    return b.join(a, "model_name").select(
        "model_name",
        F.round("_ba", 4).alias("before_accuracy"), F.round("_aa", 4).alias("after_accuracy"),
        F.round("_bf", 4).alias("before_f1"), F.round("_af", 4).alias("after_f1"),
        F.round(change, 4).alias("improvement"), direction.alias("direction"),
    )


def _score_counts(predictions: DataFrame) -> DataFrame:
    """(model_name, class, score, positives, negatives) with one row per distinct score."""
    scores = [
        F.struct(F.lit(c).alias("class"), F.col(f"p{c}").alias("score"), (F.col("label") == c).alias("hit"))
        for c in LABELS
    ]
    long = predictions.select("model_name", F.inline(F.array(*scores)))
    return long.groupBy("model_name", "class", "score").agg(
        F.count_if("hit").alias("positives"), F.count_if(~F.col("hit")).alias("negatives")
    )


def _ranked_scores(predictions: DataFrame) -> DataFrame:
    counts = _score_counts(predictions).withColumn("_order", -F.col("score"))
    keys = ["model_name", "class"]
    totals = counts.groupBy(*keys).agg(F.sum("positives").alias("_p"), F.sum("negatives").alias("_n"))
    running = running_sums(counts, keys, "_order", ["positives", "negatives"])
    return running.join(totals, keys)


def roc_points(predictions: DataFrame, origin: bool = True) -> DataFrame:
    """One-vs-rest ROC: (model_name, class, threshold, fpr, tpr), one point per distinct score."""
    points = _ranked_scores(predictions).select(
        "model_name", "class", F.col("score").alias("threshold"),
        F.try_divide("running_negatives", "_n").alias("fpr"), F.try_divide("running_positives", "_p").alias("tpr"),
    )
    if not origin:
        return points
    start = points.select("model_name", "class").distinct().select(
        "model_name", "class", F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def roc_auc(predictions: DataFrame) -> DataFrame:
    """Exact one-vs-rest AUC; equal scores count half. Null if a class has no positives or negatives."""
    above = F.col("running_positives") - F.col("positives")
    won = F.sum(F.col("negatives") * (above + F.col("positives") / 2))
    return _ranked_scores(predictions).groupBy("model_name", "class").agg(
        F.try_divide(won, F.max(F.col("_p").cast("double") * F.col("_n"))).alias("auc")
    )


def metric_bars(comparison: DataFrame) -> DataFrame:
    """Long form of the comparison table, flagged from 0.80."""
    long = comparison.unpivot(["model_name"], METRICS, "metric", "value")
    return long.withColumn("above_threshold", F.col("value") >= GOOD_FROM)


def best_model(comparison: DataFrame) -> DataFrame:
    """Best by F1, then accuracy, then precision, then name."""
    order = [F.desc("f1_score"), F.desc("accuracy"), F.desc("precision"), F.col("model_name")]
    return comparison.orderBy(*order).limit(1)

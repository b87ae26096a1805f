"""Chart-ready aggregates; each is a small table, whatever the number of posts."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.functions.text import feature_words, ngrams
from tickertide.operators.keyed import top_per_key
from tickertide.operators.ordered import quantiles_per_key
from tickertide.operators.stats import existing, sentiment_word_counts
from tickertide.settings import RADAR_COLUMNS, SENTIMENTS

VIOLIN_SHARES = [i / 20 for i in range(21)]


def _labelled(df: DataFrame) -> DataFrame:
    """Rows of the three sentiments: at most three groups from here on."""
    return df.filter(F.col("sentiment").isin(*SENTIMENTS))


def ensure_engagement(df: DataFrame) -> DataFrame:
    return df if "engagement" in df.columns else df.withColumn("engagement", F.col("score"))


def _per_sentiment(df: DataFrame, make) -> DataFrame:
    """One global aggregate per sentiment, as three rows in fixed order, present or not."""
    row = df.agg(*[c.alias(f"{s}_{i}") for s in SENTIMENTS for i, c in enumerate(make(s).values())])
    names = list(make(SENTIMENTS[0]))
    structs = [
        F.struct(
            F.lit(at).alias("position"), F.lit(s).alias("sentiment"),
            *[F.col(f"{s}_{i}").alias(name) for i, name in enumerate(names)],
        )
        for at, s in enumerate(SENTIMENTS)
    ]
    return row.select(F.inline(F.array(*structs)))


def sentiment_distribution(df: DataFrame) -> DataFrame:
    return _per_sentiment(df, lambda s: {"count": F.count_if(F.col("sentiment") == s)})


def _pivot(df: DataFrame, key: str) -> DataFrame:
    """Counts per key with one column per sentiment, zero where there are none."""
    counts = [F.count_if(F.col("sentiment") == s).alias(s) for s in SENTIMENTS]
    return _labelled(df).filter(F.col(key).isNotNull()).groupBy(key).agg(*counts)


def sentiment_by_community(df: DataFrame) -> DataFrame:
    return _pivot(df, "subreddit")


def word_weights(df: DataFrame, k: int = 200) -> DataFrame:
    """Word-cloud weights: frequency relative to the most frequent word of the class."""
    top = top_per_key(sentiment_word_counts(df), ["sentiment"], [F.desc("n"), F.col("word")], k)
    highest = F.max("n").over(Window.partitionBy("sentiment"))  # at most k rows per class
    return top.withColumn("weight", F.col("n") / highest)


def sentiment_over_time(df: DataFrame, dense: bool = False) -> DataFrame:
    """Posts per day and sentiment; dense=True adds the days without posts."""
    days = _pivot(df.withColumn("date", F.to_date("created_at")), "date")
    if not dense:
        return days
    span = days.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    spine = span.select(F.explode(F.sequence("first", "last")).alias("date"))
    return spine.join(days, "date", "left").fillna(0, SENTIMENTS)


def hourly_sentiment(df: DataFrame) -> DataFrame:
    return _pivot(df.withColumn("hour", F.hour("created_at")), "hour")


def score_distribution(df: DataFrame, method: str = "exact") -> DataFrame:
    """Score quantiles in steps of 5 percent per sentiment (violin)."""
    found = quantiles_per_key(_labelled(df), "score", VIOLIN_SHARES, ["sentiment"], method)
    pairs = F.arrays_zip(F.array(*[F.lit(s) for s in VIOLIN_SHARES]).alias("share"), F.col("quantiles").alias("score"))
    return found.select("sentiment", F.inline(pairs).alias("share", "score"))


def comment_box(df: DataFrame, method: str = "exact") -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 IQR, and outliers of num_comments."""
    posts = _labelled(df).filter(F.col("num_comments").isNotNull())
    quartiles = quantiles_per_key(posts, "num_comments", [0.25, 0.5, 0.75], ["sentiment"], method)
    boxes = quartiles.select(
        "sentiment",
        F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("median"), F.col("quantiles")[2].alias("q3"),
    )
    # three sentiments, so three rows
    joined = posts.select("sentiment", "num_comments").join(F.broadcast(boxes), "sentiment")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    x = F.col("num_comments")
    inside = (x >= F.col("q1") - reach) & (x <= F.col("q3") + reach)
    return joined.groupBy("sentiment", "q1", "median", "q3").agg(
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def mean_engagement(df: DataFrame) -> DataFrame:
    df = ensure_engagement(df)
    return _per_sentiment(
        df, lambda s: {"mean_engagement": F.avg(F.when(F.col("sentiment") == s, F.col("engagement")))}
    )


def score_comment_bins(df: DataFrame, score_width: int = 10, comment_width: int = 10) -> DataFrame:
    """Scatter of score and comments as counts of 2-D bins (lower bin edges)."""
    score_bin = (F.floor(F.col("score") / score_width) * score_width).cast("long").alias("score_bin")
    comment_bin = (F.floor(F.col("num_comments") / comment_width) * comment_width).cast("long").alias("comment_bin")
    return _labelled(df).groupBy("sentiment", score_bin, comment_bin).agg(F.count(F.lit(1)).alias("n"))


def score_comment_sample(df: DataFrame, share: float, seed: int = 42) -> DataFrame:
    """The point cloud itself, as a seeded sample."""
    return _labelled(df).sample(share, seed).select("sentiment", "score", "num_comments")


def _histogram(df: DataFrame, keys: list[str], column: str, bins: int) -> DataFrame:
    """Equal bins on each group's own range, the last one closed, empty bins kept.

    As in the usual histogram, a group with a single value gets a range of width 1 around it.
    """
    x = F.col(column).cast("double")
    ranges = df.filter(F.col(column).isNotNull()).groupBy(*keys).agg(F.min(x).alias("_a"), F.max(x).alias("_b"))
    half = F.when(F.col("_a") == F.col("_b"), 0.5).otherwise(0.0)
    ranges = ranges.select(*keys, (F.col("_a") - half).alias("low"), (F.col("_b") + half).alias("high"))
    if keys:
        placed = df.join(F.broadcast(ranges), keys)  # one row for each of three sentiments
    else:
        edges = ranges.select(F.struct("low", "high").alias("r")).scalar()
        placed = df.withColumns({"low": edges["low"], "high": edges["high"]})
    step = (F.col("high") - F.col("low")) / bins
    guess = F.least(F.floor((x - F.col("low")) / step).cast("int"), F.lit(bins - 1))
    placed = placed.filter(F.col(column).isNotNull()).withColumn("_bin", guess)
    # the division may be off by one at an edge; the edges decide
    at = F.col("_bin")
    at = (
        F.when(x < F.col("low") + step * at, at - 1)
        .when((x >= F.col("low") + step * (at + 1)) & (at < bins - 1), at + 1)
        .otherwise(at)
    )
    placed = placed.withColumn("_bin", at)
    counts = [F.count_if(F.col("_bin") == i).alias(f"_{i}") for i in range(bins)]
    counted = placed.groupBy(*keys, "low", "high").agg(*counts)
    rows = [
        F.struct(
            F.lit(i).alias("bin"), (F.col("low") + step * i).alias("bin_low"),
            (F.col("low") + step * (i + 1)).alias("bin_high"), F.col(f"_{i}").alias("n"),
        )
        for i in range(bins)
    ]
    return counted.select(*keys, F.inline(F.array(*rows)))


def word_count_histogram(df: DataFrame, bins: int = 10) -> DataFrame:
    return _histogram(_labelled(df), ["sentiment"], "word_count", bins)


def engagement_histogram(df: DataFrame, bins: int = 40) -> DataFrame:
    return _histogram(ensure_engagement(df), [], "engagement", bins)


def top_ngrams(df: DataFrame, n: int = 1, k: int = 15, min_texts: int = 5) -> DataFrame:
    """Most frequent n-grams per sentiment; classes with fewer than min_texts texts are skipped."""
    texts = _labelled(df).filter(F.col("cleaned_text").isNotNull())
    sizes = texts.groupBy("sentiment").agg(F.count(F.lit(1)).alias("_texts"))
    terms = ngrams(feature_words("cleaned_text"), n)
    counted = texts.select("sentiment", F.explode(terms).alias("term")).groupBy(
        "sentiment", "term"
    ).agg(F.count(F.lit(1)).alias("n"))
    top = top_per_key(counted, ["sentiment"], [F.desc("n"), F.col("term")], k)
    # three sentiments, so three rows
    enough = F.broadcast(sizes.filter(F.col("_texts") >= min_texts).select("sentiment"))
    return top.join(enough, "sentiment", "left_semi")


def radar(df: DataFrame) -> DataFrame:
    """Mean of each metric per sentiment, min-max normalised across the sentiments."""
    df = ensure_engagement(df)
    metrics = existing(df, RADAR_COLUMNS)

    def means(sentiment: str) -> dict[str, Column]:
        return {m: F.avg(F.when(F.col("sentiment") == sentiment, F.col(m))) for m in metrics}

    rows = _per_sentiment(df, means)
    long = rows.unpivot(["sentiment"], metrics, "metric", "mean")
    across = Window.partitionBy("metric")  # three rows per metric
    low, high = F.min("mean").over(across), F.max("mean").over(across)
    return long.withColumn("normalised", (F.col("mean") - low) / (high - low + F.lit(1e-9)))

"""Descriptive statistics: counts, shares, seven-number summaries, tokens and the report."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.functions.text import split_words, tokenize
from tickertide.operators.keyed import top_per_key
from tickertide.operators.ordered import quantiles_of_counts, quantiles_per_key
from tickertide.settings import DESCRIBE_COLUMNS, REPORT_COLUMNS, REPORT_PLOTS, SENTIMENTS
from tickertide.sources.handover import materialise

SKETCH_SIZE = 400  # k of the quantile sketches: ranks are off by less than 1 % of the rows


def existing(df: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


def total_posts(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_posts"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def sentiment_shares(df: DataFrame, of_all_rows: bool = True) -> DataFrame:
    """Count and percentage per sentiment; of all rows, or of the rows that have one."""
    counted = df.groupBy("sentiment").agg(F.count(F.lit(1)).alias("count"))
    # one row per sentiment from here on
    total = F.sum("count") if of_all_rows else F.sum(F.when(F.col("sentiment").isNotNull(), F.col("count")))
    shared = counted.withColumn("_total", total.over(Window.partitionBy()))
    return shared.filter(F.col("sentiment").isNotNull()).select(
        "sentiment", "count", (F.col("count") / F.col("_total") * 100).alias("percentage")
    )


def community_counts(df: DataFrame) -> DataFrame:
    counted = df.filter(F.col("subreddit").isNotNull()).groupBy("subreddit")
    return counted.agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "subreddit")


def community_sentiments(df: DataFrame) -> DataFrame:
    """Count per community and sentiment; absent pairs are left out."""
    both = df.filter(F.col("subreddit").isNotNull() & F.col("sentiment").isNotNull())
    return both.groupBy("subreddit", "sentiment").agg(F.count(F.lit(1)).alias("count"))


def describe_numeric(df: DataFrame, columns: list[str] | None = None, method: str = "exact") -> DataFrame:
    """count, mean, sample std, min, q25, median, q75, max of the wanted columns that exist.

    The columns become rows (column, value), so one aggregate and one quantile job serve all of them.
    """
    columns = existing(df, columns or DESCRIBE_COLUMNS)
    if not columns:
        raise ValueError("none of the columns exists")
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    long = df.select(F.inline(F.array(*cells)))
    facts = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quantiles = quantiles_per_key(long, "value", [0.25, 0.5, 0.75], ["column"], method)
    # a row for each column, also where the table is empty
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    joined = names.join(facts, "column", "left").join(quantiles, "column", "left")
    q = F.col("quantiles")
    return joined.select(
        "column", F.coalesce("count", F.lit(0).cast("long")).alias("count"), "mean", "std", "min",
        q[0].alias("q25"), q[1].alias("median"), q[2].alias("q75"), "max",
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Null count per column, for columns that have any."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in df.columns]
    return row.select(F.inline(F.array(*pairs))).filter(F.col("missing") > 0)


def _token_counts(df: DataFrame, text: str) -> DataFrame:
    # hot tokens are combined in each task before the shuffle
    return df.select(F.explode(tokenize(text)).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n")
    )


def token_totals(df: DataFrame, text: str = "cleaned_text") -> DataFrame:
    """total_tokens, unique_tokens, avg_per_doc (two decimals, at least one document)."""
    documents = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    totals = _token_counts(df, text).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_tokens"), F.count(F.lit(1)).alias("unique_tokens")
    )
    average = F.round(F.col("total_tokens") / F.greatest(documents, F.lit(1)), 2)
    return totals.withColumn("avg_per_doc", average)


def top_tokens(df: DataFrame, text: str = "cleaned_text", k: int = 10) -> DataFrame:
    return _token_counts(df, text).orderBy(F.desc("n"), "token").limit(k)


def sentiment_word_counts(df: DataFrame, text: str = "cleaned_text") -> DataFrame:
    labelled = df.filter(F.col("sentiment").isin(*SENTIMENTS))
    words = labelled.select("sentiment", F.explode(split_words(text)).alias("word"))
    return words.groupBy("sentiment", "word").agg(F.count(F.lit(1)).alias("n"))


def top_words(df: DataFrame, k: int = 20, text: str = "cleaned_text") -> DataFrame:
    """Most frequent words per sentiment; ties in alphabetical order."""
    return top_per_key(sentiment_word_counts(df, text), ["sentiment"], [F.desc("n"), F.col("word")], k)


def label_counts(df: DataFrame, split: str = "split", label: str = "sentiment_label") -> DataFrame:
    return df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))


_CELL = "array<struct<part:string,community:string,sentiment:string,name:string,value:double>>"


def report_parts(df: DataFrame, text: str = "cleaned_text", day: Column | None = None, method: str = "exact") -> DataFrame:
    """Everything the report needs, from one scan and one aggregate: mergeable rows, for the whole table or per day.

    Each post becomes cells: itself, its numbers, its words. Equal cells are counted per task before the shuffle.
    A part is (day?, part, community, sentiment, name, value, n, mean, m2, low, high, sketch). exact keeps the counts
    of each number's values, so that merged quantiles are exact; approx keeps a quantile sketch of bounded size.
    """
    if method not in ("exact", "approx"):
        raise ValueError(f"unknown method {method!r}, choose exact or approx")
    none = F.lit(None)
    post = [F.struct(F.lit("post"), F.col("subreddit").cast("string"), F.col("sentiment"), none, none)]
    numbers = [F.struct(F.lit("number"), none, none, F.lit(c), F.col(c).cast("double")) for c in existing(df, REPORT_COLUMNS)]
    words = F.transform(split_words(text), lambda w: F.struct(F.lit("word"), none, F.col("sentiment"), w, none)).cast(_CELL)
    labelled = F.col("sentiment").isin(*SENTIMENTS) & F.col(text).isNotNull()
    cells = F.concat(F.array(*[c.cast(_CELL[6:-1]) for c in (*post, *numbers)]), F.when(labelled, words).otherwise(F.array().cast(_CELL)))
    days = {"day": day.cast("date")} if day is not None else {}
    long = df.select(*[c.alias(n) for n, c in days.items()], F.inline(cells))
    keys = [*days, "part", "community", "sentiment", "name"]
    n = F.count(F.lit(1)).alias("n")
    if method == "exact":
        # no sketch: the counts of the values are the distribution
        counted = long.groupBy(*keys, "value").agg(n)
        moments = [F.col("value").alias("mean"), F.lit(0.0).alias("m2"), F.col("value").alias("low"), F.col("value").alias("high")]
        return counted.select(*keys, "value", "n", *moments, F.lit(None).cast("binary").alias("sketch"))
    # nulls are parts of their own, as in the exact form; they are no values
    long = long.withColumn("known", F.col("value").isNotNull())
    found = long.groupBy(*keys, "known").agg(
        n, F.avg("value").alias("mean"), (F.var_pop("value") * F.count("value")).alias("m2"), F.min("value").alias("low"),
        F.max("value").alias("high"), F.kll_sketch_agg_double("value", SKETCH_SIZE).alias("sketch"),
    )
    return found.select(*keys, none.cast("double").alias("value"), "n", "mean", "m2", "low", "high", F.when(F.col("known"), F.col("sketch")).alias("sketch"))


def _merged_numbers(parts: DataFrame, columns: list[str] | None) -> DataFrame:
    """describe_numeric's rows from the parts of any number of days: counts add up, moments are merged around the common mean."""
    numbers = parts.filter("part = 'number'").select(F.col("name").alias("column"), "value", "n", "mean", "m2", "low", "high", "sketch")
    known = numbers.filter(F.col("mean").isNotNull())
    totals = known.groupBy("column").agg(
        F.sum("n").alias("count"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("center"), F.min("low").alias("min"), F.max("high").alias("max"))
    off = F.col("mean") - F.col("center")
    spread = known.join(totals.select("column", "center"), "column").groupBy("column").agg(F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"))
    # a column's parts are all of one kind: values with counts, or sketches
    values = known.filter(F.col("value").isNotNull()).groupBy("column", F.col("value").alias("_v")).agg(F.sum("n").alias("_n"))
    exact = quantiles_of_counts(values, [0.25, 0.5, 0.75], ["column"])
    ranks = F.array(*[F.lit(r) for r in (0.25, 0.5, 0.75)])
    merged = known.filter(F.col("sketch").isNotNull()).groupBy("column").agg(F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("_s"))
    approx = merged.select("column", F.kll_sketch_get_quantile_double("_s", ranks).alias("quantiles"))
    names = parts.sparkSession.createDataFrame([(c,) for c in columns], "column string") if columns else numbers.select("column").distinct()
    joined = names.join(totals, "column", "left").join(spread, "column", "left").join(exact.unionByName(approx), "column", "left")
    q = F.col("quantiles")
    return joined.select(
        "column", F.col("center").alias("mean"), F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1))).alias("std"),
        "min", q[0].alias("q25"), q[1].alias("median"), q[2].alias("q75"), "max",
    )


def report_of(parts: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The report as one row from written parts, of one or many days; each section is a few rows when it is gathered.

    `columns` are the numeric columns to list, also without a row; by default those that the parts name.
    """
    posts = parts.filter("part = 'post'").groupBy("community", "sentiment").agg(F.sum("n").alias("n"))
    total = F.coalesce(posts.agg(F.sum("n")).scalar(), F.lit(0).cast("long"))
    per_sentiment = posts.filter(F.col("sentiment").isNotNull()).groupBy("sentiment").agg(F.sum("n").alias("count"))
    share = F.struct("count", F.round(F.col("count") / total * 100, 2).alias("percentage"))
    shares = per_sentiment.agg(F.map_from_entries(F.collect_list(F.struct("sentiment", share))).alias("x"))
    both = posts.filter(F.col("community").isNotNull() & F.col("sentiment").isNotNull())
    per_community = both.groupBy("community").agg(F.map_from_entries(F.collect_list(F.struct("sentiment", F.col("n").alias("count")))).alias("m"))
    communities = per_community.agg(F.map_from_entries(F.collect_list(F.struct("community", "m"))).alias("x"))
    seven = F.struct(*[F.round(c, 2).alias(c) for c in ("mean", "median", "std", "min", "max", "q25", "q75")])
    numbers = _merged_numbers(parts, columns).agg(F.map_from_entries(F.collect_list(F.struct("column", seven))).alias("x"))
    counted = parts.filter("part = 'word'").groupBy("sentiment", F.col("name").alias("word")).agg(F.sum("n").alias("n"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("order"), "word")))
    listed = top_per_key(counted, ["sentiment"], [F.desc("n"), F.col("word")], 20).groupBy("sentiment").agg(
        F.transform(ranked, lambda w: w["word"]).alias("words")
    )
    words = listed.agg(F.map_from_entries(F.collect_list(F.struct("sentiment", "words"))).alias("x"))
    # a class without posts has an empty list
    empty = F.map_from_entries(F.array(*[F.struct(F.lit(s), F.array().cast("array<string>")) for s in SENTIMENTS]))
    one = parts.sparkSession.range(1)
    return one.select(
        total.alias("total_posts"),
        shares.scalar().alias("sentiment_distribution"),
        communities.scalar().alias("subreddit_breakdown"),
        numbers.scalar().alias("numeric_stats"),
        words.scalar().alias("_words"),
    ).withColumn(
        "top_words", F.map_zip_with(empty, "_words", lambda _, none, some: F.coalesce(some, none))
    ).withColumn("available_plots", F.array(*[F.lit(p) for p in REPORT_PLOTS])).drop("_words")


def build_report(df: DataFrame, method: str = "exact") -> DataFrame:
    """The whole report as one row with one struct column per section; df is scanned once, all sections read its written parts."""
    return report_of(materialise(report_parts(df, method=method), "report-parts"), existing(df, REPORT_COLUMNS))


def report_json(df: DataFrame, method: str = "exact") -> DataFrame:
    return json_of(build_report(df, method))


def json_of(report: DataFrame) -> DataFrame:
    return report.select(F.to_json(F.struct(*report.columns)).alias("value"))

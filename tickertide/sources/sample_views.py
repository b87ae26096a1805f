"""The test tables seen in the schemas of the jobs; every view reads its whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide.settings import MODEL_NAMES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a stream over its files: one file of that name, or a folder of parts."""
    # a pattern that only the name itself fits: the file source takes a single file by a pattern only
    return spark.readStream.schema(table(spark, folder, name).schema).parquet(f"{folder}/[{name[0]}]{name[1:]}.parquet")


def _sentiment():
    return (
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "neutral")
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as posts; score, comments, time and author from an event, sentiment from labels."""
    documents, events, labels = (table(spark, folder, t) for t in ("documents", "events", "labels"))
    joined = documents.join(
        events.withColumnRenamed("ts", "created_at"), F.col("event_id") == 5 * F.col("doc_id"), "left"
    ).join(labels, "doc_id", "left")
    return joined.select(
        F.col("doc_id").alias("id"), F.lit("post").alias("type"), F.col("source").alias("subreddit"), "text",
        F.floor("value").cast("long").alias("score"),
        F.get_json_object("props", "$.k").cast("long").alias("num_comments"),
        F.col("created_at").cast("timestamp").alias("created_at"), F.col("user_id").alias("author"),
        _sentiment().alias("sentiment"),
    )


def noisy_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Posts with a URL, a tag, references and a ticker added to the text."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    n_pages = pages.agg(F.count(F.lit(1)).alias("n")).scalar()
    base = posts(spark, folder).withColumn("_page", F.col("id") % n_pages)
    symbols = F.array(*[F.lit(s) for s in ("$AAPL", "TSLA", "CEO", "GME", "BUY")])
    parts = [
        F.col("text"), F.col("url"), F.lit("<b>x</b>"), F.concat(F.lit("r/"), "subreddit"),
        F.concat(F.lit("u/user"), F.col("author").cast("string")), F.lit("over/under"),
        F.get(symbols, (F.col("id") % 5).cast("int")),
    ]
    joined = base.join(pages, F.col("_page") == F.col("page_id"), "left")
    return joined.withColumn("text", F.concat_ws(" ", *parts)).select(*[c for c in base.columns if c != "_page"])


def thread_turns(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    facts = turns.groupBy("conv_id").agg(F.min("turn").alias("_first"), F.count(F.lit(1)).alias("_turns"))
    return turns.join(facts, "conv_id").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"), "conv_id", "turn", "_first",
        F.when((F.col("turn") != F.col("_first")) & ((F.col("conv_id") + F.col("turn")) % 11 == 0), "[deleted]")
        .otherwise(F.col("text")).alias("body"),
        (F.length("text") % 50).cast("long").alias("score"), (F.col("_turns") - 1).alias("num_comments"),
        F.concat(F.lit("c"), (F.col("conv_id") % 4).cast("string")).alias("subreddit"),
        (F.lit(1704067200) + F.col("conv_id") * 3600 + F.col("turn") * 60).alias("created_utc"),
    )


def thread_posts(spark: SparkSession, folder: str) -> DataFrame:
    """The first turn of each conversation, with the conversation's id."""
    first = thread_turns(spark, folder).filter(F.col("turn") == F.col("_first"))
    return first.select(F.col("conv_id").alias("id"), "subreddit", F.col("body").alias("text"), "score", "num_comments", "created_utc")


def thread_comments(spark: SparkSession, folder: str) -> DataFrame:
    """The other turns, with post_id and without a community."""
    rest = thread_turns(spark, folder).filter(F.col("turn") != F.col("_first"))
    return rest.select("id", F.col("conv_id").alias("post_id"), "body", "score", "created_utc")


def predictions(spark: SparkSession, folder: str, right: int = 6) -> DataFrame:
    """Hash-made predictions of three models for every labelled document; `right` sets the hit rate."""
    labels = table(spark, folder, "labels").withColumn("sentiment", _sentiment())
    code = F.when(F.col("sentiment") == "negative", 0).when(F.col("sentiment") == "neutral", 1).otherwise(2)
    labelled = labels.filter(F.col("sentiment").isNotNull()).select(F.col("doc_id").alias("id"), code.alias("label"))
    models = F.array(*[F.struct(F.lit(i).alias("m"), F.lit(n).alias("model_name")) for i, n in enumerate(MODEL_NAMES)])
    long = labelled.select("id", "label", F.inline(models))
    hit = (F.col("id") * 7 + F.col("m")) % 10 < right + F.col("m")
    guess = F.when(hit, F.col("label")).otherwise((F.col("label") + 1) % 3)
    sure = F.lit(0.5) + (F.col("id") % 40).cast("double") / 100
    long = long.withColumns({"prediction": guess, "_p": sure})
    p = [F.when(F.col("prediction") == i, F.col("_p")).otherwise((1 - F.col("_p")) / 2).alias(f"p{i}") for i in range(3)]
    return long.select("model_name", "id", "label", "prediction", *p)


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents as requests, and a further request (negative id) with a text at the limits for each of some ids."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    kind = F.col("doc_id") % 13
    text = (
        F.when(kind == 1, F.substring("text", 1, 2)).when(kind == 2, F.lit("   "))
        .when(kind == 3, F.repeat(F.lit("a"), 5001)).when(kind == 4, F.repeat(F.lit("a"), 5000))
    )
    limits = documents.filter(kind.between(1, 4)).select((-F.col("doc_id") - 1).alias("doc_id"), text.alias("text"))
    documents = documents.unionByName(limits)
    names = F.array(*[F.lit(m) for m in ("best", "logistic_regression", "naive_bayes", "random_forest", "other")])
    return documents.select(F.col("doc_id").alias("id"), "text", F.get(names, F.pmod("doc_id", F.lit(5)).cast("int")).alias("model"))


def metric_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as metric events."""
    return as_metric_events(table(spark, folder, "events"))


def as_metric_events(events: DataFrame) -> DataFrame:
    kinds = {"view": "post_scraped", "error": "scrape_error", "signup": "rate_limit_hit", "click": "api_request", "purchase": "prediction"}
    kind = F.lit(None).cast("string")
    for source, target in kinds.items():
        kind = F.when(F.col("event_type") == source, target).otherwise(kind)
    sentiments = F.array(F.lit("positive"), F.lit("neutral"), F.lit("negative"))
    models = F.array(*[F.lit(n) for n in MODEL_NAMES])
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), kind.alias("kind"),
        F.concat(F.lit("c"), (F.col("user_id") % 4).cast("string")).alias("subreddit"),
        F.get(models, (F.col("user_id") % 3).cast("int")).alias("model"),
        F.get(sentiments, (F.col("event_id") % 3).cast("int")).alias("predicted_sentiment"),
        (F.col("value") / 100).alias("latency_s"),
        F.concat(F.lit("E"), (F.col("user_id") % 2).cast("string")).alias("error_type"),
    )


# Fixed small tables for lookups; the terms occur in the texts.
LEXICON = [
    ("that", 1.2), ("for", -0.8), ("with", 0.9), ("was", -1.1), ("this", 0.6), ("from", -0.5),
    ("tion", 1.9), ("ment", -1.7), ("elle", 1.4), ("eau", -1.3),
]
LEMMAS = [("ment", "men"), ("tion", "tio"), ("eau", "ea"), ("elle", "el")]
STOPWORDS = ["the", "and", "der", "que", "die", "des", "und", "les", "are", "den"]


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "term string, valence double")


def lemmas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEMMAS, "token string, lemma string")

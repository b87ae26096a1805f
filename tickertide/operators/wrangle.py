"""Row filters and derived columns of the processed table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.functions.text import (
    clean_tokens, drop_noise, drop_stopwords, join_tokens, word_count,
)
from tickertide.operators.keyed import first_of_wide_rows
from tickertide.operators.lemmas import lemmatise
from tickertide.operators.ordered import quantiles_per_key
from tickertide.settings import LABEL_CODES


def drop_missing(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["text", "sentiment"])


def drop_copies(df: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per exact text: the earliest, then the smallest id. Texts are told apart by digests and do not move."""
    order = [c for c in ("created_at", "id") if c in df.columns]
    return first_of_wide_rows(df, F.unhex(F.sha2("text", 256)), order, copies)


def add_full_clean(
    df: DataFrame, lemmas: DataFrame | None = None, noise: bool = True, text: str = "text",
    id_column: str = "id", out: str = "cleaned_text", **word_lists,
) -> DataFrame:
    """Clean, drop stopwords, lemmatise, drop noise words, rejoin."""
    tokens = drop_stopwords(clean_tokens(text), **word_lists)
    if lemmas is not None:
        df = lemmatise(df, tokens, lemmas, "_tokens", id_column)
        tokens = F.col("_tokens")
    kept = drop_noise(tokens) if noise else tokens
    return df.withColumn(out, join_tokens(kept)).drop("_tokens")


def add_derived_columns(df: DataFrame) -> DataFrame:
    """Lengths, word counts, engagement and, with created_at, hour and weekday."""
    added = {
        "text_length": F.length("text"),
        "word_count": word_count("text"),
        "clean_length": F.length("cleaned_text"),
        "clean_wc": word_count("cleaned_text"),
        "engagement": F.col("score") + F.col("num_comments"),
    }
    if "created_at" in df.columns:
        added["hour_of_day"] = F.hour("created_at")
        added["day_of_week"] = F.date_format("created_at", "EEEE")
    return df.withColumns(added)


def keep_long_texts(df: DataFrame, min_words: int = 5) -> DataFrame:
    words = F.col("clean_wc") if "clean_wc" in df.columns else word_count("cleaned_text")
    return df.filter(words >= min_words)


def fence(df: DataFrame, column: str, width: float = 1.5, method: str = "exact") -> Column:
    """Condition: inside [Q1 - width * IQR, Q3 + width * IQR]; null is outside.

    The bounds are a scalar subquery: one row, computed once, no join.
    """
    quartiles = quantiles_per_key(df, column, [0.25, 0.75], None, method)
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[1]
    bounds = quartiles.select(
        F.struct(
            (q1 - width * (q3 - q1)).alias("lower"), (q3 + width * (q3 - q1)).alias("upper")
        ).alias("bounds")
    ).scalar()
    return (F.col(column) >= bounds["lower"]) & (F.col(column) <= bounds["upper"])


def keep_within_fence(df: DataFrame, column: str, width: float = 1.5, method: str = "exact") -> DataFrame:
    """Tukey fence. With Q1 = Q3 only that value stays, as documented."""
    return df.filter(fence(df, column, width, method))


def deviation(df: DataFrame, column: str, threshold: float, on_constant: str) -> Column:
    """Condition: less than `threshold` population deviations from the mean; null counts as the mean."""
    value = F.col(column).cast("double")
    # filling with the mean adds nothing to the squared distances
    spread = F.sqrt(F.try_divide(F.var_pop(value) * F.count(value), F.count(F.lit(1))))
    facts = df.agg(F.struct(F.avg(value).alias("mean"), spread.alias("spread")).alias("facts")).scalar()
    distance = F.abs(F.coalesce(value, facts["mean"]) - facts["mean"])
    inside = F.try_divide(distance, facts["spread"]) < threshold
    # a constant column has no score: every row goes, or every row stays
    return F.coalesce(inside, F.lit(on_constant == "keep"))


def keep_within_deviation(
    df: DataFrame, column: str, threshold: float = 3.0, on_constant: str = "drop"
) -> DataFrame:
    return df.filter(deviation(df, column, threshold, on_constant))


def encode_sentiment(df: DataFrame) -> DataFrame:
    """negative 0, neutral 1, positive 2, anything else null."""
    s = F.col("sentiment")
    code = F.lit(None).cast("int")
    for name, value in LABEL_CODES.items():
        code = F.when(s == name, value).otherwise(code)
    return df.withColumn("sentiment_label", code)

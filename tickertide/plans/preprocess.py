"""Preprocessing job: raw posts to the processed table."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.operators import wrangle as W
from tickertide.settings import MIN_CLEAN_WORDS
from tickertide.sources.handover import materialise


@dataclass
class Processed:
    posts: DataFrame
    accounting: DataFrame


def preprocess(
    raw: DataFrame, lemmas: DataFrame | None = None, min_words: int = MIN_CLEAN_WORDS,
    method: str = "exact", on_constant: str = "drop", stopwords: list[str] | None = None,
) -> Processed:
    """Drop nulls and copies, clean, derive columns, drop short texts and outliers, encode.

    Cleaning runs once: its result is written, and the three outlier passes, each on the
    survivors of the one before, read single columns of the written table.
    """
    words = {} if stopwords is None else {"stopwords": stopwords}
    distinct = W.drop_copies(W.drop_missing(raw), copies="_copies")
    derived = W.add_derived_columns(W.add_full_clean(distinct, lemmas, **words))
    cleaned = materialise(derived, "cleaned")

    long_enough = W.keep_long_texts(cleaned, min_words)
    by_score = W.keep_within_fence(long_enough, "score", method=method)
    by_comments = W.keep_within_fence(by_score, "num_comments", method=method)
    kept = W.keep_within_deviation(by_comments, "text_length", 3.0, on_constant)

    survivors = [
        ("missing", cleaned.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("n"))),
        ("copies", _rows(cleaned)),
        ("short", _rows(long_enough)),
        ("score_fence", _rows(by_score)),
        ("comment_fence", _rows(by_comments)),
        ("length_deviation", _rows(kept)),
    ]
    return Processed(W.encode_sentiment(kept.drop("_copies")), _accounting(_rows(raw), survivors))


def _rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def _accounting(first: DataFrame, survivors: list[tuple[str, DataFrame]]) -> DataFrame:
    """(step, rows_in, rows_out), counted on the written table: right also after lost executors."""
    counts = first.select("n", *[table.scalar().alias(step) for step, table in survivors])
    names = ["n", *[step for step, _ in survivors]]
    rows = [
        F.struct(F.lit(step).alias("step"), F.col(before).alias("rows_in"), F.col(step).alias("rows_out"))
        for before, step in zip(names, names[1:])
    ]
    return counts.select(F.inline(F.array(*rows)))

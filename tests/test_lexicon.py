import math

import pytest
from pyspark.sql import functions as F

from tickertide.operators import lexicon as L

TERMS = [("good", 1.9), ("great", 3.1), ("bad", -2.5), (":)", 2.0)]


def score(spark, text, **options):
    lexicon = spark.createDataFrame(TERMS, "term string, valence double")
    posts = spark.createDataFrame([(1, text)], "id long, text string")
    row = L.score_sentiment(posts, lexicon, **options).first()
    return row["vader_compound"], row["sentiment"]


def compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


@pytest.mark.parametrize(
    "text, total",
    [
        ("it is good", 1.9),
        ("it is GOOD", 1.9 + 0.733),
        ("IT IS GOOD", 1.9),
        ("very good", 1.9 + 0.293),
        ("VERY good", 1.9 + 0.293 + 0.733),
        ("very bad", -2.5 - 0.293),
        ("slightly good", 1.9 - 0.293),
        ("very much good", 1.9 + 0.293 * 0.95),
        ("very much so-so good", 1.9 + 0.293 * 0.9),
        ("very aa bb cc good", 1.9),
        ("not good", 1.9 * -0.74),
        ("isn't aa good", 1.9 * -0.74),
        ("not very good", (1.9 + 0.293) * -0.74),
        ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
        ("good!", 1.9 + 0.292),
        ("good!!!!!!", 1.9 + 4 * 0.292),
        ("bad!", -2.5 - 0.292),
        ("good?", 1.9),
        ("good??", 1.9 + 0.36),
        ("good????", 1.9 + 0.96),
        ("good, \"great\"", 1.9 + 3.1),
        ("fine :)", 2.0),
    ],
)
def test_rules(spark, text, total):
    found = score(spark, text)[0]
    assert found == pytest.approx(compound(total), abs=1e-4)


def test_blank_is_neutral(spark):
    for text in (None, "", "  \n"):
        assert score(spark, text) == (0.0, "neutral")


def test_plain_sum(spark):
    assert score(spark, "not good", rules=False)[0] == compound(1.9)


def test_join_path_equals_lookup_path(spark):
    lexicon = spark.createDataFrame(TERMS, "term string, valence double")
    texts = ["not good", None, "VERY good but bad!!", "nothing", "good " * 40]
    posts = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    small = L.score_sentiment(posts, lexicon)
    joined = L.score_sentiment(posts, lexicon, max_rows=1)
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, joined.select(*small.columns).collect()), key=str)


def test_label_limits(spark):
    values = spark.createDataFrame([(v,) for v in (0.05, 0.04999, -0.05, -0.04999, 0.0, None)], "c double")
    labels = [r[0] for r in values.select(L.label_of(F.col("c"))).collect()]
    assert labels == ["positive", "neutral", "negative", "neutral", "neutral", "neutral"]


@pytest.mark.parametrize("marks", [1, 199, 500, 5000])
def test_any_number_of_marks_around_a_word(spark, marks):
    assert score(spark, "good" + "." * marks)[0] == compound(1.9)
    assert score(spark, "." * marks + "good")[0] == compound(1.9)
    assert score(spark, "not " + "," * marks + "good" + ";" * marks)[0] == compound(1.9 * -0.74)


@pytest.mark.parametrize(
    "text, total",
    [
        ("least good", 1.9 * -0.74), ("the least good", 1.9 * -0.74), ("at least good", 1.9), ("very least good", 1.9 + 0.293 * 0.95),
        ("never so good", (1.9 + 0.293) * 1.5), ("never was this good", 1.9 * 1.25), ("never this good", 1.9 * 1.5), ("never good", 1.9 * -0.74),
    ],
)
def test_least_and_never_so(spark, text, total):
    assert score(spark, text)[0] == compound(total)

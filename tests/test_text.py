from pyspark.sql import functions as F

from tickertide.functions import text as T
from tickertide.functions.tickers import extract_tickers
from tickertide.operators import wrangle as W
from tickertide.operators.lemmas import lemmatise, plural_lemmas


def one(spark, text, expression):
    return spark.createDataFrame([(text,)], "text string").select(expression(F.col("text"))).first()[0]


def test_clean_text(spark):
    cases = {
        None: "", "": "", "  \n ": "", "See HTTP://X.com now": "see http x com now", "www.a.b ok": "ok",
        'go <a href="x">here</a>': "go here", "R/stocks r/stocks u/me": "r stocks", "over/under": "ove",
        "a b": "a b", "été 🚀 50%": "t 50", "A  b\t\nC": "a b c",
    }
    for text, wanted in cases.items():
        assert one(spark, text, T.clean_text) == wanted, text


def test_step_order_matters(spark):
    assert one(spark, "http://a.b/<b>c", T.remove_markup) == " "
    assert one(spark, "<b r/x>y", T.remove_markup) == " y"


def test_tokens_split_contractions(spark):
    assert one(spark, "I cannot; gonna, WANNA!", T.clean_tokens) == ["i", "can", "not", "gon", "na", "wan", "na"]
    assert one(spark, "cannot be", T.tokenize) == ["can", "not", "be"]
    assert one(spark, "cannots", T.tokenize) == ["cannots"]
    assert one(spark, None, T.clean_tokens) == []


def test_keep_words_survive_the_stopwords(spark):
    text = "the market is not up but below a high"
    assert one(spark, text, lambda c: T.drop_stopwords(T.clean_tokens(c))) == ["market", "not", "below", "high"]


def test_word_counts(spark):
    for text, wanted in {None: 0, "": 0, " \n": 0, "a": 1, " a  b\n": 2, "a b": 2}.items():
        assert one(spark, text, T.word_count) == wanted


def test_ngrams(spark):
    assert one(spark, "a b c", lambda c: T.ngram_range(T.split_words(c), 1, 2)) == ["a", "b", "c", "a b", "b c"]
    assert one(spark, "a", lambda c: T.ngrams(T.split_words(c), 2)) == []
    assert one(spark, "", lambda c: T.ngrams(T.split_words(c), 2)) == []


def test_feature_words_without_accents(spark):
    assert one(spark, "Été is Ø a été-x2", T.feature_words) == ["ete", "is", "ete", "x2"]
    assert one(spark, "abc d ef", T.feature_words) == ["abc", "ef"]


def test_tickers(spark):
    cases = {
        "$AAPL is going up": ["AAPL"], "TSLA and AMZN look bullish": ["AMZN", "TSLA"],
        "I think the CEO is good": [], None: [], "GME GME ABCDEF A xTSLA éAAPL": ["GME"],
    }
    for text, wanted in cases.items():
        assert one(spark, text, extract_tickers) == wanted, text


def test_filter_after_cleaning_does_not_change_the_result(spark):
    posts = spark.createDataFrame([(1, "good profits today"), (2, "the")], "id long, text string")
    kept = W.add_full_clean(posts).filter("cleaned_text <> ''")
    assert [tuple(r) for r in kept.select("id", "cleaned_text").collect()] == [(1, "good profits today")]


def test_lemmas_by_lookup_and_by_join(spark):
    vocabulary = spark.createDataFrame(
        [(w,) for w in "stock stocks company companies loss losses woman women gas gass box boxes s".split()], "token string"
    )
    table = plural_lemmas(vocabulary)
    assert {r["token"]: r["lemma"] for r in table.collect()} == {
        "stocks": "stock", "companies": "company", "losses": "loss", "women": "woman", "boxes": "box",
    }
    posts = spark.createDataFrame([(1, ["stocks", "women", "up"]), (2, []), (3, ["stocks"] * 50)], "id long, tokens array<string>")
    wanted = [["stock", "woman", "up"], [], ["stock"] * 50]
    for rows in (100, 1):
        done = lemmatise(posts, F.col("tokens"), table, "out", max_rows=rows)
        assert [r["out"] for r in done.orderBy("id").collect()] == wanted


def test_noise_after_lemmas(spark):
    posts = spark.createDataFrame([(1, "posts removed nice trade")], "id long, text string")
    lemmas = spark.createDataFrame([("posts", "post")], "token string, lemma string")
    assert W.add_full_clean(posts, lemmas).first()["cleaned_text"] == "nice trade"
    assert W.add_full_clean(posts, lemmas, noise=False).first()["cleaned_text"] == "post removed nice trade"

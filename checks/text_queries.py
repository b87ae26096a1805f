"""Checks of text cleaning, tickers, lexicon and lemmas."""

from pyspark.sql import functions as F

from checks.registry import check, rounded
from checks.views_sql import clean, quoted, tokens, with_views, words
from tickertide.functions import text as T
from tickertide.functions.tickers import extract_tickers, has_ticker, ticker_list
from tickertide.functions.wordlists import BOOST_DOWN, BOOST_UP, NEGATIONS, NOISE_WORDS, NOT_TICKERS, STOPWORDS
from tickertide.operators import ingest as I
from tickertide.operators import lexicon as L
from tickertide.operators import metrics as P
from tickertide.operators import wrangle as W
from tickertide.operators.lemmas import lemmatise, plural_lemmas
from tickertide.sources import sample_views as V


def _text_check(name, expression, sql):
    @check(name, with_views(f"SELECT id, {sql} AS out FROM noisy", "noisy"))
    def run(spark, folder):
        return V.noisy_posts(spark, folder).select("id", expression(F.col("text")).alias("out"))


_text_check("text_remove_urls", T.remove_urls, "regexp_replace(text, 'http\\S+|www\\.\\S+', ' ', 'g')")
_text_check("text_remove_tags", T.remove_tags, "regexp_replace(text, '<[^>]+>', ' ', 'g')")
# \w of the comparison engine knows ASCII only: both sides see ASCII text
_text_check(
    "text_remove_references", lambda c: T.remove_references(F.regexp_replace(c, r"[^\x00-\x7F]", "x")),
    "regexp_replace(regexp_replace(regexp_replace(text, '[^\\x00-\\x7F]', 'x', 'g'), 'r/\\w+', ' ', 'g'), 'u/\\w+', ' ', 'g')",
)
_text_check("text_lower", F.lower, "lower(text)")
_text_check("text_plain_characters", T.keep_plain_characters, "regexp_replace(text, '[^a-zA-Z0-9\\s]', ' ', 'g')")
_text_check("text_collapse_space", T.collapse_space, "trim(regexp_replace(text, '\\s+', ' ', 'g'))")
_text_check("text_clean", T.clean_text, clean("text"))


@check("text_page_tags", "SELECT page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS out FROM pages")
def page_tags(spark, folder):
    return V.table(spark, folder, "pages").select("page_id", T.remove_tags("html").alias("out"))


@check("text_tokens", with_views(f"SELECT id, array_to_string({tokens(clean('text'))}, '|') AS out FROM noisy", "noisy"))
def token_lists(spark, folder):
    return V.noisy_posts(spark, folder).select("id", F.array_join(T.clean_tokens("text"), "|").alias("out"))


@check(
    "text_drop_stopwords",
    with_views(
        f"SELECT id, array_to_string(list_filter({tokens(clean('text'))}, "
        f"lambda t: length(t) > 2 AND t NOT IN ({quoted(STOPWORDS)})), ' ') AS out FROM noisy", "noisy",
    ),
)
def without_stopwords(spark, folder):
    return V.noisy_posts(spark, folder).select("id", T.join_tokens(T.drop_stopwords(T.clean_tokens("text"))).alias("out"))


_LEMMATISED = with_views(
    "SELECT id, string_agg(token, ' ' ORDER BY pos) AS out FROM lemma_tokens GROUP BY id", "lemma_tokens"
)


@check("text_lemmatise", _LEMMATISED)
def lemmatised(spark, folder):
    found = W.add_full_clean(_labelled(spark, folder), V.lemmas(spark), noise=False, out="out")
    return found.filter("out <> ''").select("id", "out")


@check("text_lemmatise_by_join", _LEMMATISED)
def lemmatised_by_join(spark, folder):
    """The path for a lemma table beyond the lookup size."""
    tokens = T.drop_stopwords(T.clean_tokens("text"))
    found = lemmatise(_labelled(spark, folder), tokens, V.lemmas(spark), "tokens", max_rows=1)
    return found.select("id", T.join_tokens("tokens").alias("out")).filter("out <> ''")


@check("text_full_clean", with_views("SELECT id, cleaned_text FROM cleaned", "cleaned"))
def full_clean(spark, folder):
    return W.add_full_clean(_labelled(spark, folder), V.lemmas(spark)).select("id", "cleaned_text")


@check(
    "text_drop_noise",
    with_views(
        f"SELECT id, array_to_string(list_filter({tokens(clean('text'))}, "
        f"lambda t: length(t) > 2 AND t NOT IN ({quoted(NOISE_WORDS)})), ' ') AS out FROM noisy", "noisy",
    ),
)
def without_noise(spark, folder):
    return V.noisy_posts(spark, folder).select("id", T.join_tokens(T.drop_noise(T.clean_tokens("text"))).alias("out"))


@check(
    "lemma_rule_table",
    with_views(
        f"""
SELECT token, arg_min(lemma, length(lemma)) AS lemma FROM (
  SELECT DISTINCT token, left(token, length(token) - length(e)) || r AS lemma FROM vocab,
    (VALUES ('ses', 's'), ('xes', 'x'), ('zes', 'z'), ('ches', 'ch'), ('shes', 'sh'), ('ves', 'f'), ('ies', 'y'),
            ('men', 'man'), ('s', '')) t(e, r)
  WHERE ends_with(token, e) AND length(token) > length(e) + 1 AND NOT (e = 's' AND ends_with(token, 'ss')))
WHERE lemma IN (SELECT token FROM vocab) GROUP BY token""".replace(
            "vocab", f"(SELECT DISTINCT unnest({tokens(clean('text'))}) AS token FROM posts)"
        ), "posts",
    ),
)
def lemma_rules(spark, folder):
    tokens = V.posts(spark, folder).select(F.explode(T.clean_tokens("text")).alias("token"))
    return plural_lemmas(tokens.distinct())


def _labelled(spark, folder):
    return W.drop_copies(W.drop_missing(V.posts(spark, folder)))


_ASCII = "regexp_replace(text, '[^\\x00-\\x7F]', 'x', 'g')"
TICKERS_SQL = (
    f"list_sort(list_distinct(list_filter(regexp_extract_all({_ASCII}, '\\b[A-Z]{{1,5}}\\b'), "
    f"lambda t: length(t) >= 2 AND t NOT IN ({quoted(NOT_TICKERS)}))))"
)


@check(
    "tickers_of_posts",
    with_views(f"SELECT id, array_to_string(t, ',') AS tickers, len(t) > 0 AS has_ticker FROM (SELECT id, {TICKERS_SQL} AS t FROM noisy)", "noisy"),
)
def tickers_of_posts(spark, folder):
    found = V.noisy_posts(spark, folder).select("id", extract_tickers("text").alias("t"))
    return found.select("id", ticker_list("t").alias("tickers"), has_ticker("t").alias("has_ticker"))


@check("tickers_distinct", with_views(f"SELECT count(DISTINCT t) AS unique_tickers FROM (SELECT unnest({TICKERS_SQL}) AS t FROM noisy)", "noisy"))
def tickers_distinct(spark, folder):
    return I.distinct_tickers(I.add_tickers(V.noisy_posts(spark, folder)))


@check(
    "metric_tickers_total",
    with_views(f"SELECT subreddit, CAST(coalesce(sum(len(t)), 0) AS BIGINT) AS total FROM (SELECT subreddit, {TICKERS_SQL} AS t FROM noisy) GROUP BY subreddit", "noisy"),
)
def tickers_total(spark, folder):
    """The counter grows by the number of tickers of each post."""
    posts = V.noisy_posts(spark, folder).select("subreddit", F.size(extract_tickers("text")).alias("n"), F.lit("post_scraped").alias("kind"))
    return P.summed_totals(posts, "post_scraped", ["subreddit"], "n")


@check(
    "tickers_per_community",
    with_views(f"SELECT subreddit, count(*) AS mentions FROM (SELECT subreddit, unnest({TICKERS_SQL}) AS t FROM noisy) GROUP BY subreddit", "noisy"),
)
def tickers_per_community(spark, folder):
    return I.ticker_mentions(I.add_tickers(V.noisy_posts(spark, folder)))


# words as the job sees them: outer punctuation off, more than one character
_BARE = (
    "regexp_replace(regexp_replace(w, '^[!-/:-@\\[-`{-~]+(\\w\\w)', '\\1'), '(\\w\\w)[!-/:-@\\[-`{-~]+$', '\\1')"
)
_VALENCES = f"""
SELECT id, sum(valence) AS s FROM (
  SELECT id, lower({_BARE}) AS term FROM (SELECT id, unnest({words(_ASCII.replace("'x'", "'é'").replace('[^\\x00-\\x7F]', 'é'))}) AS w FROM posts)
) JOIN lexicon_table USING (term) GROUP BY id"""


@check(
    "sentiment_plain_sum",
    with_views(
        f"""
SELECT id, round(c, 4) AS vader_compound,
       CASE WHEN round(c, 4) >= 0.05 THEN 'positive' WHEN round(c, 4) <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment
FROM (SELECT p.id, coalesce(s / sqrt(s * s + 15), 0) AS c FROM posts p LEFT JOIN ({_VALENCES}) v USING (id))""",
        "posts", "lexicon_table",
    ),
)
def sentiment_plain_sum(spark, folder):
    posts = V.posts(spark, folder).drop("sentiment")
    return L.score_sentiment(posts, V.lexicon(spark), rules=False).select("id", "vader_compound", "sentiment")


_WORD_CHARACTER = "[\\p{L}\\p{M}\\p{Nd}\\p{Nl}\\p{Pc}]"
_MARKS = "[!-/:-@\\[-`{-~]+"
_BARE = f"regexp_replace(regexp_replace(w, '({_WORD_CHARACTER}{{2}}){_MARKS}$', '\\1'), '^{_MARKS}({_WORD_CHARACTER}{{2}})', '\\1')"


def _looked_back(score: str, back: int) -> str:
    """The score after the word `back` places before: boosters push it, negations turn it."""
    pushed = f"({score} + CASE WHEN boost{back} <> 0 THEN CASE WHEN {score} < 0 THEN -1 ELSE 1 END * (boost{back} + CASE WHEN mixed AND capital{back} THEN 0.733::DOUBLE ELSE 0 END) ELSE 0 END * {L.DAMPING[back]}::DOUBLE)"
    never = {1: "false", 2: "lower1 IN ('so', 'this')", 3: "(lower2 IN ('so', 'this') OR lower1 IN ('so', 'this'))"}[back]
    turned = f"CASE WHEN lower{back} = 'never' AND {never} THEN {pushed} * {L.NEVER_SO.get(back, 1)}::DOUBLE WHEN negates{back} THEN {pushed} * -0.74::DOUBLE ELSE {pushed} END"
    return f"CASE WHEN lower{back} IS NOT NULL AND valence{back} IS NULL THEN {turned} ELSE {score} END"


def rules_sql(source: str, lexicon: str = "lexicon_table") -> str:
    """(id, vader_compound) of a view with id and text, by the published rules as steps over a table of words."""
    back = ", ".join(f"lag({c}, {k}) OVER place AS {c}{k}" for k in (1, 2, 3) for c in ("lower", "boost", "negates", "capital", "valence"))
    return f"""
SELECT t.id, CASE WHEN trim(t.text, ' ' || chr(10) || chr(9) || chr(13)) = '' THEN 0 ELSE round(coalesce(x / sqrt(x * x + 15), 0), 4) + 0 END AS vader_compound
FROM {source} t LEFT JOIN (
  SELECT id, total + sign(total) * marks AS x FROM (
    SELECT id, any_value(marks) AS marks, sum(CASE WHEN pos < but THEN 0.5::DOUBLE WHEN pos > but THEN 1.5::DOUBLE ELSE 1 END * CASE WHEN boost <> 0 THEN 0 ELSE score END) AS total
    FROM (
      SELECT *, CASE WHEN lower1 = 'least' AND valence1 IS NULL AND NOT coalesce(lower2 IN ('at', 'very'), false) THEN s3 * -0.74::DOUBLE ELSE s3 END AS score
      FROM (SELECT *, {_looked_back('s2', 3)} AS s3
      FROM (SELECT *, {_looked_back('s1', 2)} AS s2
      FROM (SELECT *, {_looked_back('s0', 1)} AS s1
      FROM (SELECT *, valence + CASE WHEN mixed AND capital THEN sign(valence) * 0.733::DOUBLE ELSE 0 END AS s0, {back}
      FROM (
        SELECT k.*, v.valence, bool_or(capital) OVER d AND bool_or(NOT capital) OVER d AS mixed, min(CASE WHEN lower = 'but' THEN pos END) OVER d AS but
        FROM (
          SELECT id, marks, pos, word, lower(word) AS lower, lower(word) <> word AND upper(word) = word AS capital,
                 CASE WHEN lower(word) IN ({quoted(BOOST_UP)}) THEN 0.293::DOUBLE WHEN lower(word) IN ({quoted(BOOST_DOWN)}) THEN -0.293::DOUBLE ELSE 0 END AS boost,
                 lower(word) IN ({quoted(NEGATIONS)}) OR contains(lower(word), 'n''t') AS negates
          FROM (
            SELECT id, marks, unnest(b) AS word, generate_subscripts(b, 1) AS pos FROM (
              SELECT id, list_filter(list_transform(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> ''), lambda w: {_BARE}), lambda w: length(w) > 1) AS b,
                     least(length(text) - length(replace(text, '!', '')), 4) * 0.292::DOUBLE
                     + CASE WHEN length(text) - length(replace(text, '?', '')) > 3 THEN 0.96::DOUBLE WHEN length(text) - length(replace(text, '?', '')) > 1
                            THEN (length(text) - length(replace(text, '?', ''))) * 0.18::DOUBLE ELSE 0 END AS marks
              FROM {source})))
        k LEFT JOIN {lexicon} v ON v.term = k.lower WINDOW d AS (PARTITION BY id))
      WINDOW place AS (PARTITION BY id ORDER BY pos))))))
    WHERE valence IS NOT NULL GROUP BY id)) r USING (id)"""


@check(
    "sentiment_with_rules",
    with_views(
        f"""
SELECT id, vader_compound, CASE WHEN vader_compound >= 0.05 THEN 'positive' WHEN vader_compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment
FROM ({rules_sql('noisy')})""",
        "noisy", "lexicon_table",
    ),
)
def sentiment_with_rules(spark, folder):
    posts = V.noisy_posts(spark, folder).drop("sentiment")
    return L.score_sentiment(posts, V.lexicon(spark)).select("id", "vader_compound", "sentiment")


@check(
    "sentiment_labels",
    """
SELECT event_id, CASE WHEN c >= 0.05 THEN 'positive' WHEN c <= -0.05 THEN 'negative' ELSE 'neutral' END AS label
FROM (SELECT event_id, (value - 50) / sqrt((value - 50) * (value - 50) + 15) AS c FROM events)""",
)
def sentiment_labels(spark, folder):
    compound = L.compound_score(F.col("value") - 50)
    return V.table(spark, folder, "events").select("event_id", L.label_of(compound).alias("label"))

"""Lexicon sentiment of raw text, by the published rules (Hutto & Gilbert, ICWSM 2014).

Everything happens inside a document's own row: words and valences are arrays, the rules are
higher-order functions over positions, so no token is shuffled.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.functions.text import _col, is_blank, let, split_words
from tickertide.functions.wordlists import BOOST_DOWN, BOOST_UP, NEGATIONS, SEED_LEXICON
from tickertide.operators.lookup import join_lookup, lookup_in_row
from tickertide.settings import LOOKUP_ROWS, NEGATIVE_TO, POSITIVE_FROM

# Fixed values of the published rules.
BOOST = 0.293
CAPITALS = 0.733
NEGATE = -0.74
NEVER_SO = {2: 1.5, 3: 1.25}
DAMPING = {1: 1.0, 2: 0.95, 3: 0.9}
BUT_BEFORE, BUT_AFTER = 0.5, 1.5
EXCLAMATION, EXCLAMATION_MAX = 0.292, 4
QUESTION, QUESTION_MAX = 0.18, 0.96
NORMALISER = 15.0

# The class comes first, so that the scan stops only at punctuation.
MARK = r"[!-/:-@\[-`{-~]"
OUTER_PUNCTUATION = (
    rf"(?U){MARK}(?<=\w\w{MARK}){MARK}*(?!\S)|{MARK}(?<=(?:\s|^){MARK}){MARK}*(?=\w\w)"
)


def seed_lexicon(spark) -> DataFrame:
    return spark.createDataFrame(SEED_LEXICON, "term string, valence double")


def sentiment_words(text) -> Column:
    """White-space words without outer punctuation; marks such as :) or :D stay as they are."""
    bare = F.regexp_replace(F.coalesce(_col(text), F.lit("")), OUTER_PUNCTUATION, "")
    return F.filter(split_words(bare), lambda w: F.length(w) > 1)


def compound_score(total) -> Column:
    total = _col(total)
    return F.least(F.greatest(total / F.sqrt(total * total + NORMALISER), F.lit(-1.0)), F.lit(1.0))


def label_of(compound) -> Column:
    """positive from 0.05, negative down to -0.05, else neutral (also for null)."""
    compound = _col(compound)
    return (
        F.when(compound >= POSITIVE_FROM, "positive")
        .when(compound <= NEGATIVE_TO, "negative")
        .otherwise("neutral")
    )


def _count_of(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def punctuation_emphasis(text) -> Column:
    text = _col(text)
    exclamations = F.least(_count_of(text, "!"), F.lit(EXCLAMATION_MAX)) * EXCLAMATION
    asked = _count_of(text, "?")
    questions = F.when(asked > 3, QUESTION_MAX).when(asked > 1, asked * QUESTION).otherwise(0.0)
    return exclamations + questions


def plain_valence_sum(valences) -> Column:
    """Sum of the matched valences without any rule."""
    known = F.filter(_col(valences), lambda v: v.isNotNull())
    return F.aggregate(known, F.lit(0.0), lambda total, v: total + v)


def _is_capital(word, lower) -> Column:
    return (lower != word) & (F.upper(word) == word)


def _boost(lower) -> Column:
    return F.when(lower.isin(*BOOST_UP), BOOST).when(lower.isin(*BOOST_DOWN), -BOOST).otherwise(0.0)


def _position_score(words: Column, lowers: Column, valences: Column, mixed: Column, at: Column) -> Column:
    """Valence at one position after capitals, boosters and negations in the 3 words before it."""
    own, own_lower, valence = F.get(words, at), F.get(lowers, at), F.get(valences, at)
    shout = F.when(mixed & _is_capital(own, own_lower), F.signum(valence) * CAPITALS).otherwise(0.0)
    damping = F.create_map(*[F.lit(x) for pair in DAMPING.items() for x in pair])

    def intense(back):
        return F.coalesce(F.get(lowers, at - back).isin("so", "this"), F.lit(False))

    def apply(score, back):
        lower = F.get(lowers, at - back)
        boost = _boost(lower)
        louder = F.when(mixed & _is_capital(F.get(words, at - back), lower), CAPITALS).otherwise(0.0)
        # a booster pushes away from zero; written in capitals it pushes further
        push = F.when(boost != 0, F.when(score < 0, -1.0).otherwise(1.0) * (boost + louder)).otherwise(0.0)
        pushed = score + push * F.element_at(damping, back)
        negates = lower.isin(*NEGATIONS) | lower.contains("n't")
        # "never so" and "never this" strengthen
        follows = F.when(back == 2, intense(1)).when(back == 3, intense(2) | intense(1))
        stronger = F.when(back == 2, NEVER_SO[2]).otherwise(NEVER_SO[3])
        turned = F.when((lower == "never") & follows, pushed * stronger).when(negates, pushed * NEGATE).otherwise(pushed)
        return F.when((at >= back) & F.get(valences, at - back).isNull(), turned).otherwise(score)

    distances = F.array(*[F.lit(d) for d in DAMPING])
    scored = F.aggregate(distances, valence + shout, apply)
    # "least" turns the word after it, but for "at least" and "very least"
    least = (at > 0) & (F.get(lowers, at - 1) == "least") & F.get(valences, at - 1).isNull()
    softened = (at > 1) & F.get(lowers, at - 2).isin("at", "very")
    scored = let(scored, lambda s: F.when(F.coalesce(least & ~softened, F.lit(False)), s * NEGATE).otherwise(s))
    return F.when(_boost(own_lower) != 0, 0.0).otherwise(scored)


def _rule_sum(words: Column, lowers: Column, valences: Column) -> Column:
    """Sum of the adjusted valences; "but" weakens what precedes it and strengthens the rest."""
    pairs = F.arrays_zip(words.alias("word"), lowers.alias("lower"))
    some_capital = F.exists(pairs, lambda p: _is_capital(p["word"], p["lower"]))
    some_other = F.exists(pairs, lambda p: ~_is_capital(p["word"], p["lower"]))
    facts = F.struct(
        (some_capital & some_other).alias("mixed"),
        (F.array_position(lowers, "but").cast("int") - 1).alias("but"),
    )
    positions = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda i: F.get(valences, i).isNotNull(),
    )

    def total(fact):
        but = fact["but"]

        def add(so_far, i):
            weight = (
                F.when((but >= 0) & (i < but), BUT_BEFORE)
                .when((but >= 0) & (i > but), BUT_AFTER)
                .otherwise(1.0)
            )
            return so_far + weight * _position_score(words, lowers, valences, fact["mixed"], i)

        return F.aggregate(positions, F.lit(0.0), add)

    return let(facts, total)


def score_sentiment(
    df: DataFrame, lexicon: DataFrame, id_column: str = "id", text: str = "text", rules: bool = True,
    max_rows: int = LOOKUP_ROWS,
) -> DataFrame:
    """Add vader_compound (4 decimals) and sentiment; blank text is neutral with score 0.

    `lexicon` is any (term, valence) table. rules=False sums the valences only.
    """
    words = sentiment_words(text)
    find = lookup_in_row(lexicon, "term", "valence", max_rows)
    if find is None:
        df = join_lookup(df, id_column, F.transform(words, F.lower), lexicon, "term", "valence", "_valences")
        find = lambda _: F.col("_valences")

    def total(w, lowers):
        return let(find(lowers), lambda v: _rule_sum(w, lowers, v) if rules else plain_valence_sum(v))

    found = let(words, lambda w: let(F.transform(w, F.lower), lambda lowers: total(w, lowers)))
    if rules:
        found = let(found, lambda x: x + F.signum(x) * punctuation_emphasis(text))
    # the analyzer rounds its score, and the label is taken from what it returns
    compound = F.when(is_blank(text), 0.0).otherwise(F.round(let(found, compound_score), 4))
    scored = df.withColumn("vader_compound", compound).drop("_valences")
    return scored.withColumn("sentiment", label_of("vader_compound"))

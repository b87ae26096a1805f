"""Lemmas from a (token, lemma) table, and a rule that builds one from the corpus vocabulary."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.functions.text import let
from tickertide.operators.lookup import join_lookup, lookup_in_row
from tickertide.settings import LOOKUP_ROWS

# Noun endings and what replaces them, tried in this order.
NOUN_ENDINGS = [
    ("ses", "s"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
    ("ves", "f"), ("ies", "y"), ("men", "man"), ("s", ""),
]


def plural_lemmas(vocabulary: DataFrame, word: str = "token") -> DataFrame:
    """(token, lemma) for regular plurals whose base occurs in the vocabulary (one row per word).

    The base found by the shortest candidate wins, as for a dictionary lookup.
    """
    w = F.col(word)
    bases = []
    for ending, replacement in NOUN_ENDINGS:
        base = F.concat(F.expr(f"left({word}, length({word}) - {len(ending)})"), F.lit(replacement))
        fits = w.endswith(ending) & (F.length(w) > len(ending) + 1)
        if ending == "s":
            fits &= ~w.endswith("ss")
        bases.append(F.when(fits, base))
    candidates = vocabulary.select(
        w.alias("token"), F.explode(F.array_compact(F.array(*bases))).alias("lemma")
    )
    known = candidates.join(vocabulary.select(w.alias("lemma")), "lemma", "left_semi")
    # shortest first, then alphabetical
    best = known.groupBy("token").agg(F.min(F.struct(F.length("lemma").alias("n"), "lemma")).alias("b"))
    return best.select("token", F.col("b.lemma").alias("lemma"))


def _replaced(tokens, lemmas) -> Column:
    return F.zip_with(tokens, lemmas, lambda token, lemma: F.coalesce(lemma, token))


def lemmatise(
    df: DataFrame, tokens: Column, lemmas: DataFrame, out: str, id_column: str = "id", max_rows: int = LOOKUP_ROWS
) -> DataFrame:
    """Add `out`: the tokens with each replaced by its lemma; tokens without one pass through."""
    in_row = lookup_in_row(lemmas, "token", "lemma", max_rows)
    if in_row is not None:
        return df.withColumn(out, let(tokens, lambda t: _replaced(t, in_row(t))))
    joined = join_lookup(df, id_column, tokens, lemmas, "token", "lemma", "_lemmas")
    return joined.withColumn(out, _replaced(tokens, F.col("_lemmas"))).drop("_lemmas")

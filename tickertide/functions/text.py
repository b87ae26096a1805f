"""Text cleaning and tokens as native column expressions.

Java's \\s, \\S and \\w know ASCII only unless the pattern starts with (?U).
"""

import unicodedata
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickertide.functions.wordlists import NOISE_WORDS, SPLIT_CONTRACTIONS, STOPWORDS

SPACE = r"(?U)[\s\x1c-\x1f]+"
URL = r"(?U)http\S+|www\.\S+"
TAG = r"<[^>]+>"
COMMUNITY_REF = r"(?U)r/\w+"
USER_REF = r"(?U)u/\w+"
NOT_PLAIN = r"(?U)[^a-zA-Z0-9\s]"
WORD = r"(?U)\b\w\w+\b"
CONTRACTIONS = [a + b for a, b in SPLIT_CONTRACTIONS]
CONTRACTION_GAP = "|".join(rf"(?<=\b{a})(?={b}\b)" for a, b in SPLIT_CONTRACTIONS)
SPACE_CHARACTERS = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value, body) -> Column:
    """body(value) with `value` evaluated once, however often and wherever body uses it.

    A column used inside a lambda is not safe for that: when the optimizer pushes a filter below
    the projection, its expression is copied into the lambda and evaluated per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _contains_any(c: Column, parts: list[str]) -> Column:
    """Plain substring tests, far cheaper than a regular expression that rarely matches."""
    return reduce(or_, [c.contains(part) for part in parts])


def trim_space(c) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(_col(c), F.lit(SPACE_CHARACTERS))


def is_blank(c) -> Column:
    return F.coalesce(trim_space(c) == "", F.lit(True))


def remove_urls(c) -> Column:
    return F.regexp_replace(_col(c), URL, " ")


def remove_tags(c) -> Column:
    return F.regexp_replace(_col(c), TAG, " ")


def remove_references(c) -> Column:
    """Community references first, then user references; neither has a word boundary."""
    return F.regexp_replace(F.regexp_replace(_col(c), COMMUNITY_REF, " "), USER_REF, " ")


def keep_plain_characters(c) -> Column:
    return F.regexp_replace(_col(c), NOT_PLAIN, " ")


def collapse_space(c) -> Column:
    return F.trim(F.regexp_replace(_col(c), SPACE, " "))


def remove_markup(c) -> Column:
    """URLs, tags and references; text without any of their marks is passed through."""
    c = _col(c)
    marked = _contains_any(c, ["http", "www.", "<", "r/", "u/"])
    return F.when(marked, remove_references(remove_tags(remove_urls(c)))).otherwise(c)


def clean_text(c) -> Column:
    """URLs, tags, references, lower case, plain characters, white space, in this order."""
    # one pass for the last two steps: runs of other characters become one blank
    plain = F.trim(F.regexp_replace(F.lower(remove_markup(c)), "[^a-z0-9]+", " "))
    return F.coalesce(plain, F.lit(""))


def split_words(c) -> Column:
    """White-space words; no words for null or blank text."""
    return F.filter(F.split(F.coalesce(_col(c), F.lit("")), SPACE), lambda w: w != "")


def word_count(c) -> Column:
    return F.size(split_words(c))


def split_contractions(c) -> Column:
    """Insert the blank that the tokeniser puts into words such as cannot."""
    c = _col(c)
    return F.when(_contains_any(c, CONTRACTIONS), F.regexp_replace(c, CONTRACTION_GAP, " ")).otherwise(c)


def tokenize(c) -> Column:
    """Tokens of cleaned text."""
    return F.filter(F.split(split_contractions(F.coalesce(_col(c), F.lit(""))), " "), lambda w: w != "")


def clean_tokens(c) -> Column:
    """Tokens of clean_text(c), without building the cleaned string in between."""

    def tokens(lower):
        return F.filter(F.split(split_contractions(lower), "[^a-z0-9]+"), lambda w: w != "")

    return let(F.lower(remove_markup(F.coalesce(_col(c), F.lit("")))), tokens)


def drop_stopwords(tokens, stopwords=STOPWORDS, min_length=3) -> Column:
    # isin() over literals becomes a hash-set test
    return F.filter(
        _col(tokens), lambda t: (F.length(t) >= min_length) & ~t.isin(*stopwords)
    )


def drop_noise(tokens, noise=NOISE_WORDS, min_length=3) -> Column:
    return F.filter(_col(tokens), lambda t: (F.length(t) >= min_length) & ~t.isin(*noise))


def join_tokens(tokens) -> Column:
    return F.array_join(_col(tokens), " ")


def _ngrams(words: Column, n: int) -> Column:
    if n == 1:
        return words
    starts = F.sequence(F.lit(0), F.size(words) - n)
    grams = F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(n)]))
    return F.when(F.size(words) >= n, grams).otherwise(F.array().cast("array<string>"))


def ngram_range(words, low: int, high: int) -> Column:
    """All n-grams from `low` to `high` words, with repetitions."""
    return let(
        _col(words), lambda w: F.flatten(F.array(*[_ngrams(w, n) for n in range(low, high + 1)]))
    )


def ngrams(words, n: int) -> Column:
    return ngram_range(words, n, n)


def _accent_table() -> tuple[str, str]:
    """Accented letters whose decomposition is one ASCII letter plus marks."""
    source, target = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(
            ch for ch in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(ch)
        )
        if len(base) == 1 and base.isascii() and base != chr(code):
            source.append(chr(code))
            target.append(base)
    return "".join(source), "".join(target)


ACCENTED, UNACCENTED = _accent_table()


def strip_accents(c) -> Column:
    c = _col(c)
    plain = F.translate(F.regexp_replace(c, r"\p{Mn}+", ""), ACCENTED, UNACCENTED)
    return F.when(c.rlike(r"[^\x00-\x7F]"), plain).otherwise(c)


def feature_words(c) -> Column:
    """Words of at least two word characters, lower case, without accents."""

    def words(text):
        found = F.regexp_extract_all(strip_accents(F.lower(text)), F.lit(WORD), 0)
        # text that is clean already needs no pattern per word
        split = F.filter(F.split(text, " "), lambda w: F.length(w) >= 2)
        return F.when(text.rlike("[^a-z0-9 ]"), found).otherwise(split)

    return let(F.coalesce(_col(c), F.lit("")), words)

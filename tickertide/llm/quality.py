"""Quality rules: counts per text, and lines that many documents of a host share.

Lines are normalised (lower case, single blanks, runs of digits as 0) and hashed. Per host (the source column), the distinct
documents that hold a line are counted; exact copies of a text are one document. A line in more than `most_documents`
of them goes from all documents of the host, and a document that keeps less than `least_kept` of its words is
depleted and rejected. All of it is DataFrame functions.

Near-copies are distinct documents here, as telling them apart is another operator's task: where more than `most_documents` of
them share their lines on one host, these lines go.

Texts are cut into lines once; the lines are written (numbers only) and read for both steps. A line that fewer rows hold than the
limit is not looked at again. Joins on lines are salted, so that a line in a third of all documents is spread over tasks.

Nulls: a null text has no words and fails; a null source is a host of its own. Empty texts fail.
Repeated rows count once and share their verdict. Empty tables work. Columns of the input with the
names this makes are replaced.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.functions.text import let
from tickertide.llm.common import PLAIN_GAP, others, plain_words, text_key
from tickertide.sources.handover import materialise

MADE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_words", "removed_lines", "kept", "clean_text"]
SALTS = 16
WINDOW = 5


def _covered(positions: Column) -> Column:
    """Places in windows of five that start at these ascending positions."""
    last = F.size(positions) - 1
    steps = F.transform(positions, lambda p, k: F.when(k == last, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), F.get(positions, k + 1) - p)))
    return F.aggregate(steps, F.lit(0), lambda a, b: a + b)


def _repeated(grams: Column) -> Column:
    """Words in windows whose hash occurs twice or more."""

    def starts(sorted_pairs):
        def again(x, k):
            near = [F.get(sorted_pairs, k - 1)["h"], F.get(sorted_pairs, k + 1)["h"]]
            return F.coalesce(near[0] == x["h"], F.lit(False)) | F.coalesce(near[1] == x["h"], F.lit(False))

        return F.array_sort(F.transform(F.filter(sorted_pairs, again), lambda x: x["i"]))

    pairs = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(pairs, starts), _covered)


def _grams(words: Column) -> Column:
    """Hashes of the windows of five words."""
    places = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))


def n_repeat_words(words: Column) -> Column:
    """Of an array of words that is evaluated once (a lambda's variable)."""
    grams = _grams(words)
    # most texts repeat nothing: a set of the hashes shows that without sorting
    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(_repeated(g)))


def with_counts(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(plain_words(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n"), n_repeat_words(w).cast("long").alias("r")))
    out = docs.withColumn("_counts", counts).withColumn(
        "word_chars", F.length(F.regexp_replace(text, PLAIN_GAP, "")).cast("long")).withColumn(
        "n_symbols", (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long")).withColumn(
        "n_dup_lines", let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))).withColumn(
        "n_words", F.col("_counts.n")).withColumn("n_repeat_words", F.col("_counts.r")).drop("_counts")
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _host(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _salted(small: DataFrame) -> DataFrame:
    return small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def lines_of(docs: DataFrame) -> DataFrame:
    """One row per line with a word: host, doc_id, text (hash), place, line (hash), words, salt."""
    normal = lambda s: F.trim(F.regexp_replace(F.regexp_replace(F.lower(s), "[0-9]+", "0"), PLAIN_GAP, " "))
    parts = F.transform(F.split(F.col("text"), "\n"), lambda s, i: F.struct(
        i.alias("place"), F.xxhash64(normal(s)).alias("line"), F.size(plain_words(s)).alias("words")))
    full = F.filter(parts, lambda p: p["words"] > 0)
    rows = docs.filter(F.col("text").isNotNull()).select(
        _host(F.col("source")).alias("host"), "doc_id", text_key().alias("text"), F.inline(full))
    return rows.withColumn("salt", F.pmod(F.col("text"), F.lit(SALTS)).cast("int"))


def removed_lines(docs: DataFrame, most_documents: int = 50) -> DataFrame:
    """(host, doc_id, text hash, removed_words, removed_lines) of documents with lines above the limit."""
    lines = materialise(lines_of(docs), "quality-lines")
    often = lines.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > most_documents).drop("n")
    seen = lines.join(_salted(often), ["host", "line", "salt"])
    # copies of a text share its hash and its salt, so counts per salt add up
    holders = seen.groupBy("host", "line", "salt", "text").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count("*").alias("n"))
    boiler = holders.filter(F.col("n") > most_documents).drop("n")
    places = F.collect_set(F.struct("place", "words")).alias("places")
    hits = lines.join(_salted(boiler), ["host", "line", "salt"]).groupBy("host", "doc_id", "text").agg(places)
    words = F.aggregate("places", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    return hits.select("host", "doc_id", "text", words.alias("removed_words"), F.col("places.place").alias("removed_lines"))


def judge(docs: DataFrame, most_documents: int = 50, least_kept: float = 0.3, with_text: bool = True) -> DataFrame:
    """docs with the counts, removed_words, removed_lines, kept and (with_text) clean_text without boilerplate lines."""
    given = docs.select(*[F.col(f"`{c}`") for c in others(docs, MADE)])
    removed = removed_lines(given.select("doc_id", "source", "text"), most_documents).withColumnsRenamed({"doc_id": "_doc", "text": "_text", "host": "_of"})
    counted = with_counts(given).withColumns({"_key": text_key(), "_host": _host(F.col("source"))})
    if not with_text:
        counted = counted.drop("text")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_text")) & (F.col("_host") == F.col("_of"))
    out = counted.join(removed, same, "left").drop("_doc", "_text", "_of", "_key", "_host")
    gone = F.coalesce(F.col("removed_words"), F.lit(0).cast("long"))
    out = out.withColumn("removed_words", gone).withColumn(
        "kept", ~F.col("base_failed") & (F.col("n_words") - gone >= least_kept * F.col("n_words")))
    if with_text:
        stays = F.filter(F.split("text", "\n"), lambda s, i: ~F.array_contains(F.col("removed_lines"), i))
        out = out.withColumn("clean_text", F.when(F.col("removed_lines").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n")))
    return out

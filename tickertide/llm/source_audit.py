"""How far the sources of a language differ in their terms, with every text read once however often it occurs.

1. Duplicate-text collapse: identical texts of a language (by SHA-256) become one row with its number of copies in each
   source. Copies are counted and reduced to one text per task before anything is shuffled, so a text that makes up
   a third of the corpus costs one row per task.
2. Each text is cut into terms once. A task adds its term counts and document counts, times the copies, to tables of
   (lang, term, source) and hands them on when they reach ENTRIES entries.
3. A language keeps the terms in at least `least_documents` of its documents (V terms, N occurrences in a group). Every
   (lang, source) group and each lang give a kept term of count c p = 1 + floor(10^9 (c + 2) / (N + 2 V)), in whole numbers.
4. Sparse pair evaluation of f(p, q) = floor((p - q)^2 / (p + q)), summed over all kept terms. A term that a group lacks
   has the group's p0, so with the terms of a, of b, and of both:
       sum of f = sum_a f(p_a, p0_b) + sum_b f(p0_a, p_b) + (V - terms_a - terms_b) f(p0_a, p0_b)
                + sum_both [f(p_a, p_b) - f(p_a, p0_b) - f(p0_a, p_b) + f(p0_a, p0_b)]
   The first two sums go over the distinct counts of a group, the last over the distinct pairs of counts of two groups,
   which come from the terms' own rows: a term is one row with its sources, so no pairs of terms are joined.

Result: for each group, part `pair` (each other source of the lang; all) and part `term` (kept terms more frequent here
than in the lang; `top` of them), ranked by value, then item in UTF-8 order.

Nulls in text, lang and source count as ''. A group without terms and a lang without kept terms have pairs (value 0 where V
is 0). Repeated rows count as often as they occur. Empty tables give no rows. Extra columns are ignored.
"""

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickertide.llm.common import small_batches
from tickertide.sources.handover import materialise

#: Entries of a task's tables before they are handed on.
ENTRIES = 150_000
COUNTS = "lang string, term string, source string, n long, documents long"

#: Letters and everything beyond ASCII stay (A-Z as a-z), the rest parts terms.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def collapse(docs: DataFrame) -> DataFrame:
    """(lang, text, copies): one row per text of a language; copies holds its number in each source."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    given = docs.select(part("lang"), part("source"), part("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    per_source = given.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
    copies = per_source.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = given.select("lang", "digest", "text").dropDuplicates(["lang", "digest"])
    return texts.join(copies, ["lang", "digest"]).select("lang", "text", "copies")


def _rows(tables: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (counts, documents) in tables.items():
        terms = list(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array([source] * len(terms), pa.string()), pa.array([counts[t] for t in terms], pa.int64()),
                pa.array([documents[t] for t in terms], pa.int64()),
            ], names=["lang", "term", "source", "n", "documents"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        langs, texts, copies = (batch.column(k) for k in range(3))
        for lang, text, held in zip(langs.to_pylist(), texts.cast(pa.binary()).to_pylist(), copies.to_pylist()):
            terms = text.translate(_TERM).split()
            # one copy in one source, the usual case, is added without a loop over its terms
            once = len(held) == 1 and held[0]["n"] == 1
            found = None if once else Counter(terms)
            for copy in held:
                counts, documents = tables.setdefault((lang, copy["source"]), (Counter(), Counter()))
                size -= len(counts)
                if once:
                    counts.update(terms)
                    documents.update(set(terms))
                else:
                    for term, n in found.items():
                        counts[term] += n * copy["n"]
                        documents[term] += copy["n"]
                size += len(counts)
            if size >= ENTRIES:
                yield from _rows(tables)
                tables, size = {}, 0
    yield from _rows(tables)


def held_terms(docs: DataFrame, least_documents: int) -> DataFrame:
    """(lang, term, lang_n, held) of the kept terms; held has (source, n) of the sources with the term, by source.

    Tasks have added up their own counts, so a term arrives as a row per task and source at most; both sums follow one shuffle.
    """
    small_batches(docs.sparkSession, 4 << 20)
    parts = collapse(docs).mapInArrow(_count, COUNTS).repartition("lang", "term")
    summed = parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    terms = summed.groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("documents").alias("documents"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("held"))
    return terms.filter(F.col("documents") >= least_documents).drop("documents")


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), exact at any size."""
    above = F.lit(1_000_000_000).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return 1 + F.call_function("div", above.cast("decimal(38,0)"), (total + 2 * terms).cast("decimal(38,0)"))


def difference(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of whole numbers up to 10^9 + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    ranked = ranked if top is None else ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def pair_values(groups: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, a, b, value) for each two sources a < b of a language; groups: lang, source, total, terms, v, p0."""
    a, b = (groups.select("lang", F.col("source").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("total", "terms", "p0", "v")]) for x in "ab")
    p = {x: probability(F.col(f"n_{x}"), F.col(f"total_{x}"), F.col(f"v_{x}")) for x in "ab"}
    p0 = {x: F.col(f"p0_{x}") for x in "ab"}
    none = difference(p0["a"], p0["b"])

    lacking = (F.col("v_a") - F.col("terms_a") - F.col("terms_b")) * none
    neither = a.join(b, "lang").filter("a < b").select("lang", "a", "b", F.coalesce(lacking, F.lit(0)).alias("value"))

    # terms with equal counts give equal values: each combination of counts is worked out once
    counts = terms.select("lang", F.explode("held").alias("x")).groupBy("lang", F.col("x.source").alias("a"), F.col("x.n").alias("n_a"))
    one = counts.agg(F.count("*").alias("k")).join(a, ["lang", "a"]).join(b, "lang").filter("a <> b").select(
        "lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (F.col("k") * difference(p["a"], p0["b"])).alias("value"))

    sides = terms.filter(F.size("held") > 1).select("lang", "held", F.posexplode("held").alias("i", "x"))
    sides = sides.select("lang", "x", F.explode(F.slice("held", F.col("i") + 2, F.size("held"))).alias("y"))
    met = sides.groupBy("lang", *[F.col(f"{s}.{c}").alias(f"{n}{x}") for s, x in (("x", "a"), ("y", "b")) for c, n in (("source", ""), ("n", "n_"))])
    corrected = difference(p["a"], p["b"]) - difference(p["a"], p0["b"]) - difference(p0["a"], p["b"]) + none
    both = met.agg(F.count("*").alias("k")).join(a, ["lang", "a"]).join(b, ["lang", "b"]).select("lang", "a", "b", (F.col("k") * corrected).alias("value"))
    return neither.unionByName(one).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit_sources(docs: DataFrame, least_documents: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank), see above."""
    terms = materialise(held_terms(docs.select("lang", "source", "text"), least_documents), "audit-terms")
    each = terms.select("lang", "term", "lang_n", F.explode("held").alias("x")).select("lang", "term", "lang_n", "x.source", "x.n")

    totals = each.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    langs = terms.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("v"))
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    groups = docs.select(name("lang"), name("source")).distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["total", "terms", "lang_total", "v"])
    p0 = F.when(F.col("v") > 0, probability(F.lit(0), F.col("total"), F.col("v")))
    groups = materialise(groups.withColumn("p0", p0), "audit-groups")

    pairs = pair_values(groups, terms)
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = pairs.select("lang", sides.alias("side"), "value").select("lang", "side.source", "side.item", "value")

    p = probability(F.col("n"), F.col("total"), F.col("v"))
    q = probability(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    scored = each.join(groups.select("lang", "source", "total", "lang_total", "v"), ["lang", "source"]).withColumns({"p": p, "q": q})
    more = scored.filter("p > q").select("lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
    return _ranked(pairs, "pair").unionByName(_ranked(more, "term", top))

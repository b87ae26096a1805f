"""TF-IDF and scaled numeric features."""


from pyspark.ml.feature import CountVectorizerModel, VectorAssembler, VectorSizeHint
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.functions.text import feature_words, is_blank, let, ngram_range
from tickertide.functions.vectors import sparse_vector, stored_vector, vector_parts
from tickertide.operators.keyed import top_per_key
from tickertide.operators.ordered import hash_of, hash_order_cuts
from tickertide.operators.stats import existing
from tickertide.settings import (
    FOLDS, MAX_DOC_SHARE, MAX_TERMS, MIN_DOC_COUNT, NUMERIC_FEATURES, SEED, SENTIMENTS, TEST_SHARE,
)


def drop_blank_texts(df: DataFrame) -> DataFrame:
    return df.filter(~is_blank("cleaned_text"))


def _with_cuts(df: DataFrame, label: str, id_column: str, seed: int, shares: list[float]) -> DataFrame:
    # one row per label, sent to every task: joined by the label, the wide rows of one label would meet in one task
    cuts = hash_order_cuts(df, label, id_column, seed, shares)
    joined = df.join(F.broadcast(cuts), label, "left")
    return joined.withColumn("_hash", hash_of(id_column, seed)).select(*df.columns, "_hash", "cuts")


def stratified_split(
    df: DataFrame, label: str = "sentiment_label", id_column: str = "id",
    test_share: float = TEST_SHARE, seed: int = SEED,
) -> DataFrame:
    """Add split (train / test): per label the round(test_share * rows) smallest hashed ids are test.

    The shares are exact and the assignment does not depend on the partitioning.
    """
    placed = _with_cuts(df, label, id_column, seed, [test_share])
    test = F.coalesce(F.col("_hash") <= F.get("cuts", F.lit(0)), F.lit(False))
    return placed.withColumn("split", F.when(test, "test").otherwise("train")).drop("_hash", "cuts")


def stratified_folds(
    df: DataFrame, label: str = "sentiment_label", id_column: str = "id",
    folds: int = FOLDS, seed: int = SEED,
) -> DataFrame:
    """Add fold (0 .. folds - 1): each label's rows in hashed order, cut into equal parts."""
    placed = _with_cuts(df, label, id_column, seed, [i / folds for i in range(1, folds)])
    fold = F.size(F.filter("cuts", lambda c: F.coalesce(c < F.col("_hash"), F.lit(True))))
    return placed.withColumn("fold", fold).drop("_hash", "cuts")


def document_terms(text: str = "cleaned_text", low: int = 1, high: int = 2) -> Column:
    """Words and word pairs of a document, with repetitions."""
    return ngram_range(feature_words(text), low, high)


def term_counts(df: DataFrame, id_column: str = "id", text: str = "cleaned_text") -> DataFrame:
    """Term frequency per document."""
    terms = df.select(id_column, F.explode(document_terms(text)).alias("term"))
    return terms.groupBy(id_column, "term").agg(F.count(F.lit(1)).alias("tf"))


def fit_vocabulary(
    df: DataFrame, text: str = "cleaned_text", max_terms: int = MAX_TERMS,
    min_docs: int = MIN_DOC_COUNT, max_doc_share: float = MAX_DOC_SHARE,
) -> DataFrame:
    """(term, idx, tf, df, idf): document frequency in range, then the most frequent max_terms.

    One shuffle by term: every document sends its occurrences, the first of each term flagged,
    combined in each task. Ties go to the smaller term, idx is alphabetical.
    """
    documents = df.agg(F.count(F.lit(1)).alias("n")).scalar()

    def marks(terms):
        """Each occurrence, flagged where the term is new in its document."""
        return F.transform(
            terms,
            lambda t, i: F.struct(
                t.alias("term"), F.when((i == 0) | (F.get(terms, i - 1) != t), 1).otherwise(0).alias("new")
            ),
        )

    marked = df.select(F.inline(let(F.sort_array(document_terms(text)), marks)))
    counted = marked.groupBy("term").agg(F.count(F.lit(1)).alias("tf"), F.sum("new").alias("df"))
    counted = counted.withColumn("_n", documents)
    usable = counted.filter((F.col("df") >= min_docs) & (F.col("df") <= max_doc_share * F.col("_n")))
    kept = usable.orderBy(F.desc("tf"), "term").limit(max_terms)
    # at most max_terms rows
    alphabetical = Window.partitionBy().orderBy("term")
    return kept.select(
        "term", (F.row_number().over(alphabetical) - 1).alias("idx"), "tf", "df",
        smooth_idf(F.col("_n"), F.col("df")).alias("idf"),
    )


def smooth_idf(documents: Column, with_term: Column) -> Column:
    return F.log((documents + 1) / (with_term + 1)) + 1


class TermWeights:
    """A fitted vocabulary: turns documents into L2-normalised TF-IDF vectors, batch or stream.

    The vocabulary is bounded by max_terms, so it may live on the driver and in every task.
    """

    def __init__(self, terms: list[str], idf: list[float]):
        self.terms, self.idf = terms, idf

    @classmethod
    def from_table(cls, vocabulary: DataFrame, max_terms: int = MAX_TERMS) -> "TermWeights":
        rows = vocabulary.select("idx", "term", "idf").limit(max_terms + 1).collect()
        if len(rows) > max_terms:
            raise ValueError(f"the vocabulary exceeds {max_terms} terms")
        rows.sort()
        return cls([r["term"] for r in rows], [r["idf"] for r in rows])

    def add_weights(self, df: DataFrame, text: str = "cleaned_text") -> DataFrame:
        """Add _at ARRAY<INT> (ascending) and _weights ARRAY<DOUBLE>; unseen terms are dropped."""
        counter = CountVectorizerModel.from_vocabulary(self.terms or ["\u0000"], inputCol="_terms", outputCol="_tf")
        counted = counter.transform(df.withColumn("_terms", document_terms(text))).drop("_terms")
        # a constant array, parsed once
        idf = F.from_json(F.lit(str(self.idf or [0.0])), "array<double>")

        def weigh(tf):
            raw = F.zip_with(tf["indices"], tf["values"], lambda i, n: (F.log(n) + 1) * F.get(idf, i))
            return let(raw, scale)

        def scale(raw):
            squares = F.aggregate(raw, F.lit(0.0), lambda total, w: total + w * w)
            return let(F.sqrt(squares), lambda norm: F.transform(raw, lambda w: w / norm))

        stored = vector_parts("_tf")
        return counted.withColumns({"_at": stored["indices"], "_weights": let(stored, weigh)}).drop("_tf")

    def add_vector(self, df: DataFrame, text: str = "cleaned_text", out: str = "tfidf") -> DataFrame:
        weighted = self.add_weights(df, text)
        size = max(1, len(self.terms))
        built = weighted.withColumn(out, sparse_vector(size, F.col("_at"), F.col("_weights")))
        # the size as metadata: the assembler then needs no look at the data, also on a stream
        hint = VectorSizeHint(inputCol=out, size=size, handleInvalid="optimistic")
        return hint.transform(built.drop("_at", "_weights"))

    def add_stored(self, df: DataFrame, text: str = "cleaned_text", out: str = "tfidf") -> DataFrame:
        """The vector in its stored form, for a table that is written next."""
        weighted = self.add_weights(df, text)
        return weighted.withColumn(out, stored_vector(max(1, len(self.terms)), F.col("_at"), F.col("_weights"))).drop("_at", "_weights")

    def weights_table(self, df: DataFrame, columns: list[str], text: str = "cleaned_text") -> DataFrame:
        """Long form: the given columns, idx, weight."""
        pairs = F.arrays_zip(F.col("_at").alias("idx"), F.col("_weights").alias("weight"))
        return self.add_weights(df, text).select(*columns, F.inline(pairs).alias("idx", "weight"))

    def as_table(self, spark) -> DataFrame:
        rows = [(t, i, w) for i, (t, w) in enumerate(zip(self.terms, self.idf))]
        return spark.createDataFrame(rows, "term string, idx int, idf double")


def fit_scaler(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, low, high) over the wanted columns that exist; null counts as 0."""
    columns = existing(df, columns or NUMERIC_FEATURES)
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]
    row = df.select(*filled).agg(
        *[F.min(c).alias(f"{c}__low") for c in columns], *[F.max(c).alias(f"{c}__high") for c in columns]
    )
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"{c}__low").alias("low"), F.col(f"{c}__high").alias("high"))
        for i, c in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*rows)))


def apply_scaler(df: DataFrame, scaler: DataFrame, prefix: str = "scaled_") -> tuple[DataFrame, list[str]]:
    """Min-max scaled columns, not clipped; a constant column becomes the distance to its value."""
    names = []
    for fact in sorted(scaler.collect()):  # one row per numeric feature
        low, spread = fact["low"] or 0.0, (fact["high"] or 0.0) - (fact["low"] or 0.0)
        x = F.coalesce(F.col(fact["column"]).cast("double"), F.lit(0.0)) - F.lit(low)
        name = prefix + fact["column"]
        df = df.withColumn(name, x / F.lit(spread) if spread else x)
        names.append(name)
    return df, names


def combine(df: DataFrame, numeric: list[str], out: str = "features", tfidf: str = "tfidf") -> DataFrame:
    """TF-IDF block, then numeric block, in one sparse vector."""
    return VectorAssembler(inputCols=[tfidf, *numeric], outputCol=out).transform(df)


def combine_stored(stored: Column, numbers: list[Column]) -> Column:
    """TF-IDF block, then the numbers that are not 0, in one vector in stored form."""
    row = F.array(*[n.cast("double") for n in numbers])
    known = F.filter(F.sequence(F.lit(0), F.lit(len(numbers) - 1)), lambda i: F.get(row, i) != 0) if numbers else F.array().cast("array<int>")
    return stored_vector(
        stored["size"] + len(numbers), F.concat(stored["indices"], F.transform(known, lambda i: stored["size"] + i)),
        F.concat(stored["values"], F.transform(known, lambda i: F.get(row, i))),
    )


def top_terms(weights: DataFrame, vocabulary: DataFrame, documents: int | Column, k: int = 20) -> DataFrame:
    """Terms by mean weight over all documents, those without the term counting as 0."""
    summed = weights.groupBy("idx").agg((F.sum("weight") / documents).alias("mean_weight"))
    named = summed.join(F.broadcast(vocabulary.select("idx", "term")), "idx")  # at most max_terms rows
    return named.select("term", "mean_weight").orderBy(F.desc("mean_weight"), "term").limit(k)


def top_terms_by_sentiment(df: DataFrame, model: TermWeights, k: int = 15) -> DataFrame:
    """Terms by mean weight over all documents of each class."""
    labelled = df.filter(F.col("sentiment").isin(*SENTIMENTS))
    sizes = labelled.groupBy("sentiment").agg(F.count(F.lit(1)).alias("_documents"))
    summed = model.weights_table(labelled, ["sentiment"]).groupBy("sentiment", "idx").agg(F.sum("weight").alias("_sum"))
    # three sentiments; at most max_terms terms
    meant = summed.join(F.broadcast(sizes), "sentiment").join(F.broadcast(model.as_table(df.sparkSession)), "idx")
    meant = meant.select("sentiment", "term", (F.col("_sum") / F.col("_documents")).alias("mean_weight"))
    return top_per_key(meant, ["sentiment"], [F.desc("mean_weight"), F.col("term")], k)

"""First row, top rows and joins per key that hold when one key has a large share of the rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.sources.handover import materialise


def first_per_key(
    df: DataFrame, keys: list[str], order: list[str], copies: str | None = None
) -> DataFrame:
    """Keep the first row per key by ascending `order` (nulls first); `copies` names a row count.

    An aggregate, not a window: copies are combined before the shuffle, so a group of copies
    never meets in one task. Remaining columns break ties, so the result is the same for any
    partitioning.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[c for c in order if c not in keys], *rest)
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    picked = df.groupBy(*keys).agg(F.min(packed).alias("_first"), *counted)
    named = picked.select(*keys, "_first.*", *([copies] if copies else []))
    return named.select(*df.columns, *([copies] if copies else []))


def _has_places(df: DataFrame) -> bool:
    """Can each row be named by its file and its number in the file? Rows of one scan can, those of a join cannot."""
    hidden = df._jdf.queryExecution().analyzed().metadataOutput()
    kinds = [hidden.apply(i).dataType().simpleString() for i in range(hidden.size())]
    return len(kinds) == 1 and "row_index" in kinds[0]


def first_of_wide_rows(df: DataFrame, key: Column, order: list[str], copies: str | None = None) -> DataFrame:
    """Keep the first row per key by ascending `order` (nulls first), without moving wide rows to find it.

    Key, order and the place of a row (file and number in it) are written as a narrow table; only they are aggregated. Of groups of
    several rows, the others are then taken out of the table by their places. A table that is no scan of
    files is written first. Rows that agree in key and order are told apart by a hash of their columns, then by place.
    """
    table = df if _has_places(df) else materialise(df, "wide-rows")
    rest = [c for c, kind in table.dtypes if c not in order and "map<" not in kind]
    place = {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    narrow = table.select(key.alias("_key"), *order, F.xxhash64(*rest).alias("_content") if rest else F.lit(0).alias("_content"), *[v.alias(k) for k, v in place.items()])
    narrow = materialise(narrow, "row-places")
    found = narrow.groupBy("_key").agg(F.min(F.struct(*order, "_content", "_file", "_row")).alias("_first"), F.count(F.lit(1)).alias("_n"))
    groups = found.filter("_n > 1").select("_key", F.col("_first._file").alias("_first_file"), F.col("_first._row").alias("_first_row"), "_n")
    is_first = (F.col("_file") == F.col("_first_file")) & (F.col("_row") == F.col("_first_row"))
    # null keys are a group too
    marks = narrow.select("_key", "_file", "_row").join(groups.withColumnRenamed("_key", "_group"), F.col("_key").eqNullSafe(F.col("_group")))
    # written, so that its size is known before the wide table is read: few rows are broadcast and nothing else moves
    marks = materialise(marks.select("_file", "_row", is_first.alias("_stays"), "_n"), "row-marks")
    marked = table.withColumns(place).join(marks, ["_file", "_row"], "left").filter(F.coalesce("_stays", F.lit(True)))
    counted = [F.coalesce("_n", F.lit(1).cast("long")).alias(copies)] if copies else []
    return marked.select(*df.columns, *counted)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """Keep the first k rows per key; Spark limits each group per task before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") <= k).drop("_rank")


def hot_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys holding more than `share` of the non-null rows: fewer than 1 / share of them."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("n")).scalar()
    return counts.filter(F.col("_n") > total * share).select(key)


def join_on_skewed_key(
    many: DataFrame, one: DataFrame, key: str, how: str = "inner", share: float = 0.01
) -> DataFrame:
    """Join a table with hot keys to a table with one row per key (inner or left).

    Rows of hot keys meet a broadcast of at most 1 / share rows; the rest is an ordinary join.
    """
    # fewer than 1 / share keys can each exceed `share` of the rows, so these broadcasts are bounded
    hot = hot_keys(many, key, share)
    tagged = many.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    hot_rows = tagged.filter(F.col("_hot")).drop("_hot")
    other_rows = tagged.filter(F.col("_hot").isNull()).drop("_hot")
    hot_one = one.join(F.broadcast(hot), key, "left_semi")
    from_hot = hot_rows.join(F.broadcast(hot_one), key, how)
    return from_hot.unionByName(other_rows.join(one, key, how))

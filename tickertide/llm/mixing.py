"""Mixing sources to target weights.

Sizes are summed per source, targets follow from weights and caps, and each document is emitted
floor(rate) times plus one copy more with the rate's fraction as probability. The draw is a hash of
seed and doc_id, so reruns and lost tasks give the same mix.

Nulls: a null source is a source of its own, the last; a null text has size 0; a null doc_id is drawn
as the text "null". Repeated rows share one draw. Empty tables give empty mixes. Sources of size 0
get the target 0. Columns of the input with the names this makes are replaced.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.llm.common import PLAIN_WORD, others
from tickertide.sources.handover import materialise

MADE = ["size", "source_size", "target", "rate", "copies", "taken"]


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(PLAIN_WORD)), F.lit(0)).cast("long")


def source_targets(docs: DataFrame, weights=(3, 1, 2), share=1.5, most=2.0) -> DataFrame:
    """One row per source: source, source_size, target.

    Sources in code-point order, null last, take the weights in turn. They share `share` times all
    sizes; a target stops at `most` times its source's size and the excess is shared again by weight
    until none is above. The table is written: its rounds read only this short table.
    """
    spark = docs.sparkSession
    sums = docs.groupBy("source").agg(F.sum(size_of(F.col("text"))).alias("source_size"))
    # ranks without one task for all sources: ranges of names, then places within a range
    ranged = sums.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id())
    ranged = materialise(ranged, "mix-sources")
    parts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    # one row per range, a number set by spark.sql.shuffle.partitions
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1 + F.col("before")
    named = F.array(*[F.lit(int(w)) for w in weights])
    weighted = ranged.join(before, "part").select(
        "source", "source_size", F.get(named, (place % len(weights)).cast("int")).cast("long").alias("weight"))
    weighted = materialise(weighted, "mix-weights")

    cap = F.col("source_size") * F.lit(float(most))
    level, capped = 0.0, -1
    while True:
        above = (F.col("weight") * F.lit(level) > cap) if capped >= 0 else F.lit(False)
        row = weighted.agg(
            F.sum("source_size").alias("all"), F.count(F.when(above, 1)).alias("n"),
            F.sum(F.when(above, F.col("source_size"))).alias("full"), F.sum(F.when(~above, F.col("weight"))).alias("open"),
        ).first()
        if row["n"] == capped:
            break
        capped = row["n"]
        left = share * (row["all"] or 0) - most * (row["full"] or 0)
        level = left / row["open"] if row["open"] else 0.0
        share_of, rest = left, row["open"] or 1
    target = F.least(cap, F.col("weight") * F.lit(float(share_of)) / F.lit(float(rest)))
    return weighted.select("source", "source_size", target.alias("target"))


def draw(doc_id: Column, seed: str) -> Column:
    """A number from 0 (included) to 1 (not included), the same for the same seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mix_sources(docs: DataFrame, weights=(3, 1, 2), share=1.5, most=2.0, seed="mix") -> DataFrame:
    """docs with size, source_size, target, rate, copies and taken (words, repeats counted).

    The sources' table joins on source; Spark broadcasts it while its written size is small, and
    splits hot sources otherwise. The documents themselves are never shuffled for a small table.
    """
    targets = source_targets(docs, weights, share, most).withColumnsRenamed({"source": "_source"})
    given = docs.select(*[F.col(f"`{c}`") for c in others(docs, MADE)]).withColumn("size", size_of(F.col("text")))
    both = given.join(targets, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor("rate")
    more = draw(F.col("doc_id"), seed) < F.col("rate") - whole
    return both.withColumn("rate", rate).withColumn("copies", (whole + more.cast("long")).cast("long")).withColumn(
        "taken", F.col("size") * F.col("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """Each document as often as `copies` says, with the number of the copy from 1."""
    some = mixed.filter(F.col("copies") > 0)
    return some.select(*[F.col(f"`{c}`") for c in others(mixed, ["copy"])], F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))

"""Running totals, ranks and exact quantiles without gathering a group in one task."""

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickertide.functions.text import let
from tickertide.sources.handover import materialise


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _step(spark: SparkSession) -> int:
    """A group is cut into step * step ranges, about one for each shuffle partition; the result does not depend on it."""
    return max(2, math.ceil(math.sqrt(_partitions(spark))))


def _hash_digits(spark: SparkSession) -> int:
    """Hex digits that give many more prefixes than tasks; the result does not depend on them."""
    return max(2, math.ceil(math.log(16 * _partitions(spark), 16)))


def _cuts(order: str, sums: list[str], step: int) -> Column:
    """Ascending cuts between the ranges, and every step-th of them.

    The totals make this read the same columns as the running sums, so that Spark shuffles the
    input once and reuses it.
    """
    ranges = step * step
    shares = [i / ranges for i in range(1, ranges)]
    cuts = F.percentile_approx(order, shares, 10 * ranges)
    every = F.transform(F.sequence(F.lit(1), F.lit(step - 1)), lambda k: F.get(cuts, k * step - 1))
    totals = F.array(*[F.sum(s) for s in sums])
    return F.struct(cuts.alias("all"), every.alias("every"), totals.alias("totals"))


def _cuts_below(cuts: Column, value: Column, step: int) -> Column:
    """How many of the cuts are below the value: whole steps first, then inside one step."""

    def below(part):
        return F.size(F.filter(part, lambda c: c < value))

    def inside(k):
        return k * step + below(F.slice(cuts["all"], k * step + 1, F.lit(step)))

    # never null, so that no null test is pushed down to the single rows
    return F.coalesce(let(below(cuts["every"]), inside), F.lit(0))


def running_sums(df: DataFrame, keys: list[str], order: str, sums: list[str]) -> DataFrame:
    """Add running_<s> (inclusive, ascending `order`) to a table with one row per (keys, order).

    Each group is cut into ranges of `order`; totals per range give the start value of a range,
    so a task only sums within one range. The approximate cuts set the balance, not the result.
    Without keys there is one group. Any number of groups works: Spark chooses the joins from sizes.
    """
    step = _step(df.sparkSession)
    cuts = df.groupBy(*keys).agg(_cuts(order, sums, step).alias("_cuts"))
    if keys:
        ranged = df.join(cuts, keys)
    else:
        ranged = df.withColumn("_cuts", cuts.scalar())
    ranged = ranged.withColumn("_range", _cuts_below(F.col("_cuts"), F.col(order), step)).drop("_cuts")

    range_keys = [*keys, "_range"]
    totals = ranged.groupBy(*range_keys).agg(*[F.sum(s).alias(f"_total_{s}") for s in sums])
    # step * step rows per group
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *range_keys,
        *[F.coalesce(F.sum(f"_total_{s}").over(earlier), F.lit(0)).alias(f"_start_{s}") for s in sums],
    )
    within = Window.partitionBy(*range_keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged.join(starts, range_keys)
    return joined.select(
        *df.columns,
        *[(F.sum(s).over(within) + F.col(f"_start_{s}")).alias(f"running_{s}") for s in sums],
    )


def exact_quantiles(
    df: DataFrame, column: str, shares: list[float], keys: list[str] | None = None
) -> DataFrame:
    """Linear-interpolated quantiles as (keys, quantiles ARRAY<DOUBLE>), for any number of values.

    Values are counted before the shuffle, and the counts are written; the two order statistics next to
    each share are read off the running counts.
    """
    keys = keys or []
    values = df.filter(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("_v"))
    counted = materialise(values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    return quantiles_of_counts(counted, shares, keys)


def quantiles_of_counts(counted: DataFrame, shares: list[float], keys: list[str]) -> DataFrame:
    """The same from a table of counted values: (keys, _v, _n), one row per value; it is read several times."""
    ranked = running_sums(counted, keys, "_v", ["_n"])
    totals = counted.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    if keys:
        ranked = ranked.join(totals, keys)
    else:
        ranked = ranked.withColumn("_total", totals.scalar())

    last = F.col("running__n") - 1
    first = F.col("running__n") - F.col("_n")

    def holds(rank: Column) -> Column:
        return rank.between(first, last)

    picks = []
    for i, share in enumerate(shares):
        at = (F.col("_total") - 1) * F.lit(float(share))
        picks.append(F.max(F.when(holds(F.floor(at)), F.col("_v"))).alias(f"_lo{i}"))
        picks.append(F.max(F.when(holds(F.ceil(at)), F.col("_v"))).alias(f"_hi{i}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_part{i}"))
    picked = ranked.groupBy(*keys).agg(*picks)
    quantiles = F.array(
        *[
            F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}")
            for i in range(len(shares))
        ]
    )
    return picked.select(*keys, quantiles.alias("quantiles"))


def quantiles_per_key(
    df: DataFrame, column: str, shares: list[float], keys: list[str] | None = None,
    method: str = "exact",
) -> DataFrame:
    """Quantiles as (keys, quantiles): exact for any type and number of values, or approx, a bounded sketch."""
    if method == "exact":
        return exact_quantiles(df, column, shares, keys)
    if method != "approx":
        raise ValueError(f"unknown method {method!r}, choose exact or approx")
    probabilities = F.array(*[F.lit(float(s)) for s in shares])
    quantiles = F.percentile_approx(column, probabilities).cast("array<double>").alias("quantiles")
    return df.groupBy(*(keys or [])).agg(quantiles)


def hash_of(id_column: str, seed: int) -> Column:
    """A seeded order that depends on the id only, not on the partitioning."""
    return F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f"|{seed}")))


def hash_order_cuts(
    df: DataFrame, key: str, id_column: str, seed: int, shares: list[float]
) -> DataFrame:
    """Per key, the hashed id at rank round(share * rows), as (key, cuts ARRAY<STRING>).

    A cut is null where the rank is 0. Counts per hash prefix find the prefix of each rank, so
    only rows of those prefixes are ordered.
    """
    digits = _hash_digits(df.sparkSession)
    hashed = df.select(key, hash_of(id_column, seed).alias("_hash"))
    hashed = hashed.withColumn("_prefix", F.substring("_hash", 1, digits))
    per_prefix = hashed.groupBy(key, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    # at most 16 ** digits rows per key
    upto = Window.partitionBy(key).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(key)
    placed = per_prefix.select(
        key, "_prefix", "_n",
        F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(whole).alias("_total"),
    )
    ranks = F.transform(
        F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(s)).alias("s")) for i, s in enumerate(shares)]),
        lambda x: F.struct(x["i"].alias("cut"), F.round(x["s"] * F.col("_total")).cast("long").alias("rank")),
    )
    wanted = placed.select(key, "_prefix", "_n", "_upto", F.explode(ranks).alias("_r"))
    wanted = wanted.filter((F.col("_r.rank") <= F.col("_upto")) & (F.col("_r.rank") > F.col("_upto") - F.col("_n")))
    wanted = wanted.groupBy(key, "_prefix").agg(
        F.collect_list(
            F.struct(F.col("_r.cut").alias("cut"), (F.col("_r.rank") - F.col("_upto") + F.col("_n")).alias("rank"))
        ).alias("_wanted")
    )
    near = hashed.join(wanted, [key, "_prefix"])
    order = Window.partitionBy(key, "_prefix").orderBy("_hash")
    near = near.withColumn("_rank", F.row_number().over(order))
    hits = near.select(key, "_hash", "_rank", F.explode("_wanted").alias("_w"))
    hits = hits.filter(F.col("_w.rank") == F.col("_rank"))
    cuts = [F.max(F.when(F.col("_w.cut") == i, F.col("_hash"))) for i in range(len(shares))]
    return hits.groupBy(key).agg(F.array(*cuts).alias("cuts"))

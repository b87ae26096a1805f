"""Plan properties that matter at scale."""

from pyspark.sql import functions as F

from tickertide.operators import keyed as K
from tickertide.operators.wrangle import keep_within_fence
from tickertide.sources import files

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_rows_are_limited_before_the_shuffle(spark):
    table = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    found = plan(K.top_per_key(table, ["k"], [F.desc("id")], 3))
    # read bottom up: the first limit stands below the exchange
    assert found.count("WindowGroupLimit") == 2 and found.rindex("WindowGroupLimit") > found.index("Exchange")


def test_first_rows_are_combined_before_the_shuffle(spark):
    table = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    assert "partial_min" in plan(K.first_per_key(table, ["k"], ["id"]))


def test_texts_do_not_move_when_copies_are_dropped(spark, tmp_path, monkeypatch):
    from tickertide.operators import keyed, wrangle

    path = str(tmp_path / "posts")
    spark.range(100).select("id", F.concat(F.lit("text "), (F.col("id") % 60).cast("string")).alias("text"), F.current_timestamp().alias("created_at")).write.parquet(path)
    written = []
    monkeypatch.setattr(keyed, "materialise", lambda df, name, write=keyed.materialise: written.append((name, df.columns)) or write(df, name))
    kept = wrangle.drop_copies(spark.read.parquet(path))
    assert [w[0] for w in written] == ["row-places", "row-marks"] and not any("text" in w[1] for w in written)
    assert kept.count() == 60
    # only the marks move
    found = plan(kept)
    assert "BroadcastHashJoin" in found and "Exchange hashpartitioning" not in found


def test_rows_of_one_label_do_not_meet_in_one_task(spark):
    from tickertide.operators.features import stratified_folds, stratified_split

    table = spark.range(80).select("id", (F.col("id") % 2).cast("int").alias("sentiment_label"))
    # sent to every task whatever its estimated size, so the wide rows stay where they are
    for placed in (stratified_split(table), stratified_folds(table)):
        assert "strategy=broadcast" in placed._jdf.queryExecution().optimizedPlan().toString()


def test_counting_reads_no_column(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(5).select("id", F.lit("s").alias("subreddit"), F.lit("t").alias("text")).write.parquet(path)
    assert "ReadSchema: struct<>" in plan(files.count_raw(spark, path))


def test_bounds_are_a_subquery(spark):
    found = plan(keep_within_fence(spark.range(9), "id"))
    assert "Subquery" in found and "NestedLoopJoin" not in found and "CartesianProduct" not in found


def test_flagship_cleans_its_texts(spark):
    from pathlib import Path

    import pytest

    import __spark_entry__

    if not Path(__spark_entry__.SMALL).exists():
        pytest.skip("no test tables")
    assert "regexp_replace" in plan(__spark_entry__.entry(spark)).lower()


def test_quantiles_of_many_keys(spark):
    from tickertide.operators.ordered import quantiles_per_key

    values = spark.range(50_000).select((F.col("id") % 5000).alias("k"), (F.col("id") / 5000).cast("int").cast("decimal(9,2)").alias("v"))
    found = quantiles_per_key(values, "v", [0.25, 0.5], ["k"]).collect()
    assert len(found) == 5000 and {tuple(r["quantiles"]) for r in found} == {(2.25, 4.5)}

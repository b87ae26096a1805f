"""Records of CSV files across splits against Spark's own reader, which reads a file in one task."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickertide.sources import files
from tickertide.sources.csv_records import read_records

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("id", T.StringType()), ("text", T.StringType()), ("score", T.LongType()))])


@pytest.fixture
def small_splits(spark):
    """Splits of a few bytes, so that quoted cells cross them."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield of
    for k, v in old.items():
        spark.conf.set(k, v)


def write(path, rows, ending="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        table = csv.writer(out, lineterminator=ending)
        table.writerow(["id", "text", "score"])
        table.writerows(rows)


def random_rows(rng, n):
    parts = ["plain", "a,b", 'say "hi"', "line\nbreak", '"\n"', "\n\n\n", "é漢", "", " x ", 'q""q', "a\r\nb", ",\n,", "long " * 30, "\n" * 40]
    return [(f"i{k}", "".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))), rng.randrange(100)) for k in range(n)]


@pytest.mark.parametrize("size,ending", [(7, "\n"), (40, "\r\n"), (200, "\n"), (1 << 20, "\r\n")])
def test_rows_do_not_depend_on_splits(spark, tmp_path, small_splits, size, ending):
    rng, wanted = random.Random(size), []
    for k in range(3):
        rows = random_rows(rng, 40)
        write(tmp_path / f"part-{k}.csv", rows, ending)
        wanted += [(i, None if t in files.MISSING_CELLS else t, s) for i, t, s in rows]
    small_splits(size)
    found = files.read_raw_csv(spark, str(tmp_path), SCHEMA)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, wanted))
    one = spark.read.schema("id string, text string, score string").csv(str(tmp_path), header=True, multiLine=True, escape='"', lineSep="\n" if ending == "\n" else None)
    if ending == "\n":
        plain = one.select("id", F.when(~F.col("text").isin(*files.MISSING_CELLS), F.col("text")).alias("text"), F.col("score").cast("long").alias("score"))
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


def test_several_tasks_read_one_file(spark, tmp_path, small_splits):
    write(tmp_path / "one.csv", random_rows(random.Random(1), 200))
    small_splits(500)
    lines = read_records(spark, str(tmp_path))
    assert lines.count() == 201 and lines.filter("first").count() == 1
    assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 10


def test_cell_longer_than_blocks(spark, tmp_path, small_splits):
    long = "one line of many\n" * 50
    write(tmp_path / "a.csv", [("1", long, 1), ("2", "after", 2), ("3", long + '"', 3)])
    small_splits(64)
    found = {r["id"]: r["text"] for r in files.read_raw_csv(spark, str(tmp_path), SCHEMA).collect()}
    assert found == {"1": long, "2": "after", "3": long + '"'}


def test_headers_and_empty_files(spark, tmp_path):
    write(tmp_path / "a.csv", [])
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text('﻿id,text,score\n\n"1","x",\n2,y\n', encoding="utf-8")
    found = sorted(map(tuple, files.read_raw_csv(spark, str(tmp_path), SCHEMA).collect()))
    assert found == [("1", "x", None), ("2", "y", None)]
    (tmp_path / "d.csv").write_text("id,score,text\n1,2,x\n")
    with pytest.raises(Exception, match="the header of a file"):
        files.read_raw_csv(spark, str(tmp_path), SCHEMA).collect()
    with pytest.raises(FileNotFoundError):
        files.read_raw_csv(spark, str(tmp_path / "none"), SCHEMA)


def test_no_line_looks_at_all_lines_after_it(spark, tmp_path):
    """Such a frame is summed up anew for every line: the square of the lines of a block."""
    write(tmp_path / "one.csv", random_rows(random.Random(2), 20))
    plan = read_records(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan

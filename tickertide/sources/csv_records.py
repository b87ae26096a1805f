"""Records of CSV files whose quoted cells hold line breaks, read by many tasks per file.

A line break ends a record if an even number of quotes stands before it in the file (a doubled quote inside a cell counts
twice). So the number of quotes in each block of a file, added up over the blocks before, tells every block how it starts, and each
block finds its records by itself:

1. count the quotes per block (one row per split of the scan), prefix sums per file;
2. running counts of quotes over the lines of a block; lines that are a whole record, nearly all, are done;
3. the lines of longer records are joined per block; only those that cross a block's border meet other blocks.

Records end with a line feed, or a carriage return and one; both are kept inside cells.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    # the number grows along a block: a task reads it in order
    return lines.select(
        "value", quotes.alias("quotes"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))


def _joined(lines: DataFrame, *keys: str) -> DataFrame:
    """The lines of each record as one text."""
    ordered = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    found = lines.groupBy(*keys).agg(F.max("first").alias("first"), ordered.alias("lines"))
    return found.select("first", F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("record"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(first, record): the text of each record, and whether it is the first of its file. Blank lines are no records."""
    lines = _lines(spark, path)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # one row per split of the scan
    blocks = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    blocks = blocks.select("file", "block", F.coalesce(F.sum("quotes").over(before), F.lit(0)).alias("earlier"))

    order = Window.partitionBy("file", "block").orderBy("at")
    running = F.coalesce(F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.withColumns({"running": running, "first": (F.col("block") == 0) & (F.row_number().over(order) == 1)}).join(blocks, ["file", "block"])
    inside = (F.col("earlier") + F.col("running")) % 2 == 1
    whole = ~inside & (F.col("quotes") % 2 == 0)

    rest = placed.withColumn("start", F.when(~inside, F.col("at"))).withColumn("whole", whole)
    rest = rest.withColumn("start", F.last("start", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # a record that no line of its block ends, or that none starts, goes on in other blocks
    after = (F.col("earlier") + F.col("running") + F.col("quotes")) % 2 == 0
    # from the last line back: a frame up to the last row would be summed up anew for every line
    back = Window.partitionBy("file", "block").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, 0)
    end = F.max(F.when(after, F.col("at"))).over(back)
    rest = rest.withColumn("crosses", F.col("start").isNull() | end.isNull()).filter(~F.col("whole"))

    along = Window.partitionBy("file").orderBy("block", "at").rowsBetween(Window.unboundedPreceding, 0)
    crossing = rest.filter("crosses").withColumn("start", F.last("start", ignorenulls=True).over(along))
    found = placed.filter(whole).select("first", F.col("value").alias("record"))
    found = found.unionByName(_joined(rest.filter(~F.col("crosses")), "file", "block", "start")).unionByName(_joined(crossing, "file", "start"))
    return found.withColumn("record", F.regexp_replace("record", "\r$", "")).filter("record <> ''")

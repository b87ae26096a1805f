"""Scans and sinks of the jobs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickertide.schemas import COMMENT_JSON, RAW_POST, REPORT_JSON, SUBMISSION_JSON
from tickertide.sources.csv_records import read_records

# CSV cells read as missing.
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _require(spark: SparkSession, path: str, hint: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path):
        raise FileNotFoundError(f"no data at {path}; {hint}")


def _csv_cells(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The cells as text, missing ones as null. Each file starts with a header of the schema's names."""
    _require(spark, path, "collect posts first")
    records, names = read_records(spark, path), [f.name for f in schema]
    options = {"escape": '"', "multiLine": "true"}
    header = F.from_csv(F.ltrim("record", F.lit("\ufeff")), ", ".join(f"c{i} string" for i in range(len(names) + 1)), options)
    titles = F.array(*[F.coalesce(header[f"c{i}"], F.lit("")) for i in range(len(names) + 1)])
    fits = titles == F.array(*[F.lit(n) for n in [*names, ""]])
    wrong = F.raise_error(F.concat(F.lit(f"the header of a file in {path} is not {','.join(names)} but "), F.col("record")))
    kept = records.filter(F.when(F.col("first"), F.when(fits, F.lit(False)).otherwise(wrong.cast("boolean"))).otherwise(True))
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    table = kept.select(F.from_csv("record", as_text.toDDL(), options).alias("row")).select("row.*")
    return table.select(*[F.when(~F.col(n).isin(*MISSING_CELLS), F.col(n)).alias(n) for n in names])


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_POST) -> DataFrame:
    """Raw posts from CSV with quoted line breaks, each file in as many tasks as it has splits.

    A cell that does not fit its type is null; rejected_cells lists these.
    """
    cells = _csv_cells(spark, path, schema)
    return cells.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def rejected_cells(spark: SparkSession, path: str, schema: T.StructType = RAW_POST) -> DataFrame:
    """(column, wanted, cell, n): cells that read_raw_csv turns into null because they do not fit their type."""
    bad = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("wanted"), F.col(f.name).alias("cell")))
        for f in schema
    ]
    rows = _csv_cells(spark, path, schema).select(F.inline(F.array_compact(F.array(*bad))))
    return rows.groupBy("column", "wanted", "cell").agg(F.count(F.lit(1)).alias("n"))


def write_raw(posts: DataFrame, path: str) -> None:
    posts.write.mode("overwrite").partitionBy("subreddit").parquet(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    _require(spark, path, "collect posts first")
    return spark.read.parquet(path)


def count_raw(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the raw table, from the row counts of its files: no column is read."""
    return read_raw(spark, path).select("id").agg(F.count(F.lit(1)).alias("n"))


def write_processed(posts: DataFrame, path: str) -> None:
    posts.write.mode("overwrite").parquet(path)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    _require(spark, path, "run the preprocessing job first")
    return spark.read.parquet(path)


def read_submissions(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Landed submissions, JSON lines; missing keys are null."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(SUBMISSION_JSON).json(path)


def read_comments(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.schema(COMMENT_JSON).json(path)


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, n): landed lines that are no JSON object; read_submissions and read_comments read them as empty rows."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    fits = F.coalesce(F.try_parse_json("value").isNotNull() & F.ltrim("value").startswith("{"), F.lit(False))
    return lines.filter(~fits).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


def write_report(report: DataFrame, path: str) -> None:
    """`report` is one row with one JSON text column."""
    report.coalesce(1).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The report as one row; sections by sentiment, community and column are maps."""
    _require(spark, path, "run the report job first")
    return spark.read.schema(REPORT_JSON).json(path)


def write_features(features: DataFrame, path: str) -> None:
    """Vectors, label and split of train and test rows in one table."""
    features.write.mode("overwrite").partitionBy("split").parquet(path)


def read_features(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    _require(spark, path, "run the feature job first")
    table = spark.read.parquet(path)
    return table if split is None else table.filter(F.col("split") == split)

"""Hand-over points: a stage writes its result to the shared folder and later stages read it.

A written table survives lost executors and lets every later pass read only its own columns.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, else one in the warehouse, which executors share too."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/handover"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write df once as parquet and return a scan of the written table."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Cleaning of a training corpus: quality rules, near-duplicates, decontamination, personal data, mixing.

Each stage takes the documents its predecessor kept and returns documents with the same columns (the last
adds the sizes, targets and copies of the mix). run() writes each stage's result to the shared folder and
reads it again, so a lost executor costs no earlier stage. No SQL expresses the stages; the tests hold
them against plain versions.

Nulls, empty and repeated rows: as the operators say. Rows without a word fail the quality rules, so
later stages see none of them in a pipeline run.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide.llm import decontam, mixing, near_dup, pii, quality
from tickertide.sources.handover import materialise


def _with_text(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs with clean_text as the text; n_chars follows where the text changed."""
    changed = ~F.col("text").eqNullSafe(F.col("clean_text"))
    columns = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length("clean_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; boilerplate lines go from those that stay."""
    return _with_text(quality.judge(docs).filter("kept"), docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-copies stays."""
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents beyond the coverage limit go; matches beyond the length limit go from the others."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return _with_text(decontam.decontaminate(docs, benchmark).filter(~F.col("contaminated")), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts."""
    return _with_text(pii.find_personal_data(docs, pii.fit(docs)), docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate asks for, with the number of the copy."""
    return mixing.emit(mixing.mix_sources(docs))


STAGES = [
    ("quality_rules", quality_rules), ("ngram_jaccard", ngram_jaccard), ("decontamination", decontamination),
    ("personal_data", personal_data), ("source_mix", source_mix),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

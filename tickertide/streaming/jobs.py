"""Streams over posts and metric events, with the same functions as the batch jobs."""

from collections.abc import Callable

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickertide.operators.features import TermWeights
from tickertide.operators.metrics import pane_counts, sliding_increase, windowed_counts, windowed_rate
from tickertide.operators.models import score_texts
from tickertide.streaming.upserts import latest_windows, upsert_windows  # noqa: F401


def first_arrivals(posts: DataFrame, delay: str = "1 day", time: str = "created_at") -> DataFrame:
    """Each id once while its copies arrive within the watermark; later rows are dropped."""
    return posts.withWatermark(time, delay).dropDuplicatesWithinWatermark(["id"])


def counted_windows(events: DataFrame, labels: list[str], length: str, delay: str, slide: str | None = None) -> DataFrame:
    return windowed_counts(events, labels, length, slide, delay)


def rated_windows(events: DataFrame, labels: list[str], length: str, delay: str) -> DataFrame:
    return windowed_rate(events, labels, length, delay)


def increased_windows(events: DataFrame, labels: list[str], length: str, slide: str, delay: str) -> DataFrame:
    """Sliding windows that a stream may update before they are closed: each event is counted in every window it is in."""
    return sliding_increase(events, labels, length, slide, delay)


def finished_increases(events: DataFrame, labels: list[str], length: str, slide: str, delay: str) -> DataFrame:
    """Sliding windows that a stream appends when they are closed, as sums over panes: an event is counted once."""
    return pane_counts(events, labels, length, slide, delay).withColumnRenamed("n", "increase")


def scored_posts(
    posts: DataFrame, model: Model, model_name: str, weights: TermWeights, numeric: list[str], lemmas: DataFrame | None = None
) -> DataFrame:
    """Classify posts as they arrive; dictionary and vocabulary are static. For a large dictionary see append_scored."""
    return score_texts(posts, model, model_name, weights, numeric, lemmas)


def append_scored(
    posts: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, available_now: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    """Score each batch of a stream with the batch function, so that dictionaries of any size work.

    Each batch has a folder of its own: a repeated batch replaces its rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = posts.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.foreachBatch(write).start()


def append_to(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = False, every: str = "1 minute"
) -> StreamingQuery:
    """Append the finished rows of a stream to a parquet table."""
    writer = stream.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()

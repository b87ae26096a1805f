"""A table of windows that a stream keeps changing, bounded by the windows that can still change.

Layout under one folder (n is a batch number):

    deltas/batch=n    the windows that batch n changed; a repeated batch replaces its own folder
    open/upto=n       all windows that may still change, as of batch n
    closed/upto=n     windows that were found closed at batch n; each window is in one of these once
    manifest/upto=n   written last: open/upto=n, closed/upto<=n and deltas after n are the table

Every `compact_every` batches the open windows and the deltas since are merged. A window is closed when it ended before
the newest window's start less the watermark delay: the stream's own watermark is at least that, and drops what comes later.
The generation before the last is deleted, so a reader that has just read the manifest still finds its files.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EDGES = ["window_start", "window_end"]


class WindowTable:
    """The files of one table of windows; labels tell the windows of one time apart."""

    def __init__(self, spark: SparkSession, path: str, labels: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), [*EDGES, *labels]

    def _folder(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def numbers(self, part: str, key: str) -> list[int]:
        """The finished folders <part>/<key>=n, ascending: one for each compaction or recent batch."""
        folder = self._folder(part)
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(folder):
            return []
        found = [s.getPath().getName() for s in system.listStatus(folder)]
        named = [int(name.split("=")[1]) for name in found if name.startswith(f"{key}=")]
        return sorted(n for n in named if system.exists(self._folder(f"{part}/{key}={n}/_SUCCESS")))

    def _delete(self, part: str, key: str, below: int) -> None:
        for n in self.numbers(part, key):
            if n < below:
                folder = self._folder(f"{part}/{key}={n}")
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _read(self, folder: str, number: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{folder}={number}").withColumn("batch", F.lit(number).cast("long"))

    def _changing(self, upto: int | None, until: int | None = None) -> DataFrame | None:
        """The last state of each window of open/upto and of the deltas after it."""
        parts = [] if upto is None else [self._read("open/upto", upto)]
        deltas = [n for n in self.numbers("deltas", "batch") if (upto is None or n > upto) and (until is None or n <= until)]
        parts += [self._read("deltas/batch", n) for n in deltas]
        if not parts:
            return None
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        values = [c for c in every.columns if c not in self.keys and c != "batch"]
        return every.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "batch").alias("_latest")).select(*self.keys, "_latest.*")

    def add(self, batch: DataFrame, number: int, delay: str, compact_every: int) -> None:
        """Write the windows a batch changed; every compact_every batches, merge. Repeating a batch changes nothing."""
        batch.write.mode("overwrite").parquet(f"{self.path}/deltas/batch={number}")
        if (number + 1) % compact_every == 0:
            self.compact(number, delay)

    def _finish(self, number: int, delay: str) -> None:
        facts = self.spark.createDataFrame([(number, delay)], "upto long, delay string")
        facts.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/upto={number}")

    def compact(self, number: int, delay: str) -> None:
        before = [n for n in self.numbers("manifest", "upto") if n < number]
        merged = self._changing(before[-1] if before else None, number)
        limit = merged.agg((F.max("window_start") - F.expr(f"interval {delay}")).alias("limit")).scalar()
        closed = F.coalesce(F.col("window_end") <= limit, F.lit(False))
        marked = merged.withColumn("_closed", closed)
        marked.filter("_closed").drop("_closed").write.mode("overwrite").parquet(f"{self.path}/closed/upto={number}")
        marked.filter("NOT _closed").drop("_closed").write.mode("overwrite").parquet(f"{self.path}/open/upto={number}")
        self._finish(number, delay)
        if before:
            self._delete("open", "upto", before[-1])
            self._delete("deltas", "batch", before[-1] + 1)
            self._delete("manifest", "upto", before[-1])

    def read(self) -> DataFrame:
        """The last state of every window."""
        finished = self.numbers("manifest", "upto")
        upto = finished[-1] if finished else None
        now = self._changing(upto)
        if now is None:
            raise FileNotFoundError(f"no windows in {self.path}; start the stream first")
        if upto is None:
            return now
        closed = self.spark.read.option("basePath", f"{self.path}/closed").parquet(f"{self.path}/closed")
        return now.unionByName(closed.filter(F.col("upto") <= upto).select(*now.columns))


def upsert_windows(
    stream: DataFrame, path: str, checkpoint: str, labels: list[str], delay: str, available_now: bool = False, compact_every: int = 10,
) -> StreamingQuery:
    """Keep a table of the last state of every window; `delay` is the watermark's. Read with latest_windows."""
    table = WindowTable(stream.sparkSession, path, labels)
    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.foreachBatch(lambda batch, number: table.add(batch, number, delay, compact_every)).start()


def latest_windows(spark: SparkSession, path: str, labels: list[str]) -> DataFrame:
    """The last written state of every window."""
    return WindowTable(spark, path, labels).read()

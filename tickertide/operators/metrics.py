"""Monitoring metrics as aggregates over an event table with an event time `ts`.

The windowed functions take a batch or a stream.
"""

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.operators.ordered import running_sums


def totals(events: DataFrame, kind: str, labels: list[str]) -> DataFrame:
    """Counter value per label set."""
    return events.filter(F.col("kind") == kind).groupBy(*labels).agg(F.count(F.lit(1)).alias("total"))


def summed_totals(events: DataFrame, kind: str, labels: list[str], amount: str) -> DataFrame:
    """Counter value per label set where each event counts `amount`."""
    return events.filter(F.col("kind") == kind).groupBy(*labels).agg(F.coalesce(F.sum(amount), F.lit(0)).alias("total"))


def prediction_totals(events: DataFrame) -> DataFrame:
    """Predictions per predicted sentiment, one column each."""
    predictions = events.filter(F.col("kind") == "prediction")
    return predictions.agg(
        *[F.count_if(F.col("predicted_sentiment") == s).alias(s) for s in ("positive", "neutral", "negative")]
    )


def _bucket_counts(value: str, bounds: list[float]) -> list[Column]:
    x = F.col(value)
    return [F.count_if(x <= le).alias(f"_le{i}") for i, le in enumerate(bounds)] + [F.count(x).alias("_all")]


def _buckets(bounds: list[float]) -> Column:
    """Cumulative buckets as an array, the last one without a bound."""
    finite = [F.struct(F.lit(float(le)).alias("le"), F.col(f"_le{i}").alias("n")) for i, le in enumerate(bounds)]
    return F.array(*finite, F.struct(F.lit(float("inf")).alias("le"), F.col("_all").alias("n")))


def histogram(events: DataFrame, value: str, bounds: list[float], labels: list[str]) -> DataFrame:
    """(labels, le, n, total, sum): observations up to each bound; le is +inf for all of them."""
    counted = events.filter(F.col(value).isNotNull()).groupBy(*labels).agg(
        *_bucket_counts(value, bounds), F.sum(value).alias("sum")
    )
    return counted.select(*labels, F.inline(_buckets(bounds)), F.col("_all").alias("total"), "sum")


def quantile_from_buckets(buckets: Column, bounds: list[float], share: float) -> Column:
    """Linear interpolation inside the first bucket that reaches the rank.

    `buckets` is an array of struct(le, n), cumulative. A rank above the last bound gives that
    bound; no observations give null.
    """
    total = F.element_at(buckets, -1)["n"]
    rank = total * share
    reached = F.filter(F.sequence(F.lit(0), F.lit(len(bounds))), lambda i: F.get(buckets, i)["n"] >= rank)
    at = F.get(reached, F.lit(0))
    upper, count = F.get(buckets, at)["le"], F.get(buckets, at)["n"]
    before = F.when(at == 0, 0).otherwise(F.get(buckets, at - 1)["n"])
    # the first bucket starts at 0 unless its bound is negative
    lower = F.when(at > 0, F.get(buckets, at - 1)["le"]).when(upper > 0, 0.0).otherwise(upper)
    inside = lower + (upper - lower) * F.coalesce(F.try_divide(rank - before, count - before), F.lit(0.0))
    beyond = at == len(bounds)
    return F.when(total > 0, F.when(beyond, F.lit(float(bounds[-1]))).otherwise(inside))


def bucket_quantile(events: DataFrame, value: str, bounds: list[float], labels: list[str], share: float = 0.95) -> DataFrame:
    counted = events.filter(F.col(value).isNotNull()).groupBy(*labels).agg(*_bucket_counts(value, bounds))
    return counted.select(*labels, quantile_from_buckets(_buckets(bounds), bounds, share).alias("quantile"))


def _has_panes(length: str, slide: str) -> bool:
    return pd.Timedelta(length) % pd.Timedelta(slide) == pd.Timedelta(0)


def pane_counts(events: DataFrame, labels: list[str], length: str, slide: str, watermark: str | None = None) -> DataFrame:
    """(window_start, window_end, labels, n) of overlapping windows: counts per slide, then sums of them.

    Only the counts are copied for each window. On a stream (with a watermark) both steps keep state, and a window comes out
    once, when the watermark has passed it (append mode).
    """
    if not _has_panes(length, slide):
        raise ValueError(f"windows of {length} are no multiple of {slide}")
    if watermark:
        events = events.withWatermark("ts", watermark)
    panes = events.groupBy(F.window("ts", slide).alias("_pane"), *labels).agg(F.count(F.lit(1)).alias("_n"))
    # the last moment of a pane is in the same windows as the whole of it
    at = F.window_time("_pane") if watermark else F.col("_pane.start")
    summed = panes.select(at.alias("_at"), *labels, "_n").groupBy(F.window("_at", length, slide), *labels).agg(F.sum("_n").alias("n"))
    return summed.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *labels, "n")


def windowed_counts(
    events: DataFrame, labels: list[str], length: str, slide: str | None = None, watermark: str | None = None
) -> DataFrame:
    """(window_start, window_end, labels, n); with a watermark also on a stream.

    In a batch, overlapping windows are sums of counts per slide, so an event is not copied for each window.
    """
    if slide and not events.isStreaming and _has_panes(length, slide):
        return pane_counts(events, labels, length, slide)
    if watermark:
        events = events.withWatermark("ts", watermark)
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    counted = events.groupBy(window, *labels).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *labels, "n"
    )


def _seconds(start: str, end: str) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def windowed_rate(
    events: DataFrame, labels: list[str], length: str = "1 minute", watermark: str | None = None
) -> DataFrame:
    """Events per second in tumbling windows."""
    counted = windowed_counts(events, labels, length, watermark=watermark)
    return counted.withColumn("rate", F.col("n") / _seconds("window_start", "window_end"))


def summed_rate(rates: DataFrame, by: list[str]) -> DataFrame:
    return rates.groupBy("window_start", "window_end", *by).agg(F.sum("rate").alias("rate"))


def sliding_increase(
    events: DataFrame, labels: list[str], length: str = "5 minutes", slide: str = "1 minute", watermark: str | None = None
) -> DataFrame:
    return windowed_counts(events, labels, length, slide, watermark).withColumnRenamed("n", "increase")


def latest_time(events: DataFrame, by: str = "subreddit") -> DataFrame:
    return events.groupBy(by).agg(F.max("ts").alias("last_ts"))


def in_progress(spans: DataFrame, start: str = "started_at", end: str = "ended_at") -> DataFrame:
    """(ts, active): running jobs after every change; a span is +1 at its start, -1 at its end."""
    changes = spans.select(
        F.inline(
            F.array(
                F.struct(F.col(start).alias("ts"), F.lit(1).alias("change")),
                F.struct(F.col(end).alias("ts"), F.lit(-1).alias("change")),
            )
        )
    ).filter(F.col("ts").isNotNull())
    per_time = changes.groupBy("ts").agg(F.sum("change").alias("change"))
    running = running_sums(per_time, [], "ts", ["change"])
    return running.select("ts", F.col("running_change").alias("active"))


def peak_in_progress(spans: DataFrame) -> DataFrame:
    return in_progress(spans).agg(F.max("active").alias("peak"))


def model_gauges(history: DataFrame) -> DataFrame:
    """Latest accuracy and F1 per model from (model_name, accuracy, f1_score, trained_at)."""
    latest = history.groupBy("model_name").agg(
        F.max_by(F.struct("accuracy", "f1_score", "trained_at"), "trained_at").alias("l")
    )
    return latest.select("model_name", "l.*")


# --- alerts -------------------------------------------------------------------------------


#: Steps of a series that one task looks at together; the result does not depend on it.
RANGE_STEPS = 4096


def _step_number(at: str, step: str) -> Column:
    """Steps since the epoch; windows start at multiples of their length."""
    return F.expr(f"unix_micros({at}) div {pd.Timedelta(step) // pd.Timedelta('1us')}")


def _step_start(number: Column, step: str) -> Column:
    return F.timestamp_micros(number * (pd.Timedelta(step) // pd.Timedelta("1us")))


def minute_spine(events: DataFrame, labels: list[str], step: str, until: DataFrame | None = None, range_steps: int = RANGE_STEPS) -> DataFrame:
    """(labels, _range, _step, at): every step from a label's first event to the last event of `until` (all labels of events unless given).

    The ranges of a series are dealt out before they are filled, so that a long series is many tasks.
    """
    grain = F.window("ts", step)["start"]
    last = (events if until is None else until).agg(F.max(grain).alias("_last")).select(_step_number("_last", step)).scalar()
    firsts = events.groupBy(*labels).agg(F.min(grain).alias("_first")).withColumns({"_low": _step_number("_first", step), "_high": last})
    size = F.lit(range_steps)
    floor = lambda x: F.floor(x / size).cast("long")
    ranges = firsts.filter("_high >= _low").select(*labels, "_low", "_high", F.explode(F.sequence(floor(F.col("_low")), floor(F.col("_high")))).alias("_range"))
    start = F.col("_range") * size
    steps = F.sequence(F.greatest("_low", start), F.least(F.col("_high"), start + size - 1))
    filled = ranges.repartition(*labels, "_range").select(*labels, "_range", F.explode(steps).alias("_step"))
    return filled.withColumn("at", _step_start(F.col("_step"), step))


def _on_spine(
    events: DataFrame, labels: list[str], step: str, aggregates: list[Column], until: DataFrame | None, range_steps: int
) -> DataFrame:
    """Aggregates per step, zero where nothing happened. Rows depend on time, not on events."""
    per_step = events.groupBy(*labels, F.window("ts", step)["start"].alias("_at")).agg(*aggregates)
    names = [c for c in per_step.columns if c not in labels and c != "_at"]
    number = _step_number("_at", step)
    per_step = per_step.select(*labels, F.floor(number / range_steps).cast("long").alias("_range"), number.alias("_step"), *names)
    return minute_spine(events, labels, step, until, range_steps).join(per_step, [*labels, "_range", "_step"], "left").fillna(0, names)


def _rolled(dense: DataFrame, labels: list[str], sums: dict[str, tuple[str, int]], range_steps: int) -> DataFrame:
    """Sums {name: (column, steps)} over the last steps: the last rows of a range are copied to the next as its halo, and taken out again."""
    steps = max(n for _, n in sums.values())
    if steps > range_steps:
        raise ValueError(f"windows of {steps} steps need ranges of at least as many, not {range_steps}")
    near_end = F.pmod("_step", F.lit(range_steps)) > range_steps - steps
    copies = F.when(near_end, F.array(F.col("_range"), F.col("_range") + 1)).otherwise(F.array("_range"))
    dealt = dense.withColumn("_in", F.explode(copies))
    order = Window.partitionBy(*labels, "_in").orderBy("_step")
    found = dealt.select(*labels, "_range", "_step", "at", "_in", *[F.sum(c).over(order.rowsBetween(1 - n, 0)).alias(name) for name, (c, n) in sums.items()])
    # by the name of the window's partitions, so that what follows by range needs no further shuffle
    return found.filter("_in = _range").select(*labels, F.col("_in").alias("_range"), "_step", "at", *sums)


def rolling_counts(
    events: DataFrame, labels: list[str], step: str, steps: int, until: DataFrame | None = None, range_steps: int = RANGE_STEPS
) -> DataFrame:
    """(labels, _range, _step, at, value): events in the last `steps` steps, at every step."""
    dense = _on_spine(events, labels, step, [F.count(F.lit(1)).alias("value")], until, range_steps)
    return _rolled(dense, labels, {"value": ("value", steps)}, range_steps)


def rolling_quantile(
    events: DataFrame, value: str, bounds: list[float], labels: list[str], step: str, steps: int, share: float = 0.95,
    until: DataFrame | None = None, range_steps: int = RANGE_STEPS,
) -> DataFrame:
    """(labels, _range, _step, at, value): bucket quantile over the last `steps` steps; null without observations."""
    known = events.filter(F.col(value).isNotNull())
    counts = _bucket_counts(value, bounds)
    dense = _on_spine(known, labels, step, counts, until, range_steps)
    names = [f"_le{i}" for i in range(len(bounds))] + ["_all"]
    summed = _rolled(dense, labels, {n: (n, steps) for n in names}, range_steps)
    return summed.select(*labels, "_range", "_step", "at", quantile_from_buckets(_buckets(bounds), bounds, share).alias("value"))


def firing(
    series: DataFrame, labels: list[str], condition: Column, hold_steps: int | Column, rule: str | Column, step: str
) -> DataFrame:
    """Stretches in which the condition held for at least hold_steps steps; hold_steps and rule may depend on the labels.

    (rule, labels, pending_at, firing_at, last_at); consecutive true steps form one stretch, named by the last false step before
    it. A range finds that step by itself or takes it from the ranges before (one row per range), and stretches are
    aggregates, so that neither a series nor a long stretch is one task's.
    """
    marked = series.withColumn("_on", F.coalesce(condition, F.lit(False))).select(*labels, "_range", "_step", "at", "_on")
    so_far = Window.partitionBy(*labels, "_range").orderBy("_step").rowsBetween(Window.unboundedPreceding, 0)
    off = F.when(~F.col("_on"), F.col("_step"))
    earlier = Window.partitionBy(*labels).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    lasts = marked.groupBy(*labels, "_range").agg(F.max(off).alias("_last"))
    lasts = lasts.select(*labels, "_range", F.max("_last").over(earlier).alias("_carried"))
    named = marked.withColumn("_off", F.max(off).over(so_far)).filter("_on").join(lasts, [*labels, "_range"])
    stretches = named.withColumn("_stretch", F.coalesce("_off", "_carried", F.lit(-(1 << 62)))).groupBy(*labels, "_stretch").agg(
        F.min("at").alias("pending_at"), F.max("at").alias("last_at"), F.count(F.lit(1)).alias("_steps")
    )
    # the spine is regular, so a stretch has a row at every step
    hold = hold_steps if isinstance(hold_steps, Column) else F.lit(hold_steps)
    fires = F.col("pending_at") + F.expr(f"interval {step}") * hold
    named = rule if isinstance(rule, Column) else F.lit(rule)
    return stretches.filter(F.col("_steps") > hold).select(
        named.alias("rule"), *[c for c in labels if c != "rule"], "pending_at", fires.alias("firing_at"), "last_at"
    )


#: Columns that tell the series of each rule apart, as far as the events have them.
ALERT_LABELS = {
    "errors": ["subreddit", "error_type"], "no_posts": ["subreddit"], "rate_limits": ["subreddit"],
    "requests": ["method", "endpoint", "status_code"], "latency": ["model"],
}


def alert_rules(
    events: DataFrame, bounds: list[float], step: str = "1 minute", short: int = 5, long: int = 10,
    holds: dict[str, int] | None = None, limits: dict[str, float] | None = None, labels: dict[str, list[str]] | None = None,
    range_steps: int = RANGE_STEPS,
) -> DataFrame:
    """All five rules over the event table: (rule, label, pending_at, firing_at, last_at).

    Windows and hold times are in steps, so a sparse table can be tested with longer steps. Each rule's
    series are told apart by its `labels` (defaults in ALERT_LABELS; columns that the table lacks are left out,
    a null is an empty label); label joins them by "|". Every series lasts until the last event of any kind,
    so that an outage is seen.
    """
    holds = {"errors": 1, "no_posts": 10, "rate_limits": 2, "requests": 2, "latency": 2, **(holds or {})}
    limits = {"rate_limits": 5, "requests": 50, "latency": 1.0, **(limits or {})}
    kinds = {
        "errors": "scrape_error", "no_posts": "post_scraped", "rate_limits": "rate_limit_hit", "requests": "api_request",
        "latency": "prediction",
    }
    named = {**ALERT_LABELS, **(labels or {})}

    def label_of(rule: str) -> Column:
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in named[rule] if c in events.columns]
        return F.concat_ws("|", *parts)

    def by_rule(values: dict) -> Column:
        """The value of each row's rule."""
        return F.coalesce(*[F.when(F.col("rule") == r, v) for r, v in values.items()])

    step_seconds = F.unix_timestamp(F.col("at") + F.expr(f"interval {step}")) - F.unix_timestamp("at")
    # the four rules that count events are one pass
    counted = [r for r in kinds if r != "latency"]
    rule = F.coalesce(*[F.when(F.col("kind") == kinds[r], F.lit(r)) for r in counted])
    series = events.withColumn("rule", rule).filter(F.col("rule").isNotNull())
    series = series.select("rule", by_rule({r: label_of(r) for r in counted}).alias("label"), "ts")
    keys = ["rule", "label"]
    dense = _on_spine(series, keys, step, [F.count(F.lit(1)).alias("now")], events, range_steps)
    rolled = _rolled(dense, keys, {"now": ("now", 1), "short": ("now", short), "long": ("now", long)}, range_steps)
    on = by_rule({
        "errors": F.col("short") > 0, "no_posts": F.col("long") == 0, "rate_limits": F.col("short") > limits["rate_limits"],
        "requests": F.col("now") / step_seconds > limits["requests"]})
    fired = firing(rolled, keys, on, by_rule({r: F.lit(holds[r]) for r in counted}), F.col("rule"), step)

    timed = events.filter(F.col("kind") == kinds["latency"]).select(label_of("latency").alias("label"), "ts", "latency_s")
    latency = rolling_quantile(timed, "latency_s", bounds, ["label"], step, short, until=events, range_steps=range_steps)
    return fired.unionByName(firing(latency, ["label"], F.col("value") > limits["latency"], holds["latency"], "latency", step))

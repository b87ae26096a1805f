"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import QUERIES  # noqa: E402
from tickertide.session import get_session  # noqa: E402

HEADLINES = [
    "chart_sentiment_by_community", "text_clean", "text_full_clean", "sentiment_with_rules", "tickers_per_community",
    "wrangle_drop_copies", "wrangle_fence_decimal", "preprocess_job", "stats_describe_numeric", "stats_top_words",
    "stats_report", "chart_top_bigrams", "chart_radar", "ingest_attach_comments", "ingest_top_comments",
    "feature_split", "feature_vocabulary", "feature_weights", "feature_top_terms_by_sentiment", "eval_model_metrics",
    "eval_roc_auc", "metric_rate", "metric_sliding_increase", "metric_latency_p95", "metric_in_progress",
    "metric_alert_rules",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # the first query of a session also starts the engine
    QUERIES["stats_total_posts"](spark, folder).collect()
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": Path(folder).name}))


if __name__ == "__main__":
    main()

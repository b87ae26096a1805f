"""Parameters shared by the jobs."""

# Results depend on them, so they equal the documented defaults.
SENTIMENTS = ["positive", "neutral", "negative"]
LABEL_CODES = {"negative": 0, "neutral": 1, "positive": 2}
LABEL_NAMES = ["negative", "neutral", "positive"]
MODEL_NAMES = ["logistic_regression", "naive_bayes", "random_forest"]
REQUEST_MODELS = ["best", "logistic_regression", "naive_bayes", "random_forest"]
POSTS_PER_COMMUNITY = 100
COMMENTS_PER_POST = 25
REMOVED_BODIES = ["[deleted]", "[removed]"]
TEST_SHARE = 0.2
SEED = 42
FOLDS = 5
MAX_TERMS = 5000
MIN_DOC_COUNT = 2
MAX_DOC_SHARE = 0.95
MIN_CLEAN_WORDS = 3
POSITIVE_FROM = 0.05
NEGATIVE_TO = -0.05
DESCRIBE_COLUMNS = ["score", "num_comments", "upvote_ratio", "text_length", "word_count", "engagement"]
REPORT_COLUMNS = ["score", "num_comments", "upvote_ratio", "word_count", "engagement"]
RADAR_COLUMNS = ["score", "num_comments", "engagement", "word_count"]
NUMERIC_FEATURES = ["score", "num_comments", "upvote_ratio", "engagement", "word_count", "clean_wc", "text_length"]
COMPOUND_BOUNDS = [-1.0, -0.75, -0.5, -0.25, -0.05, 0.05, 0.25, 0.5, 0.75, 1.0]
COLLECT_SECONDS_BOUNDS = [5.0, 10.0, 30.0, 60.0, 120.0, 300.0, 600.0]
LATENCY_BOUNDS = [0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5]
STAGE_SECONDS_BOUNDS = [1.0, 5.0, 15.0, 30.0, 60.0, 120.0, 300.0, 600.0, 1800.0]
REPORT_PLOTS = [
    "sentiment_distribution", "sentiment_by_subreddit", "wordclouds", "sentiment_over_time",
    "engagement_analysis", "text_length_distribution", "top_bigrams", "top_unigrams",
    "hourly_heatmap", "radar_chart", "descriptive_dashboard", "metrics_comparison",
    "confusion_matrices_all", "tuning_improvement", "roc_curves",
]

# A lookup table up to this many rows is sent to every task; a larger one is joined instead.
LOOKUP_ROWS = 20_000

"""Check queries over the test tables, with DuckDB SQL where SQL can express the result."""

from checks import ingest_queries, metric_queries, model_queries, table_queries, text_queries  # noqa: F401
from checks.registry import ORACLES, QUERIES  # noqa: F401

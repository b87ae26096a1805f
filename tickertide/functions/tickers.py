"""Ticker symbols in raw text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickertide.functions.text import _col
from tickertide.functions.wordlists import NOT_TICKERS

# Fixed value: one to five capitals between word boundaries (a leading $ changes nothing).
CAPITAL_RUN = r"(?U)\b[A-Z]{1,5}\b"


def extract_tickers(text, blocked=NOT_TICKERS) -> Column:
    """Distinct symbols in alphabetical order; empty for null text."""
    runs = F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(CAPITAL_RUN), 0)
    kept = F.filter(runs, lambda r: (F.length(r) >= 2) & ~r.isin(*blocked))
    return F.array_sort(F.array_distinct(kept))


def ticker_list(tickers) -> Column:
    return F.array_join(_col(tickers), ",")


def has_ticker(tickers) -> Column:
    return F.size(_col(tickers)) > 0

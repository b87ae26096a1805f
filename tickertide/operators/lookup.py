"""Look every token of a document up in a (key, value) table."""

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.operators.keyed import join_on_skewed_key
from tickertide.settings import LOOKUP_ROWS


def rows_within(table: DataFrame, max_rows: int = LOOKUP_ROWS) -> int | None:
    """Size check before a table is sent to every task: its rows, or None beyond max_rows."""
    rows = table.limit(max_rows + 1).count()
    return rows if rows <= max_rows else None


def _unique_keys(table: DataFrame, key: str, value: str) -> DataFrame:
    return table.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))


def _slot(key, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def hashed_dictionary(table: DataFrame, key: str, value: str, slots: int) -> Column:
    """A size-checked table as one constant array of maps, indexed by the hash of the key."""
    entries = [{} for _ in range(slots)]
    for row in _unique_keys(table, key, value).select(key, value, _slot(key, slots)).collect():
        entries[row[2]][row[0]] = row[1]
    kinds = [table.schema[c].dataType.simpleString() for c in (key, value)]
    # parsed once, at planning: the constant is shipped with the tasks of the stage
    return F.from_json(F.lit(json.dumps(entries)), f"array<map<{kinds[0]},{kinds[1]}>>")


def lookup_in_row(table: DataFrame, key: str, value: str, max_rows: int = LOOKUP_ROWS):
    """A function from an array of tokens to the array of their values (null where there is none).

    Only for a table that passes the size check; otherwise None, and join_lookup does the work.
    """
    rows = rows_within(table, max_rows)
    if rows is None:
        return None
    # n entries in n slots or more: about one entry to scan per lookup
    slots = 1 << max(4, rows.bit_length())
    dictionary = hashed_dictionary(table, key, value, slots)
    return lambda tokens: F.transform(
        tokens, lambda t: F.element_at(F.get(dictionary, _slot(t, slots)), t)
    )


def join_lookup(
    df: DataFrame, id_column: str, tokens: Column, table: DataFrame, key: str, value: str, out: str
) -> DataFrame:
    """Add the values of the tokens as column `out` by a join, for a table of any size.

    Hot tokens are split off; `id_column` is unique per row.
    """
    if df.isStreaming:
        raise ValueError(f"a stream takes a table of at most {LOOKUP_ROWS} rows here; append_scored runs the batch function for a larger one")
    kind = table.schema[value].dataType.simpleString()
    unique = _unique_keys(table, key, value).withColumnRenamed(value, "_value")
    pairs = df.select(id_column, F.posexplode(tokens).alias("_at", key))
    found = join_on_skewed_key(pairs, unique, key, "left")
    # a document's own tokens, in order
    aligned = F.transform(
        F.array_sort(F.collect_list(F.struct("_at", "_value"))), lambda x: x["_value"]
    )
    per_document = found.groupBy(id_column).agg(aligned.alias(out))
    nothing = F.array().cast(f"array<{kind}>")
    return df.join(per_document, id_column, "left").withColumn(out, F.coalesce(out, nothing))

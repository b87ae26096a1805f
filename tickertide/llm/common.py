"""What the operators of this package share: Arrow row maps, row keys, hashed words of texts."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Runs of everything but ASCII white space.
PLAIN_WORD = r"[^\x20\x09-\x0D]+"
PLAIN_GAP = r"[\x20\x09-\x0D]+"
#: Runs of digits, letters and everything beyond ASCII (after lower-casing A-Z).
FOLDED_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rows and bytes of one Arrow batch: texts may be long, so batches are small.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Keep Arrow batches of long texts small; called by every operator that runs Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def others(df: DataFrame, made: list[str]) -> list[str]:
    """The columns of df that an operator hands on: those it makes replace columns of the same name."""
    taken = {c.lower() for c in made}
    return [c for c in df.columns if c.lower() not in taken]


def map_rows(
    df: DataFrame, made: str, work: Callable[[dict[str, list]], dict[str, list]], reads: dict[str, str],
    keep: list[str] | None = None,
) -> DataFrame:
    """df with the columns `made` (DDL) that work() computes for each Arrow batch.

    reads names the columns that work() gets, as Python lists: "bytes" (UTF-8 of a string), or "as is".
    Columns of the same name are replaced; all others are handed on untouched, or only those in `keep`.
    """
    small_batches(df.sparkSession)
    fields = T._parse_datatype_string(made).fields
    kept = others(df, [f.name for f in fields])
    kept = kept if keep is None else [c for c in kept if c in keep]
    extra = [c for c in reads if c not in kept]
    source = df.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(f"_in_{i}") for i, c in enumerate(extra)])
    schema = T.StructType([source.schema[c] for c in kept] + list(fields))
    n, at = len(kept), {c: (kept + extra).index(c) for c in reads}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(schema)
        for batch in batches:
            given = {}
            for name, kind in reads.items():
                column = batch.column(at[name])
                given[name] = (column.cast(pa.binary()) if kind == "bytes" else column).to_pylist()
            out = work(given)
            arrays = [batch.column(i) for i in range(n)]
            arrays += [pa.array(out[f.name], type=wanted.field(n + i).type) for i, f in enumerate(fields)]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def text_key(text: Column | str = "text") -> Column:
    """With doc_id, a key of a row's content: repeated rows share it, other rows do not."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.isNotNull(), F.xxhash64(text))


def fold(text: Column | str) -> Column:
    """Lower-case A-Z only; null: empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def plain_words(text: Column) -> Column:
    """Array of the words PLAIN_WORD; null: none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), PLAIN_GAP), "")


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_R = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, 1 << 20)
        for base in (_R, pow(_R, -1, 1 << 64)):
            row = np.full(n, base, dtype=np.uint64)
            row[0] = 1
            _powers.append(np.multiply.accumulate(row))
        del _powers[:-2]
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def hashed_words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of each folded word of a text in UTF-8."""
    raw = np.frombuffer(text, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = _WORD[raw]
    steps = np.diff(inside)
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    if not len(starts):
        return starts, ends, np.zeros(0, dtype=np.uint64)
    powers, inverse = _tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((_FOLD[raw].astype(np.uint64) + np.uint64(1)) * powers[: len(raw)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return starts, ends, mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def joined(texts: list[bytes | None]) -> tuple[bytes, np.ndarray]:
    """Texts in one buffer, a zero byte (in no word) after each, and where each starts."""
    given = [t or b"" for t in texts]
    starts = np.zeros(len(given) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in given], out=starts[1:])
    return b"\0".join(given) + b"\0" * bool(given), starts

"""Language identification by prediction by partial matching.

One byte model per language counts which byte follows each context of up to `ORDER` bytes. A text's
code length under a language is the sum over its bytes of -log2 of the predicted probability: the longest
context that was seen predicts; where the byte is new after it, an escape is paid (a context with n
followers of d kinds keeps d / (n + d) for it) and the next shorter context predicts; after the
empty context, 8 bits. Counts are frozen after fitting. The language with the shortest code wins.

Fitting takes at most `rows_per_language` labelled rows of each language, those with the smallest
hashes of their doc_id; everything else covers all rows and whole texts.

Nulls: a null text, or one without a letter, is "und" with score 0; rows without text or label are not
fitted. Ties go to the smaller language name. Repeated rows are predicted alike. Empty tables work;
without any fitted language all texts are "und". Columns with the names this makes are replaced.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.llm.common import map_rows, small_batches
from tickertide.sources.handover import materialise

ORDER = 4
MADE = "lang_pred string, score double, bits double"
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """A character of category L; signs such as ² and Ⅷ are words to the pattern, but no letters."""
    return any(m[0].isalpha() for m in _LETTER.finditer(text))
_SLOTS = 21


def _mask(n: int) -> np.int64:
    return np.int64((1 << (8 * n)) - 1)


def _codes(buffer: bytes) -> np.ndarray:
    """The last ORDER + 1 bytes at each place, as one number."""
    raw = np.frombuffer(buffer, dtype=np.uint8).astype(np.int64)
    code = raw.copy()
    for k in range(1, ORDER + 1):
        code[k:] |= raw[:-k] << np.int64(8 * k)
    return code


def _padded(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Texts behind ORDER zero bytes each; where each begins and ends."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + ORDER)
    pad = b"\0" * ORDER
    return b"".join(pad + t for t in texts), ends - sizes, ends


class Model:
    """Frozen counts: per language and context length, sorted strings and their code lengths."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = sorted(counts)
        self.tables = []
        for language in self.languages:
            codes, n = counts[language]
            orders = []
            for k in range(ORDER + 1):
                grams, where = np.unique(codes & _mask(k + 1), return_inverse=True)
                times = np.bincount(where, weights=n)
                contexts, where = np.unique(grams >> np.int64(8), return_inverse=True)
                total, kinds = np.bincount(where, weights=times), np.bincount(where)
                cost = -np.log2(times / (total + kinds)[where])
                orders.append((grams, cost, contexts, -np.log2(kinds / (total + kinds))))
            self.tables.append(orders)

    def code_lengths(self, codes: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each code, per language."""
        out = np.zeros((len(codes), len(self.languages)), dtype=np.float32)
        for column, orders in enumerate(self.tables):
            open_, bits = np.arange(len(codes)), np.zeros(len(codes))
            for k in range(ORDER, -1, -1):
                grams, cost, contexts, escape = orders[k]
                part = codes[open_] & _mask(k + 1)
                at = np.searchsorted(grams, part).clip(0, len(grams) - 1)
                seen = grams[at] == part
                bits[open_[seen]] += cost[at[seen]]
                open_, part = open_[~seen], part[~seen] >> np.int64(8)
                at = np.searchsorted(contexts, part).clip(0, len(contexts) - 1)
                known = contexts[at] == part
                bits[open_[known]] += escape[at[known]]
            bits[open_] += 8
            out[:, column] = bits
        return out


class Cache:
    """Code lengths of strings met before, in a table of fixed size that each task keeps."""

    def __init__(self, model: Model):
        self.model = model
        self.code = np.full(1 << _SLOTS, -1, dtype=np.int64)
        self.bits = np.zeros((1 << _SLOTS, len(model.languages)), dtype=np.float32)

    def code_lengths(self, codes: np.ndarray) -> np.ndarray:
        slot = ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOTS)).astype(np.int64)
        out = self.bits[slot]
        missed = np.flatnonzero(self.code[slot] != codes)
        if len(missed):
            new, where = np.unique(codes[missed], return_inverse=True)
            bits = self.model.code_lengths(new)
            out[missed] = bits[where]
            first = np.zeros(len(new), dtype=np.int64)
            first[where] = missed
            self.code[slot[first]], self.bits[slot[first]] = new, bits
            # two new strings may share a slot: the slot's string must be the one its bits are of
            kept = self.code[slot[first]] == new
            self.bits[slot[first[kept]]] = bits[kept]
        return out


def counts_of(labelled: DataFrame) -> DataFrame:
    """(lang, code, n): how often each string of ORDER + 1 bytes ends somewhere in the texts of a language."""
    small_batches(labelled.sparkSession)

    def run(batches):
        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for lang in sorted(set(langs)):
                buffer, begins, ends = _padded([t for t, x in zip(texts, langs, strict=True) if x == lang])
                inside = np.zeros(len(buffer) + 1, dtype=np.int8)
                np.add.at(inside, begins, 1)
                np.add.at(inside, ends, -1)
                code, n = np.unique(_codes(buffer)[np.cumsum(inside[:-1]) > 0], return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(code), "code": code, "n": n.astype(np.int64)})

    counted = labelled.select("lang", "text").mapInArrow(run, "lang string, code long, n long")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, rows_per_language: int = 400) -> Model:
    """A model of the rows (doc_id, text, lang), at most rows_per_language of each language.

    The rows are chosen by ids alone; their texts are counted in tasks, and only the counts of this
    bounded sample come to the driver.
    """
    order = F.xxhash64(F.lit("fit"), F.col("doc_id").cast("string"))
    ids = labelled.filter(F.col("lang").isNotNull()).select("lang", order.alias("h"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    cuts = ids.withColumn("k", place).filter(F.col("k") <= rows_per_language).groupBy("lang").agg(F.max("h").alias("most"))
    # one row per language: written, so that Spark knows its size and need not shuffle the texts by language
    cuts = materialise(cuts, "language-cuts")
    chosen = labelled.join(cuts, "lang").filter((order <= F.col("most")) & F.col("text").isNotNull())
    counts: dict[str, tuple[list, list]] = {}
    for row in counts_of(chosen).toLocalIterator():
        codes, n = counts.setdefault(row["lang"], ([], []))
        codes.append(row["code"])
        n.append(row["n"])
    return Model({k: (np.array(c, dtype=np.int64), np.array(n, dtype=np.float64)) for k, (c, n) in counts.items()})


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """docs with lang_pred, score (its share of 2 ** -bits over all languages) and bits per byte."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    cache: list[Cache] = []

    def work(given):
        if not cache:
            cache.append(Cache(sent.value))
        names = sent.value.languages
        texts = [t or b"" for t in given["text"]]
        lettered = [bool(names) and has_letter(t.decode("utf-8", "replace")) for t in texts]
        use = [t for t, ok in zip(texts, lettered, strict=True) if ok]
        out = {"lang_pred": [], "score": [], "bits": []}
        totals = iter(())
        if use:
            buffer, begins, ends = _padded(use)
            # one sum per text: the places between texts fall to sums that are left out
            bounds = np.stack([begins, ends], axis=1).ravel()[:-1]
            totals = iter(np.add.reduceat(cache[0].code_lengths(_codes(buffer)), bounds, axis=0, dtype=np.float64)[::2])
        for text, ok in zip(texts, lettered, strict=True):
            if not ok:
                lang, score, bits = "und", 0.0, None
            else:
                total = next(totals)
                best = int(np.argmin(total))
                lang, bits = names[best], float(total[best]) / len(text)
                score = float(1 / np.exp2(np.maximum(total[best] - total, -1000)).sum())
            for name, value in (("lang_pred", lang), ("score", score), ("bits", bits)):
                out[name].append(value)
        return out

    given = docs.withColumn("text", F.col("text").cast("string"))
    return map_rows(given, MADE, work, {"text": "bytes"}, keep)

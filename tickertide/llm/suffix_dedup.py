"""Removal of repeated byte strings by suffix sorting.

A byte goes when a string of `length` bytes that covers it also starts anywhere else. Three steps find
these strings without sorting what cannot repeat:

1. Anchors. The smallest hash of the `GRAM`-byte strings inside a window of `length` bytes is the
   window's anchor. Equal windows have equal anchors, so windows are only compared within an anchor, and
   anchors that occur once are done. All windows with one anchor in a row form a context of
   at most 2 * length bytes. Contexts that occur twice as a whole repeat in every window.
2. Suffix sorting. One context of each kind, of anchors with several kinds, goes to shards. A shard is
   one string, sorted by induction: suffixes that are smaller than both neighbours are sorted first (their
   substrings by induction, then the string of their names, the recursion), and induce all others.
   The suffixes with one first byte lie in one stretch of an order that is a file mapped into memory; stretches
   are filled by sorting arrays, they are no priority queues. All else (text, types, hashes, window starts) is
   held in memory, so shards are of bounded size and must fit there. Neighbours in the result are compared up
   to `length` bytes; where they agree, both windows repeat.
3. Anchors with more kinds of contexts than a shard takes are dealt out window by window instead, by
   128-bit hashes of whole windows; their counts are combined before the shuffle.

Matches never cross documents: contexts lie inside one. Common-prefix values are taken from sorted
neighbours; they are not carried through the queues.

Nulls: a null text is empty. Texts below `length` bytes lose nothing. Repeated rows repeat each other
entirely. A null doc_id takes part. Empty tables work. Columns with the names this makes are replaced.
"""

import hashlib
import itertools
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.llm.common import map_rows, mix, others, small_batches, text_key
from tickertide.sources.handover import materialise

LENGTH, GRAM = 200, 24
SHARD_BYTES = 2 << 20
#: More kinds of contexts at one anchor than this are dealt out by windows.
MOST_KINDS = 10_000
MADE = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, clean_text string"


# --- anchors ---


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes that start at each place."""
    n = len(raw) - 7
    words = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        words |= raw[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    h, m = mix(words), len(raw) - GRAM + 1
    return mix(h[:m] * np.uint64(0x9E3779B97F4A7C15) + h[8 : m + 8] * np.uint64(0xC2B2AE3D27D4EB4F) + h[16 : m + 16])


def sliding_minimum(h: np.ndarray, width: int) -> np.ndarray:
    out, step = h, 1
    while step * 2 <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def contexts(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window) of each run of windows with the same place of their smallest gram."""
    if len(text) < length:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    h = gram_hashes(np.frombuffer(text, dtype=np.uint8))
    least = sliding_minimum(h, length - GRAM + 1)
    # a new run where the smallest value changes, or where its leftmost place was left
    cut = np.flatnonzero((least[1:] != least[:-1]) | (h[: len(least) - 1] == least[:-1])) + 1
    first = np.concatenate([np.zeros(1, dtype=np.int64), cut])
    last = np.concatenate([cut - 1, np.array([len(least) - 1])])
    return least[first], first, last


ANCHORS = "doc_id long, key long, anchor long, kind long, first int, last int"


def anchors_of(docs: DataFrame, length: int) -> DataFrame:
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = {"doc_id": [], "key": [], "anchor": [], "kind": [], "first": [], "last": []}
            for doc, key, text in zip(ids, keys, batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
                anchor, first, last = contexts(text or b"", length)
                if not len(anchor):
                    continue
                view, ends = memoryview(text), (last + length).tolist()
                kinds = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), ends, strict=True)]
                out["doc_id"] += [doc] * len(anchor)
                out["key"] += [key] * len(anchor)
                out["anchor"].append(anchor.view(np.int64))
                out["kind"].append(np.array(kinds, dtype=np.uint64).view(np.int64))
                out["first"].append(first.astype(np.int32))
                out["last"].append(last.astype(np.int32))
            if out["doc_id"]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["doc_id"], pa.int64()), pa.array(out["key"], pa.int64()), *(pa.array(np.concatenate(out[c])) for c in ("anchor", "kind", "first", "last"))],
                    names=list(out))

    texts = docs.select("doc_id", text_key().alias("key"), F.col("text").cast("string").alias("text")).filter("text is not null")
    return texts.mapInArrow(run, ANCHORS)


# --- suffix sorting ---


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts after it; the last is."""
    n = len(text)
    small = np.zeros(n, dtype=bool)
    differs = text[:-1] != text[1:]
    at = np.where(differs, np.arange(n - 1), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    inside = nearest < n - 1
    places = nearest[inside]
    small[:-1][inside] = text[places] < text[places + 1]
    small[n - 1] = True
    return small


class Queues:
    """The suffixes of a text by first symbol: each symbol's queue has its own stretch of one mapped file."""

    def __init__(self, text: np.ndarray, small: np.ndarray, on_disk: bool):
        self.text, self.small = text, small
        counts = np.bincount(text)
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        # the file has no name and goes with its mapping
        self.order = np.memmap(tempfile.TemporaryFile(), dtype=np.int32, shape=len(text), mode="w+") if on_disk else np.empty(len(text), dtype=np.int32)

    def _push(self, suffixes: np.ndarray, heads: np.ndarray, sign: int) -> None:
        """Append suffixes to the queues of their first symbols, in their order, at the front or (sign -1) the back."""
        if not len(suffixes):
            return
        symbols = self.text[suffixes]
        by = np.argsort(symbols, kind="stable")
        symbols, suffixes = symbols[by], suffixes[by]
        begin = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
        sizes = np.diff(np.concatenate([begin, [len(symbols)]]))
        names = symbols[begin]
        within = np.arange(len(symbols)) - np.repeat(begin, sizes)
        base = np.repeat(heads[names], sizes)
        self.order[base + within if sign > 0 else base - 1 - within] = suffixes
        heads[names] += sign * sizes

    def _induced(self, suffixes: np.ndarray, small: bool) -> np.ndarray:
        """The suffixes one place before, of the asked type."""
        before = suffixes[suffixes > 0] - 1
        return before[self.small[before] == small]

    def induce(self, seeds: np.ndarray) -> np.ndarray:
        """All suffixes in order, from seeds in order of their first symbols (and as far as they are sorted)."""
        symbols = len(self.starts)
        first = np.searchsorted(self.text[seeds], np.arange(symbols + 1))
        heads = self.starts.copy()
        for c in range(symbols):
            done = self.starts[c]
            while done < heads[c]:
                part = np.array(self.order[done : heads[c]])
                done = heads[c]
                self._push(self._induced(part, False), heads, 1)
            if first[c] < first[c + 1]:
                self._push(self._induced(seeds[first[c] : first[c + 1]], False), heads, 1)
        tails = self.ends.copy()
        for c in range(symbols - 1, -1, -1):
            done = self.ends[c]
            if c == 0:
                # the end mark is the smallest suffix; nothing induces it
                self.order[0] = len(self.text) - 1
                continue
            while done > tails[c]:
                part = np.array(self.order[tails[c] : done])[::-1]
                done = tails[c]
                self._push(self._induced(part, True), tails, -1)
            if heads[c] > self.starts[c]:
                self._push(self._induced(np.array(self.order[self.starts[c] : heads[c]])[::-1], True), tails, -1)
        return self.order


def _name_order(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names, as far as their first `depth` names (ties as they come)."""
    rank, step = names.astype(np.int64), 1
    while True:
        after = np.full(len(rank), -1, dtype=np.int64)
        after[:-step] = rank[step:]
        key = rank * (rank.max() + 2) + after + 1
        order = np.argsort(key, kind="stable")
        new = np.zeros(len(rank), dtype=np.int64)
        new[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        rank, step = new, step * 2
        if step >= depth or step >= len(rank) or rank[order[-1]] == len(rank) - 1:
            return order


def suffix_order(text: np.ndarray, depth: int, on_disk: bool = False) -> np.ndarray:
    """Suffixes of a text of small numbers in order of (at least) their first `depth` symbols.

    The last symbol must be 0 and occur nowhere else.
    """
    small = _types(text)
    turns = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    queues = Queues(text, small, on_disk)
    if len(turns) > 1:
        seeds = turns[np.argsort(text[turns], kind="stable")]
        is_turn = np.zeros(len(text), dtype=bool)
        is_turn[turns] = True
        order = queues.induce(seeds)
        ordered = np.array(order[is_turn[order]])
        # equal substrings from one turn to the next get equal names
        size = np.zeros(len(text), dtype=np.int32)
        size[turns] = np.diff(np.concatenate([turns, [len(text) - 1]])) + 1
        hashes = StretchHashes(text)
        length = size[ordered].astype(np.int64)
        value = hashes.of(ordered.astype(np.int64), length)
        fresh = (value[1:] != value[:-1]) | (length[1:] != length[:-1])
        name_at = np.zeros(len(text), dtype=np.int32)
        name_at[ordered] = np.concatenate([[0], np.cumsum(fresh)])
        names = name_at[turns]
        if names.max() + 1 < len(turns):
            # a name stands for two symbols at least
            ordered = turns[_name_order(names, depth // 2 + 2)]
        seeds = ordered
    else:
        seeds = turns
    return queues.induce(seeds[np.argsort(text[seeds], kind="stable")])


class StretchHashes:
    """Hashes of any stretch of a text, modulo 2 ** 64 and mixed."""

    def __init__(self, text: np.ndarray):
        base = 0x9E3779B97F4A7C15
        powers = np.full(len(text), base, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        self.inverse = np.full(len(text) + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
        self.inverse[0] = 1
        np.multiply.accumulate(self.inverse, out=self.inverse)
        self.sums = np.zeros(len(text) + 1, dtype=np.uint64)
        np.cumsum(mix(text.astype(np.uint64) + np.uint64(1)) * powers, out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.inverse[start])


def repeated_windows(parts: list[bytes], windows: list[int], length: int = LENGTH, on_disk: bool = True) -> np.ndarray:
    """For the windows of all parts (each has its first windows[k] places), one after the other: whether another is equal."""
    joined = b"\0".join(parts) + b"\0" * 9
    raw = np.frombuffer(joined, dtype=np.uint8)
    text = np.zeros(len(joined) - 8, dtype=np.int16)
    text[:-1] = raw[: len(text) - 1]
    text[:-1] += 2
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    text[(begins + sizes)[:-1]] = 1
    starts = np.zeros(len(text), dtype=bool)
    number = np.array(windows, dtype=np.int64)
    inner = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
    places = np.repeat(begins, number) + inner
    starts[places] = True
    order = suffix_order(text, length, on_disk)
    order = np.array(order[starts[order]], dtype=np.int64)
    # eight bytes at a time; the last word ends with the window
    words = np.zeros(len(joined) - 7, dtype=np.uint64)
    for k in range(8):
        words |= raw[k : k + len(words)].astype(np.uint64) << np.uint64(8 * k)
    pairs = np.arange(1, len(order))
    for k in [*range(0, length - 7, 8), length - 8]:
        pairs = pairs[words[order[pairs] + k] == words[order[pairs - 1] + k]]
    again = np.zeros(len(text), dtype=bool)
    again[order[pairs]] = True
    again[order[pairs - 1]] = True
    return again[places]


# --- jobs ---

SPANS = "doc_id long, key long, first int, last int"


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1) - 1


def packed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """doc_id, the columns of keep, _key (the text's hash) and _packed, the text compressed for the shuffle."""

    def work(given):
        compressor = zstandard.ZstdCompressor(level=1)
        return {"_packed": [None if t is None else compressor.compress(t) for t in given["_text"]]}

    more = [F.col(f"`{c}`") for c in keep if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", *more, text_key().alias("_key"), F.col("text").cast("string").alias("_text"))
    return map_rows(rows, "_packed binary", work, {"_text": "bytes"}, [c for c in rows.columns if c != "_text"])


def _unpack(text: bytes | None) -> bytes:
    return b"" if text is None else zstandard.ZstdDecompressor().decompress(text)


def same_document():
    """A packed document and what was found for it, as (_doc, _found)."""
    return F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("_key").eqNullSafe(F.col("_found"))


def context_texts(docs: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """kinds (anchor, n, doc_id, key, first, last) with the bytes of their contexts, cut from the documents."""
    wanted = kinds.groupBy(F.col("doc_id").alias("_doc"), F.col("key").alias("_found")).agg(
        F.collect_list(F.struct("anchor", "n", "first", "last")).alias("cuts"))
    # contexts of repeated rows come twice; they occur more than once anyway, so none of their windows is reported
    both = packed(docs, []).join(wanted, same_document())

    def work(given):
        out = []
        for text, cuts in zip(given["_packed"], given["cuts"], strict=True):
            whole = _unpack(text)
            out.append([{**c, "bytes": whole[c["first"] : c["last"] + length]} for c in cuts])
        return {"found": out}

    found = map_rows(both, "found array<struct<anchor: long, n: long, first: int, last: int, bytes: binary>>", work, {"_packed": "as is", "cuts": "as is"}, ["doc_id", "_key"])
    return found.select("doc_id", F.col("_key").alias("key"), F.inline("found"))


def sorted_shards(cut: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """Runs of repeated windows (doc_id, key, first, last) of contexts that occur once; each anchor lies within one shard."""
    dealt = cut.select("anchor", "doc_id", "key", "n", "first", "last", "bytes").repartition("anchor").sortWithinPartitions("anchor")

    def shards(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True)

        held, size = [], 0
        for _, group in itertools.groupby(rows(), key=lambda r: r[0]):
            group = list(group)
            held += group
            size += sum(len(r[6]) for r in group)
            if size >= shard_bytes:
                yield held
                held, size = [], 0
        if held:
            yield held

    def run(batches):
        for shard in shards(batches):
            windows = [r[5] - r[4] + 1 for r in shard]
            again = repeated_windows([r[6] for r in shard], windows, length)
            out = {"doc_id": [], "key": [], "first": [], "last": []}
            for (_, doc, key, n, first, _, _), flags in zip(shard, np.split(again, np.cumsum(windows)[:-1]), strict=True):
                # what occurs twice as a whole is known already
                if n == 1 and flags.any():
                    for a, b in zip(*_runs(flags), strict=True):
                        for name, value in zip(out, (doc, key, first + int(a), first + int(b)), strict=True):
                            out[name].append(value)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(out["doc_id"], pa.int64()), "key": pa.array(out["key"], pa.int64()),
                "first": pa.array(out["first"], pa.int32()), "last": pa.array(out["last"], pa.int32())})

    return dealt.mapInArrow(run, SPANS)


def counted_windows(cut: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many kinds: each window is a row, and equal windows are counted."""

    def work(given):
        out = []
        for text, first in zip(given["bytes"], given["first"], strict=True):
            digests = [xxhash.xxh3_128_intdigest(text[k : k + length]) for k in range(len(text) - length + 1)]
            out.append([{"place": first + k, "high": (d >> 64) - (1 << 63), "low": (d & (1 << 64) - 1) - (1 << 63)} for k, d in enumerate(digests)])
        return {"windows": out}

    each = map_rows(cut, "windows array<struct<place: int, high: long, low: long>>", work, {"bytes": "as is", "first": "as is"}, ["doc_id", "key", "n"])
    each = each.select("doc_id", "key", "n", F.inline("windows"))
    again = each.groupBy("high", "low").agg(F.count("*").alias("times")).filter("times > 1").drop("times")
    return each.filter("n = 1").join(again, ["high", "low"]).select("doc_id", "key", F.col("place").alias("first"), F.col("place").alias("last"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, most_kinds: int = MOST_KINDS) -> DataFrame:
    """(doc_id, key, first, last): runs of places where repeated windows start."""
    anchors = materialise(anchors_of(docs, length), "suffix-anchors")
    often = anchors.groupBy("anchor").agg(F.count("*").alias("times")).filter("times > 1").select("anchor")
    shared = materialise(anchors.join(often, "anchor"), "suffix-shared")
    kinds = shared.groupBy("anchor", "kind").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "key", "first", "last")).alias("at"))
    kinds = materialise(kinds.select("anchor", "kind", "n", "at.*"), "suffix-kinds")
    whole = shared.join(kinds.filter("n > 1").select("anchor", "kind"), ["anchor", "kind"]).select("doc_id", "key", "first", "last")
    number = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    several = kinds.join(number, "anchor").select("anchor", "n", "doc_id", "key", "first", "last", "kinds")
    # both ways are parts of one plan, so that the texts are shuffled once for both and for the caller
    usual = context_texts(docs, several.filter(F.col("kinds") <= most_kinds), length)
    crowded = context_texts(docs, several.filter(F.col("kinds") > most_kinds), length)
    return whole.unionByName(sorted_shards(usual, length, shard_bytes)).unionByName(counted_windows(crowded, length))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, most_kinds: int = MOST_KINDS,
    with_text: bool = True, keep: list[str] | None = None,
) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans, kept_sha256 and clean_text, the bytes that stay (null unless with_text).

    Where a cut leaves broken UTF-8, clean_text has replacement characters; the digest is of the bytes.
    """
    names = [f.split(" ")[0] for f in MADE.split(", ")]
    handed = [c for c in others(docs, names) if keep is None or c in keep]
    spans = repeated_spans(docs, length, shard_bytes, most_kinds)
    per_doc = spans.groupBy(F.col("doc_id").alias("_doc"), F.col("key").alias("_found")).agg(F.collect_set(F.struct("first", "last")).alias("_spans"))

    def work(given):
        out = {n: [] for n in names}
        for text, runs in zip(given["_packed"], given["_spans"], strict=True):
            whole, gone = _unpack(text), []
            for first, last in sorted((r["first"], r["last"] + length) for r in runs or ()):
                if gone and first <= gone[-1][1]:
                    gone[-1][1] = max(gone[-1][1], last)
                else:
                    gone.append([first, last])
            kept, at = [], 0
            for first, last in gone:
                kept.append(whole[at:first])
                at = last
            rest = b"".join([*kept, whole[at:]])
            for name, value in zip(names, (
                len(whole), len(whole) - len(rest), len(gone), hashlib.sha256(rest).hexdigest(),
                rest.decode("utf-8", "replace") if with_text and text is not None else None), strict=True):
                out[name].append(value)
        return out

    both = packed(docs, handed).join(per_doc, same_document(), "left")
    whole_text = "text" in handed
    done = map_rows(both, MADE, work, {"_packed": "as is", "_spans": "as is"}, handed + ["_packed"] * whole_text)
    if not whole_text:
        return done

    def unpack(given):
        return {"text": [None if t is None else _unpack(t).decode("utf-8", "replace") for t in given["_packed"]]}

    return map_rows(done, "text string", unpack, {"_packed": "as is"}, [c for c in done.columns if c != "_packed"])

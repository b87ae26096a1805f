"""Benchmark decontamination with a generalised suffix automaton of the benchmark's items.

Items and documents are lower-cased (A-Z) and cut into words; the words of all items form one
automaton. Each document's words are streamed through it, which yields the longest match that ends
at each word. Words inside a match of at least `window` words, or inside a whole shorter item, are hit.

The items are dealt by their hashes into blocks of about `block_words` words. Each block's automaton is built
in a task and written to the shared folder; the driver passes on one block's bytes at a time. Every document
passes every block, and the hits so far are written between blocks, so a task holds one automaton and any
number of items works with bounded memory. (A single item is never cut: the longest one bounds a block too.)

Nulls: a null text has no words; an item with a null id hits but is not listed. Texts or items
without words hit nothing. Repeated rows and items change nothing but their own rows. Empty tables
work. Columns of the input with the names this makes are replaced.
"""

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.llm.common import FOLDED_GAP, fold, hashed_words, joined, map_rows, others
from tickertide.sources.handover import materialise

MADE = "n_words long, n_hit long, longest long, items array<string>, hits array<struct<first: long, last: long>>, clean_text string"


class Automaton:
    """All substrings of the items, as states with word transitions and suffix links."""

    def __init__(self, items: list[tuple[str | None, list[int]]], window: int):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.window = window
        for _, words in items:
            last = 0
            for word in words:
                last = self._add(last, word)
        self.names: list[str | None] = [name for name, _ in items]
        self.windows: dict[int, set[int]] = {}
        self.whole: dict[int, list[tuple[int, int]]] = {}
        for k, (_, words) in enumerate(items):
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                if i >= window - 1:
                    self.windows.setdefault(self._ancestor(state, window), set()).add(k)
            if 0 < len(words) < window:
                self.whole.setdefault(self._ancestor(state, len(words)), []).append((len(words), k))
        self.above = [self._ancestor(s, window) if self.length[s] >= window else 0 for s in range(len(self.link))]
        self.short: list[tuple[tuple[int, int], ...]] = [()] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.short[s] = self.short[self.link[s]] + tuple(self.whole.get(s, ()))
        self.least = min([window, *(n for found in self.whole.values() for n, _ in found)])

    def _add(self, last: int, word: int) -> int:
        at = self.next[last].get(word)
        if at is not None:
            return at if self.length[at] == self.length[last] + 1 else self._clone(last, word, at)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, word, q)
        return new

    def _clone(self, p: int, word: int, q: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _ancestor(self, state: int, length: int) -> int:
        """The state of the last `length` words of what leads to `state`."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def stream(self, words: list[int]) -> Iterator[tuple[int, int, int, list[int]]]:
        """(place, longest match, words hit up to here, items) wherever a window or whole item ends."""
        nexts, link, length, state, n = self.next, self.link, self.length, 0, 0
        for i, word in enumerate(words):
            while state and word not in nexts[state]:
                state = link[state]
                n = length[state]
            if word not in nexts[state]:
                n = 0
                continue
            state = nexts[state][word]
            n += 1
            found, most = [], 0
            if n >= self.window:
                found, most = list(self.windows[self.above[state]]), self.window
            for size, k in self.short[state]:
                if size <= n:
                    found.append(k)
                    most = max(most, size)
            if most:
                yield i, n, most, found


class Block:
    """One automaton with the hashes of its words; word numbers are places in the sorted hashes."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], window: int):
        self.known = np.unique(np.concatenate([h for _, h in items])) if items else np.zeros(0, dtype=np.uint64)
        numbered = [(name, np.searchsorted(self.known, h).tolist()) for name, h in items]
        self.automaton = Automaton(numbered, window)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.searchsorted(self.known, hashes)
        at[at == len(self.known)] = 0
        return np.where(self.known[at] == hashes, at, -1)


#: Bytes of one row of a stored automaton.
PIECE = 32 << 20


def built_blocks(benchmark: DataFrame, window: int, block_words: int) -> tuple[DataFrame, int]:
    """(block, piece, content), written: the pickled automata of all items, each built in a task of its own; and how many there are."""
    items = benchmark.select(F.col("item_id").cast("string").alias("name"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # the parts between gaps are at least as many as the words
    words = items.agg(F.sum(F.size(F.split(fold("text"), FOLDED_GAP))).alias("n")).first()["n"] or 0
    count = max(1, -(-words // block_words))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(count)).cast("int"))

    def build(group: pa.Table) -> pa.Table:
        texts = group.column("text").cast(pa.binary()).to_pylist()
        hashed = [(name, hashed_words(text)[2]) for name, text in zip(group.column("name").to_pylist(), texts, strict=True)]
        content = pickle.dumps(Block([item for item in hashed if len(item[1])], window), pickle.HIGHEST_PROTOCOL)
        pieces = [content[at : at + PIECE] for at in range(0, len(content), PIECE)]
        block = group.column("block")[0].as_py()
        return pa.table({
            "block": pa.array([block] * len(pieces), pa.int32()), "piece": pa.array(range(len(pieces)), pa.int32()), "content": pa.array(pieces, pa.binary())})

    made = dealt.groupBy("block").applyInArrow(build, "block int, piece int, content binary")
    return materialise(made, "automata"), count


_held: dict[str, Block] = {}


def held_block(key: str, content: bytes, window: int) -> Block:
    """A block, unpickled once per worker, which holds one at a time. No content: no items."""
    if key not in _held:
        _held.clear()
        _held[key] = pickle.loads(content) if content else Block([], window)
    return _held[key]


def find_hits(block: Block, texts: list[bytes | None]) -> dict[str, list]:
    """Per text: number of words, hit words as (first, last) runs, longest match, item names."""
    buffer, offsets = joined(texts)
    starts, ends, hashes = hashed_words(buffer)
    first_word = np.searchsorted(starts, offsets)
    numbers = block.numbers(hashes)
    known = np.zeros(len(numbers) + 2, dtype=np.int8)
    known[1:-1] = numbers >= 0
    # a run of known words ends with its text
    steps = np.diff(known)
    begins, stops = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    inner = first_word[1:-1]
    cut = np.unique(inner[(inner > 0) & (inner < len(numbers)) & (known[inner.clip(0, len(known) - 2)] > 0) & (known[inner.clip(0, len(known) - 3) + 1] > 0)])
    begins, stops = np.sort(np.concatenate([begins, cut])), np.sort(np.concatenate([stops, cut]))
    long = stops - begins >= block.automaton.least
    out = {"n_words": np.diff(first_word).tolist(), "hits": [[] for _ in texts], "longest": [0] * len(texts), "items": [set() for _ in texts]}
    for b, s in zip(begins[long].tolist(), stops[long].tolist(), strict=True):
        doc = int(np.searchsorted(first_word, b, "right")) - 1
        base = b - int(first_word[doc])
        for i, n, most, found in block.automaton.stream(numbers[b:s].tolist()):
            runs, first, last = out["hits"][doc], base + i - most + 1, base + i
            while runs and runs[-1][1] >= first - 1:
                first = min(first, runs.pop()[0])
            runs.append((first, last))
            out["longest"][doc] = max(out["longest"][doc], n)
            out["items"][doc].update(block.automaton.names[k] for k in found if block.automaton.names[k] is not None)
    out["bounds"] = (starts, ends, first_word, offsets)
    return out


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and out[-1][1] >= first - 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, one_in: int = 20, max_match: int = 50,
    block_words: int = 500_000, with_text: bool = True, keep: list[str] | None = None,
) -> DataFrame:
    """docs with n_words, n_hit, n_items, items, hits, longest, contaminated and clean_text.

    contaminated: some word is hit, and at least one word in `one_in`. clean_text is the
    text without the runs of hit words of a contaminated document, and without runs of over `max_match`
    words in any document (null unless with_text). keep: the columns to hand on, all unless given.
    """
    spark = docs.sparkSession
    automata, count = built_blocks(benchmark, window, block_words)
    run = uuid.uuid4().hex
    final = ["n_items", "contaminated"]
    given = docs.withColumn("text", F.col("text").cast("string"))
    out = given.select(*[F.col(f"`{c}`") for c in others(docs, [*[f.split(" ")[0] for f in MADE.split(", ")], *final])])
    for k in range(count):
        last = k == count - 1
        # one block, whose size block_words bounds
        pieces = automata.filter(F.col("block") == k).orderBy("piece").select("content").collect()
        sent = spark.sparkContext.broadcast(b"".join(bytes(p["content"]) for p in pieces))

        def work(given, sent=sent, key=f"{run}-{k}", first=k == 0, last=last):
            found = find_hits(held_block(key, sent.value, window), given["text"])
            n = len(given["text"])
            hits, items, longest = found["hits"], found["items"], found["longest"]
            if not first:
                hits = [a + [(r["first"], r["last"]) for r in b] for a, b in zip(hits, given["hits"], strict=True)]
                items = [a | set(b) for a, b in zip(items, given["items"], strict=True)]
                longest = [max(a, b) for a, b in zip(longest, given["longest"], strict=True)]
            hits = [merged(h) for h in hits]
            total = [sum(b - a + 1 for a, b in h) for h in hits]
            texts = [None] * n
            if last and with_text:
                starts, ends, first_word, offsets = found["bounds"]
                for d, text in enumerate(given["text"]):
                    dirty = one_in * total[d] >= found["n_words"][d]
                    gone = [r for r in hits[d] if dirty or r[1] - r[0] >= max_match]
                    if text is not None:
                        pieces, at, low = [], 0, int(first_word[d])
                        for a, b in gone:
                            pieces.append(text[at : int(starts[low + a] - offsets[d])])
                            at = int(ends[low + b] - offsets[d])
                        texts[d] = b"".join([*pieces, text[at:]]).decode("utf-8", "replace")
            return {
                "n_words": found["n_words"], "n_hit": total, "longest": longest, "items": [sorted(s) for s in items],
                "hits": [[{"first": a, "last": b} for a, b in h] for h in hits], "clean_text": texts,
            }

        more = {} if k == 0 else {"hits": "as is", "items": "as is", "longest": "as is"}
        handed = keep if keep is None or last else [*keep, "text"]
        out = map_rows(out, MADE, work, {"text": "bytes"} | more, handed)
        if not last:
            out = materialise(out, "hits-so-far")
            sent.unpersist()
    dirty = (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))
    return out.withColumn("n_items", F.size("items").cast("long")).withColumn("contaminated", dirty)


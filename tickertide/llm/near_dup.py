"""N-gram Jaccard join with Bayesian pruning of candidates.

1. Each text becomes the set of its shingles of five words (hashed to 64 bits) and a signature of MinHash
   values. Texts with equal sets form a class of copies and are handled once, with their number.
2. Classes whose signatures agree in a band share a bucket. Pairs in a bucket compare their MinHash
   values step by step; with m of n equal, the similarity's posterior is Beta(m + 1, n - m + 1), and a pair
   goes as soon as its posterior probability of reaching the threshold is below `tolerance`. The
   pairs that remain are reported as spanning links, so rows stay linear in the members.
3. Components of these links are clusters. Within each cluster all pairs are verified exactly on their
   whole sets, which also restores any pair that pruning missed there.
4. Verified links give each document its class_id and its number of links.

Buckets and clusters of any size are cut into blocks; each pair of blocks is a task's group of bounded
size, and a group emits one row per member, never one per pair. Comparing all pairs of different
texts in one group of near-copies is quadratic by nature: counting their links asks for it.

With 48 bands of 5 values a pair at similarity 0.8 misses all bands with probability 5e-9.

Nulls: a null text, or one without words, has no shingles: it links to nothing and is a class of its own. A
text of one to four words is one shingle. A null doc_id takes part; a class of null ids only has a null
class_id. Repeated rows are copies. Empty tables work. Ties cannot occur: classes are named by their
smallest doc_id. Only doc_id and text are read.
"""

import itertools
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.llm.common import hashed_words, joined, map_rows, mix, text_key
from tickertide.llm.components import components
from tickertide.sources.handover import materialise

WORDS, BANDS, ROWS = 5, 48, 5
HASHES = BANDS * ROWS
STEPS = (30, 60, 120, 240)
BLOCK, BLOCK_SHINGLES = 1000, 1_000_000
_rng = np.random.default_rng(20240229)
_FLIP = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_TIMES = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_P = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted hashes of the different shingles of each text."""
    buffer, offsets = joined(texts)
    starts, _, hashes = hashed_words(buffer)
    bounds = np.searchsorted(starts, offsets).tolist()
    rolled = np.zeros(max(0, len(hashes) - words + 1), dtype=np.uint64)
    for k in range(words):
        rolled = rolled * _P + hashes[k : k + len(rolled)]
    rolled = mix(rolled)
    out = []
    for low, high in itertools.pairwise(bounds):
        if high - low >= words:
            out.append(np.unique(rolled[low : high - words + 1]))
        elif high > low:
            whole = np.zeros(1, dtype=np.uint64)
            for h in hashes[low:high]:
                whole = whole * _P + h
            out.append(mix(whole + np.uint64(high - low)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    low = shingles.astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(low), 2048):
        values = (low[k : k + 2048, None] ^ _FLIP) * _TIMES
        np.minimum(best, values.min(axis=0), out=best)
    return best


def bands_of(best: np.ndarray) -> np.ndarray:
    h = np.arange(BANDS, dtype=np.uint64)
    for column in best.reshape(BANDS, ROWS).T:
        h = mix(h * _P + column)
    return h.view(np.int64)


SKETCH = "class long, n long, signature binary, bands array<long>"


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, key, class, n, signature, bands); class: a hash of the set, null without shingles."""

    def work(given):
        sets = shingle_sets(given["text"])
        out = {"class": [], "n": [], "signature": [], "bands": []}
        for s in sets:
            best = signature(s) if len(s) else None
            out["class"].append(int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))) if len(s) else None)
            out["n"].append(len(s))
            out["signature"].append(best.astype(np.uint16).tobytes() if len(s) else None)
            out["bands"].append(bands_of(best).tolist() if len(s) else [])
        return out

    rows = docs.select("doc_id", text_key().alias("key"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, SKETCH, work, {"text": "bytes"}, ["doc_id", "key"])


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """Of n MinHash values, how many must be equal for a pair to stay."""
    out = {}
    for n in STEPS:
        # P(Beta(m + 1, n - m + 1) >= t) = P(Binomial(n + 1, t) <= m)
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


class Roots:
    """Union-find over the places of one group."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.find(x), self.find(y)
        self.up[max(a, b)] = min(a, b)


def surviving(signatures: np.ndarray, block: np.ndarray, mixed: bool, least: dict[int, int]) -> Roots:
    """Spanning links among the members whose pairs stay; in a group of two blocks (mixed, also if one is empty) pairs of one block do not meet."""
    n, roots = len(signatures), Roots(len(signatures))
    for i in range(n - 1):
        rest = np.arange(i + 1, n)
        if mixed:
            rest = rest[block[i + 1 :] != block[i]]
        equal, done = np.zeros(len(rest), dtype=np.int64), 0
        for step in STEPS:
            if not len(rest):
                break
            equal += (signatures[rest, done:step] == signatures[i, done:step]).sum(axis=1)
            stays = equal >= least[step]
            rest, equal, done = rest[stays], equal[stays], step
        for j in rest.tolist():
            roots.join(i, j)
    return roots


def _dealt(members: DataFrame, group: list[str], blocks: str, node: str) -> DataFrame:
    """Each member once for every pair of blocks that its block is in: group, i, j, block."""
    mine = F.pmod(F.xxhash64(node), F.col(blocks)).cast("int")
    placed = members.withColumn("block", mine)
    pairs = F.transform(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int")), lambda k: F.struct(
        F.least(F.col("block"), k).alias("i"), F.greatest(F.col("block"), k).alias("j")))
    dealt = placed.select("*", F.inline(pairs)).drop(blocks)
    keys = [*group, "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, node)


def _groups(batches, keys: int):
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)

    for _, group in itertools.groupby(rows(), key=lambda r: r[:keys]):
        yield list(group)


def _emitted(rows, schema: pa.Schema, size: int = 5000):
    rows = iter(rows)
    while part := list(itertools.islice(rows, size)):
        columns = list(zip(*part, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def candidate_links(reps: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Links (a, b) that span the pairs of classes which share a bucket and outlive the pruning."""
    least = least_matches(threshold, tolerance)
    in_bands = reps.select("class", F.posexplode("bands").alias("band", "bucket"))
    shared = in_bands.groupBy("band", "bucket").agg(F.count("*").alias("size"), F.min("class").alias("x"), F.max("class").alias("y"))
    shared = shared.filter("x <> y").select("band", "bucket", F.ceil(F.col("size") / BLOCK).alias("blocks"))
    members = in_bands.join(shared, ["band", "bucket"]).join(reps.select("class", "signature"), "class")
    dealt = _dealt(members, ["band", "bucket"], "blocks", "class").select("band", "bucket", "i", "j", "block", "class", "signature")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(batches):
        for group in _groups(batches, 4):
            if len(group) < 2:
                continue
            signatures = np.frombuffer(b"".join(r[6] for r in group), dtype=np.uint16).reshape(len(group), HASHES)
            roots = surviving(signatures, np.array([r[4] for r in group]), group[0][2] != group[0][3], least)
            for k in range(len(group)):
                if (root := roots.find(k)) != k:
                    yield group[root][5], group[k][5]

    return dealt.mapInArrow(lambda batches: _emitted(links(batches), schema), "a long, b long").distinct()


def verified(sets: list[np.ndarray], block: np.ndarray, mixed: bool, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold, from exact intersections of whole sets (matrix, both halves); mixed as in surviving()."""
    m, sizes = len(sets), np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), sizes)
    values, where, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    common = times[where] > 1
    owner, column = owner[common], number[where[common]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((m, m), dtype=np.int64)
    width = max(256, min(8192, 8_000_000 // m))
    total = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, total, width):
        a, b = np.searchsorted(column, (low, low + width))
        part = np.zeros((m, width), dtype=np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        both += (part @ part.T).astype(np.int64)
    limit = Fraction(str(threshold))
    union = sizes[:, None] + sizes[None, :] - both
    linked = both * limit.denominator >= union * limit.numerator
    np.fill_diagonal(linked, False)
    if mixed:
        linked &= block[:, None] != block[None, :]
    return linked


def verified_links(docs: DataFrame, clusters: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(a, root, links): per class and group of blocks, its links to other documents and a class it hangs together with."""
    members = clusters.join(classes, F.col("node") == F.col("class")).select("class", F.col("label").alias("cluster"), "n", "copies", "rep_id", "rep_key")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("size"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    members = members.join(sizes.select("cluster", blocks.alias("blocks")), "cluster")
    texts = docs.select("doc_id", text_key().alias("key"), F.col("text").cast("string").alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("key") == F.col("rep_key"))
    held = texts.join(members, same).select("class", "cluster", "blocks", "copies", "text").dropDuplicates(["class"])

    def to_sets(given):
        return {"shingles": [s.tobytes() for s in shingle_sets(given["text"])]}

    sets = map_rows(held, "shingles binary", to_sets, {"text": "bytes"}, ["class", "cluster", "blocks", "copies"])
    dealt = _dealt(sets, ["cluster"], "blocks", "class").select("cluster", "i", "j", "block", "class", "copies", "shingles")
    schema = pa.schema([("a", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])

    def links(batches):
        for group in _groups(batches, 3):
            if len(group) < 2:
                continue
            linked = verified([np.frombuffer(r[6], dtype=np.uint64) for r in group], np.array([r[3] for r in group]), group[0][1] != group[0][2], threshold)
            counts = linked @ np.array([r[5] for r in group])
            roots = Roots(len(group))
            for k in range(len(group)):
                for other in np.flatnonzero(linked[k, :k]).tolist():
                    roots.join(k, other)
            for k, r in enumerate(group):
                if counts[k]:
                    yield r[4], group[roots.find(k)][4], int(counts[k])

    return dealt.mapInArrow(lambda batches: _emitted(links(batches), schema), "a long, root long, links long")


def join_near(docs: DataFrame, threshold: float = 0.8, tolerance: float = 1e-9) -> DataFrame:
    """(doc_id, key, label, class_id, n_links) of each row; key is the text's hash, label names its class (null without words).

    class_id: the smallest doc_id of all documents that links connect. n_links: the other documents
    with a similarity of at least the threshold, copies included.
    """
    sketch = materialise(sketches(docs), "sketches")
    classes = sketch.filter("class is not null").groupBy("class").agg(
        F.min(F.struct("doc_id", "key")).alias("rep"), F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.max("n").alias("n"))
    classes = materialise(classes.select("class", "first_id", "copies", "n", F.col("rep.doc_id").alias("rep_id"), F.col("rep.key").alias("rep_key")), "classes")
    reps = sketch.filter("class is not null").select("class", "signature", "bands").dropDuplicates(["class"])
    candidates = materialise(candidate_links(materialise(reps, "representatives"), threshold, tolerance), "candidates")
    found = materialise(verified_links(docs, components(candidates), classes, threshold), "verified")
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    labels = components(found.select("a", F.col("root").alias("b"))).withColumnRenamed("node", "_node")
    named = classes.select("class", "first_id", "copies").join(links, F.col("class") == F.col("a"), "left").join(
        labels, F.col("class") == F.col("_node"), "left").withColumn("label", F.coalesce("label", "class"))
    ids = named.groupBy("label").agg(F.min("first_id").alias("class_id"))
    per_class = materialise(named.join(ids, "label").select(
        F.col("class").alias("_class"), "class_id", F.col("label"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "near-classes")
    out = sketch.select("doc_id", "key", "class").join(per_class, F.col("class") == F.col("_class"), "left")
    alone = F.col("class").isNull()
    return out.select(
        "doc_id", "key", "label", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, threshold: float = 0.8, tolerance: float = 1e-9) -> DataFrame:
    """The rows of docs of which each class keeps one: the smallest doc_id (null last), then the smallest text hash.

    Texts without words stay. Of repeated rows of the kept document one stays; only these are shuffled for it.
    """
    near = join_near(docs, threshold, tolerance).filter("label is not null").select(
        "label", F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key").alias("row"))
    rows = materialise(near.groupBy("label", "row").agg(F.count("*").alias("times")), "near-rows")
    first = rows.groupBy("label").agg(F.min("row").alias("first")).withColumnRenamed("label", "_label")
    marked = rows.join(first, F.col("label") == F.col("_label"))
    stays = F.col("row").eqNullSafe(F.col("first"))
    keys = marked.filter(~stays | (F.col("times") > 1)).select(
        F.col("row.doc_id").alias("_doc"), F.col("row.key").alias("_key"), stays.alias("_stays"))
    keyed = docs.withColumn("_text", text_key())
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("_text").eqNullSafe(F.col("_key"))
    judged = keyed.join(keys, same, "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = judged.filter(F.col("_stays").isNull()).select(columns)
    repeated = judged.filter("_stays").dropDuplicates(["_doc", "_key"]).select(columns)
    return whole.unionByName(repeated)

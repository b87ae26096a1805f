"""The Jaccard join against all pairs, and one document per class."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickertide.llm import near_dup
from tickertide.llm import queries as Q
from tickertide.llm.components import components


def plain_sets(rows):
    out = []
    for _, text in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def plain_join(rows, threshold=0.8):
    sets, n = plain_sets(rows), len(rows)
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    shared = {}
    for held in holders.values():
        for pair in itertools.combinations(held, 2):
            shared[pair] = shared.get(pair, 0) + 1
    up, links = list(range(n)), [0] * n

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for (i, j), k in shared.items():
        if 10 * k >= 8 * (len(sets[i]) + len(sets[j]) - k):
            links[i] += 1
            links[j] += 1
            up[find(i)] = find(j)
    first = {}
    for i in range(n):
        if rows[i][0] is not None:
            first[find(i)] = min(first.get(find(i), 1 << 62), rows[i][0])
    return sorted((str(rows[i][0]), str(first.get(find(i))), links[i]) for i in range(n))


def made_rows():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(4000)]
    rows, k = [], 0
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([6, 40, 200]))]
        for _ in range(rng.choice([1, 2, 9, 40])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((k, " ".join(text)))
            k += 1
    rows += [(900, None), (901, ""), (902, ""), (903, "!!"), (904, "one two"), (905, "One, two"), (906, "one two three"), (None, "one TWO"), (None, "lonely words of a null id here"),
             (None, "other words with a null id there"), (904, "one two"), (907, "x" * 50_000), (908, "x" * 50_000), (909, "a b " * 20_000)]
    return rows


@pytest.mark.parametrize("block", [1000, 4])
def test_join_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class", F.lit(1)).withColumn("key", F.lit("k"))
    found = sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in near_dup.join_near(docs).collect())
    assert found == plain_join(rows)


def test_links_count_once_beside_an_empty_block(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 20)  # pairs of texts get four blocks, so that most are empty
    rng = random.Random(8)
    rows = []
    for k in range(0, 60, 2):
        words = [f"w{rng.randrange(10_000)}" for _ in range(40)]
        rows += [(k, " ".join(words)), (k + 1, " ".join([*words[:-1], "other"]))]
    found = sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in near_dup.join_near(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert found == plain_join(rows)


def test_one_of_each_class_stays(spark):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit(1)).withColumn("_doc2", F.lit("k"))
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    texts = [(r["doc_id"], r["text"]) for r in kept.collect()]
    worded = [t for t in texts if re.search("[a-z0-9]", (t[1] or "").lower())]
    assert all(n == 0 for _, _, n in plain_join(worded))
    assert len(texts) - len(worded) == 4
    sets = plain_sets(rows)
    classes = {(str(i), c) for i, c, _ in plain_join(rows)}
    ids = {i for i, _ in worded}
    assert all(int(c) in ids for i, c in classes if c != "None" and sets[[r[0] for r in rows].index(int(c))])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.join_near(docs).count() == 0 and near_dup.keep_one(docs).count() == 0


def test_query_equals_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in Q.table(spark, folder, "documents").collect()]
    found = sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in Q.QUERIES["op7_ngram_jaccard"](spark, folder).collect())
    assert found == plain_join(rows)


def test_pruning_keeps_pairs_at_the_threshold():
    least = near_dup.least_matches(0.8, 1e-9)
    rng = np.random.default_rng(3)
    lost = sum(rng.binomial(n, 0.8, 100_000).min() < m for n, m in least.items())
    assert lost == 0 and least[240] > 120


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 300).select((F.col("id") * 7 % 300).alias("a"), ((F.col("id") + 1) * 7 % 300).alias("b"))
    assert {r["label"] for r in components(links).collect()} == {0}

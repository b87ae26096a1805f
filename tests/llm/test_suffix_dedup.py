"""Suffix sorting against sorted(), and removed bytes against a table of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickertide.llm import queries as Q
from tickertide.llm import suffix_dedup as S


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("on_disk", [False, True])
def test_suffix_order(seed, on_disk):
    rng = random.Random(seed)
    n, symbols = rng.choice([1, 2, 5, 60, 400]), rng.choice([1, 2, 3, 20])
    body = [rng.randrange(1, symbols + 1) for _ in range(n)]
    if seed % 3 == 0:
        body = (body[:7] * n)[: n + 3]
    text = np.array([*body, 0], dtype=np.int16)
    assert S.suffix_order(text, len(text), on_disk).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def plain(texts, length=200):
    windows = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - length + 1):
            if windows[t[i : i + length]] > 1:
                gone[i : i + length] = True
        steps = np.diff(np.concatenate([[0], gone.astype(int)]))
        kept = bytes(c for c, g in zip(t, gone, strict=False) if not g)
        out.append((len(t), int(gone.sum()), int((steps == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def made_texts():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, other = prose(90), prose(70)
    texts = [prose(rng.randrange(5, 200)) for _ in range(25)]
    texts += [f"{prose(30)}{passage}{prose(20)}" for _ in range(9)] + [f"{prose(3)}{other[:k]}{prose(3)}" for k in (150, 199, 200, 201, 210, 260)]
    texts += [passage, passage, other, "x" * 1200, "ab" * 400, "x" * 199, "y" * 200, "z" * 201, "", None, passage[:100] + passage[100:] * 2]
    near = list(passage)
    for _ in range(14):
        near[rng.randrange(len(near))] = "#"
        texts.append("".join(near))
    return texts


@pytest.mark.parametrize("shard_bytes,most_kinds", [(1 << 20, 10_000), (2_000, 10_000), (1 << 20, 4)])
def test_removed_bytes(spark, shard_bytes, most_kinds):
    texts = made_texts()
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, prefix := "n" + texts[1]), (None, prefix + "?")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("N_bytes", F.lit(1))
    found = S.remove_repeats(docs, shard_bytes=shard_bytes, most_kinds=most_kinds)
    assert found.columns == ["doc_id", "text", "key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "clean_text"] or set(found.columns) == {"doc_id", "text", "key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "clean_text"}
    wanted = sorted((str(i), *p) for (i, _), p in zip(rows, plain([(t or "").encode() for _, t in rows]), strict=True))
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found.collect())
    assert got == wanted


def test_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_on_test_tables(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in Q.table(spark, folder, "documents").collect()]
    wanted = sorted((str(i), *p) for (i, _), p in zip(rows, plain([t.encode() for _, t in rows]), strict=True))
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in Q.QUERIES["op10_suffix_dedup"](spark, folder).collect())
    assert got == wanted

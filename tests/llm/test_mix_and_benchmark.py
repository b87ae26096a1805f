"""Mixing and decontamination on odd rows; the SQL comparison of all queries that have one."""

import hashlib
import random
import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tickertide.llm import decontam, mixing
from tickertide.llm import queries as Q

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    found = Q.QUERIES[name](spark, SMALL)
    wanted = connection.execute(Q.ORACLES[name])
    columns = sorted(d[0] for d in wanted.description)
    at = {d[0]: k for k, d in enumerate(wanted.description)}
    assert sorted(found.columns) == columns
    assert sorted(repr([r[c] for c in columns]) for r in found.collect()) == sorted(repr([r[at[c]] for c in columns]) for r in wanted.fetchall())


@pytest.mark.parametrize("name", ["op1_quality_rules", "op6_license_scan"])
def test_native_queries_run_no_python(spark, name):
    plan = Q.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


# --- mixing ---


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        level = rest / max(1, sum(weight[s] for s in names if s not in full))
        more = {s for s in names if weight[s] * level > most * sizes[s]}
        if more == full:
            return {s: min(most * sizes[s], weight[s] * level) for s in names}
        full = more


def test_mix_of_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randrange(1, 5) for _ in range(rng.randrange(0, 60))), rng.choice(["b", "a", "ä", "Z", None])) for i in range(400)]
    rows += [(1, rows[1][1], rows[1][2]), (None, "one two", "a"), (900, None, "empty"), (901, "", "empty"), (902, "q " * 30_000, "big"), (903, "x", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("Target", F.lit("clash")).withColumn("copy", F.lit(0))
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    wanted = plain_targets(sizes)
    mixed = mixing.mix_sources(docs)
    found = mixed.collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(wanted[r["source"]])
        assert r["taken"] <= 2 * r["size"] and (r["taken"] == 0 or r["taken"] % r["size"] == 0)
    assert sum(wanted.values()) == pytest.approx(1.5 * sum(sizes.values()))
    again = {(r["doc_id"], r["text"]): r["taken"] for r in mixing.mix_sources(docs.repartition(5)).collect()}
    assert all(again[(r["doc_id"], r["text"])] == r["taken"] for r in found)
    copies = mixing.emit(mixed)
    assert copies.count() == sum(r["copies"] for r in found) and copies.agg(F.min("copy")).first()[0] == 1
    assert mixing.mix_sources(docs.limit(0)).count() == 0


# --- decontamination ---


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, window=13):
    grams = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[i : i + window]), set()).add(name)
    out = []
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in grams:
                    hit.update(range(i, i + n))
                    names |= grams[g] - {None}
        out.append((str(doc), len(w), len(hit), ",".join(sorted(names)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def made():
    rng = random.Random(4)
    vocabulary = [f"v{k}" for k in range(30)]
    items = [(str(k), " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 12, 13, 14, 40])))) for k in range(25)]
    items += [("a", "same Words here"), ("b", "SAME words, here"), (None, "null id item of these words"), ("e", ""), ("n", None), ("0", items[0][1])]
    docs = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 80)))) for k in range(60)]
    for k in range(60):
        item = rng.choice(items)[1] or ""
        w = item.split()
        cut = " ".join(w[rng.randrange(0, 3) : len(w) - rng.randrange(0, 3)])
        docs.append((100 + k, f"É{rng.choice(vocabulary)} x {cut} y " + "z " * rng.choice([0, 10, 400])))
    docs += [(900, None), (901, ""), (902, "--"), (903, "null id item of these words"), (903, "null id item of these words"), (None, "same words here"), (904, "q " * 50_000 + items[4][1])]
    return docs, items


@pytest.mark.parametrize("block_words", [500_000, 60])
def test_hits_equal_a_plain_version(spark, block_words):
    docs, items = made()
    given = spark.createDataFrame(docs, "doc_id long, text string").withColumn("HITS", F.lit(1))
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    found = decontam.decontaminate(given, benchmark, block_words=block_words)
    rows = found.collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], ",".join(r["items"]), r["contaminated"]) for r in rows) == plain(docs, items)
    for r in rows:
        kept = words(r["clean_text"])
        if r["contaminated"]:
            assert len(kept) == r["n_words"] - r["n_hit"]
        elif r["text"] is not None and not any(h["last"] - h["first"] >= 50 for h in r["hits"]):
            assert r["clean_text"] == r["text"]


def test_automata_are_built_in_tasks(spark, monkeypatch):
    docs, items = made()
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    automata, count = decontam.built_blocks(benchmark, 13, 60)
    found = {r["block"]: r["content"] for r in automata.collect()}
    assert count > 3 and set(found) <= set(range(count))
    sizes = []
    for content in found.values():
        block = decontam.held_block("one", bytes(content), 13)
        decontam._held.clear()
        sizes.append(len(block.automaton.names))
    assert sum(sizes) == sum(1 for _, text in items if words(text))
    # a stored automaton may take several rows
    monkeypatch.setattr(decontam, "PIECE", 1000)
    pieces, _ = decontam.built_blocks(benchmark, 13, 500_000)
    rows = pieces.orderBy("piece").collect()
    assert len(rows) > 1 and [r["piece"] for r in rows] == list(range(len(rows)))
    given = spark.createDataFrame(docs, "doc_id long, text string")
    rows = decontam.decontaminate(given, benchmark).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], ",".join(r["items"]), r["contaminated"]) for r in rows) == plain(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    nothing = spark.createDataFrame([], "item_id long, text string")
    row = decontam.decontaminate(docs, nothing).first()
    assert (row["n_words"], row["n_hit"], row["contaminated"], row["clean_text"]) == (2, 0, False, "some words")
    assert decontam.decontaminate(docs.limit(0), nothing).count() == 0
    assert hashlib.sha256(b"").hexdigest() == docs.select(Q.digest(F.array().cast("array<string>"))).first()[0]

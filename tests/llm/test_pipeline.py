"""The pipeline's stages, each on its predecessor's output, against plain versions."""

import re

import duckdb
import pytest

import corpus_pipeline
from tests.llm.test_near_dup import plain_join
from tests.llm.test_text_rules import plain_counts, plain_personal
from tickertide.llm import queries as Q

FOLDER = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(text, items):
    w, hit = words(text), set()
    for n in {len(i) for i in items}:
        grams = {i for i in items if len(i) == n}
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in grams:
                hit.update(range(k, k + n))
    return len(w), len(hit)


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.materialise(stage(spark, docs, FOLDER), "test-stage")
        out.append((name, before, docs))
    return {name: (before, after) for name, before, after in out}


def rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_columns(stages):
    names = [c for c in stages["quality_rules"][0].columns]
    for name, (_, after) in stages.items():
        assert after.columns == names or name == "source_mix"
    assert stages["source_mix"][1].columns[: len(names)] == names


def test_quality(stages):
    before, after = stages["quality_rules"]
    wanted = []
    for i, t in rows(before):
        n, _, _, _, repeated = plain_counts(t)
        if n >= 10 and 100 * repeated <= 20 * n:
            wanted.append((i, t))
    # no line of so small a table stands in over fifty surroundings
    assert rows(after) == wanted and len(wanted) < before.count()


def test_near_copies(stages):
    before, after = stages["ngram_jaccard"]
    given = rows(before)
    first = {i: c for i, c, _ in plain_join(given)}
    assert rows(after) == [(i, t) for i, t in given if first[str(i)] == str(i)] and after.count() < before.count()


def test_decontamination(stages):
    before, after = stages["decontamination"]
    items = set()
    for (text,) in duckdb.sql(f"select text from '{FOLDER}/benchmark.parquet'").fetchall():
        w = words(text)
        items |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    wanted = []
    for i, t in rows(before):
        n, hit = plain_hits(t, items)
        if not (hit and 20 * hit >= n):
            wanted.append(i)
    assert [i for i, _ in rows(after)] == wanted and len(wanted) < before.count()
    texts = dict(rows(before))
    assert all(t == texts[i] for i, t in rows(after) if plain_hits(t, items)[1] < 50)


def test_personal_data(stages):
    before, after = stages["personal_data"]
    texts, changed = dict(rows(before)), 0
    assert len(texts) == after.count()
    for r in after.collect():
        assert not plain_personal(r["text"]) and r["n_chars"] == (r["n_chars"] if r["text"] == texts[r["doc_id"]] else len(r["text"]))
        changed += r["text"] != texts[r["doc_id"]]
        if not plain_personal(texts[r["doc_id"]]) and r["text"] != texts[r["doc_id"]]:
            assert "<" in r["text"]
    assert changed


def test_mix(stages, tmp_path):
    before, after = stages["source_mix"]
    before.toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    wanted = {i: (size, target, taken) for i, size, _, target, taken in connection.execute(Q.MIXING_SQL).fetchall()}
    got = {}
    for r in after.collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert set(got) == {i for i, (size, _, taken) in wanted.items() if taken}
    for i, copies in got.items():
        assert sorted(r["copy"] for r in copies) == list(range(1, len(copies) + 1))
        assert wanted[i] == (copies[0]["size"], copies[0]["target"], copies[0]["size"] * len(copies))


def test_run_gives_the_same_rows(spark, stages):
    found = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(str, found.select("doc_id", "copy", "text").collect())) == sorted(map(str, stages["source_mix"][1].select("doc_id", "copy", "text").collect()))

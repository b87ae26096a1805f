"""The audit of sources against a plain version in whole numbers; the SQL runs in test_against_sql's way."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb

from tickertide.llm import queries as Q
from tickertide.llm import source_audit

SMALL = "/root/testdata/sf0.001"


def plain_audit(rows, least=10, top=10):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        counts[lang, source].update(terms)
        documents[lang].update(set(terms))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in documents[lang].items() if n >= least]
        p_of = lambda c, n: 1 + 10**9 * (c + 2) // (n + 2 * len(kept))
        f = lambda p, q: (p - q) ** 2 // (p + q)
        totals = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: p_of(counts[lang, s][t], totals[s]) for t in kept} for s in sources}
        whole = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        q = {t: p_of(n, sum(whole.values())) for t, n in whole.items()}
        parts = defaultdict(list)
        for a, b in permutations(sources, 2):
            parts[a, "pair"].append((b, sum(f(p[a][t], p[b][t]) for t in kept)))
        for s in sources:
            parts[s, "term"] = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
        for (source, part), items in parts.items():
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, i, v, k + 1) for k, (i, v) in enumerate(items[: top if part == "term" else None])]
    return sorted(out)


def test_against_the_plain_version(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "ENTRIES", 7)
    rng = random.Random(3)
    words = ["Éa", "b", "C", "d1e", "f_g", "ß", "漢字", "h", "i", "j"]
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["s", "t", "u", None, "s2"]), " ".join(rng.choices(words, k=rng.randrange(6)))) for _ in range(200)]
    rows += [("en", "t", "b b c")] * 30 + [("en", "u", "b b c")] * 3 + [("fr", "s", None), ("fr", "t", ""), ("it", "only", "x"), (None, None, None)]
    rows += [("es", f"s{k % 12}", f"wort w{'xyzuv'[k % 5]} q{'ab'[k % 2]}") for k in range(90)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, value int, TERM string").repartition(5)
    found = sorted(tuple(r) for r in source_audit.audit_sources(docs).collect())
    assert found == plain_audit(rows)
    assert sorted(tuple(r) for r in source_audit.audit_sources(docs, least_documents=3, top=2).collect()) == plain_audit(rows, 3, 2)
    assert source_audit.audit_sources(docs.limit(0)).count() == 0


def test_a_text_is_read_once(spark):
    rows = [("en", f"s{k % 3}", "same text") for k in range(100)] + [("de", "s0", "same text"), ("en", "s0", "other")]
    found = source_audit.collapse(spark.createDataFrame(rows, "lang string, source string, text string")).collect()
    assert len(found) == 3
    hot = next(r for r in found if r["lang"] == "en" and r["text"] == "same text")
    assert sorted(map(tuple, hot["copies"])) == [("s0", 34), ("s1", 33), ("s2", 33)]


def test_counts_beyond_64_bits_stay_exact(spark):
    n, total, v = 10**15 + 7, 10**18 + 9, 10**9
    df = spark.createDataFrame([(n, total, v)], "n long, total long, v long")
    p = df.select(source_audit.probability(df.n, df.total, df.v).alias("p")).first()["p"]
    assert p == 1 + 10**9 * (n + 2) // (total + 2 * v)


def test_query_against_its_sql(spark):
    found = sorted(tuple(r) for r in Q.QUERIES["op12_source_audit"](spark, SMALL).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet/*.parquet')" if __import__("os").path.isdir(f"{SMALL}/documents.parquet") else f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert found == sorted(con.execute(Q.AUDIT_SQL).fetchall())
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("lang", "source", "text").collect()
    assert found == plain_audit([tuple(r) for r in docs])

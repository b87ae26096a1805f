"""Periodic runs against a plain search over all periods, and the registered query against the same."""

import hashlib
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickertide.llm import periodic
from tickertide.llm import queries as Q

SMALL = "/root/testdata/sf0.001"


def plain_runs(words, least_words=24, least_exponent=3):
    n, out = len(words), {}
    for q in range(1, n // least_exponent + 1):
        k = 0
        while k + q < n:
            if words[k] != words[k + q]:
                k += 1
                continue
            start = k
            while k + q < n and words[k] == words[k + q]:
                k += 1
            length = k - start + q
            if length >= max(least_words, least_exponent * q):
                out.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


def as_words(numbers):
    return [b"w%d" % x for x in numbers]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=90), max_size=4), st.integers(1, 12), st.integers(0, 80))
def test_short_alphabets(texts, period, length):
    # one text also gets a stretch of a period, so that long runs occur
    if texts and texts[0]:
        texts = [texts[0] + (texts[0][:period] * 80)[:length] + texts[-1]] + texts
    words = [as_words(t) for t in texts]
    found = periodic.runs_of_texts(words)
    for t, runs in zip(words, found):
        assert runs == plain_runs(t)
        assert periodic.collapsed(t, runs) == plain_collapsed(t, runs)


def test_parts_and_long_runs():
    rng = random.Random(7)
    texts = []
    for k in range(40):
        base = [rng.randrange(30) for _ in range(rng.randrange(1, 120))]
        p = rng.randrange(1, 40)
        texts.append(as_words(base + (base[:p] or [1]) * rng.randrange(1, 9) + base))
    texts += [as_words([1] * 3000), as_words([1, 2] * 1500 + [1]), [], as_words([1] * 23), as_words([1] * 24)]
    expected = [plain_runs(t) for t in texts]
    assert periodic.runs_of_texts(texts) == expected
    assert periodic.runs_of_texts(texts, most=50) == expected
    assert expected[-1] == [(0, 24, 1)] and expected[-2] == []


def test_smaller_children_hold_all_but_the_largest():
    words, ends = periodic.numbered([[b"a", b"b"] * 6])
    sa, isa, lcp = periodic.suffix_array(words, ends)
    assert [words[k:].tolist() for k in sa] == sorted(words[k:].tolist() for k in range(12))
    assert (isa[sa] == range(12)).all()
    for lb, rb, d, child, child_end in periodic.smaller_children(lcp):
        assert lb <= child <= child_end <= rb and d == min(lcp[lb + 1 : rb + 1]) and child_end - child < rb - lb


def test_two_million_words_in_one_text():
    words = as_words(range(50)) * 2000 + as_words(range(100_000, 200_000))
    assert periodic.runs_of_texts([words]) == [[(0, 100_000, 50)]]


def test_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (None, "a " * 30, 5), (3, "xé y\x0bz " * 30, 5), (3, "xé y\x0bz " * 30, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, RUNS int").withColumn("source", F.lit("s"))
    out = periodic.detect_runs(docs)
    assert out.columns == ["doc_id", "text", "source", "n_words", "runs", "best", "collapsed"]
    found = out.collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == 5
    assert by_id[1]["n_words"] == by_id[2]["n_words"] == 0 and by_id[1]["runs"] == [] and by_id[1]["collapsed"] == ""
    assert by_id[None]["collapsed"] == "a" and tuple(by_id[None]["best"]) == (0, 30, 1)
    assert by_id[3]["n_words"] == 60 and by_id[3]["collapsed"] == "xé y z"
    assert periodic.detect_runs(docs.limit(0)).count() == 0


def test_query_against_the_plain_search(spark):
    given = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in Q.QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    assert len(found) == len(given)
    many = 0
    for doc_id, text in given:
        words = (text or "").encode().split()
        n = len(words)
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words) if n < 3000 else periodic.runs_of_texts([words])[0]
        many += len(runs) > 0
        r = found[doc_id]
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else (None, None, None)
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapsed(words, runs)).hexdigest()
    assert many > 5

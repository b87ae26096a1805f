"""Quality rules, license scans and personal data against plain versions."""

import hashlib
import re
from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickertide.llm import licenses, pii, quality
from tickertide.llm import queries as Q

SMALL = "/root/testdata/sf0.001"


# --- quality ---


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_counts_on_odd_texts(spark):
    texts = [None, "", " \n\t", "a b c d e a b c d e", "a " * 30, "é#\nx\nx\n\n x", "a b c d e f g a b c d e b c d e f", "w" * 100_000, "1 2 3 4", "1 2 3 4 5"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit(None).cast("string")).withColumn("KEPT", F.lit(1))
    found = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    for i, text in enumerate(texts):
        r = found[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain_counts(text), text
        assert r["clean_text"] == text
    assert quality.judge(docs.limit(0)).count() == 0


def plain_removed(rows, most=50):
    """Per row the words and the text that lines above the limit leave."""
    normal = lambda x: " ".join(re.sub("[0-9]+", "0", x.lower()).split())
    holders = {}
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if normal(line):
                holders.setdefault((source, normal(line)), set()).add(text)
    out = []
    for _, text, source in rows:
        lines = (text or "").split("\n")
        gone = [len(holders.get((source, normal(x)), ())) > most for x in lines]
        removed = sum(len(x.split()) for x, g in zip(lines, gone) if g)
        words = len((text or "").split())
        failed = words < 10 or 100 * plain_counts(text)[4] > 20 * words
        out.append((removed, None if text is None else "\n".join(x for x, g in zip(lines, gone) if not g), not failed and words - removed >= 0.3 * words))
    return out


def page(i, n=60):
    """Words that no other page has."""
    return " ".join(f"w{chr(97 + k % 26)}{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i // 100]}{'q' * (k // 26)}" for k in range(n))


def check_rows(spark, rows):
    """Judged rows agree with the plain rule, and the SQL with both."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    found = sorted((r["doc_id"], r["text"], r["source"], r["removed_words"], r["clean_text"], r["kept"]) for r in quality.judge(docs).collect())
    plain = sorted((*row, *x) for row, x in zip(rows, plain_removed(rows)))
    assert found == plain
    con = duckdb.connect()
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "source"])  # noqa: F841
    sql = con.execute(f"SELECT doc_id, removed_words, kept FROM ({Q.QUALITY_SQL}) ORDER BY ALL").fetchall()
    assert sql == sorted((x[0], x[3], x[5]) for x in plain)
    return {x[0]: x[3:] for x in plain}


def test_lines_above_the_limit_go(spark):
    rows = []
    for i in range(60):  # a shared line between lines that differ, in a host
        rows.append((i, f"words that are one of a kind here {'z' * i} y z\nsubscribe to our letter now {i}\nmore words of document {'q' * i} and so on", "a"))
    # near-copies are documents: what more than 50 of them share goes, and little of them is left
    rows += [(100 + i, f"a text with copies of some lines in it\nwhich all copies share word by word\nand one that differs {'x' * i}", "a") for i in range(60)]
    rows += [(200, "subscribe to our letter now 1\nfive more words stand here now", "a"), (201, "subscribe to our letter now 1\n" * 2, "b")]
    rows += [(200, "subscribe to our letter now 1\nfive more words stand here now", "a"), (200, "subscribe to our letter now 1\nfive more words stand here now", "b")]
    # exact copies are one document
    rows += [(300 + i, "the same page with a line of its own\nand one more line of it", "a") for i in range(80)]
    found = check_rows(spark, rows)
    assert all(found[i][0] == 6 and found[i][2] for i in range(60))
    assert all(found[100 + i][0] == 16 and not found[100 + i][2] for i in range(60))
    assert all(found[300 + i][0] == 0 and found[300 + i][2] for i in range(80))
    strict = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"), least_kept=0.6).filter("doc_id = 200 and source = 'a'").first()
    assert strict["removed_words"] == 6 and not strict["kept"]


def test_hosts_that_are_mostly_boilerplate(spark):
    menu = "\n".join(page(900 + k, 10) for k in range(10))
    rows = []
    for k, own in enumerate((10, 15, 20, 30, 40, 100, 1000)):
        rows += [(1000 * k + i, f"{menu}\n{page(i, own)}", f"host{own}") for i in range(200)]
    # exactly as many documents as the limit, and a null host
    rows += [(9000 + i, f"{menu}\n{page(i, 60)}", None) for i in range(50)] + [(9100 + i, f"{menu}\n{page(i, 60)}", "none") for i in range(51)]
    found = check_rows(spark, rows)
    words = 100
    for k, own in enumerate((10, 15, 20, 30, 40, 100, 1000)):
        assert all(found[1000 * k + i][0] == words and found[1000 * k + i][2] == (own >= 0.3 * (own + words)) for i in range(200))
    assert all(found[9000 + i][0] == 0 for i in range(50)) and all(found[9100 + i][0] == words for i in range(51))


def test_shared_passages_of_several_lines_go(spark):
    header, footer = "our shop\nhome news contact", "all rights are ours\nwrite to us at any time\nand read the terms"
    menu = "first entry\nsecond entry"
    rows = [(i, f"{header}\n{page(i)}\n{menu}\n{page(100 + i)}\n{footer}", "a") for i in range(60)]
    rows += [(200 + i, f"{header}\n{page(i)}\n{footer}", "b") for i in range(50)]
    found = check_rows(spark, rows)
    assert all(found[i][:2] == (23, f"{page(i)}\n{page(100 + i)}") and found[i][2] for i in range(60))
    assert all(found[200 + i][0] == 0 for i in range(50))


# --- licenses ---


def plain_base(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = []
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(places)


LICENSED = [
    "CC BY cc-by cc by cc", None, "", "All rights reserved. ALL RIGHTS reserved all rights", "GNU General Public License, version 3", "ccby cc  ++ BY",
    "All Rights Kreserved Kcc by", "general public general public license license", "x" * 50_000 + " cc by", "by",
    "Licensed under the Apache License, Version 2.0.", "licensed under the well known apache license version 2 0", "the license", "Released under the MIT License.",
    "cc by " * 3_000,
]


def test_license_places(spark):
    rows = list(enumerate(LICENSED)) + [(0, LICENSED[0]), (None, "cc by"), (None, "cc by nothing")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Labels", F.lit(3)).withColumn("x", F.lit(1))
    found = licenses.scan_licenses(docs).collect()
    assert len(found) == len(rows)
    texts = dict(enumerate(LICENSED))
    for r in found:
        if r["doc_id"] is None:
            assert r["n_base"] == 1 and r["first_word"] == 0
            continue
        n, places = plain_base(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"]) == (n, len(places)), r
        assert [(p["start"], p["label"]) for p in r["places"] if p["base"]] == places
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places})) and 0 <= r["score"] <= 1
    labels = {r["doc_id"]: r["labels"] for r in found}
    assert labels[10] == "apache-2.0" and labels[13] == "mit" and labels[12] == "" and "cc-by" in labels[0]
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def plain_passages(text, least=0.6):
    """Labels of the longer templates: four-word windows in the order of the template, on diagonals at most NEIGHBOURS apart."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams, labels = {}, set()
    for i in range(len(words) - 3):
        grams.setdefault(tuple(words[i : i + 4]), []).append(i)
    for passage, label in licenses.PASSAGES:
        t = passage.split()
        needed = len(t) - 3
        points = sorted((p, a) for a in range(needed) for p in grams.get(tuple(t[a : a + 4]), ()))
        for low in {p - a for p, a in points}:
            chains = []
            for p, a in [x for x in points if low <= x[0] - x[1] <= low + licenses.NEIGHBOURS]:
                chains.append((p, a, 1 + max((n for q, b, n in chains if q < p and b < a), default=0)))
            if chains and max(c[2] for c in chains) >= least * needed:
                labels.add(label)
    return labels


def test_longer_templates_are_verified_in_order(spark):
    import random

    rng = random.Random(5)
    texts = ["released under the mit released under the mit", "released under the mit license released under the mit license", "under the mit license released under the mit"]
    for passage, _ in licenses.PASSAGES:
        t = passage.split()
        texts += [passage.upper(), " ".join(t[:-1]), " ".join(t[len(t) // 2 :]), " ".join(t[len(t) // 2 :] + t[: len(t) // 2]), " ".join(t[:6]) + " well known " + " ".join(t[6:]), " ".join(t + t)]
        for _ in range(6):
            cut = list(t)
            for _ in range(rng.randrange(1, 4)):
                k = rng.randrange(len(cut))
                cut[k : k + rng.randrange(2)] = rng.choice([["x"], [], ["x", "y", "z"], cut[:3]])
            texts.append(" ".join(["before", *cut, "after"]))
    # two templates that overlap, and very many copies at a distance of four words
    texts += [licenses.PASSAGES[0][0] + " the license you may not use this file except in compliance with the license", "released under the mit " * 2000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: {p["label"] for p in r["places"] if not p["base"]} for r in licenses.scan_licenses(docs).collect()}
    assert found == {k: plain_passages(t) for k, t in enumerate(texts)}
    assert found[0] == set() and found[1] == {"mit"} and sum(map(bool, found.values())) > 20
    assert all(0 <= r["score"] <= 1 for r in licenses.scan_licenses(docs).collect())


def test_license_query_on_test_tables(spark):
    texts = {r["doc_id"]: r["text"] for r in Q.table(spark, SMALL, "documents").collect()}
    rows = Q.QUERIES["op6_license_scan"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, places = plain_base(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (n, len(places), ",".join(sorted({x for _, x in places})))


# --- personal data ---


def plain_personal(text):
    """The base kinds as the contract words them."""
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    for k, (kind, pattern, ok) in enumerate([
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m[0])) <= 15),
    ]):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text) if ok(m)]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out)]


PERSONAL = [
    None, "", "é a.b@c.de, x@y @z.w a@b@c.d.e q@r..s +1@t.uu", "1.2.3.4.5.6.7.8 256.1.1.1.2 0001.2.3.004 1.2.3 1.2.3.4.", "4111 1111 1111 1111 and 4111-1111-1111-1112 and 41111111111111114111",
    "+1 (988) 555-2485 +12 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +49.30.123456", "+4111 1111 1111 1111", "a@" * 1000 + "b.c", "1" * 5000 + " 1.1.1.1", "9" * 20 + "@x.y",
    "Call Dr. Anna Smith at 555-123-4567, born 1980-02-30 or 1980-02-28; id 123-45-6789", "iban DE89370400440532013000", "--@--.--.", "0000000000.0.0.0 0.0.0.0000000000000256",
]


def test_personal_spans(spark):
    rows = list(enumerate(PERSONAL)) + [(2, PERSONAL[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Spans", F.lit(3))
    model = pii.fit(docs)
    for use in (model, pii.Model()):
        found = pii.find_personal_data(docs, use).collect()
        assert len(found) == len(rows)
        for r in found:
            spans = [f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"] if s["kind"] in pii.BASE]
            assert spans == plain_personal(PERSONAL[r["doc_id"]]), r["doc_id"]
            assert (r["clean_text"] is None) == (PERSONAL[r["doc_id"]] is None)
    assert pii.find_personal_data(docs.limit(0), pii.fit(docs.limit(0))).count() == 0
    assert pii.masked(b"ab cd ef", [(0, 2, "email"), (1, 4, "ip"), (6, 8, "card")]) == b"<EMAIL>d <CARD>"


def test_candidates_found_once_equal_two_passes(spark):
    rows = list(enumerate(PERSONAL)) + [(2, PERSONAL[2]), (None, "née Anna Maria Smith, Mr John Miller Dr. Weber")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Spans", F.lit(3)).withColumn("more", F.lit("x"))
    wanted = pii.find_personal_data(docs, pii.fit(docs), with_text=False)
    found = pii.detect(docs)
    assert found.columns == ["doc_id", "text", "more", "spans"]

    def listed(df):
        return sorted(repr((r["doc_id"], r["text"], [(s["kind"], s["start"], s["end"], round(s["score"], 9)) for s in r["spans"]])) for r in df.collect())

    assert listed(found) == listed(wanted)
    assert pii.detect(docs.limit(0)).count() == 0 and pii.detect(docs, keep=["doc_id"]).columns == ["doc_id", "spans"]


def test_gazetteer_proposes_names(spark):
    def persons(text, names=pii.NAMES):
        return [text.encode()[a:b].decode() for a, b, kind in pii.candidates(text.encode(), names) if kind == "person"]

    assert persons("saw Anna Maria Smith and Peter at Mr John Miller's; Anna, JohnSmith XAnna Lee") == ["Mr John Miller", "Anna Maria Smith"]
    assert persons("Paul Anna Weber Klein Wolf Green") == ["Paul Anna Weber Klein"] and persons("Dr Anna Lee Maria Bo") == ["Dr Anna Lee", "Maria Bo"]
    table = spark.createDataFrame([("Zoe", "given"), ("Quux", "family"), (None, "given")], "name string, kind string")
    own = pii.names_of(table)
    assert persons("Zoe Bar met Anna Weber", own) == ["Zoe Bar"]
    with pytest.raises(ValueError):
        pii.names_of(table, 1)


def test_context_decides_beyond_the_votes():
    import numpy as np

    # equal votes on one kind; the contexts of right and wrong candidates differ
    rows = [(7, 1, 2, 2, 1, 1, 1, 0, 1, 3), (7, 1, 2, 2, 2, 0, 0, 0, 1, 5), (7, 1, 2, 2, 1, 2, 1, 0, 1, 3), (7, 1, 2, 2, 1, 2, 1, 0, 1, 5)]
    model = pii.train(np.array(rows), np.array([500.0, 500.0, 20.0, 20.0]))
    asked = [(7, 1, 2, 2, 2, 2, 2, 0, 1, 3), (7, 1, 2, 2, 2, 2, 2, 0, 1, 5)]
    same, other = model.scores(asked)
    assert same > other + 0.1
    assert len({pii.features_of(b"555-1234", before)[2] for before in (b"", b"call ", b"CALL: ")}) == 2


def test_reliabilities_are_learnt():
    import numpy as np

    rng = np.random.default_rng(1)
    right = rng.random(20_000) < 0.4
    good = np.where(rng.random(20_000) < 0.95, right, ~right).astype(int)
    fair = np.where(rng.random(20_000) < 0.85, right, ~right).astype(int)
    other = np.where(rng.random(20_000) < 0.85, right, ~right).astype(int)
    chance = (rng.random(20_000) < 0.5).astype(int)
    rows = np.stack([np.zeros(20_000, int), np.zeros(20_000, int), good, fair, other, chance, np.full(20_000, 2)], axis=1)
    patterns, n = np.unique(rows, axis=0, return_counts=True)
    model = pii.train(patterns, n.astype(float))
    table = model.reliabilities
    assert abs(table[0, 1, 1] - 0.95) < 0.03 and abs(table[1, 1, 1] - 0.85) < 0.03 and abs(table[3, 1, 1] - 0.5) < 0.03
    predicted = np.array(model.scores([tuple(r) for r in rows])) > 0.5
    assert (predicted == right).mean() > 0.94


def test_personal_query_on_test_tables(spark):
    texts = {r["doc_id"]: r["text"] for r in Q.table(spark, SMALL, "documents").collect()}
    for r in Q.QUERIES["op8_pii"](spark, SMALL).collect():
        spans = plain_personal(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert r["n_email"] == sum(s.startswith("email") for s in spans) and set(spans) <= set(r["spans"].split(",")) | {""}

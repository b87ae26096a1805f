"""License scans by diagonal voting.

Texts are lower-cased (A-Z) and cut into words. The hashes of all rolling word pairs (and of the four words
from there) are joined to the places where they stand in the templates, a constant table. A hit
votes for the diagonal: its place in the text minus its place in the template. Votes are counted
per document, template and diagonal, each place of the template once. A short phrase is found where all its
pairs voted for one diagonal. For long templates the votes of diagonals at most NEIGHBOURS apart (words put in or left
out) are taken together and verified: the longest sequence of hits that ascends in the text and in the template must
hold at least `least` of the template's four-word hashes, so words out of order or said twice do not count. Of a
chain of neighbouring diagonals the best such place is reported. All of it is DataFrame functions.

The templates are constants of this module, so the broadcast table has a fixed size. Rows are kept apart
by doc_id and text hash.

Nulls: a null text is empty and has no words. Repeated rows get the same result each. Empty tables work.
Columns of the input with the names this makes are replaced.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickertide.functions.text import let
from tickertide.llm.common import FOLDED_GAP, fold, others, text_key
from tickertide.sources.handover import materialise

#: Short phrases: (phrase, label).
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Longer passages: (words, label).
PASSAGES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that", "bsd"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution", "cc"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
)
MADE = ["n_words", "places", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
PAIR, LONG = 2, 4
NEIGHBOURS = 4


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(fold(text), FOLDED_GAP), "")


def rolling(words: Column) -> Column:
    """Structs (place, pair, four) for each word that another follows, of an array evaluated once."""
    places = F.when(F.size(words) >= PAIR, F.sequence(F.lit(0), F.size(words) - PAIR)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(
        i.alias("place"), F.xxhash64(*[F.get(words, i + k) for k in range(PAIR)]).alias("pair"),
        F.xxhash64(*[F.get(words, i + k) for k in range(LONG)]).alias("four")))


def template_places(spark: SparkSession) -> DataFrame:
    """(template, label, base, needed, at, t_pair, t_four): t_four is null for phrases."""
    rows = [(k, label, k < len(PHRASES), words.split()) for k, (words, label) in enumerate(PHRASES + PASSAGES)]
    table = spark.createDataFrame(rows, "template int, label string, base boolean, words array<string>")
    grams = F.when(F.col("base"), F.size("words") - PAIR + 1).otherwise(F.size("words") - LONG + 1)
    placed = table.withColumn("needed", grams).select("template", "label", "base", "needed", F.inline(let(F.col("words"), rolling)))
    return placed.filter(F.col("place") < F.col("needed")).select(
        "template", "label", "base", "needed", F.col("place").alias("at"), F.col("pair").alias("t_pair"),
        F.when(~F.col("base"), F.col("four")).alias("t_four"))


def vote(docs: DataFrame, least: float = 0.6) -> DataFrame:
    """(doc_id, key, label, base, start, end, coverage) of each verified place; end is exclusive, in words."""
    grams = docs.select("doc_id", text_key().alias("key"), F.inline(let(words_of(F.col("text")), rolling)))
    # the templates are constants: a few hundred rows at any input size
    templates = F.broadcast(template_places(docs.sparkSession))
    on = (F.col("pair") == F.col("t_pair")) & (F.col("t_four").isNull() | (F.col("t_four") == F.col("four")))
    hits = grams.join(templates, on).select(
        "doc_id", "key", "template", "label", "base", "needed", "at", (F.col("place") - F.col("at")).alias("diagonal"))
    by = ["doc_id", "key", "template", "label", "base", "needed"]
    # a repeated row votes once, and so does a place of the template
    diagonals = materialise(hits.groupBy(*by, "diagonal").agg(F.array_sort(F.collect_set("at")).alias("ats")), "license-diagonals")
    found = ["doc_id", "key", "label", "base", "start", "end", "coverage"]

    whole = diagonals.filter(F.col("base") & (F.size("ats") == F.col("needed")))
    phrases = whole.select("doc_id", "key", "label", "base", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("needed") - 1 + PAIR).alias("end"), F.lit(1.0).alias("coverage"))

    along = Window.partitionBy("doc_id", "key", "template").orderBy("diagonal")
    near = F.collect_list(F.struct("diagonal", "ats")).over(along.rangeBetween(0, NEIGHBOURS))
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along), F.lit(NEIGHBOURS + 1)) > NEIGHBOURS
    runs = diagonals.filter(~F.col("base")).withColumns({"near": near, "fresh": fresh.cast("int")}).withColumn("run", F.sum("fresh").over(along))
    seen = F.size(F.array_distinct(F.flatten(F.transform("near", lambda d: d["ats"]))))
    points = F.array_sort(F.flatten(F.transform("near", lambda d: F.transform(d["ats"], lambda a: F.struct((d["diagonal"] + a).alias("place"), a.alias("at"))))))
    chains = runs.filter(seen >= least * F.col("needed")).withColumn("chain", longest_chain(points)).withColumn("coverage", F.col("chain.n") / F.col("needed"))
    best = chains.filter(F.col("coverage") >= least).groupBy(*by, "run").agg(F.max(F.struct("coverage", "chain")).alias("best"))
    passages = best.select("doc_id", "key", "label", "base", F.col("best.chain.start").alias("start"), (F.col("best.chain.stop") + LONG).alias("end"), F.col("best.coverage").alias("coverage"))
    return phrases.unionByName(passages).select(*found)


def longest_chain(points: Column) -> Column:
    """Struct (n, start, stop) of the longest sequence of points (place, at) that ascends in both; points ascend."""
    kind = "array<struct<place:int,at:int,n:int,start:int>>"

    def add(chains, p):
        before = F.filter(chains, lambda q: (q["place"] < p["place"]) & (q["at"] < p["at"]))
        longest = F.array_max(F.transform(before, lambda q: F.struct(q["n"].alias("n"), q["start"].alias("start"))))
        made = F.struct(
            p["place"].alias("place"), p["at"].alias("at"), (F.coalesce(longest["n"], F.lit(0)) + 1).alias("n"),
            F.coalesce(longest["start"], p["place"]).alias("start"))
        return F.concat(chains, F.array(made)).cast(kind)

    every = F.aggregate(points, F.array().cast(kind), add)
    return F.array_max(F.transform(every, lambda q: F.struct(q["n"].alias("n"), q["start"].alias("start"), q["place"].alias("stop"))))


def scan_licenses(docs: DataFrame, least: float = 0.6, keep: list[str] | None = None) -> DataFrame:
    """docs with n_words, places (structs), n_base, first_word, last_word, base_labels, labels and score (the best coverage, else 0)."""
    place = F.struct("start", "end", "label", "base", "coverage")
    per_doc = vote(docs.select("doc_id", "text"), least).groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_list(place)).alias("places"), F.max("coverage").alias("score"))
    per_doc = per_doc.withColumnsRenamed({"doc_id": "_doc", "key": "_hit"})
    kept = [c for c in others(docs, MADE) if keep is None or c in keep]
    counted = docs.select(*[F.col(f"`{c}`") for c in kept], F.size(words_of(F.col("text"))).cast("long").alias("n_words"), text_key().alias("_key"))
    out = counted.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_hit")), "left").drop("_doc", "_hit", "_key")
    places = F.coalesce(F.col("places"), F.array().cast(out.schema["places"].dataType))
    base = F.filter(places, lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"].cast("long"))
    names = lambda of: F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda p: p["label"]))), ",")
    return out.select(
        *kept, "n_words", places.alias("places"), F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), names(base).alias("base_labels"), names(places).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))

"""Check queries of this package over the test tables, with DuckDB SQL where SQL can express the result."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide.functions.text import let
from tickertide.llm import chat, decontam, language_id, licenses, mixing, near_dup, periodic, pii, quality, secret_scan, source_audit, suffix_dedup, token_files
from tickertide.llm.common import plain_words
from tickertide.sources.handover import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, folder)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    found = spark.read.parquet(f"{folder}/{name}.parquet")
    return found.select(*columns) if columns else found


def digest(items, last: str = "") -> F.Column:
    """Lower-case SHA-256 of an array of strings, comma-joined."""
    return F.sha2(F.array_join(items, ","), 256)


MIXING_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST) AS k,
         sum(source_size) OVER () AS total,
         coalesce(sum(source_size) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
         sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM s),
f AS (
  SELECT 1.5 * total - 2.0 * full_before AS rest, open_weight FROM o
  WHERE weight * ((1.5 * total - 2.0 * full_before) / open_weight) <= 2.0 * source_size ORDER BY k LIMIT 1),
t AS (
  SELECT source, source_size,
         least(2.0 * source_size, weight * CAST(rest AS DOUBLE) / CAST(open_weight AS DOUBLE)) AS target FROM s, f),
m AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         CAST('0x' || substr(sha256('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
           / 4503599627370496.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM m
"""


@query("op5_mixing", MIXING_SQL)
def op5_mixing(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "source", "text")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


FOLDED = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
DECONTAMINATION_SQL = f"""
WITH b AS (SELECT item_id, {FOLDED} AS w FROM benchmark),
bw AS (
  SELECT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 13 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' ')) END) AS g,
    least(len(w), 13) AS n FROM b),
sizes AS (SELECT DISTINCT n FROM bw),
d AS (SELECT row_number() OVER () AS r, doc_id, {FOLDED} AS w FROM documents),
dw AS (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i,
         unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g FROM d, sizes),
h AS (SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
x AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
y AS (SELECT r, count(DISTINCT item_id) AS n_items,
             string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM h GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN x USING (r) LEFT JOIN y USING (r)
"""


@query("op9_decontamination", DECONTAMINATION_SQL)
def op9_decontamination(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    found = decontam.decontaminate(docs, table(spark, folder, "benchmark", "item_id", "text"), with_text=False, keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest("items").alias("items_sha256"), "contaminated")


@query("op2_language_id")
def op2_language_id(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    model = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))))
    found = language_id.identify(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


EXTRA_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
CHAT_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, len(regexp_replace(role, '[<\[\\]', '..', 'g')) AS role_chars,
         len(regexp_replace(text, '[<\[\\]', '..', 'g')) AS text_chars FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(text_chars + CASE WHEN role = 'assistant' THEN 7 ELSE 18 + role_chars END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op3_chat_format", CHAT_SQL)
def op3_chat_format(spark, folder):
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    more = spark.createDataFrame(EXTRA_TURNS, "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(turns.unionByName(more)))


def listed(spans, kinds=None) -> F.Column:
    """kind:start:end, comma-joined, of all spans or of those of some kinds."""
    spans = F.filter(spans, lambda s: s["kind"].isin(*kinds)) if kinds else spans
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


@query("op4_secret_scan")
def op4_secret_scan(spark, folder):
    found = secret_scan.scan_secrets(table(spark, folder, "documents", "doc_id", "text"), keep=["doc_id"])
    kinds = [r.kind for r in secret_scan.BASE]
    return found.select(
        "doc_id", *[counted("spans", k) for k in kinds], F.sha2(listed("spans", kinds), 256).alias("base_sha256"),
        listed("spans").alias("spans"))


@query("op8_pii")
def op8_pii(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    found = pii.detect(docs, keep=["doc_id"])
    return found.select(
        "doc_id", *[counted("spans", k) for k in pii.BASE], F.sha2(listed("spans", pii.BASE), 256).alias("base_sha256"),
        listed("spans").alias("spans"))


QUALITY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT r, unnest(range(1, len(w) - 3)) AS i,
         unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM d WHERE len(w) >= 5),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM again) GROUP BY r),
parts AS (SELECT r, source, text, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
l AS (
  SELECT *, len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) AS n,
         trim(regexp_replace(regexp_replace(lower(s), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line FROM parts),
f AS (SELECT * FROM l WHERE n > 0),
dup AS (SELECT r, count(*) - count(DISTINCT s) AS n FROM f GROUP BY r),
boiler AS (SELECT source, line FROM f GROUP BY source, line HAVING count(DISTINCT text) > 50),
gone AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n FROM f JOIN boiler ON f.line = boiler.line AND f.source IS NOT DISTINCT FROM boiler.source GROUP BY r),
c AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(gone.n, 0) AS removed_words
  FROM d LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND n_words - removed_words >= CAST(0.3 AS DOUBLE) * n_words AS kept FROM c
"""


@query("op1_quality_rules", QUALITY_SQL)
def op1_quality_rules(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "source", "text")
    found = quality.judge(docs, with_text=False)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


@query("op6_license_scan")
def op6_license_scan(spark, folder):
    found = licenses.scan_licenses(table(spark, folder, "documents", "doc_id", "text"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op7_ngram_jaccard")
def op7_ngram_jaccard(spark, folder):
    return near_dup.join_near(table(spark, folder, "documents", "doc_id", "text")).select("doc_id", "class_id", "n_links")


@query("op10_suffix_dedup")
def op10_suffix_dedup(spark, folder):
    found = suffix_dedup.remove_repeats(table(spark, folder, "documents", "doc_id", "text"), with_text=False, keep=["doc_id"])
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where one document in ten, by the CRC-32 of its id, repeats a stretch of its words to its end."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.withColumn("g", F.when(crc % 10 == 0, F.floor(crc / 10)))

    def text(words):
        n = F.size(words)
        a = (F.col("g") % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
        places = F.sequence(F.lit(0), n - 1)
        chosen = F.transform(places, lambda i: F.get(words, F.when(i < a, i).otherwise(a + F.pmod(i - a, p))))
        return F.when(n > 0, F.array_join(chosen, " ")).otherwise("")

    return docs.select("doc_id", F.when(F.col("g").isNull(), F.col("text")).otherwise(let(plain_words(F.col("text")), text)).alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark, folder):
    found = periodic.detect_runs(planted(table(spark, folder, "documents", "doc_id", "text")), keep=["doc_id"])
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


AUDIT_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM t GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS lang_n FROM c GROUP BY ALL HAVING sum(docs) >= 10),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
f AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.lang_n
  FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT lang, source, sum(n) AS total FROM f GROUP BY ALL),
p AS (
  SELECT f.lang, f.source, f.term, f.n,
         1 + (CAST(1000000000 AS HUGEINT) * (f.n + 2)) // (s.total + 2 * v.v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (f.lang_n + 2)) // (v.lang_total + 2 * v.v) AS q
  FROM f JOIN s ON f.lang = s.lang AND f.source = s.source JOIN v ON f.lang = v.lang),
x AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
u AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms),
z AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM u)
SELECT lang, source, part, item, value, rank FROM z WHERE part = 'pair' OR rank <= 10
"""


@query("op12_source_audit", AUDIT_SQL)
def op12_source_audit(spark, folder):
    return source_audit.audit_sources(table(spark, folder, "documents", "lang", "source", "text"))


@query("op13_token_files")
def op13_token_files(spark, folder):
    import public_tokenizers

    files = new_path(spark, "token-files")
    token_files.write_tokens(table(spark, folder, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), files)
    return token_files.read_tokens(spark, files, with_ids=False)

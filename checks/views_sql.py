"""The sample views and common steps as DuckDB views, for comparison queries."""

from tickertide.functions.wordlists import NOISE_WORDS, NOT_TICKERS, SPLIT_CONTRACTIONS, STOPWORDS
from tickertide.sources.sample_views import LEMMAS, LEXICON


def quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def pairs(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


def clean(column: str) -> str:
    step = f"regexp_replace({column}, 'http\\S+|www\\.\\S+', ' ', 'g')"
    step = f"regexp_replace({step}, '<[^>]+>', ' ', 'g')"
    step = f"regexp_replace(regexp_replace({step}, 'r/\\w+', ' ', 'g'), 'u/\\w+', ' ', 'g')"
    step = f"regexp_replace(lower({step}), '[^a-zA-Z0-9\\s]', ' ', 'g')"
    return f"coalesce(trim(regexp_replace({step}, '\\s+', ' ', 'g')), '')"


def tokens(cleaned: str) -> str:
    for a, b in SPLIT_CONTRACTIONS:
        cleaned = f"regexp_replace({cleaned}, '\\b{a}{b}\\b', '{a} {b}', 'g')"
    return f"list_filter(string_split({cleaned}, ' '), lambda t: t <> '')"


def words(column: str) -> str:
    return f"list_filter(string_split_regex({column}, '\\s+'), lambda w: w <> '')"


SENTIMENT = (
    "CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive' "
    "WHEN l.quality = 0 THEN 'neutral' END"
)

VIEWS = {
    "posts": f"""
SELECT d.doc_id AS id, 'post' AS type, d.source AS subreddit, d.text,
       CAST(floor(e.value) AS BIGINT) AS score,
       CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS num_comments,
       e.ts AS created_at, e.user_id AS author, {SENTIMENT} AS sentiment
FROM documents d
LEFT JOIN events e ON e.event_id = 5 * d.doc_id
LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "noisy": """
SELECT p.* REPLACE (concat_ws(' ', p.text, g.url, '<b>x</b>', 'r/' || p.subreddit, 'u/user' || p.author,
       'over/under', ['$AAPL', 'TSLA', 'CEO', 'GME', 'BUY'][CAST(p.id % 5 AS INT) + 1]) AS text)
FROM posts p LEFT JOIN pages g ON g.page_id = p.id % (SELECT count(*) FROM pages)""",
    "turns": """
SELECT c.conv_id * 100 + c.turn AS id, c.conv_id, c.turn, f.first_turn,
       CASE WHEN c.turn <> f.first_turn AND (c.conv_id + c.turn) % 11 = 0 THEN '[deleted]' ELSE c.text END AS body,
       CAST(length(c.text) % 50 AS BIGINT) AS score, f.n - 1 AS num_comments,
       'c' || (c.conv_id % 4) AS subreddit,
       1704067200 + c.conv_id * 3600 + c.turn * 60 AS created_utc
FROM conversations c
JOIN (SELECT conv_id, min(turn) AS first_turn, count(*) AS n FROM conversations GROUP BY conv_id) f USING (conv_id)""",
    "thread_posts": """
SELECT conv_id AS id, subreddit, body AS text, score, num_comments, created_utc FROM turns WHERE turn = first_turn""",
    "thread_comments": """
SELECT id, conv_id AS post_id, body, score, created_utc FROM turns WHERE turn <> first_turn""",
    "owned_comments": """
SELECT c.*, p.subreddit FROM thread_comments c JOIN thread_posts p ON p.id = c.post_id AND p.num_comments > 0""",
    "kept_comments": """
SELECT * FROM owned_comments
WHERE regexp_replace(body, '^\\s+|\\s+$', '', 'g') NOT IN ('', '[deleted]', '[removed]')""",
    "merged": """
SELECT id, 'post' AS type, subreddit, text, score, num_comments, created_utc, CAST(NULL AS BIGINT) AS post_id FROM thread_posts
UNION ALL
SELECT id, 'comment', subreddit, regexp_replace(body, '^\\s+|\\s+$', '', 'g'), score, 0, created_utc, post_id FROM kept_comments""",
    "labelled": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY created_at NULLS FIRST, id) AS rn
  FROM posts WHERE text IS NOT NULL AND sentiment IS NOT NULL
) WHERE rn = 1""",
    "lemma_table": f"SELECT * FROM (VALUES {pairs(LEMMAS)}) t(token, lemma)",
    "lexicon_table": f"SELECT * FROM (VALUES {pairs(LEXICON)}) t(term, valence)",
    "lemma_tokens": f"""
SELECT t.id, t.pos, coalesce(m.lemma, t.token) AS token
FROM (SELECT id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM (
        SELECT id, list_filter({tokens(clean('text'))}, lambda t: length(t) >= 3 AND t NOT IN ({quoted(STOPWORDS)})) AS toks
        FROM labelled)) t
LEFT JOIN lemma_table m ON m.token = t.token""",
    "cleaned": f"""
SELECT p.*, coalesce(c.cleaned_text, '') AS cleaned_text
FROM labelled p LEFT JOIN (
  SELECT id, string_agg(token, ' ' ORDER BY pos) AS cleaned_text FROM lemma_tokens
  WHERE length(token) >= 3 AND token NOT IN ({quoted(NOISE_WORDS)}) GROUP BY id
) c USING (id)""",
    "derived": f"""
SELECT *, length(text) AS text_length, len({words('text')}) AS word_count, length(cleaned_text) AS clean_length,
       len({words('cleaned_text')}) AS clean_wc, score + num_comments AS engagement,
       hour(created_at) AS hour_of_day, dayname(created_at) AS day_of_week
FROM cleaned""",
    "long_enough": "SELECT * FROM derived WHERE clean_wc >= 3",
    "by_score": """
SELECT * FROM long_enough, (SELECT quantile_cont(score, 0.25) AS a, quantile_cont(score, 0.75) AS b FROM long_enough)
WHERE score >= a - 1.5 * (b - a) AND score <= b + 1.5 * (b - a)""",
    "by_comments": """
SELECT * FROM (SELECT * EXCLUDE (a, b) FROM by_score),
     (SELECT quantile_cont(num_comments, 0.25) AS a, quantile_cont(num_comments, 0.75) AS b FROM by_score)
WHERE num_comments >= a - 1.5 * (b - a) AND num_comments <= b + 1.5 * (b - a)""",
    "processed": """
SELECT * EXCLUDE (a, b, m, s), CASE sentiment WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 END AS sentiment_label
FROM by_comments, (SELECT avg(text_length) AS m, stddev_pop(text_length) AS s FROM by_comments)
WHERE abs(text_length - m) / s < 3""",
    "split": """
SELECT *, CASE WHEN rn <= round(0.2 * n) THEN 'test' ELSE 'train' END AS split,
       CAST((rn > round(0.2 * n)) AS INT) + CAST((rn > round(0.4 * n)) AS INT)
       + CAST((rn > round(0.6 * n)) AS INT) + CAST((rn > round(0.8 * n)) AS INT) AS fold
FROM (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY md5(CAST(id AS VARCHAR) || '|42')) AS rn,
             count(*) OVER (PARTITION BY sentiment) AS n,
             CASE sentiment WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 ELSE 2 END AS sentiment_label
      FROM derived WHERE length(trim(cleaned_text)) > 0)""",
    "term_counts": """
SELECT id, term, count(*) AS tf FROM (
  SELECT id, unnest(w) AS term FROM (SELECT id, string_split(cleaned_text, ' ') AS w FROM split)
  UNION ALL
  SELECT id, w[i] || ' ' || w[i + 1] AS term FROM (
    SELECT id, w, unnest(range(1, len(w))) AS i FROM (SELECT id, string_split(cleaned_text, ' ') AS w FROM split))
) GROUP BY id, term""",
    "vocabulary": """
SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, tf, df, ln((n + 1) / (df + 1)) + 1 AS idf FROM (
  SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df,
         (SELECT count(*) FROM split WHERE split = 'train') AS n
  FROM term_counts JOIN split USING (id) WHERE split = 'train' GROUP BY term
  HAVING count(*) >= 2 AND count(*) <= 0.95 * (SELECT count(*) FROM split WHERE split = 'train')
  ORDER BY tf DESC, term LIMIT 5000)""",
    "weights": """
SELECT id, term, idx, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM (
  SELECT c.id, c.term, v.idx, (1 + ln(c.tf)) * v.idf AS w FROM term_counts c JOIN vocabulary v USING (term))""",
    "metric": """
SELECT event_id, ts, CASE event_type WHEN 'view' THEN 'post_scraped' WHEN 'error' THEN 'scrape_error'
         WHEN 'signup' THEN 'rate_limit_hit' WHEN 'click' THEN 'api_request' WHEN 'purchase' THEN 'prediction' END AS kind,
       'c' || (user_id % 4) AS subreddit,
       ['logistic_regression', 'naive_bayes', 'random_forest'][CAST(user_id % 3 AS INT) + 1] AS model,
       ['positive', 'neutral', 'negative'][CAST(event_id % 3 AS INT) + 1] AS predicted_sentiment,
       value / 100 AS latency_s, 'E' || (user_id % 2) AS error_type
FROM events""",
}


def predictions(right: int) -> str:
    return f"""
SELECT model_name, id, label, prediction,
       CASE WHEN prediction = 0 THEN p ELSE (1 - p) / 2 END AS p0,
       CASE WHEN prediction = 1 THEN p ELSE (1 - p) / 2 END AS p1,
       CASE WHEN prediction = 2 THEN p ELSE (1 - p) / 2 END AS p2
FROM (SELECT model_name, id, label, CASE WHEN (id * 7 + m) % 10 < {right} + m THEN label ELSE (label + 1) % 3 END AS prediction,
             0.5::DOUBLE + CAST(id % 40 AS DOUBLE) / 100 AS p
      FROM (SELECT l.doc_id AS id, CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 ELSE 2 END AS label
            FROM labels l WHERE toxic = 1 OR quality IN (0, 1)),
           (VALUES (0, 'logistic_regression'), (1, 'naive_bayes'), (2, 'random_forest')) t(m, model_name))"""


def metrics(source: str) -> str:
    """Accuracy, weighted and macro metrics per model."""
    return f"""
SELECT model_name, sum(tp) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS precision,
       sum(recall * support) / sum(support) AS recall, sum(f1 * support) / sum(support) AS f1_score,
       avg(precision) FILTER (support + predicted > 0) AS macro_precision,
       avg(recall) FILTER (support + predicted > 0) AS macro_recall,
       avg(f1) FILTER (support + predicted > 0) AS macro_f1_score, CAST(sum(support) AS BIGINT) AS support
FROM (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
             CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
             CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * tp / (predicted + support) END AS f1
      FROM (SELECT model_name, c.c AS label, count(*) FILTER (label = c.c AND prediction = c.c) AS tp,
                   count(*) FILTER (prediction = c.c) AS predicted, count(*) FILTER (label = c.c) AS support
            FROM {source}, (VALUES (0), (1), (2)) c(c) GROUP BY model_name, c.c))
GROUP BY model_name"""


VIEWS["predictions"] = predictions(6)
VIEWS["predictions_before"] = predictions(5)
VIEWS["after_metrics"] = metrics("predictions")
VIEWS["before_metrics"] = metrics("predictions_before")

NEEDS = {
    "noisy": ["posts"], "thread_posts": ["turns"], "thread_comments": ["turns"],
    "owned_comments": ["thread_comments", "thread_posts"], "kept_comments": ["owned_comments"],
    "merged": ["thread_posts", "kept_comments"], "labelled": ["posts"], "lemma_tokens": ["labelled", "lemma_table"],
    "cleaned": ["labelled", "lemma_tokens"], "derived": ["cleaned"], "long_enough": ["derived"],
    "by_score": ["long_enough"], "by_comments": ["by_score"], "processed": ["by_comments"], "split": ["derived"],
    "term_counts": ["split"], "vocabulary": ["term_counts", "split"], "weights": ["term_counts", "vocabulary"],
    "after_metrics": ["predictions"], "before_metrics": ["predictions_before"],
}


def with_views(body: str, *views: str) -> str:
    """The query with the views it needs in front, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    if not ordered:
        return body
    # a view used several times is computed once
    listed = ",\n".join(f"{name} AS MATERIALIZED ({VIEWS[name]}\n)" for name in ordered)
    return f"WITH {listed}\n{body}"

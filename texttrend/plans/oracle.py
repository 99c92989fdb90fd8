"""The registered queries as plain SQL over the same tables, for comparison."""

from __future__ import annotations

from ..operators import index
from . import catalog, views

# The characters Python's "\s" matches, written out for RE2.
_SPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _clean(expression: str) -> str:
    no_url = f"regexp_replace({expression}, 'http[^{_SPACE}]+', '', 'g')"
    return f"trim(regexp_replace({no_url}, '[{_SPACE}]+', ' ', 'g'))"


def _tokens(expression: str) -> str:
    return rf"regexp_extract_all(lower({expression}), '[\p{{L}}\p{{N}}_]+')"


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else f"{value}::DOUBLE"


ARTICLES = """articles AS (
  SELECT doc_id, lang AS query, source, CASE WHEN lang <> 'en' THEN 'By ' || source END AS author,
         string_split(text, chr(10))[1] AS title, string_split(text, chr(10))[2] AS description, text AS content,
         'http://' || source || '/' || md5(text) AS url,
         TIMESTAMP '2024-01-01' + to_seconds((doc_id * 1234577) % 31622400) AS ts,
         strftime(TIMESTAMP '2024-01-01' + to_seconds((doc_id * 1234577) % 31622400), '%Y-%m-%dT%H:%M:%SZ')
           AS published_at
  FROM documents)"""

CORPUS = f"""{ARTICLES},
corpus AS (
  SELECT * FROM (
    SELECT doc_id, query, url, ts, published_at, coalesce(title, '') AS title,
           coalesce(description, '') AS description,
           {_clean("coalesce(title, '') || '. ' || coalesce(description, '') || '. ' || coalesce(content, '')")} AS text
    FROM articles)
  WHERE length(text) > 0)"""

LEXICON = (
    "lexicon(term, polarity, intensity, kind) AS (VALUES "
    + ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in views.SAMPLE_LEXICON)
    + ")"
)


def _scores(source: str, key: str = "doc_id") -> str:
    """CTEs ending in scores(key, sentiment) over source(key, text)."""
    return f"""{LEXICON},
split AS (SELECT {key} AS id, {_tokens("text")} AS t FROM {source}),
words AS (SELECT id, unnest(t) AS term, generate_subscripts(t, 1) AS i FROM split),
around AS (
  SELECT id, term, lag(term, 1) OVER w AS w1, lag(term, 2) OVER w AS w2
  FROM words WINDOW w AS (PARTITION BY id ORDER BY i)),
hits AS (
  SELECT a.id,
         CASE WHEN m.term IS NOT NULL THEN greatest(-1.0::DOUBLE, least(1.0::DOUBLE, p.polarity * m.intensity))
              ELSE p.polarity END
         * CASE WHEN n1.term IS NOT NULL
                  OR ((m.term IS NOT NULL OR length(a.w1) = 1) AND n2.term IS NOT NULL)
                THEN -0.5::DOUBLE ELSE 1.0::DOUBLE END AS v
  FROM around a
  JOIN lexicon p ON p.term = a.term AND p.kind = 'polar'
  LEFT JOIN lexicon m ON m.term = a.w1 AND m.kind = 'modifier'
  LEFT JOIN lexicon n1 ON n1.term = a.w1 AND n1.kind = 'negation'
  LEFT JOIN lexicon n2 ON n2.term = a.w2 AND n2.kind = 'negation'),
means AS (SELECT id, round(avg(v), 9) AS v FROM hits GROUP BY id),
scores AS (SELECT s.id, coalesce(v, 0.0::DOUBLE) AS sentiment FROM split s LEFT JOIN means USING (id))"""


ARTICLE_SCORES = f"""{CORPUS},
{_scores("corpus")},
scored AS (SELECT c.*, sentiment FROM corpus c JOIN scores s ON s.id = c.doc_id)"""

LABEL = "CASE WHEN sentiment > 0.1 THEN 'positive' WHEN sentiment < -0.1 THEN 'negative' ELSE 'neutral' END"


def _postings(source: str = "documents") -> str:
    """CTEs up to df per term over source(doc_id, text)."""
    return f"""split AS (SELECT doc_id, {_tokens("text")} AS t FROM {source}),
size AS (SELECT count(*)::DOUBLE AS n, sum(len(t))::DOUBLE AS n_tokens FROM split),
words AS (SELECT doc_id, unnest(t) AS term FROM split),
postings AS (SELECT doc_id, term, count(*)::DOUBLE AS tf FROM words GROUP BY ALL),
terms AS (SELECT term, count(*)::DOUBLE AS df FROM postings GROUP BY term)"""


def _frequencies(source: str = "documents") -> str:
    """CTEs of df per term alone: each document's distinct words, without postings."""
    return f"""distinct_words AS (SELECT unnest(list_distinct({_tokens("text")})) AS term FROM {source}),
size AS (SELECT count(*)::DOUBLE AS n FROM {source}),
terms AS (SELECT term, count(*)::DOUBLE AS df FROM distinct_words GROUP BY term)"""


STOP_LIST = ", ".join(_literal(w) for w in index.read_stop_words())


def _vocabulary(max_df: float = index.MAX_DF) -> str:
    return f"""voc AS (
  SELECT term, df, ln((1 + n) / (1 + df)) + 1 AS idf FROM terms, size
  WHERE length(term) >= {index.MIN_TERM_CHARS} AND term NOT IN ({STOP_LIST})
    AND df >= {index.MIN_DF} AND df <= {max_df}::DOUBLE * n)"""


WEIGHTS = """raw AS (SELECT doc_id, term, tf, tf * idf AS w FROM postings JOIN voc USING (term)),
norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY doc_id),
weights AS (SELECT doc_id, term, tf, w / norm AS weight FROM raw JOIN norms USING (doc_id))"""

BM25_IDF = f"""plain AS (SELECT term, df, ln(n - df + 0.5::DOUBLE) - ln(df + 0.5::DOUBLE) AS idf FROM terms, size),
mean AS (SELECT avg(idf) AS mean_idf FROM plain),
bm25 AS (
  SELECT term, CASE WHEN idf < 0 THEN {index.EPSILON}::DOUBLE * mean_idf ELSE idf END AS idf FROM plain, mean)"""


def _asked(queries) -> str:
    """CTEs of the queries and their words; ``queries`` is a list, or a SELECT of (query_id, query)."""
    if isinstance(queries, str):
        table = f"asked AS ({queries})"
    else:
        rows = ", ".join(f"({i}::BIGINT, {_literal(q)})" for i, q in enumerate(queries))
        table = f"asked(query_id, query) AS (VALUES {rows})"
    return f"""{table},
asked_words AS (SELECT query_id, unnest({_tokens("query")}) AS term FROM asked),
asked_terms AS (SELECT query_id, term, count(*)::DOUBLE AS n FROM asked_words GROUP BY ALL)"""


TFIDF_SCORES = """qraw AS (SELECT query_id, term, a.n * idf AS w FROM asked_terms a JOIN voc USING (term)),
qnorms AS (SELECT query_id, sqrt(sum(w * w)) AS norm FROM qraw GROUP BY query_id),
tfidf_scores AS (
  SELECT query_id, doc_id, sum(w / norm * weight) AS score
  FROM qraw JOIN qnorms USING (query_id) JOIN weights USING (term) GROUP BY ALL)"""

BM25_SCORES = f"""lengths AS (SELECT doc_id, len(t)::DOUBLE AS dl FROM split),
bm25_scores AS (
  SELECT query_id, doc_id,
         sum(a.n * idf * tf * ({index.K1}::DOUBLE + 1)
             / (tf + {index.K1}::DOUBLE
                * (1 - {index.B}::DOUBLE + {index.B}::DOUBLE * dl / (size.n_tokens / size.n)))) AS score
  FROM asked_terms a JOIN bm25 USING (term) JOIN postings USING (term) JOIN lengths USING (doc_id), size
  GROUP BY ALL)"""


def _top(scores: str, fill_zero: bool = True, k: int = 10) -> str:
    """Final ranked rows as a CTE ``ranked``, from CTE ``scores``."""
    dense = f"""SELECT query_id, doc_id, coalesce(score, 0.0::DOUBLE) AS score
    FROM asked CROSS JOIN (SELECT doc_id FROM split) LEFT JOIN {scores} USING (query_id, doc_id)"""
    rows = dense if fill_zero else f"SELECT query_id, doc_id, score FROM {scores} WHERE round(score, 9) > 0"
    return f"""{scores}_ranked AS (
  SELECT query_id, doc_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id DESC) AS rank
  FROM ({rows}) QUALIFY rank <= {k})"""


def _search(kind: str, queries, fill_zero: bool = True, max_df: float = index.MAX_DF) -> str:
    if kind == "tfidf":
        parts = [_postings(), _vocabulary(max_df), WEIGHTS, _asked(queries), TFIDF_SCORES]
    else:
        parts = [_postings(), BM25_IDF, _asked(queries), BM25_SCORES]
    body = ",\n".join([*parts, _top(f"{kind}_scores", fill_zero)])
    return f"WITH {body}\nSELECT query_id, rank, doc_id, round(score, 6) AS score FROM {kind}_scores_ranked"


BENCHMARK = "SELECT item_id AS query_id, text AS query FROM benchmark"

JUDGED = ",\n".join(
    [CORPUS, _postings("corpus"), _vocabulary(), WEIGHTS, BM25_IDF, _asked(catalog.COMPARE_QUERIES), TFIDF_SCORES,
     BM25_SCORES, _top("tfidf_scores"), _top("bm25_scores"),
     """both_rankers AS (
  SELECT 'tfidf' AS ranker, * FROM tfidf_scores_ranked UNION ALL SELECT 'bm25', * FROM bm25_scores_ranked),
judged AS (
  SELECT ranker, a.query, rank, doc_id, c.query AS article_query,
         CASE WHEN contains(lower(a.query), lower(c.query)) OR contains(lower(c.query), lower(a.query))
              THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS rel
  FROM both_rankers JOIN asked a USING (query_id) JOIN corpus c USING (doc_id))"""]
)


def _metrics(lists: str, keys: str, k: int) -> str:
    """CTE report(keys, mrr, ndcg, precision_at_k, mean_score) over lists(keys, rank, rel)."""
    return f"""ideal AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY rel DESC, rank) AS best FROM {lists}),
sums AS (
  SELECT {keys}, count(*) AS n,
         count(*) FILTER (rank <= {k} AND rel > 0) AS relevant,
         min(rank) FILTER (rank <= {k} AND rel > 0) AS first_hit,
         avg(rel) FILTER (rank <= {k}) AS mean_score,
         sum(rel / log2(rank + 1)) FILTER (rank <= {k}) AS dcg,
         sum(rel / log2(best + 1)) FILTER (best <= {k}) AS idcg
  FROM ideal GROUP BY ALL),
report AS (
  SELECT {keys}, coalesce(1.0::DOUBLE / first_hit, 0) AS mrr,
         CASE WHEN idcg > 0 THEN coalesce(dcg, 0) / idcg ELSE 0.0::DOUBLE END AS ndcg,
         relevant::DOUBLE / least({k}, n) AS precision_at_k, coalesce(mean_score, 0) AS mean_score
  FROM sums)"""


LISTS = """lists AS (
  SELECT conv_id AS query_id, turn + 1 AS rank, least(3.0::DOUBLE, floor(length(text) / 400)) AS rel
  FROM conversations)"""

LIST_REPORT = f"{LISTS},\n{_metrics('lists', 'query_id', catalog.K_LISTS)}"

LABELLED = f"""{_scores("documents")},
labelled AS (
  SELECT CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS y_true,
         {LABEL} AS y_pred
  FROM labels JOIN scores ON id = doc_id)"""


def _distribution(source: str, keys: str = "", value: str = "sentiment", low: float = -0.1, high: float = 0.1) -> str:
    lead, group = (f"{keys}, ", f"GROUP BY {keys}") if keys else ("", "")
    return f"""SELECT {lead}round(avg({value}), 6) AS mean_sentiment, round(stddev_samp({value}), 6) AS std_sentiment,
  round(avg(CASE WHEN {value} > {high}::DOUBLE THEN 1.0 ELSE 0.0 END), 6) AS positive_ratio,
  round(avg(CASE WHEN {value} < {low}::DOUBLE THEN 1.0 ELSE 0.0 END), 6) AS negative_ratio,
  round(avg(CASE WHEN {value} BETWEEN {low}::DOUBLE AND {high}::DOUBLE THEN 1.0 ELSE 0.0 END), 6) AS neutral_ratio
FROM {source} {group}"""


def _trend(source: str, time: str, value: str, spine: str, bucket: str, label: str, until: str, start: str) -> str:
    """SELECT of a gap-filled trend; ``spine`` selects the buckets as column b."""
    return f"""SELECT strftime(b, '%Y-%m-%d') AS bucket, strftime(b, '{label}') AS label,
  round(m, 6) AS sentiment, coalesce(n, 0) AS n
FROM ({spine}) LEFT JOIN (
  SELECT {bucket} AS b, avg({value}) AS m, count({value}) AS n FROM {source}
  WHERE {time} >= TIMESTAMP '{start}' AND {time} {until} GROUP BY 1) USING (b)"""


def _month_ends(start: str, end: str) -> str:
    return f"SELECT last_day(m::DATE) AS b FROM (SELECT unnest(generate_series(DATE '{start}', DATE '{end}', INTERVAL 1 MONTH)) AS m)"


def _pages(select: str, where: str) -> str:
    return f"""WITH pages AS (
  SELECT *, json_extract_string(props, '$.k')::BIGINT AS k, event_type <> 'error' AS ok, value < 1 AS later_page
  FROM events)
SELECT {select} FROM pages WHERE {where}"""


def _find(lo: str, hi: str, monthly: bool) -> str:
    """CTE found: articles containing each searched word within the dates."""
    first = f"greatest(date_trunc('month', ts)::DATE, DATE '{lo}')" if monthly else f"DATE '{lo}'"
    last = f"least(last_day(ts::DATE), DATE '{hi}')" if monthly else f"DATE '{hi}'"
    return f"""WITH {CORPUS},
found AS (
  SELECT doc_id, q AS query, strftime({first}, '%Y-%m-%d') AS range_start, strftime({last}, '%Y-%m-%d') AS range_end,
         ts, published_at
  FROM corpus, (VALUES ('license'), ('best'), ('no')) AS asked(q)
  WHERE ts::DATE BETWEEN DATE '{lo}' AND DATE '{hi}' AND list_contains({_tokens("text")}, q))"""


def _oldest(monthly: bool, cap: int) -> str:
    return f"""{_find(*catalog.GRID_RANGE, monthly)}
SELECT query, range_start, row_number() OVER (PARTITION BY query, range_start ORDER BY ts, doc_id) AS position,
       doc_id, published_at
FROM found QUALIFY position <= {cap}"""


_LENGTH = "length(substring(text, 1, 2048))"
_BLANK = f"length({_clean('text')}) = 0"

ORACLES = {
    "scan_articles": f"""WITH {ARTICLES}
SELECT doc_id, query, source, author, title, description, content, url, published_at FROM articles""",
    "flatten_json": _pages(
        """event_id, event_type AS query, 'events' AS source,
  CASE WHEN value >= 5 THEN 'By ' || user_id ELSE '' END AS author, event_type || ' ' || user_id AS title,
  CASE WHEN k >= 10 THEN props ELSE '' END AS description, CASE WHEN k >= 10 THEN props ELSE '' END AS content,
  'http://events/' || event_id AS url, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_at""",
        "ok AND event_type <> 'purchase'",
    ),
    "reject_split": _pages("event_id, event_type AS query, 'ERROR' AS status", "NOT ok"),
    "search_hits": _pages(
        "event_type AS query, strftime(ts, '%Y-%m-%d') AS range_start, max(coalesce(k, 0)) AS total_hits",
        "ok AND NOT later_page GROUP BY ALL",
    ),
    "tag_union": f"""SELECT doc_id, source, q AS query
FROM documents, (VALUES ('best'), ('no'), ('license')) AS asked(q) WHERE list_contains({_tokens("text")}, q)""",
    "run_version": """SELECT o_orderstatus AS name, strftime(o_orderdate, '%Y-%m-%d') AS run_date,
  max(o_custkey) + 1 AS run_seq,
  o_orderstatus || '_' || strftime(o_orderdate, '%Y%m%d') || '_' || printf('%03d', max(o_custkey) + 1) AS run_name
FROM orders GROUP BY o_orderstatus, o_orderdate""",
    "run_claims": """SELECT row_number() OVER (ORDER BY o_orderstatus)::INT AS run_seq, '2024-12-31' AS run_date,
  o_orderstatus AS status, count(*) AS n FROM orders GROUP BY o_orderstatus""",
    "collect_metrics": _pages(
        """count(*) FILTER (ok AND event_type <> 'purchase') AS stored, count(*) AS pages, count(*) FILTER (NOT ok) AS rejected,
  0::BIGINT AS corrupt, coalesce(sum(k) FILTER (ok AND NOT later_page), 0)::BIGINT AS hits,
  count(*) FILTER (ok AND event_type <> 'purchase') AS articles, 0::BIGINT AS time_rejects""",
        "true",
    ),
    "resumed_collection": """WITH searches AS (
  SELECT event_type AS query, strftime(ts, '%Y-%m-%d') AS range_start, count(*) AS pages,
    CASE WHEN event_type = 'purchase' THEN 0 ELSE count(*) END AS articles
  FROM events GROUP BY 1, 2)
SELECT query, range_start, 1 AS attempt, CASE WHEN query = 'error' THEN 'failed' ELSE 'finished' END AS status, pages,
  CASE WHEN query = 'error' THEN pages ELSE 0 END AS bad_pages, articles FROM searches
UNION ALL SELECT query, range_start, 2, 'finished', pages, 0, articles FROM searches WHERE query = 'error'""",
    "csv_round_trip": f"""WITH {ARTICLES}
SELECT coalesce(query, '') AS query, coalesce(source, '') AS source, coalesce(author, '') AS author, coalesce(title, '') AS title,
  coalesce(description, '') AS description, coalesce(content, '') AS content, url, published_at, count(*) AS n
FROM articles GROUP BY ALL""",
    "month_ranges": """WITH spans AS (
  SELECT o_custkey, min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi FROM orders GROUP BY 1),
months AS (
  SELECT *, unnest(generate_series(date_trunc('month', lo)::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS m
  FROM spans)
SELECT o_custkey, strftime(greatest(m, lo), '%Y%m%d') AS begin_date, strftime(least(last_day(m), hi), '%Y%m%d') AS end_date,
  strftime(greatest(m, lo), '%Y-%m') AS month FROM months""",
    "search_grid": f"""WITH months AS (
  SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '{catalog.GRID_RANGE[1]}', INTERVAL 1 MONTH))::DATE AS m),
ranges AS (
  SELECT greatest(m, DATE '{catalog.GRID_RANGE[0]}') AS s, least(last_day(m), DATE '{catalog.GRID_RANGE[1]}') AS e FROM months)
SELECT query, strftime(s, '%Y-%m-%d') AS range_start, strftime(e, '%Y-%m-%d') AS range_end,
  strftime(s, '%Y%m%d') AS begin_date, strftime(e, '%Y%m%d') AS end_date, strftime(s, '%Y-%m') AS month
FROM (SELECT DISTINCT lang AS query FROM documents), ranges""",
    "search_articles": f"""{_find(*catalog.GRID_RANGE, True)}
SELECT doc_id, query, range_start, range_end, published_at FROM found""",
    "oldest_topn": _oldest(True, 2),
    "search_whole": _oldest(False, 30),
    "search_table": f"""WITH {CORPUS},
asked AS (
  SELECT item_id AS query_id, text AS query FROM benchmark
  UNION ALL VALUES (-6, 'license'), (-5, 'best no'), (-4, 'the the orre'), (-3, 'the'), (-2, 'zzz'), (-1, '')),
worded AS (SELECT query_id, list_distinct({_tokens("query")}) AS ws FROM asked),
ranged AS (
  SELECT doc_id, published_at, ts, list_distinct({_tokens("text")}) AS t FROM corpus
  WHERE ts::DATE BETWEEN DATE '{catalog.GRID_RANGE[0]}' AND DATE '{catalog.GRID_RANGE[1]}')
SELECT query_id, doc_id, strftime(greatest(date_trunc('month', ts)::DATE, DATE '{catalog.GRID_RANGE[0]}'), '%Y-%m-%d') AS range_start,
  strftime(least(last_day(ts::DATE), DATE '{catalog.GRID_RANGE[1]}'), '%Y-%m-%d') AS range_end, published_at
FROM ranged JOIN worded ON len(ws) > 0 AND list_has_all(t, ws)""",
    "daily_quota": f"""SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS requests,
  greatest(0, {catalog.QUOTA} - count(*)) AS remaining FROM events GROUP BY 1""",
    "quota_admit": f"""SELECT event_id AS request_id, strftime(ts, '%Y-%m-%d') AS day,
  row_number() OVER (PARTITION BY ts::DATE ORDER BY ts, event_id) AS request_no
FROM events QUALIFY request_no <= {catalog.QUOTA}""",
    "dedup": f"""WITH {ARTICLES} SELECT doc_id, url, published_at FROM articles
QUALIFY row_number() OVER (PARTITION BY url ORDER BY ts, doc_id) = 1""",
    "dedup_blank_urls": f"""WITH {ARTICLES},
u AS (SELECT doc_id, published_at, ts, CASE WHEN query = 'es' THEN ' ' WHEN query <> 'de' THEN url END AS url FROM articles)
SELECT doc_id, url, published_at FROM u
QUALIFY row_number() OVER (PARTITION BY url, CASE WHEN trim(coalesce(url, '')) = '' THEN doc_id END ORDER BY ts, doc_id) = 1""",
    "build_corpus": f"WITH {CORPUS} SELECT doc_id, title, description, text FROM corpus",
    "clean_text": f"""SELECT page_id, {_clean("url || ' ' || html")} AS text FROM pages""",
    "lexicon_polarity": f"""WITH {_scores("documents")}
SELECT id AS doc_id, round(sentiment, 6) AS sentiment FROM scores""",
    "conversation_polarity": f"""WITH turns AS (SELECT conv_id * 1000000 + turn AS id, text FROM conversations),
{_scores("turns", "id")}
SELECT id // 1000000 AS conv_id, id % 1000000 AS turn, round(sentiment, 6) AS sentiment FROM scores""",
    "annotate_sentiment": f"""WITH {ARTICLE_SCORES}
SELECT doc_id, query, url, length(text) AS n_chars, round(sentiment, 6) AS sentiment FROM scored""",
    "annotate_bucketed": f"""WITH {ARTICLE_SCORES}
SELECT doc_id, query, url, length(text) AS n_chars, round(sentiment, 6) AS sentiment FROM scored""",
    "scored_runs": f"""WITH {ARTICLE_SCORES}
SELECT doc_id, '/corpus_with_sentiment/run_date=20241231/run_seq=002' AS run, round(sentiment, 6) AS sentiment
FROM scored WHERE ts BETWEEN TIMESTAMP '2024-07-01' AND TIMESTAMP '2024-12-31'""",
    "model_polarity": f"""SELECT doc_id, round(CASE WHEN {_BLANK} OR {_LENGTH} % 11 = 0 THEN 0.0::DOUBLE
    WHEN {_LENGTH} % 5 IN (0, 4) THEN ({_LENGTH} % 101)::DOUBLE / 100
    WHEN {_LENGTH} % 5 IN (1, 3) THEN -({_LENGTH} % 101)::DOUBLE / 100 ELSE 0.0::DOUBLE END, 6) AS sentiment,
  NOT ({_BLANK}) AND {_LENGTH} % 11 = 0 AS failed
FROM documents""",
    "truncate_text": "SELECT doc_id, substring(text, 1, 2048) AS text FROM documents",
    "label_to_polarity": """SELECT event_id, CASE WHEN k % 7 IN (0, 1) THEN value WHEN k % 7 IN (2, 3) THEN -value
  ELSE 0.0::DOUBLE END AS polarity
FROM (SELECT *, json_extract_string(props, '$.k')::INT AS k FROM events)""",
    "sentiment_label": f"WITH {ARTICLE_SCORES} SELECT doc_id, {LABEL} AS label FROM scored",
    "tokenize": f"""SELECT doc_id, len(t) AS n_tokens, coalesce(array_to_string(t, ' '), '') AS tokens
FROM (SELECT doc_id, {_tokens("text")} AS t FROM documents)""",
    "tfidf_terms": f"""WITH {_postings()}
SELECT doc_id, term, tf::INT AS tf FROM postings
WHERE length(term) >= {index.MIN_TERM_CHARS} AND term NOT IN ({STOP_LIST})""",
    "vocabulary": f"WITH {_postings()}, {_vocabulary()} SELECT term, df::BIGINT AS df FROM voc",
    "vocabulary_pruned": f"""WITH {_postings()}, {_vocabulary(catalog.MAX_DF_PRUNED)}
SELECT term, df::BIGINT AS df FROM voc""",
    "idf": f"WITH {_postings()}, {_vocabulary()} SELECT term, round(idf, 6) AS idf FROM voc",
    "tfidf_weights": f"""WITH {_postings()}, {_vocabulary()}, {WEIGHTS}
SELECT doc_id, term, tf::INT AS tf, round(weight, 6) AS weight FROM weights""",
    "bm25_stats": f"""WITH {_postings()}, {BM25_IDF}
SELECT n::BIGINT AS n_docs, n_tokens::BIGINT AS n_tokens, round(n_tokens / n, 6) AS avgdl,
  (SELECT count(*) FROM terms) AS n_terms, round(mean_idf, 6) AS mean_idf FROM size, mean""",
    "bm25_idf": f"WITH {_frequencies()}, {BM25_IDF} SELECT term, round(idf, 6) AS idf FROM bm25",
    "tfidf_search": _search("tfidf", catalog.SEARCH_QUERIES),
    "tfidf_search_pruned": _search("tfidf", catalog.SEARCH_QUERIES, max_df=catalog.MAX_DF_PRUNED),
    "tfidf_matches": _search("tfidf", catalog.SEARCH_QUERIES, fill_zero=False),
    "bm25_search": _search("bm25", catalog.SEARCH_QUERIES),
    "bm25_matches": _search("bm25", catalog.SEARCH_QUERIES, fill_zero=False),
    "tfidf_benchmark": _search("tfidf", BENCHMARK),
    "bm25_benchmark": _search("bm25", BENCHMARK),
    "bm25_segments": _search("bm25", catalog.SEARCH_QUERIES),
    "tfidf_segments": _search("tfidf", catalog.SEARCH_QUERIES),
    "bm25_bounded": _search("bm25", catalog.SEARCH_QUERIES),
    "tfidf_bounded": _search("tfidf", catalog.SEARCH_QUERIES),
    "bm25_bounded_benchmark": _search("bm25", BENCHMARK),
    "tfidf_bounded_benchmark": _search("tfidf", BENCHMARK),
    "relevance": f"WITH {JUDGED} SELECT ranker, query, rank, doc_id, article_query, rel FROM judged",
    "rank_compare": f"""WITH {JUDGED},
{_metrics("judged", "ranker, query", 10)}
SELECT ranker, query, round(mrr, 6) AS mrr, round(ndcg, 6) AS ndcg, round(precision_at_k, 6) AS precision_at_k
FROM (SELECT ranker, query, mrr, ndcg, precision_at_k FROM report UNION ALL
      SELECT ranker, '(average)', avg(mrr), avg(ndcg), avg(precision_at_k) FROM report GROUP BY ranker)""",
    "precision_at_k": f"WITH {LIST_REPORT} SELECT query_id, round(precision_at_k, 6) AS precision_at_k FROM report",
    "ndcg_at_k": f"WITH {LIST_REPORT} SELECT query_id, round(ndcg, 6) AS ndcg FROM report",
    "mrr": f"""WITH {LISTS},
firsts AS (SELECT query_id, min(rank) FILTER (rel > 0) AS r FROM lists GROUP BY 1)
SELECT round(avg(coalesce(1.0::DOUBLE / r, 0)), 6) AS mrr FROM firsts""",
    "evaluate_ranking": f"""WITH {LIST_REPORT}
SELECT query_id, round(mrr, 6) AS mrr, round(ndcg, 6) AS ndcg, round(precision_at_k, 6) AS precision_at_k,
  round(mean_score, 6) AS mean_score FROM report""",
    "confusion": f"WITH {LABELLED} SELECT y_true, y_pred, count(*) AS n FROM labelled GROUP BY ALL",
    "classification_report": f"""WITH {LABELLED},
classes AS (SELECT y_true AS c FROM labelled UNION SELECT y_pred FROM labelled),
counts AS (
  SELECT c, count(*) FILTER (y_true = c AND y_pred = c)::DOUBLE AS tp, count(*) FILTER (y_true = c)::DOUBLE AS support,
         count(*) FILTER (y_pred = c)::DOUBLE AS predicted
  FROM classes, labelled GROUP BY c)
SELECT round(sum(tp) / sum(support), 6) AS accuracy,
  round(sum(support * CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END) / sum(support), 6) AS precision,
  round(sum(support * CASE WHEN support > 0 THEN tp / support ELSE 0 END) / sum(support), 6) AS recall,
  round(sum(support * CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0 END) / sum(support), 6)
    AS f1_score
FROM counts""",
    "sentiment_distribution": f"WITH {ARTICLE_SCORES} {_distribution('scored')}",
    "distribution_merged": f"WITH {ARTICLE_SCORES} {_distribution('scored')}",
    "distribution_merged_by": f"WITH {ARTICLE_SCORES} {_distribution('scored', 'query')}",
    "trend_merged": f"WITH {ARTICLE_SCORES} "
    + _trend("scored", "ts", "sentiment", _month_ends("2024-01-01", "2024-12-31"), "last_day(ts::DATE)", "%Y-%m",
             "< TIMESTAMP '2025-01-01'", "2024-01-01"),
    "distribution_by": f"WITH {ARTICLE_SCORES} {_distribution('scored', 'query')}",
    "distribution_lineitem": _distribution(
        "lineitem", "l_returnflag, l_linestatus", "(l_tax - l_discount)", low=-0.025, high=0.025
    ),
    "parse_time": f"WITH {ARTICLES} SELECT doc_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM articles",
    "time_rejects": f"""WITH {ARTICLES}
SELECT doc_id, regexp_replace(published_at, '-[0-9]{{2}}-', '-13-') AS published_at FROM articles WHERE query <> 'en'""",
    "time_filter": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'""",
    "monthly_trend": f"WITH {ARTICLE_SCORES} "
    + _trend("scored", "ts", "sentiment", _month_ends("2024-01-01", "2024-12-31"), "last_day(ts::DATE)", "%Y-%m",
             "<= TIMESTAMP '2024-12-31'", "2024-01-01"),
    "trend_daily": _trend(
        "events", "ts", "value",
        "SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-02-15', INTERVAL 1 DAY))::DATE AS b",
        "ts::DATE", "%Y-%m-%d", "<= TIMESTAMP '2024-02-15'", "2024-01-01"),
    "trend_weekly": f"WITH {ARTICLE_SCORES} "
    + _trend("scored", "ts", "sentiment",
             "SELECT unnest(generate_series(DATE '2024-01-07', DATE '2025-01-05', INTERVAL 7 DAY))::DATE AS b",
             "(date_trunc('week', ts) + INTERVAL 6 DAY)::DATE", "%Y-%m-%d", "< TIMESTAMP '2025-01-01'", "2024-01-01"),
    "trend_events": _trend("events", "ts", "value", _month_ends("2024-01-01", "2024-12-31"), "last_day(ts::DATE)",
                           "%Y-%m", "<= TIMESTAMP '2024-12-31'", "2024-01-01"),
    "streamed_trend": _trend("events", "ts", "value", _month_ends("2024-01-01", "2024-12-31"), "last_day(ts::DATE)",
                             "%Y-%m", "< TIMESTAMP '2025-01-01'", "2024-01-01"),
    "streamed_quota": f"""SELECT event_id AS request_id, strftime(ts, '%Y-%m-%d') AS day,
  row_number() OVER (PARTITION BY ts::DATE ORDER BY ts, event_id) AS request_no
FROM events QUALIFY request_no <= {catalog.QUOTA}""",
    "trend_orders": _trend("orders", "o_orderdate", "o_totalprice", _month_ends("1995-01-01", "2001-12-31"),
                           "last_day(o_orderdate::DATE)", "%Y-%m", "<= TIMESTAMP '2001-12-31'", "1995-01-01"),
}

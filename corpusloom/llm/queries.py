"""The registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import ann, bpe, chat, decontam, langid, lm, neardup, quality, tokencount, urlfilter
from corpusloom.operators.order import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable:
    def put(function: Callable) -> Callable:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return put


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))


RULES = [
    urlfilter.rule(verdict, text)
    for verdict, text in (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
]
#: Advertised addresses: the canonical URLs of pages reached by a campaign link are the query's listing.
LISTED_URLS = "[?&]utm_source="

_URL_SQL = r"""
WITH parts AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
keyed AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '') END AS canonical FROM parts),
listed AS (
  SELECT DISTINCT canonical FROM keyed WHERE regexp_matches(url, '[?&]utm_source=')),
judged AS (
  SELECT k.*, l.canonical IS NOT NULL AS hit,
    CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM keyed k LEFT JOIN listed l ON k.canonical = l.canonical)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN hit THEN 'block' ELSE 'allow' END AS verdict,
  canonical
FROM judged
"""


@_query(_URL_SQL)
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page by the rules, then by the listing of the advertised canonical URLs."""
    pages = _table(spark, folder, "pages").select("page_id", "url")
    host = urlfilter.host_of(F.col("url"))
    listed = pages.filter(F.col("url").rlike(LISTED_URLS)).select(urlfilter.canonical(host, urlfilter.path_of(F.col("url"))).alias("canonical"))
    keys = listed.select(F.approx_count_distinct("canonical")).first()[0]
    return urlfilter.url_verdicts(pages, RULES, listed, keys=keys)


@_query()
def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and the bytes that they decode to, as digests."""
    return bpe.encoded(_table(spark, folder, "documents"), ids=False)


@_query()
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document as the library counts them."""
    return tokencount.token_counts(_table(spark, folder, "documents"))


_CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, row_number() OVER w AS n, lag(role) OVER w AS before,
    CASE role WHEN 'system' THEN 6 WHEN 'user' THEN 4 WHEN 'assistant' THEN 9
      ELSE 1 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g')) END AS name_chars
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY n), '')) AS loss_sha256,
  CAST(sum(4 + name_chars + 2 + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')) + 8) AS BIGINT) AS formatted_chars,
  bool_and(coalesce(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user'
    WHEN before = 'user' THEN role = 'assistant' ELSE false END, false)) AS valid
FROM marked GROUP BY conv_id
"""


@_query(_CHAT_SQL)
def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    tricky = "\\### Assistant: </turn> ok"
    kind = "conv_id long, turn long, role string, text string"
    planted = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], kind)
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.read_back(chat.segments(rows))


@_query()
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from the labels outside the held-out quarter."""
    docs = _table(spark, folder, "documents")
    trees = quality.fit(docs, _table(spark, folder, "labels"))
    scored = quality.score(docs, trees)
    return scored.select("doc_id", F.coalesce(quality.remainder() == 2, F.lit(False)).alias("held_out"), "score", "predicted")


@_query()
def op7_langid(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned outside the held-out quarter."""
    docs = _table(spark, folder, "documents")
    named = langid.identify(docs, langid.dictionaries(docs))
    return named.select("doc_id", F.coalesce(quality.remainder() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


_DECONTAM_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark),
bs AS (SELECT item_id, words, least(8, len(words)) AS n, unnest(range(1, greatest(len(words) - 7, 1) + 1)) AS i FROM b WHERE len(words) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS win FROM bs),
ns AS (SELECT DISTINCT n FROM bw),
ds AS (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, ns WHERE len(words) >= n),
dw AS (SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS win FROM ds),
hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, win)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@_query(_DECONTAM_SQL)
def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document against the windows of every benchmark item."""
    return decontam.decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query()
def op4_neardup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of near-duplicates among all documents: three-word shingles, similarity 0.85."""
    return neardup.near_duplicates(_table(spark, folder, "documents"), words=3, percent=85)


@_query()
def op6_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's log10 probability by the hierarchical Pitman-Yor model of four fifths of them."""
    return lm.lm_scores(_table(spark, folder, "documents"))


@_query()
def op9_ann(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest of all vectors, for each whose id is divisible by 100."""
    return ann.nearest(_table(spark, folder, "embeddings"), every=100, k=10)

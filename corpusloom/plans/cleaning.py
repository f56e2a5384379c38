"""Queries over lines, documents and sentences.

The tables hold no Han text, so query and SQL derive it in the same way: small
letters become Han characters, some marks their wide forms, some capitals
illegal ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import chars
from corpusloom.functions import text as T
from corpusloom.operators import documents as D
from corpusloom.operators import lines as L
from corpusloom.operators import sentences as S
from corpusloom.operators import wiki
from corpusloom.operators.order import spread
from corpusloom.plans.registry import query

DERIVE_FROM = "abcdefghijklmnopqrstuvwxyz.?!QXA"
DERIVE_TO = "的一是不了在人有我他这中大来上个国到说们为子和你地出。？！①→Ａ"
PART_CHARS, LEAST_CHARS, CHUNK = 100_000, 200, 1_000
HEADING = "参考资料"


def derived(text: Column) -> Column:
    return F.translate(text, DERIVE_FROM, DERIVE_TO)


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/documents.parquet"))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return L.to_lines(_docs(spark, folder).select("doc_id", derived(F.col("text")).alias("text")))


_ALLOWED = chars.char_class(r"\p{L}")
_DERIVED = f"translate(text, '{DERIVE_FROM}', '{DERIVE_TO}')"
_LINES = f"""
raw AS (SELECT doc_id, string_split({_DERIVED}, chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(range(len(parts))) AS line_no, unnest(parts) AS line FROM raw)"""
_JUDGED = f"""{_LINES},
converted AS (SELECT doc_id, line_no, line, translate(line, '{chars.CONVERT_FROM}', '{chars.CONVERT_TO}') AS t FROM lines
  WHERE length(line) + length(regexp_replace(line, '[^{chars.BEYOND_BMP}]', '', 'g')) >= 5),
parts AS (SELECT *, regexp_extract(t, '[^{_ALLOWED}]|[{chars.BEYOND_BMP}]', 0) AS illegal,
  regexp_replace(t, '[{chars.escaped(chars.SPACES + chr(0))}]', '', 'g') AS kept FROM converted),
counted AS (SELECT *, regexp_replace(kept, '[^{chars.HAN}]', '', 'g') AS han,
  length(regexp_extract(t, '(?s)^((?:[^\\x00]*\\x00){{5}})', 1)) AS nuls FROM parts),
judged AS (SELECT doc_id, line_no, line, illegal, kept, han,
  CASE WHEN nuls > 0 AND (illegal = '' OR nuls < instr(t, illegal)) THEN 'bad' WHEN illegal <> '' THEN 'err'
       WHEN length(han) > 5 AND (length(han) > 50 OR CAST(CAST(length(han) AS FLOAT) / CAST(length(kept) AS FLOAT) AS FLOAT) > CAST(0.7 AS FLOAT)) THEN 'ok'
       ELSE 'bad' END AS verdict FROM counted)"""
_FIRSTS = f"""{_JUDGED},
ranked AS (SELECT *, row_number() OVER (PARTITION BY han ORDER BY doc_id, line_no) AS nth FROM judged WHERE verdict = 'ok')"""


@query(f"SELECT doc_id, translate({_DERIVED}, '{chars.CONVERT_FROM}', '{chars.CONVERT_TO}') AS converted FROM documents")
def char_convert(spark: SparkSession, folder: str) -> DataFrame:
    """Every text with its characters converted."""
    return _docs(spark, folder).select("doc_id", chars.convert(derived(F.col("text"))).alias("converted"))


@query(f"WITH {_JUDGED} SELECT doc_id, line_no, han FROM judged")
def han_section(spark: SparkSession, folder: str) -> DataFrame:
    """The Han characters of every line."""
    return L.judged(_lines(spark, folder)).select("doc_id", "line_no", "han")


@query(f"WITH {_JUDGED} SELECT doc_id, line_no, illegal FROM judged WHERE illegal <> ''")
def first_illegal(spark: SparkSession, folder: str) -> DataFrame:
    """The first illegal character of every line that has one."""
    return L.judged(_lines(spark, folder)).filter("illegal != ''").select("doc_id", "line_no", "illegal")


@query(f"WITH {_JUDGED} SELECT doc_id, line_no, kept, illegal, verdict FROM judged")
def line_verdict(spark: SparkSession, folder: str) -> DataFrame:
    """What becomes of every line before repeats are sought."""
    return L.judged(_lines(spark, folder)).select("doc_id", "line_no", "kept", "illegal", "verdict")


@query(f"WITH {_JUDGED} SELECT illegal, count(*) AS n FROM judged WHERE verdict = 'err' GROUP BY illegal")
def illegal_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return L.illegal_histogram(L.judged(_lines(spark, folder)))


@query(f"WITH {_JUDGED} SELECT illegal, count(*) AS n FROM judged WHERE verdict = 'err' GROUP BY illegal ORDER BY n DESC, illegal LIMIT 5")
def illegal_topk(spark: SparkSession, folder: str) -> DataFrame:
    return L.illegal_histogram(L.judged(_lines(spark, folder)), 5)


@query(f"WITH {_FIRSTS} SELECT doc_id, line_no, kept FROM ranked WHERE nth = 1")
def line_dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    """Good lines, the first of equal Han content."""
    fine = L.judged(_lines(spark, folder)).filter("verdict = 'ok'").select("doc_id", "line_no", "kept", "han")
    return L.first_of(fine, "han", ["doc_id", "line_no"]).select("doc_id", "line_no", "kept")


@query(f"""WITH {_FIRSTS} SELECT doc_id, line_no, kept, CASE WHEN nth = 1 THEN 'kept' ELSE 'repeat' END AS verdict FROM ranked
UNION ALL SELECT doc_id, line_no, kept, verdict FROM judged WHERE verdict <> 'ok'""")
def line_filter(spark: SparkSession, folder: str) -> DataFrame:
    """All four outcomes of the line filter."""
    return L.filtered(_lines(spark, folder)).select("doc_id", "line_no", "kept", "verdict")


@query(f"WITH {_FIRSTS} SELECT doc_id, line_no, han FROM ranked WHERE nth > 1")
def repeat_lines(spark: SparkSession, folder: str) -> DataFrame:
    return L.repeats(_lines(spark, folder)).select("doc_id", "line_no", "han")


_WHOLE = f"""{_FIRSTS},
whole AS (SELECT doc_id, string_agg(kept, chr(10) ORDER BY line_no) || chr(10) AS text, count(*) AS n_lines FROM ranked WHERE nth = 1 GROUP BY doc_id)"""


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    first = line_dedup_first(spark, folder)
    return D.reassembled(first.select("doc_id", "line_no", F.col("kept").alias("line")))


@query(f"WITH {_WHOLE} SELECT doc_id, text, n_lines FROM whole")
def doc_reassemble(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned documents, put together from their lines."""
    return _cleaned(spark, folder)


@query(f"WITH {_WHOLE} SELECT doc_id, length(text) AS n_chars, CASE WHEN length(text) > {LEAST_CHARS} THEN 'keep' ELSE 'discard' END AS verdict FROM whole")
def doc_length_gate(spark: SparkSession, folder: str) -> DataFrame:
    return D.gated(_cleaned(spark, folder), LEAST_CHARS).select("doc_id", "n_chars", "verdict")


def _sized(spark: SparkSession, folder: str) -> DataFrame:
    docs = _docs(spark, folder).filter("text is not null and doc_id is not null")
    return docs.select("doc_id", F.coalesce("source", F.lit("")).alias("shard"), (F.length("text") + 1).cast("long").alias("size"))


_SIZED = "sized AS (SELECT doc_id, coalesce(source, '') AS shard, CAST(length(text) + 1 AS BIGINT) AS size FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL)"


@query(f"WITH {_SIZED} SELECT doc_id, size, CAST(floor((sum(size) OVER (ORDER BY doc_id) - size) / {PART_CHARS}) AS BIGINT) + 1 AS part FROM sized")
def pack_parts_window(spark: SparkSession, folder: str) -> DataFrame:
    """Parts by running size."""
    return D.packed_by_window(_sized(spark, folder), "size", ["doc_id"], PART_CHARS).select("doc_id", "size", "part")


@query(f"""WITH RECURSIVE {_SIZED},
placed AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id) AS n FROM sized),
packed AS (SELECT shard, n, doc_id, size, CAST(1 AS BIGINT) AS part, size AS total FROM placed WHERE n = 1
  UNION ALL SELECT p.shard, p.n, p.doc_id, p.size, CASE WHEN k.total > {PART_CHARS} THEN k.part + 1 ELSE k.part END,
    CASE WHEN k.total > {PART_CHARS} THEN 0 ELSE k.total END + p.size FROM packed k JOIN placed p ON p.shard = k.shard AND p.n = k.n + 1)
SELECT shard, doc_id, size, part FROM packed""")
def pack_parts_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of each source, ended by the document that exceeds the limit."""
    return D.packed_in_order(_sized(spark, folder), "shard", "size", ["doc_id"], PART_CHARS)


@query(f"WITH {_LINES} SELECT doc_id, line_no, CAST(floor((row_number() OVER (ORDER BY doc_id, line_no) - 1) / {CHUNK}) AS BIGINT) AS chunk FROM lines")
def count_rollover(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of so many lines over all documents."""
    return D.batches(_lines(spark, folder).select("doc_id", "line_no"), ["doc_id", "line_no"], CHUNK)


_SENTENCES = f"""{_LINES},
cut AS (SELECT doc_id, line_no, list_filter(string_split(regexp_replace(translate(line, '()', '（）'), '{T.SENTENCE_PATTERN}', '\\1' || chr(10), 'g'), chr(10)), lambda s: s <> '') AS parts FROM lines),
sentences AS (SELECT doc_id, line_no, unnest(range(len(parts))) AS sent_no, unnest(parts) AS sentence FROM cut)"""


@query(f"WITH {_SENTENCES} SELECT doc_id, line_no, sent_no, sentence FROM sentences")
def sentence_split(spark: SparkSession, folder: str) -> DataFrame:
    return S.split_sentences(_lines(spark, folder))


@query(f"""WITH {_SENTENCES},
trimmed AS (SELECT doc_id, line_no, sent_no, regexp_replace(sentence, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS sentence FROM sentences),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sentence ORDER BY doc_id, line_no, sent_no) AS nth FROM trimmed WHERE length(sentence) <> 1)
SELECT r.doc_id, line_no, sent_no, sentence, 'doc ' || r.doc_id AS title, CASE WHEN d.lang IS NOT NULL THEN d.lang || '|' || coalesce(d.source, '') END AS categories, 'wikipedia' AS source
FROM ranked r JOIN documents d ON r.doc_id = d.doc_id WHERE nth = 1""")
def sentence_dedup_tag(spark: SparkSession, folder: str) -> DataFrame:
    """The first of equal sentences, with its document's title and categories."""
    docs = _docs(spark, folder).select(
        "doc_id", F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("title"),
        F.when(F.col("lang").isNotNull(), F.array("lang", F.coalesce("source", F.lit("")))).alias("categories"),
    )
    return S.tagged(S.distinct_sentences(S.split_sentences(_lines(spark, folder))), docs)


_HEADED = f"(CASE WHEN line_no % 6 = 4 THEN '{HEADING}' WHEN line_no % 6 = 5 THEN 'Category::x,y' ELSE line || '[' || line_no || ']' END)"


def _headed(spark: SparkSession, folder: str) -> DataFrame:
    at = F.col("line_no") % 6
    noted = F.concat("line", F.lit("["), F.col("line_no").cast("string"), F.lit("]"))
    return _lines(spark, folder).withColumn("line", F.when(at == 4, HEADING).when(at == 5, "Category::x,y").otherwise(noted))


@query(f"""WITH {_LINES},
headed AS (SELECT doc_id, line_no, regexp_replace({_HEADED}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS line FROM lines),
cut AS (SELECT *, max(CASE WHEN line = '{HEADING}' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS gone FROM headed)
SELECT doc_id, line_no, line FROM cut WHERE gone = 0 OR line = 'END::' OR starts_with(line, 'Category::')""")
def section_cut(spark: SparkSession, folder: str) -> DataFrame:
    """Documents up to the first heading of the closing sections."""
    return wiki.cut_sections(_headed(spark, folder))


@query(f"""WITH {_LINES},
headed AS (SELECT doc_id, line_no, regexp_replace({_HEADED}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS line FROM lines)
SELECT doc_id, line_no, regexp_replace(line, '\\[.*?]', '', 'g') AS line FROM headed WHERE line <> ''""")
def footnote_strip(spark: SparkSession, folder: str) -> DataFrame:
    return wiki.strip_footnotes(_headed(spark, folder))


_MARKS = T.OPENING + T.CLOSING + "()"
_NO_MARKS = f"[{chars.escaped(_MARKS)}]"


@query(f"""WITH {_LINES},
quoted AS (SELECT doc_id, line_no, regexp_replace(regexp_replace(line, '{_NO_MARKS}', '', 'g'), '。([^。]*)。', '“\\1，”', 'g') AS line FROM lines),
spans AS (SELECT doc_id, line_no, list_filter(regexp_extract_all(line, '“[^“”]*”[{chars.escaped(T.ABSORBED)}]{{0,2}}'), lambda x: instr(x, '”') > {T.LONG_WITH_MARK}) AS spans FROM quoted)
SELECT doc_id, line_no, unnest(range(len(spans))) AS span_no, unnest(spans) AS span FROM spans""")
def quote_span(spark: SparkSession, folder: str) -> DataFrame:
    """Quotations of every line; marks are left out, and words between full stops put into marks, with a comma."""
    quoted = F.regexp_replace(F.translate("line", _MARKS, ""), "。([^。]*)。", "“$1，”")
    # Put out by a generator: the filter of likely lines would otherwise repeat the replacements.
    lines = _lines(spark, folder).select("doc_id", "line_no", F.explode(F.array(quoted)).alias("line"))
    return S.quotations(lines).withColumn("span_no", F.col("span_no").cast("long"))


@query("""WITH f AS (SELECT doc_id, 'URL::http://x/' || doc_id || chr(10) || coalesce(text, '') || chr(10) || 'END::' AS text FROM documents WHERE doc_id IS NOT NULL),
p AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM f),
l AS (SELECT doc_id, unnest(range(len(parts))) AS line_no, unnest(parts) AS line, len(parts) AS n FROM p)
SELECT CAST(doc_id AS VARCHAR) AS file, 'http://x/' || doc_id AS url, line_no, rtrim(line, chr(13)) AS line FROM l WHERE line_no > 0 AND line_no < n - 1""")
def framed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written in frames and read again."""
    docs = _docs(spark, folder).filter("doc_id is not null").select(F.col("doc_id").cast("string").alias("file"), F.concat(F.lit("http://x/"), F.col("doc_id").cast("string")).alias("url"), "text")
    value = F.concat(F.lit(D.OPEN), "url", F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(f"\n{D.CLOSE}"))
    return D.unframed(docs.select("file", value.alias("text"))).select("file", "url", "line_no", "line")

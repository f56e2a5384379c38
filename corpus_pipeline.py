"""From raw documents to token ids: quality, language, near-duplicates, benchmark leaks, encoding.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet into the cluster's shared folder and read
again.  All stages but the last return the columns that they were given.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, decontam, langid, neardup, quality
from corpusloom.llm.shared import unused
from corpusloom.operators.order import removed, shared_folder, spread

#: No SQL: trees, compression and byte-pair encoding have none; the tests hold each stage against its brute-force version.
ORACLE_SQL = None


def _columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{c}`") for c in docs.columns))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose quality score is below 0.7; without any usable label nothing is dropped."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trees = quality.fit(docs, labels)
    if not len(trees.roots):
        return docs
    (_, predicted) = unused(["score", "predicted"], docs.columns)
    return _columns(quality.score(docs, trees, keep=docs.columns).filter(F.col(predicted) == 1), docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents without a letter, and those of which two languages are about equally likely."""
    contents = langid.dictionaries(docs)
    if not contents:
        return docs
    (*_, rejected) = unused(["lang_pred", "score", "rejected"], docs.columns)
    return _columns(langid.identify(docs, contents, keep=docs.columns).filter(~F.col(rejected)), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: five-word shingles, similarity 0.8.

    Of exact repetitions of a row one stays.  Rows of one id are judged each by
    its text.  A group stays with its smallest id; one without any id with the
    rows of one of its texts.  Documents without words stay.
    """
    first = neardup.classes(docs, words=5, percent=80).filter("first").select("doc_id", "text_hash").distinct()
    row, hashed, own = unused(["row", "hashed", "own"], docs.columns)
    marked = docs.withColumn(hashed, F.xxhash64("text"))
    kept = marked.join(first.withColumnsRenamed({"doc_id": own, "text_hash": row}), F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(hashed) == F.col(row)), "left_semi")
    digest = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    return _columns(kept.withColumn(row, digest).dropDuplicates(["doc_id", row]), docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows whose text holds a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    (*_, contaminated) = unused(["n_words", "n_hit", "n_items", "items_sha256", "contaminated"], docs.columns)
    judged = decontam.decontaminate(docs, benchmark, size=8, least=1, keep=docs.columns)
    return _columns(judged.filter(~F.col(contaminated)), docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes that they decode to."""
    return bpe.encoded(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("language id", language_stage),
    ("minhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level bpe", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again, and removed when the next one is there."""
    place = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{number}")
        docs = spark.read.parquet(f"{place}/{number}")
        if number:
            removed(spark, f"{place}/{number - 1}")
    return docs

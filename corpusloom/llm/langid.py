"""Language identification by compression (operator 7).

For each language a zstandard raw-content dictionary holds passages in it.  A
text is compressed with every dictionary; the smallest result names the
language.  A narrow margin to the next language is reported as a rejection.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from corpusloom.llm.quality import remainder
from corpusloom.llm.shared import sliced, unused

_LETTER = re.compile(r"[^\W\d_]")
#: ASCII bytes that are not letters become spaces, so that only words are compared.
_WORDS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: Bytes of a passage of a dictionary.
PASSAGE = 1024
#: Bytes that the best language must save on the next, for each square root of the text's bytes: differences by chance grow with that.
NARROW = 0.4


def plain(text: str) -> bytes:
    return b" ".join(text.encode().translate(_WORDS).split())


def _passage(text: str, draw: int) -> bytes:
    """At most PASSAGE bytes of whole words, from a place that ``draw`` chooses."""
    data = plain(text)
    if len(data) <= PASSAGE:
        return data
    start = draw % (len(data) - PASSAGE)
    part = data[start : start + PASSAGE + 1]
    if start and data[start - 1 : start] != b" ":
        part = part.partition(b" ")[2]
    return part.rpartition(b" ")[0] or data[start : start + PASSAGE]


def dictionaries(docs: DataFrame, size: int = 32_768, sample: int = 120, languages: int = 400) -> dict[str, bytes]:
    """For each of the ``languages`` most frequent languages passages of sampled texts, at most ``size`` bytes.

    Only rows outside the held-out quarter with text and language are used.
    The hashes of their texts choose about ``sample`` different texts of each
    language, with a rate that follows from how many it has over all documents;
    of each a passage is cut out where it lies, and only passages come to the
    driver.  Of equally frequent languages the first by name are taken.
    """
    hashed = F.xxhash64("text", F.lit("sample"))
    usable = docs.filter((remainder() != 2) & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text", hashed.alias("hash"))
    counted = usable.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("hash").alias("texts"))
    counts = {r.lang: r for r in counted.orderBy(F.desc("n"), "lang").limit(languages).collect()}
    if not counts:
        return {}
    steps = 1 << 30
    draw = F.pmod("hash", F.lit(steps))
    rate = F.lit(0)
    for lang, r in counts.items():
        rate = F.when(F.col("lang") == lang, F.lit(min(steps, math.ceil(steps * sample / max(1, r.texts))))).otherwise(rate)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [_passage(t, d) if _LETTER.search(t) else b"" for t, d in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())], names=["lang", "draw", "passage"])

    chosen = usable.filter(draw < rate).select("lang", "text", draw.alias("draw")).mapInArrow(cut, "lang string, draw long, passage binary")
    # Copies of a text count once.
    rows = chosen.filter(F.octet_length("passage") > 0).groupBy("lang", "draw").agg(F.min("passage").alias("passage")).collect()
    picked: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r.draw, r.passage)):
        picked.setdefault(r.lang, []).append(bytes(r.passage))
    return {lang: _filled(picked[lang], size) for lang in counts if lang in picked}


def _filled(passages: list[bytes], size: int) -> bytes:
    """The first passages that fit into ``size``, at least a part of one."""
    parts, left = [], size
    for p in passages:
        if len(p) + 1 <= left:
            parts.append(p)
            left -= len(p) + 1
    return b" ".join(reversed(parts)) or passages[0][:size]


class Compressors:
    """A compressor for each language; matches of three bytes count.

    Long texts are compressed in chunks, each against the dictionary alone: a
    text's own history would take the dictionary's place, and its head decide.
    """

    CHUNK = 16_384

    def __init__(self, contents: dict[str, bytes]):
        import zstandard as z

        self.languages = list(contents)
        how = z.ZstdCompressionParameters(window_log=18, chain_log=17, hash_log=17, search_log=5, min_match=3, target_length=64, strategy=z.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0)
        self._each = [z.ZstdCompressor(dict_data=z.ZstdCompressionDict(contents[lang], dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=how) for lang in self.languages]

    def sizes(self, data: bytes) -> list[int]:
        chunks = [data[k : k + self.CHUNK] for k in range(0, len(data), self.CHUNK)] or [data]
        return [sum(len(c.compress(chunk)) for chunk in chunks) for c in self._each]


def verdict(sizes: list[int], languages: list[str], narrow: float) -> tuple[str, float, bool]:
    """(language, score, rejected): a byte saved on another language is 8 bits of evidence, tempered by 4."""
    order = np.argsort(np.array(sizes), kind="stable")
    best = sizes[order[0]]
    score = 1.0 / sum(math.exp(-min(700.0, (s - best) * 8 * math.log(2) / 4)) for s in sizes)
    margin = sizes[order[1]] - best if len(sizes) > 1 else narrow
    return languages[order[0]], score, margin < narrow


def identify(docs: DataFrame, contents: dict[str, bytes], narrow: float = NARROW, keep: list[str] | None = None) -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``rejected`` to ``docs`` (columns ``keep``, by default doc_id), for every row, from its whole text.

    Null texts and texts without a letter are ``und`` with score 0, and are
    rejected.  ``rejected`` is also true where the best two languages differ by
    less than ``narrow`` bytes for each square root of the text's bytes, or not at
    all; ties go to the language with more documents.  A single language has no rival.
    Without any language everything is ``und``.  If ``keep`` has columns of
    these names, the added ones end in an underscore.
    """
    names = keep or ["doc_id"]
    added = unused(["lang_pred", "score", "rejected"], names)
    place = names.index("text") if "text" in names else len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(contents) if contents else None
        for batch in sliced(batches):
            rows = []
            for text in batch.column(place):
                text = text.as_py()
                if compressors is None or text is None or not _LETTER.search(text):
                    rows.append(("und", 0.0, True))
                else:
                    data = plain(text)
                    rows.append(verdict(compressors.sizes(data), compressors.languages, max(1, narrow * math.sqrt(len(data)))))
            langs, scores, rejected = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], names=[*names, *added])

    kinds = StructType([*(docs.schema[n] for n in names), *map(StructField, added, (StringType(), DoubleType(), BooleanType()))])
    return docs.select(*(F.col(f"`{n}`") for n in names), *([] if "text" in names else ["text"])).mapInArrow(run, kinds)

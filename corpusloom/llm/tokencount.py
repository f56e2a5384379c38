"""Token counts by a tokenizer library, huge documents included (operator 5).

Texts up to a bound are counted piece by piece (see ``pieces``), each distinct
piece by the library once.  Huge texts are encoded in overlapping chunks with
offsets.  Two neighbouring chunks are spliced at a place in their overlap where
both have a token border and where the text proves that no token can cross: an
ASCII blank after a character that is not white space.  If an overlap has no
such place the next chunk starts further left, twice as far each time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.pieces import cut
from corpusloom.llm.shared import sliced

#: Pieces whose counts a worker remembers.
_KNOWN = 600_000
#: Python's white space is wider than the pattern's, which errs on the safe side.
_STABLE = re.compile(r"(?<=\S)(?<![\x1c-\x1f\x85])[ \t\r\n]")


def spliced_count(text: str, encode: Callable, chunk: int = 65_536, overlap: int = 2_048) -> int:
    """Tokens of a text of any length; ``encode(text)`` gives the tokens' (start, end) offsets."""
    total, begin, size = 0, 0, len(text)
    while True:
        end = min(size, begin + chunk)
        here = np.array(encode(text[begin:end]), np.int64).reshape(-1, 2) + begin
        while end < size:
            back, place = overlap, -1
            while place < 0 and end - back > begin:
                place = _splice(text, here, end - back, end, encode)
                back *= 2
            if place > begin:
                break
            # Nothing is stable in this chunk: it grows until something is, or to the end.
            end = min(size, end + (end - begin))
            here = np.array(encode(text[begin:end]), np.int64).reshape(-1, 2) + begin
        else:
            return total + len(here)
        total += int(np.count_nonzero(here[:, 1] <= place))
        begin = place


def _splice(text: str, here: np.ndarray, low: int, end: int, encode: Callable) -> int:
    """The last proven border in [low, end) where both chunks have a token border; -1 without one."""
    ends, starts = set(here[:, 1].tolist()), set(here[:, 0].tolist())
    for match in reversed(list(_STABLE.finditer(text, max(low, 1), end - 1))):
        at = match.start()
        if at in ends and at in starts:
            other = encode(text[low:end])
            borders = {low + a for a, _ in other} & {low + b for _, b in other}
            return at if at in borders or at == low else -1
    return -1


@lru_cache(maxsize=2)
def _counter(name: str, chunk: int) -> Callable[[list[str]], list[int]]:
    import os

    import public_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(model.encode(x, add_bos=False, add_eos=False)) for x in texts]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    if not name.startswith("byte_bpe"):  # the proof of the borders is that pattern's
        return lambda texts: [len(library.encode(x, add_special_tokens=False)) for x in texts]
    known: dict[str, int] = {}

    def huge(text: str) -> int:
        return spliced_count(text, lambda part: library.encode(part, add_special_tokens=False).offsets, chunk)

    def count(texts: list[str]) -> list[int]:
        cuts = [None if len(x) > chunk else cut(x) for x in texts]
        new = list({piece for pieces in cuts if pieces for piece in pieces if piece not in known})
        if len(known) + len(new) > _KNOWN:
            known.clear()
            new = list({piece for pieces in cuts if pieces for piece in pieces})
        known.update(zip(new, map(len, library.encode_batch_fast(new, add_special_tokens=False)), strict=True))
        return [huge(x) if pieces is None else sum(map(known.__getitem__, pieces)) for x, pieces in zip(texts, cuts, strict=True)]

    return count


def _runs(texts: list[str], chars: int = 2_000_000) -> Iterator[list[str]]:
    """The texts in runs of bounded length."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size > chars:
            yield run
            run, size = [], 0
    yield run


def token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = 1024, chunk: int = 65_536) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: UTF-8 bytes, tokens, and whether they exceed the limit.

    Null and empty texts have no bytes and no tokens.  Repeated rows give
    repeated rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(vocabulary, chunk)
        for batch in sliced(batches):
            texts = [x.as_py() or "" for x in batch.column(1)]
            tokens = np.array([n for part in _runs(texts) for n in count(part)], np.int64)
            sizes = np.array([len(x.encode()) for x in texts], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

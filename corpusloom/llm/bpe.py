"""Byte-level BPE encoding and decoding (operator 3).

Every match of the split pattern is encoded on its own.  Bytes are mapped to
Latin-1 characters, one each, so that the trie of an Aho-Corasick automaton of
the whole vocabulary finds the longest token at a place.  From there the
encoder goes forward; where a token cannot follow its predecessor it tries the
next shorter one, and when none is left it steps back and marks the place as a
dead end, so no place is entered again by the same token.  Whether two tokens may be neighbours is decided from the merge
ranks (would the merges of the joined bytes give exactly this pair?) and
memoised.  The result is the merges' own result, in time linear in the length.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.pieces import Memo
from corpusloom.llm.shared import sliced, sole

_NONE = 1 << 62


class BytePairCodec:
    """Encoder and decoder for a rank file and a split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self._split = regex.compile(pattern).findall
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._longest = max(map(len, ranks))
        self._lengths = {rank: len(token) for token, rank in ranks.items()}
        self._ranks_of = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in self._ranks_of.items():
            self._automaton.add_word(token, rank)
        self._best = Memo(self._longest_of, max_chars=10_000_000)
        self._shorter = self._prefixes()
        self._pair: dict[tuple[int, int], int] = {}
        self._halves: dict[int, tuple[int, int]] = {}
        self._may_follow: dict[tuple[int, int], bool] = {}
        self._unmerge()
        self._may_follow.clear()
        self._words = Memo(self._encode_match, max_chars=40_000_000)

    def _prefixes(self) -> dict[int, int]:
        """For each token the longest other token that begins it, or -1."""
        shorter = {}
        for token, rank in self.ranks.items():
            n = len(token) - 1
            while n and token[:n] not in self.ranks:
                n -= 1
            shorter[rank] = self.ranks[token[:n]] if n else -1
        return shorter

    def _unmerge(self) -> None:
        """The two tokens whose merge makes each token; a token no merge makes stands for itself."""
        for rank in sorted(self.tokens):
            token = self.tokens[rank]
            self._halves[rank] = (rank, rank)
            left = self._shorter[rank]
            while left != -1:
                right = self.ranks.get(token[len(self.tokens[left]) :], _NONE)
                if left < rank and right < rank and self._compatible(left, right):
                    self._halves[rank] = (left, right)
                    self._pair[left, right] = rank
                    break
                left = self._shorter[left]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes stop at exactly these two.

        Walks the merges of both sides backwards, latest first, and looks for a
        merge across the border that would have come earlier.
        """
        limit = _NONE
        while True:
            if self._pair.get((left, right), _NONE) < limit:
                return False
            if left > right:
                limit, left = left, self._halves[left][1]
                if left != limit:
                    continue
                limit, right = right + 1, self._halves[right][0]
                if right + 1 == limit:
                    return True
            else:
                limit, right = right + 1, self._halves[right][0]
                if right + 1 != limit:
                    continue
                limit, left = left, self._halves[left][1]
                if left == limit:
                    return True

    def _follows(self, left: int, right: int) -> bool:
        known = self._may_follow.get((left, right))
        if known is None:
            if len(self._may_follow) > 500_000:
                self._may_follow.clear()
            known = self._may_follow[left, right] = self._compatible(left, right)
        return known

    def _longest_of(self, prefix: str) -> int:
        """The longest token that begins a path of the automaton's trie."""
        while prefix not in self._ranks_of:
            prefix = prefix[:-1]
        return self._ranks_of[prefix]

    def _encode_match(self, text: str) -> bytes:
        data = text if text.isascii() else text.encode().decode("latin-1")
        whole = self._ranks_of.get(data)
        if whole is not None:
            return whole.to_bytes(4, "little")
        lengths, shorter, known, follows = self._lengths, self._shorter, self._may_follow, self._follows
        reach, best, longest = self._automaton.longest_prefix, self._best, self._longest
        size, at, out, last, dead = len(data), 0, [], -1, set()
        ahead = data[:longest]
        token = best[ahead[: reach(ahead)]]
        while True:
            end = at + lengths[token]
            if end not in dead and (last < 0 or (ok := known.get((last, token))) or ok is None and follows(last, token)):
                out.append(token)
                if end == size:
                    return array("I", out).tobytes()
                at, last = end, token
                ahead = data[at : at + longest]
                token = best[ahead[: reach(ahead)]]
                continue
            token = shorter[token]
            if token < 0:
                dead.add(at)
                token = out.pop()
                at -= lengths[token]
                last = out[-1] if out else -1

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers; null is as empty."""
        return b"".join(map(self._words.__getitem__, self._split(text))) if text else b""

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@sole
def codec(name: str) -> BytePairCodec:
    """The codec of a rank file of the public tokenizers, built once in each Python worker."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return BytePairCodec(ranks, public_tokenizers.PATTERN)


def encoded(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", ids: bool = True) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: number and digest of the ids, digest and size of the decoded bytes, and the ids if wanted.

    Null and empty texts have no tokens and the digests of nothing.  Repeated
    rows give repeated rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocabulary)
        for batch in sliced(batches):
            n, ids_hex, out_hex, sizes, all_ids = [], [], [], [], []
            for text in batch.column(1):
                packed = bpe.encode_bytes(text.as_py())
                numbers = np.frombuffer(packed, "<u4")
                decoded = bpe.decode(numbers.tolist())
                if ids:
                    all_ids.append(numbers.astype(np.int32))
                n.append(len(numbers))
                ids_hex.append(hashlib.sha256(packed).hexdigest())
                out_hex.append(hashlib.sha256(decoded).hexdigest())
                sizes.append(len(decoded))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(out_hex, pa.string()), pa.array(sizes, pa.int64())]
            if ids:
                offsets = pa.array(np.cumsum([0, *map(len, all_ids)], dtype=np.int32))
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int32), *all_ids]))))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "token_ids"][: len(columns)])

    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"
    return docs.select("doc_id", "text").mapInArrow(run, kinds + ", token_ids array<int>" * ids)

"""Language-model scoring by a hierarchical Pitman-Yor model (operator 6).

Every word follows its predecessor in the restaurant of that predecessor (its
context); the restaurants of all contexts share one parent, the restaurant of
the words themselves, whose base is uniform over the vocabulary and one unknown
word.  Gibbs sweeps alternate between the contexts and the parent: how many
tables serve a word in a restaurant, given the parent's probabilities and the
restaurant's other tables, is drawn from its conditional by generalised Stirling
numbers; the tables of all contexts are the parent's customers, whose seating is
drawn in the same way.  The predictive probabilities of the last samples are
averaged.  All draws of a sweep start from the state before it, and every draw
takes its random number from the hash of what it is for: the scores are a
function of the data alone, not of how they are dealt out.

Nothing is sent to all executors and nothing but a few hot contexts comes to the
driver.  Words and contexts are 64-bit hashes, and the occurrences go, packed,
to groups by context.  A word has a home, where its customers and tables in the
parent are kept.  A step of a sweep is one exchange: the groups send to the
homes what their words add, the homes answer with the totals of the words asked
for.  After the first exchange only words that are twice or more in a context
are sent, as single customers have one table whatever happens.  A group and a
home exchange a message only if they share words, so there are never more
messages than words in groups.  A context with a large share of all occurrences
is dealt out over the groups by word; its totals travel like those of a word,
and so do the totals over everything.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.neardup import _mixed, _word_hashes

#: Hashes of the end of a text and of the context of its first word; no word has them, as words' hashes keep the lowest bit set.
END, START = 2, 4
#: Of entries that are no words the three lowest bits are zero.  These hold totals: tokens and tables of the contexts; words and
#: tables of the parent; types seen once and twice; words with one and with two customers in the parent.
SUMS, PARENT, ONCE_TWICE, PARENT_ONCE_TWICE = TOTALS = 8, 16, 24, 32
#: Occurrences that a group is meant to hold, those of a block of documents, and the least share that makes a context a hot one.
GROUP_TOKENS, BLOCK_TOKENS, LEAST_SHARE = 1_500_000, 2_000_000, 1 / 20_000
#: Customers whose tables are weighed by Stirling numbers; for those beyond the sums have a closed form.
EXACT = 512
#: Sweeps, of which the last ones are averaged.
SWEEPS, SAMPLES = 4, 2
STRENGTH, PARENT_STRENGTH = 1.0, 10.0
_ROWS = "q int, p int, kind string, blob binary"


def _hashes(text: str | None) -> np.ndarray:
    found = (text or "").encode().lower().split()
    h = np.fromiter(map(_word_hashes().__getitem__, found), np.uint64, len(found)) if found else np.empty(0, np.uint64)
    return np.concatenate([h | np.uint64(1), np.array([END], np.uint64)])


def _pack(**arrays: np.ndarray) -> bytes:
    import zstandard

    out = []
    for name, x in arrays.items():
        out.append(f"{name}:{x.dtype.str}:{len(x)}\n".encode() + x.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    import zstandard

    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, {}
    while at < len(data):
        stop = data.index(b"\n", at)
        name, kind, n = data[at:stop].decode().split(":")
        size = int(n) * np.dtype(kind).itemsize
        out[name] = np.frombuffer(data, kind, int(n), stop + 1)
        at = stop + 1 + size
    return out


def _small(x: np.ndarray) -> np.ndarray:
    """The values in the narrowest unsigned type."""
    return x.astype(np.min_scalar_type(int(x.max())) if len(x) else np.uint8)


@lru_cache(maxsize=64)
def _stirling(d: float) -> np.ndarray:
    """log of the generalised Stirling numbers S_d(c, t), for c and t up to EXACT."""
    s = np.full((EXACT + 1, EXACT + 1), -np.inf)
    s[0, 0] = 0.0
    for c in range(EXACT):
        t = np.arange(1, c + 1)
        stay = np.full(c + 2, -np.inf)
        stay[1 : c + 1] = s[c, 1 : c + 1] + np.log(c - d * t)
        s[c + 1, : c + 2] = np.logaddexp(stay, np.concatenate([[-np.inf], s[c, : c + 1]]))
    return s


def _spread(x: np.ndarray) -> np.ndarray:
    """Sorted hashes as differences, by bytes of one place: the highest bytes are mostly zero."""
    return np.ascontiguousarray(np.diff(x, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).ravel()


def _gathered(x: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(x.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def _chance(h: np.ndarray, salt: int) -> np.ndarray:
    """A number from 0 to 1 for each hash."""
    return (_mixed(h ^ np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _discount(once: int, twice: int) -> float:
    return round(float(np.clip(once / (once + 2 * twice), 0.1, 0.95)), 4) if once else 0.5


def seat(c: np.ndarray, rest: np.ndarray, p0: np.ndarray, theta: float, d: float, h: np.ndarray, salt: int) -> np.ndarray:
    """Tables of dishes with ``c`` customers, given the restaurant's other tables ``rest`` and the parent's probabilities; ``h``: a hash for each draw.

    t tables have the weight S(c, t) times the product of (theta + d (rest + j)) p0 for j < t.  Up to EXACT customers that is
    drawn from.  Each further one, the i-th, multiplies by i - d t or opens a table; with exp(-d t / i) for 1 - d t / i the sums over all that
    may happen have a closed form: the weights of t after EXACT customers times a power, and negative binomially more tables.
    """
    t = np.minimum(c, 1).astype(np.int64)
    drawn = np.minimum(c, EXACT)
    order = np.argsort(drawn, kind="stable")
    first = np.searchsorted(drawn[order], np.arange(2, EXACT + 2))
    logs, chance = _stirling(d), _chance(h, salt)
    stay = np.maximum(c / EXACT, 1.0) ** -d
    more = p0 * (1 - stay)
    for n in np.unique(drawn[drawn > 1]):
        rows = order[first[n - 2] : first[n - 1]]
        for at in range(0, len(rows), max(1, 500_000 // n)):
            r = rows[at : at + max(1, 500_000 // n)]
            open_ = np.log(theta + d * (rest[r][:, None] + np.arange(n))) + np.log(p0[r] * stay[r] / (1 - more[r]))[:, None]
            weight = logs[n, 1 : n + 1] + np.cumsum(open_, 1)
            sums = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), 1)
            t[r] = 1 + np.minimum((sums < chance[r][:, None] * sums[:, -1:]).sum(1), n - 1)
    for r in np.flatnonzero(c > EXACT):
        rng = np.random.Generator(np.random.Philox(key=int(h[r]), counter=salt))
        t[r] += min(int(c[r]) - EXACT, rng.negative_binomial(t[r] + theta / d + rest[r], 1 - more[r]))
    return t


def _occurrences(docs: DataFrame, held_out_of: int, groups: int, hot: list[int]) -> DataFrame:
    """Packed occurrences by group: for each block of documents the rows, counts per row, and contexts and words as places in a list of hashes.

    The ids of a block's rows go to one group, in a blob of their own.
    """
    heavy = np.array(sorted(hot), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33

        def block(parts: list[np.ndarray], ids: list, train: list[bool], first: int) -> pa.RecordBatch:
            sizes = np.array([len(x) for x in parts])
            known, word = np.unique(np.concatenate([*parts, np.array([START], np.uint64)]), return_inverse=True)
            word = word.astype(np.uint32)
            context = np.concatenate([word[-1:], word[:-2]])
            word = word[:-1]
            context[np.cumsum(sizes)[:-1]] = context[0]
            doc = np.repeat(np.arange(len(parts), dtype=np.uint32), sizes)
            group = (_mixed(known) % np.uint64(groups)).astype(np.int32)[context]
            if len(heavy):
                spots = np.flatnonzero(np.isin(known, heavy)[context])
                group[spots] = (_mixed(known[context[spots]] ^ (known[word[spots]] * np.uint64(31))) % np.uint64(groups)).astype(np.int32)
            order = np.argsort(group, kind="stable")
            borders = np.searchsorted(group[order], np.arange(groups + 1))
            learned = np.array(train)
            home = int(_home(np.array([first], np.uint64), groups)[0])
            out = [(home, home, "I", _pack(rows=np.arange(len(ids)) + first, ids=np.array([0 if i is None else i for i in ids], np.int64), null=np.array([i is None for i in ids])))]
            for p in np.unique(group):
                o = order[borders[p] : borders[p + 1]]
                used, places = np.unique(np.concatenate([context[o], word[o]]), return_inverse=True)
                rows, per = np.unique(doc[o], return_counts=True)
                out.append((p, p, "O", _pack(hashes=_spread(known[used]), c=_small(places[: len(o)]), w=_small(places[len(o) :]), first=np.array([first]), steps=_small(np.diff(rows, prepend=np.uint32(0))), train=learned[rows], per=_small(per))))
            return _batch(out)

        parts, ids, train, size, first = [], [], [], 0, row
        for batch in batches:
            for i, learn, text in zip(*(batch.column(k) for k in range(3)), strict=True):
                parts.append(_hashes(text.as_py()))
                ids.append(i.as_py())
                train.append(bool(learn.as_py()))
                size, row = size + len(parts[-1]), row + 1
                if size >= BLOCK_TOKENS:
                    yield block(parts, ids, train, first)
                    parts, ids, train, size, first = [], [], [], 0, row
        if parts:
            yield block(parts, ids, train, first)

    learn = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % held_out_of != 1, F.lit(True))
    return docs.select("doc_id", learn.alias("learn"), "text").mapInArrow(run, _ROWS)


def _batch(rows: list[tuple[int, int, str, bytes]]) -> pa.RecordBatch:
    q, p, kind, blob = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(p, pa.int32()), pa.array(kind, pa.string()), pa.array(blob, pa.binary())], names=["q", "p", "kind", "blob"])


def _home(hashes: np.ndarray, groups: int) -> np.ndarray:
    return (_mixed(hashes ^ np.uint64(0x5DEECE66D)) % np.uint64(groups)).astype(np.int32)


def _blobs(table: pa.Table | None, kind: str) -> dict[int, dict[str, np.ndarray]]:
    """By sender, in its order, what was sent of a kind."""
    if table is None:
        return {}
    rows = [(p, b) for p, k, b in zip(table.column("p").to_pylist(), table.column("kind").to_pylist(), table.column("blob"), strict=True) if k == kind]
    return {p: _unpack(b.as_py()) for p, b in sorted(rows, key=lambda r: r[0])}


class _Group:
    """The occurrences of a group, merged: types (context, word) with their counts in training texts, and its entries at the homes.

    Entries are the group's words, its hot contexts and the totals, by home and hash.
    """

    def __init__(self, table: pa.Table, heavy: np.ndarray, groups: int):
        parts = [_unpack(b.as_py()) for k, b in zip(table.column("kind").to_pylist(), table.column("blob"), strict=True) if k == "O"]
        merged = lambda name, kind: np.concatenate([np.empty(0, kind), *(x[name] for x in parts)]).astype(kind)
        known = [_gathered(x["hashes"]) for x in parts]
        self.hashes = np.unique(np.concatenate([np.empty(0, np.uint64), *known]))
        n = np.int64(max(1, len(self.hashes)))
        place = [np.searchsorted(self.hashes, x) for x in known]
        keys = np.concatenate([np.empty(0, np.int64), *(m[x["c"]] * n + m[x["w"]] for m, x in zip(place, parts, strict=True))])
        types, type_of = np.unique(keys, return_inverse=True)
        self.type_of = type_of.astype(np.int32)
        per = merged("per", np.int64)
        learned = np.repeat(merged("train", bool), per)
        self.count = np.bincount(type_of, learned, len(types)).astype(np.int64)
        self.context, self.word = types // n, types % n
        self.rows = np.concatenate([np.empty(0, np.int64), *(np.cumsum(x["steps"], dtype=np.int64) + x["first"] for x in parts)])
        self.row_of = np.repeat(np.arange(len(per), dtype=np.int32), per)
        used = np.unique(self.word)
        spots = np.flatnonzero(np.isin(self.hashes, heavy))
        named = np.concatenate([self.hashes[used], _mixed(self.hashes[spots] ^ np.uint64(START)) & ~np.uint64(7) | np.uint64(1 << 63), np.array(TOTALS, np.uint64)])
        home = _home(named, groups)
        order = np.lexsort((named, home))
        self.entries, self.homes = named[order], home[order]
        at = np.empty(len(named), np.int64)
        at[order] = np.arange(len(named))
        self.entry_of_word = np.zeros(len(self.hashes), np.int64)
        self.entry_of_word[used] = at[: len(used)]
        self.entry_of_context = np.full(len(self.hashes), -1, np.int64)
        self.entry_of_context[spots] = at[len(used) : len(used) + len(spots)]
        self.totals = at[len(used) + len(spots) :]

    def summed(self, t: np.ndarray) -> np.ndarray:
        """What tables ``t`` of the types add to the entries."""
        hot = self.entry_of_context[self.context]
        out = np.bincount(self.entry_of_word[self.word], t, len(self.entries)) + np.bincount(hot[hot >= 0], t[hot >= 0], len(self.entries))
        out[self.totals[0]] = t.sum()
        return out.astype(np.int64)

    def hash_of_types(self) -> np.ndarray:
        return _mixed(self.hashes[self.context] * np.uint64(3) ^ _mixed(self.hashes[self.word]))


def _by_home(homes: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each home of sorted ``homes`` with its stretch."""
    starts = np.flatnonzero(np.concatenate([[True], homes[1:] != homes[:-1]])) if len(homes) else np.empty(0, int)
    for a, b in zip(starts, [*starts[1:], len(homes)], strict=True):
        yield int(homes[a]), slice(int(a), int(b))


def _parent(m: np.ndarray, t: np.ndarray, tables: float, words: float, total: float, d: float) -> np.ndarray:
    """The parent's predictive probabilities of words with m customers at t tables."""
    return (m - d * t + (PARENT_STRENGTH + d * tables) / (words + 1)) / (PARENT_STRENGTH + total)


def _begin(key: tuple, table: pa.Table, groups: int, heavy: np.ndarray) -> pa.Table:
    """Of a group: W to the homes, all its entries with counts and with one table for each type; and T to itself, its types of two customers and more."""
    p, group = key[0].as_py(), _Group(table, heavy, groups)
    seen = np.minimum(group.count, 1)
    c, m = group.summed(group.count), group.summed(seen)
    c[group.totals], m[group.totals] = [group.count.sum(), 0, (group.count == 1).sum(), 0], [seen.sum(), 0, (group.count == 2).sum(), 0]
    several = np.flatnonzero(group.count > 1)
    varies = np.zeros(len(group.entries), bool)
    varies[group.entry_of_word[group.word[several]]] = True
    varies[group.entry_of_context[group.entry_of_context >= 0]] = True
    varies[group.totals] = True
    place = np.cumsum(varies) - 1
    out = [(q, p, "W", _pack(words=_spread(group.entries[s]), c=_small(c[s]), m=_small(m[s]), varies=varies[s])) for q, s in _by_home(group.homes)]
    contexts, spot = np.unique(group.context[several], return_inverse=True)
    once = np.where(group.count == 1, 1, 0)
    hot = group.entry_of_context[contexts]
    fixed = group.summed(once)
    fixed[group.totals[2]] = m[group.totals[2]]
    out.append((p, p, "T", _pack(
        h=(group.hash_of_types()[several] >> np.uint64(32)).astype(np.uint32), c=_small(group.count[several]), w=_small(place[group.entry_of_word[group.word[several]]]), u=_small(spot),
        alone=_small(np.bincount(group.context, once, len(group.hashes)).astype(np.int64)[contexts]), hot=np.where(hot >= 0, place[hot], -1), fixed=fixed[varies], counts=c[varies],
        homes=_small(group.homes[varies]), totals=place[group.totals],
    )))
    return pa.Table.from_batches([_batch(out)])


def _at_home(key: tuple, begun: pa.Table, sent: pa.Table | None, sweep: int) -> pa.Table:
    """Adds up what the groups have sent, seats the parent's customers and answers; after the last sweep for all entries and samples."""
    q = key[0].as_py()
    asked, news = _blobs(begun, "W"), _blobs(sent, "U")
    out = [(q, q, "T", b.as_py()) for k, b in zip(sent.column("kind").to_pylist(), sent.column("blob"), strict=True) if k == "T"] if sent is not None else []
    if not asked:
        return pa.Table.from_batches([_batch(out)])
    named = {p: _gathered(x["words"]) for p, x in asked.items()}
    words = np.unique(np.concatenate(list(named.values())))
    places = {p: np.searchsorted(words, x) for p, x in named.items()}
    c, m = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for p, x in asked.items():
        own_c, own_m = x["c"].astype(np.int64), x["m"].astype(np.int64)
        if p in news:
            own_c[x["varies"]], own_m[x["varies"]] = news[p]["c"], news[p]["m"]
        c[places[p]] += own_c
        m[places[p]] += own_m
    is_word = (words & np.uint64(7)) != 0
    held = _blobs(sent, "H").get(q, {})
    t = held.get("t", np.minimum(m, 1) * is_word).astype(np.int64)
    _, size, tables, once, twice = next(iter(news.values()))["known"] if news else [0] * 5
    if size:
        own = np.flatnonzero(is_word)
        t[own] = seat(m[own], np.maximum(tables - t[own], 0), np.full(len(own), 1 / (size + 1)), PARENT_STRENGTH, _discount(once, twice), words[own], 1000 + sweep)
    state = {"t": t} | {k: v for k, v in held.items() if k != "t"}
    if sweep >= SWEEPS - SAMPLES + 1:
        state |= {f"m{sweep}": m, f"t{sweep}": t.copy()}
    last = sweep == SWEEPS
    if not last:
        out.append((q, q, "H", _pack(**{k: _small(v) for k, v in state.items()})))
    # A home's own sums go to one of the groups.
    sums = np.array([(c[is_word] > 0).sum(), t[is_word].sum(), (m[is_word] == 1).sum(), (m[is_word] == 2).sum()], np.int64)
    for n, (p, x) in enumerate(asked.items()):
        at = places[p] if last else places[p][x["varies"]]
        fields = {k: _small(v[at]) for k, v in state.items() if k != "t"} if last else {"m": _small(m[at]), "t": _small(t[at])}
        out.append((p, q, "D", _pack(c=_small(c[at]), sums=sums if n == 0 else sums * 0, **fields)))
    return pa.Table.from_batches([_batch(out)])


def _filled(answers: dict[int, dict], name: str, homes: np.ndarray) -> np.ndarray:
    """What the homes answered, in the order of the entries."""
    out = np.zeros(len(homes), np.int64)
    for q, s in _by_home(homes):
        out[s] = answers[q][name]
    return out


def _in_group(key: tuple, begun: pa.Table, sent: pa.Table, sweep: int) -> pa.Table:
    """Seats the customers of the contexts by the parent's probabilities, and sends to the homes what the tables add up to."""
    p = key[0].as_py()
    out = [(p, p, "H", b.as_py()) for k, b in zip(sent.column("kind").to_pylist(), sent.column("blob"), strict=True) if k == "H"]
    own = _blobs(begun, "T")
    if not own:
        return pa.Table.from_batches([_batch(out)])
    x, answers, held = own[p], _blobs(sent, "D"), _blobs(sent, "T").get(p, {})
    c, m, t0 = (_filled(answers, name, x["homes"]) for name in ("c", "m", "t"))
    (tokens, words, once, single), (total, tables, twice, pairs) = c[x["totals"]], m[x["totals"]]
    d, d0 = _discount(once, twice), _discount(single, pairs)
    # The first sweep does not know yet how many words there are.
    p0 = _parent(m, t0, tables, words, total, d0) if words else (m + 0.5) / (total + 0.5)
    count = x["c"].astype(np.int64)
    t = held.get("t", np.ones(len(count), np.int64)).astype(np.int64)
    there = np.bincount(x["u"], t, len(x["alone"])) + x["alone"]
    there = np.where(x["hot"] >= 0, m[x["hot"]], there) if len(there) else there
    t = seat(count, np.maximum(there[x["u"]] - t, 0), p0[x["w"]], STRENGTH, d, x["h"].astype(np.uint64), sweep)
    now = x["fixed"] + np.bincount(x["w"], t, len(m)).astype(np.int64)
    is_hot = x["hot"][x["u"]] >= 0
    now += np.bincount(x["hot"][x["u"]][is_hot], t[is_hot], len(m)).astype(np.int64)
    counts, sums = x["counts"].copy(), sum(a["sums"] for a in answers.values())
    at = x["totals"]
    now[at[0]] = x["fixed"][at[0]] + t.sum()
    counts[at[1]], now[at[1]], counts[at[3]], now[at[3]] = sums
    known = np.array([tokens, words, tables, single, pairs], np.int64)
    out += [(q, p, "U", _pack(c=_small(counts[s]), m=_small(now[s]), known=known)) for q, s in _by_home(x["homes"])]
    state = {k: v for k, v in held.items() if k != "t"} | {"t": _small(t)}
    out.append((p, p, "T", _pack(**state, **({f"t{sweep}": _small(t)} if sweep > SWEEPS - SAMPLES else {}))))
    return pa.Table.from_batches([_batch(out)])


def _scored(key: tuple, table: pa.Table, sent: pa.Table, groups: int, heavy: np.ndarray) -> pa.Table:
    """Sums of the group's occurrences by row; and the rows whose ids came to this group."""
    p, group = key[0].as_py(), _Group(table, heavy, groups)
    ids = [_unpack(b.as_py()) for k, b in zip(table.column("kind").to_pylist(), table.column("blob"), strict=True) if k == "I"]
    answers, own = _blobs(sent, "D"), _blobs(sent, "T").get(p, {})
    c = _filled(answers, "c", group.homes)
    train, words, once, single = c[group.totals].tolist()
    u, d = group.context, None
    guests = np.bincount(u, group.count, len(group.hashes))
    is_hot = group.entry_of_context >= 0
    guests[is_hot] = c[group.entry_of_context[is_hot]]
    chance, several = np.zeros(len(group.count)), group.count > 1
    for sweep in range(SWEEPS - SAMPLES + 1, SWEEPS + 1):
        m, t0 = (_filled(answers, f"{name}{sweep}", group.homes) for name in ("m", "t"))
        total, tables, twice, pairs = m[group.totals].tolist()
        d, d0 = _discount(once, twice), _discount(single, pairs)
        t = np.minimum(group.count, 1)
        t[several] = own[f"t{sweep}"]
        there = np.bincount(u, t, len(group.hashes))
        there[is_hot] = m[group.entry_of_context[is_hot]]
        p0 = _parent(m, t0, tables, words, total, d0)[group.entry_of_word[group.word]]
        chance += (group.count - d * t + (STRENGTH + d * there[u]) * p0) / (STRENGTH + guests[u])
    held = c[group.entry_of_word[group.word]]
    logs, base = np.log10(chance / SAMPLES), np.log10((held + 0.5) / (train + 0.5 * (words + 1)))
    row, at = np.unique(group.rows, return_inverse=True)
    at = at[group.row_of]
    add = lambda x: np.bincount(at, x[group.type_of], len(row))
    named = np.concatenate([np.empty(0, np.int64), *(x["rows"] for x in ids)])
    id_ = pa.array(np.concatenate([np.zeros(len(row), np.int64), *(x["ids"] for x in ids)]), mask=np.concatenate([np.ones(len(row), bool), *(x["null"] for x in ids)]))
    none = np.zeros(len(named), np.int64)
    columns = [np.bincount(at, minlength=len(row)).astype(np.int64), add(held > 0).astype(np.int64), np.full(len(row), train, np.int64), add(base), add(logs)]
    return pa.table([pa.array(np.concatenate([row, named])), id_, *(pa.array(np.concatenate([x, none.astype(x.dtype)])) for x in columns)], names=["row", "doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def lm_scores(docs: DataFrame, held_out_of: int = 5, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32 of the id, as text, modulo ``held_out_of``
    is not 1 (null ids learn).  A null or empty text is one end token.  Without
    any training text the model is uniform.  Rows of one id stay apart; other
    columns are ignored; an empty table gives an empty result.  ``group_tokens``
    bounds a task's memory and does not change a score, but for the order in
    which numbers are added.

    The number of the parent's tables in a sweep is that of the sweep before.
    """

    def heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        total = starts = 0

        def flush() -> pa.RecordBatch:
            top = [(_word_hashes()[w] | 1, n) for w, n in counts.items() if n >= LEAST_SHARE * total]
            top += [(START, starts), (0, total)]
            h, n = zip(*top, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(np.array(h, np.uint64).view(np.int64)), pa.array(n, pa.int64())], names=["h", "n"])

        for batch in batches:
            for text in batch.column(0):
                found = (text.as_py() or "").encode().lower().split()
                counts.update(found)
                total, starts = total + len(found) + 1, starts + 1
            if len(counts) > 400_000:
                yield flush()
                counts.clear()
                total = starts = 0
        yield flush()

    shares = docs.select("text").mapInArrow(heavy, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = shares.orderBy(F.desc("n"), "h").limit(int(2 / LEAST_SHARE)).collect()  # few words can have so large a share
    total = sum(r.n for r in top if r.h == 0)
    groups = max(2, -(-total // group_tokens), min(64, total // 100_000))
    hot = [r.h % (1 << 64) for r in top if r.h != 0 and r.n >= total * max(LEAST_SHARE, 0.5 / groups)]
    heavy_hashes = np.array(sorted(hot), np.uint64)
    packed = _occurrences(docs, held_out_of, groups, hot).groupBy("q")
    begun = packed.applyInArrow(lambda key, table: _begin(key, table, groups, heavy_hashes), _ROWS).groupBy("q")
    sent = begun.applyInArrow(lambda key, table: _at_home(key, table, None, 0), _ROWS)
    step = lambda f, sweep: lambda key, table, news: f(key, table, news, sweep)
    for sweep in range(1, SWEEPS + 1):
        for f in (_in_group, _at_home):
            sent = begun.cogroup(sent.groupBy("q")).applyInArrow(step(f, sweep), _ROWS)
    kinds = "row long, doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    parts = packed.cogroup(sent.groupBy("q")).applyInArrow(lambda key, table, news: _scored(key, table, news, groups, heavy_hashes), kinds)
    added = parts.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *(F.sum(x).alias(x) for x in ("n_tokens", "n_known")), F.max("train_tokens").alias("train_tokens"), *(F.sum(x).alias(x) for x in ("base_score", "score")))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % held_out_of == 1, F.lit(False))
    return added.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

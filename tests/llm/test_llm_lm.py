"""The language model against samplers that are written out: one customer after another, and sums over all seatings."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import lm

KIND = "doc_id long, text string"


def _tokens(text):
    return [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text)] + [None]


def _held(i):
    return zlib.crc32(str(i).encode()) % 5 == 1


def _corpus(n, seed=3):
    """Texts of a chain of words, with words that are seen once and one that follows the same word very often."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(n):
        text, at = [], 0
        for k in range(rng.randint(5, 40)):
            at = int(40 * rng.random() ** 3) if rng.random() < 0.5 else (at * 7 + 1) % 40
            text.append(words[at] if rng.random() < 0.95 else f"once{i}x{k}")
        rows.append((i, " ".join(text)))
    return rows


class Restaurant:
    """Customers at tables by dish; takes customers in and out one at a time."""

    def __init__(self, theta, d, above):
        self.theta, self.d, self.above = theta, d, above
        self.tables, self.guests, self.open = {}, 0, 0

    def chance(self, w):
        own = self.tables.get(w, ())
        return (sum(own) - self.d * len(own) + (self.theta + self.d * self.open) * self.above.chance(w)) / (self.theta + self.guests)

    def enter(self, w, rng):
        own = self.tables.setdefault(w, [])
        weights = [n - self.d for n in own] + [(self.theta + self.d * self.open) * self.above.chance(w)]
        k = rng.choices(range(len(weights)), weights)[0]
        self.guests += 1
        if k == len(own):
            own.append(1)
            self.open += 1
            self.above.enter(w, rng)
        else:
            own[k] += 1

    def leave(self, w, rng):
        own = self.tables[w]
        k = rng.choices(range(len(own)), own)[0]
        self.guests -= 1
        own[k] -= 1
        if not own[k]:
            own.pop(k)
            self.open -= 1
            self.above.leave(w, rng)


class Base:
    def __init__(self, p):
        self.p = p

    def chance(self, w):
        return self.p

    def enter(self, w, rng):
        pass

    leave = enter


def _one_by_one(rows, sweeps=30, burn=10):
    rng = random.Random(1)
    pairs = lambda text: list(zip([0, *_tokens(text)], _tokens(text)))
    seen = [x for i, text in rows if not _held(i) for x in pairs(text)]
    types = Counter(seen)
    heads = Counter(w for _, w in types)
    once = lambda c: lm._discount(sum(n == 1 for n in c.values()), sum(n == 2 for n in c.values()))
    parent = Restaurant(lm.PARENT_STRENGTH, once(heads), Base(1 / (len(heads) + 1)))
    below = {u: Restaurant(lm.STRENGTH, once(types), parent) for u, _ in types}
    for u, w in seen:
        below[u].enter(w, rng)
    sums = {i: np.zeros(len(pairs(text))) for i, text in rows}
    for sweep in range(sweeps):
        for u, w in seen:
            below[u].leave(w, rng)
            below[u].enter(w, rng)
        if sweep >= burn:
            for i, text in rows:
                sums[i] += [below[u].chance(w) if u in below else parent.chance(w) for u, w in pairs(text)]
    return {i: float(np.log10(x / (sweeps - burn)).sum()) for i, x in sums.items()}


def test_scores_as_of_a_sampler_of_single_customers(spark):
    rows = _corpus(120)
    wanted = _one_by_one(rows)
    got = {r.doc_id: r.score for r in lm.lm_scores(spark.createDataFrame(rows, KIND)).collect()}
    assert abs(sum(got.values()) / sum(wanted.values()) - 1) < 0.01
    assert max(abs(got[i] / wanted[i] - 1) for i in wanted) < 0.06


def test_scores_do_not_depend_on_groups(spark):
    docs = spark.createDataFrame(_corpus(400), KIND)
    scores = [{r.doc_id: r for r in lm.lm_scores(docs, group_tokens=n).collect()} for n in (1_000_000, 700)]
    for i, r in scores[0].items():
        other = scores[1][i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (other.n_tokens, other.n_known, other.train_tokens, other.held_out)
        assert math.isclose(r.score, other.score, rel_tol=1e-9) and math.isclose(r.base_score, other.base_score, rel_tol=1e-9)


def _exact(c, rest, p0, theta, d):
    """Chances of 1..c tables, customer by customer."""
    f = np.zeros(c + 1)
    f[1] = 1.0
    for n in range(1, c):
        t = np.arange(c + 1)
        opened = np.concatenate([[0], f[:-1] * (theta + d * (rest + t[:-1])) * p0])
        f = f * np.maximum(n - d * t, 0) * (t >= 1) + opened
        f /= f.sum()
    return f[1:] / f[1:].sum()


@pytest.mark.parametrize("c, rest, p0", [(2, 0, 0.3), (5, 3, 0.1), (40, 100, 0.01), (600, 50, 0.02), (3000, 400, 0.005), (4000, 300, 0.05)])
def test_tables_by_their_conditional(c, rest, p0):
    n = 4000
    h = np.random.default_rng(5).integers(0, 1 << 63, n).astype(np.uint64)
    t = lm.seat(np.full(n, c), np.full(n, rest), np.full(n, p0), 1.0, 0.7, h, 1)
    chances = _exact(c, rest, p0, 1.0, 0.7)
    mean = (chances * np.arange(1, c + 1)).sum()
    spread = math.sqrt((chances * (np.arange(1, c + 1) - mean) ** 2).sum())
    # Beyond EXACT customers there is an approximation.
    assert abs(t.mean() - mean) < 4 * spread / math.sqrt(n) + (0.06 * mean if c > lm.EXACT else 0)
    assert abs(t.std() - spread) < 0.1 * spread + 0.05

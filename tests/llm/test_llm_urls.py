"""URL rules, the Bloom filter and the listing, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import queries, urlfilter

URLS = [
    None, "", "no scheme", "http://", "http://Example.ORG", "http://example.org/es/1", "http://www.example.org/en/12?x=1", "https://sub.example.org/es/#f",
    "https://notexample.org/es/a", "http://a.com/fr/x", "http://a.com/de/x", "http://com/de/", "ftp://b.net//", "http://m.b.net", "http://b.net?q=1#z",
    "x://y://z/w", "http://B.net/ÄÖ", "http://example.org/en/1", "http://example.org/en/1",
]


def _parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    stop = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if c.isascii() else c for c in rest[:end]), path[:stop]


def _rule(host, path, rules):
    fitting = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return min(fitting, key=lambda r: (-len(r.text), r.text), default=None)


def _canonical(host, path):
    if not host:
        return None
    for start in ("www.", "m."):
        if host.startswith(start):
            host = host[len(start) :]
            break
    return host + path.rstrip("/")


def _wanted(rows, rules, listed):
    out = []
    for i, url in rows:
        host, path = _parts(url)
        rule = _rule(host, path, rules)
        verdict = rule.verdict if rule else "block" if _canonical(host, path) in listed else "allow"
        out.append((i, host, path, rule and rule.text, verdict, _canonical(host, path)))
    return sorted(out, key=repr)


def _got(frame):
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.canonical) for r in frame.collect()), key=repr)


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, "h", "c", "l") for i, u in rows], "page_id long, url string, host string, canonical string, listed string")


def _listing(spark, listed):
    return spark.createDataFrame([(x,) for x in listed], "canonical string")


ROWS = [*enumerate(URLS), (3, "http://b.net"), (None, "http://b.net/"), (None, None)]


@pytest.mark.parametrize("listed", [[], [None], ["b.net", "b.net", None, "example.org/es/1"]])
def test_pages_with_odd_urls(spark, listed):
    got = urlfilter.url_verdicts(_pages(spark, ROWS), queries.RULES, _listing(spark, listed), keys=len(listed))
    assert _got(got) == _wanted(ROWS, queries.RULES, set(listed) - {None})
    assert urlfilter.url_verdicts(_pages(spark, []), queries.RULES, _listing(spark, listed), keys=1).count() == 0


def test_equally_long_rules(spark):
    rules = [urlfilter.rule("allow", "example.org/"), urlfilter.rule("block", "org/aaaaaaaa")]
    for given in (rules, rules[::-1]):
        got = urlfilter.url_verdicts(_pages(spark, [(1, "http://example.org/aaaaaaaab")]), given, _listing(spark, []), keys=0)
        assert got.first().rule == "example.org/"


def test_many_rules_as_one_by_one(spark, monkeypatch):
    rng = random.Random(6)
    hosts = ["org", "example.org", "a.example.org", "com", "b.com", "x.y.z.net", ""]
    rules = [urlfilter.rule(rng.choice(("allow", "block")), f"{rng.choice(hosts)}/{rng.choice(('', 'a', 'ab', 'b/c'))}{rng.choice(('', '/', '1'))}") for _ in range(120)]
    rows = [(k, f"http://{rng.choice(hosts)}/{rng.choice(('', 'a', 'ab1', 'b/c/', 'abc'))}") for k in range(200)]
    wanted = _wanted(rows, list({r.text: r for r in rules}.values()), set())
    assert _got(urlfilter.url_verdicts(_pages(spark, rows), rules, _listing(spark, []), keys=0)) == wanted
    monkeypatch.setattr(urlfilter, "TRIED_RULES", 3)
    assert _got(urlfilter.url_verdicts(_pages(spark, rows), rules, _listing(spark, []), keys=0)) == wanted


@pytest.mark.parametrize("most", [1 << 18, 4])
def test_false_positives_of_a_full_filter_are_removed(spark, monkeypatch, most):
    """A filter for one key that holds 3,000 lets nearly everything through; also one that is not broadcast."""
    monkeypatch.setattr(urlfilter, "BROADCAST_BLOCKS", most)
    listed = [f"host{k}.net/p" for k in range(3000)]
    rows = [(k, f"http://host{k}.net/{'p' if k % 2 else 'q'}") for k in range(600)]
    filled = urlfilter.bloom(_listing(spark, listed), "canonical", urlfilter.blocks_for(1))
    block, words = urlfilter._place(F.lit("host0.net/q"), urlfilter.blocks_for(1))
    within = words[0].bitwiseAND(F.col("w0")) == words[0]
    for k in (1, 2, 3):
        within &= words[k].bitwiseAND(F.col(f"w{k}")) == words[k]
    assert filled.filter((F.col("block") == block) & within).count() == 1  # passes, and is not listed
    got = urlfilter.url_verdicts(_pages(spark, rows), [], _listing(spark, listed), keys=1)
    assert _got(got) == _wanted(rows, [], set(listed))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan


def test_filter_grows_with_the_listing():
    assert urlfilter.blocks_for(0) == 16
    assert all(n * 16 <= urlfilter.blocks_for(n) * urlfilter.BLOCK_BITS <= n * 64 for n in (10_000, 10**7, 10**9))

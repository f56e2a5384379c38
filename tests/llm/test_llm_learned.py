"""Quality, language, near-duplicates, decontamination, scoring and search against brute force, and the pipeline."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from corpusloom.llm import ann, decontam, langid, lm, neardup, quality, queries

SF = "/root/testdata/sf0.01"
#: Nulls, empty and long texts, repeated rows, and extra columns whose names the operators use themselves.
ODD = [(1, None, "en"), (2, "", "en"), (3, " \n\t", None), (4, "word", "en"), (4, "word", "en"), (5, "one two three four five six seven eight nine ten", "en"),
       (None, "no id at all here", "en"), (6, "long text " * 40_000, "fr"), (7, "...", "de"), (8, "ONE two three four five six seven eight nine ten", "en")]
KIND = "doc_id long, text string, lang string, source string, n_chars long, score string, n string, label string, words string"


def _odd(spark, rows=ODD):
    return spark.createDataFrame([(i, t, lang, None, None, "s", "n", "l", "w") for i, t, lang in rows], KIND)


def _held(i, of=4, rest=2):
    return i is not None and zlib.crc32(str(i).encode()) % of == rest


def _tables(folder=SF):
    import duckdb

    return duckdb.connect().execute(f"SELECT doc_id, text, lang FROM '{folder}/documents.parquet'").fetchall()


def test_quality_of_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.QUERIES["op2_quality"](spark, SF).collect()
    assert len(rows) == len(_tables()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == _held(r.doc_id) for r in rows)
    judged = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in judged) >= 0.9 * len(judged) > 0


def test_trees_walk_as_one_by_one():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    trees = quality.grow(x, y, trees=20)
    for row, raw in zip(x[:50], trees.raw(x[:50]), strict=True):
        total = trees.base
        for at in trees.roots:
            while trees.feature[at] >= 0:
                at = trees.left[at] + (row[trees.feature[at]] > trees.bound[at])
            total += trees.value[at]
        assert math.isclose(total, raw)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.95
    assert quality.grow(np.empty((0, 3)), np.empty(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]


def test_quality_ranks_held_out_documents(spark):
    """Area under the curve of labelled documents that were not learned from; most labels are 1, so shares prove little."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op2_quality"](spark, "/root/testdata/sf0.1").collect() if r.held_out and labels.get(r.doc_id) is not None]
    good, bad = ([r.score for r in rows if labels[r.doc_id] == k] for k in (1, 0))
    assert len(good) > 100 and len(bad) > 50
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) > 0.98 * len(good) * len(bad)
    assert sum(s >= 0.7 for s in good) >= 0.97 * len(good) and sum(s < 0.7 for s in bad) >= 0.9 * len(bad)


def test_trees_as_grown_slowly():
    """One tree of one split: the best of all cuts tried one by one, with the leaves' values by hand."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 20, (300, 3)).astype(float)
    y = (x[:, 1] > 12).astype(float)
    y[:30] = 1 - y[:30]
    trees = quality.grow(x, y, trees=1, depth=1)
    p = (y.sum() + 1) / (len(y) + 2)
    g, h = p - y, np.full(len(y), p * (1 - p))
    part = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1)
    tried = {(j, cut): part(x[:, j] <= cut) + part(x[:, j] > cut) for j in range(3) for cut in range(19) if 10 <= (x[:, j] <= cut).sum() <= 290}
    j, cut = max(tried, key=tried.get)
    assert trees.feature[0] == j and ((x[:, j] > trees.bound[0]) == (x[:, j] > cut)).all()
    for row, raw in zip(x, trees.raw(x), strict=True):
        m = (x[:, j] > cut) == (row[j] > cut)
        assert math.isclose(raw, math.log(p / (1 - p)) - 0.12 * g[m].sum() / (h[m].sum() + 1))


def test_quality_of_repeated_ids(spark):
    rows = [(i, f"some text number {i} " * (i % 5 + 1), "en") for i in range(40)] * 3 + [(i, "other text", "en") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    once = quality.fit(_odd(spark, rows), labels, sample=30)
    assert (once.feature == quality.fit(_odd(spark, rows[::-1]), labels, sample=30).feature).all()


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (5, None, 0), (5, 0, 0), (99, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    trees = quality.fit(_odd(spark), labels)
    assert quality.score(_odd(spark), trees).count() == len(ODD)
    assert quality.score(_odd(spark).limit(0), trees).count() == 0
    kept = quality.score(_odd(spark), trees, keep=_odd(spark).columns)
    assert kept.columns[-2:] == ["score_", "predicted"]
    assert len(quality.fit(_odd(spark).limit(0), labels.limit(0)).roots) == 0


def test_language_of_held_out_documents(spark):
    lang = {i: name for i, _, name in _tables()}
    rows = [r for r in queries.QUERIES["op7_langid"](spark, SF).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.95 * len(rows) > 0


def test_languages_as_by_sizes_alone(spark):
    """The sizes of whole texts, compressed here chunk by chunk with every dictionary, give language, score and rejection."""
    import zstandard as z

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    contents = langid.dictionaries(docs)
    assert contents == langid.dictionaries(docs.repartition(7)) and all(0 < len(x) <= 32_768 for x in contents.values())
    assert contents == langid.dictionaries(docs.unionAll(docs.filter("doc_id % 3 = 0")))  # copies count once
    how = z.ZstdCompressionParameters(window_log=18, chain_log=17, hash_log=17, search_log=5, min_match=3, target_length=64, strategy=z.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0)
    got = {r.doc_id: r for r in langid.identify(docs, contents).collect()}
    for i, text, _ in _tables():
        r = got[i]
        if text is None or not re.search(r"[^\W\d_]", text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        data = " ".join(re.sub("[\x00-\x40\x5b-\x60\x7b-\x7f]", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).split(" ")).encode()
        data = b" ".join(x for x in data.split(b" ") if x)
        sizes = []
        for content in contents.values():
            c = z.ZstdCompressor(dict_data=z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=how)
            sizes.append(sum(len(c.compress(data[k : k + 16_384])) for k in range(0, max(1, len(data)), 16_384)))
        best = min(range(len(sizes)), key=lambda k: sizes[k])
        margin = sorted(sizes)[1] - sizes[best]
        assert (r.lang_pred, r.rejected) == (list(contents)[best], margin < max(1, 0.4 * math.sqrt(len(data))))
        assert math.isclose(r.score, 1 / sum(2 ** (-2 * (s - sizes[best])) for s in sizes), rel_tol=1e-6)


def test_dictionaries_of_ties_and_long_texts(spark):
    rows = [(3, "tie tie tie", "aa"), (3, "tie tie tie", "bb"), (5, "x" * 3_000_000, "cc"), (6, "word " * 500_000, "dd")]
    contents = langid.dictionaries(_odd(spark, [r for r in rows if not _held(r[0])] + [(k, r[1], r[2]) for r in rows for k in (100, 104) if not _held(k)]), size=2000)
    assert set(contents) == {"aa", "bb", "cc", "dd"} and all(len(x) <= 2000 for x in contents.values())
    got = langid.identify(_odd(spark, [(1, "tie tie", "zz")]), {k: contents[k] for k in ("bb", "aa")}).first()
    assert (got.lang_pred, got.rejected) == ("bb", True)  # the one that comes first
    assert set(langid.dictionaries(_odd(spark, rows), languages=2)) <= {"aa", "bb"}


def test_language_of_odd_rows(spark):
    contents = {"en": b"the quick brown fox " * 20, "de": b"der schnelle braune fuchs " * 20}
    got = langid.identify(_odd(spark), contents, keep=_odd(spark).columns).collect()
    assert len(got) == len(ODD)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 7)} == {"und"} and all(r.rejected for r in got if r.doc_id in (1, 2, 3, 7))
    assert {r.lang_pred for r in langid.identify(_odd(spark), {}).collect()} == {"und"}
    assert langid.dictionaries(_odd(spark).limit(0)) == {}


def test_language_of_long_mixed_texts(spark):
    contents = langid.dictionaries(spark.read.parquet(f"{SF}/documents.parquet"))
    texts = {}
    for i, text, lang in sorted(_tables(), key=repr):
        if text and lang in contents and not _held(i):
            texts[lang] = texts.get(lang, "") + " " + text
    pairs = [(a, b) for a in sorted(texts) for b in sorted(texts) if a != b]
    made = [(k, texts[a][:20_000] + " " + (texts[b] * 9)[20_000:200_000], "en") for k, (a, b) in enumerate(pairs)]
    got = {r.doc_id: r.lang_pred for r in langid.identify(_odd(spark, made), contents).collect()}
    assert [got[k] for k in range(len(pairs))] == [b for _, b in pairs]


def test_language_of_no_learned_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    contents = langid.dictionaries(docs)
    rng = np.random.default_rng(5)
    word = lambda: "".join(map(chr, rng.integers(97, 123, rng.integers(2, 10))))
    made = [(i, " ".join(word() for _ in range(n)), "en") for i, n in enumerate([150] * 60 + [750] * 60 + [3000] * 20)]
    got = langid.identify(_odd(spark, made), contents).collect()
    assert sum(r.rejected for r in got) >= 0.95 * len(got)
    clean = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").select("doc_id").distinct()
    judged = langid.identify(docs.join(clean, "doc_id", "left_semi"), contents).collect()
    # Some of them are half in one language and half in another.
    assert len(judged) > 50 and sum(r.rejected for r in judged) <= 0.02 * len(judged)


def _sets(rows, words):
    out = []
    for i, text, *_ in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = min(words, len(found))
        out.append((i, {tuple(found[k : k + n]) for k in range(len(found) - n + 1)} if found else set()))
    return out


def _components(rows, words, percent):
    sets = _sets(rows, words)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_shingle = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(k)
    common = Counter((a, b) for held in by_shingle.values() for j, a in enumerate(held) for b in held[j + 1 :])
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a][1]) + len(sets[b][1]) - n):
            parent[root(a)] = root(b)
    least = {}
    for k, (i, s) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(((i, len(s), least.get(root(k))) for k, (i, s) in enumerate(sets)), key=repr)


def test_near_duplicates_as_by_brute_force(spark):
    wanted = _components(_tables(), 3, 85)
    got = queries.QUERIES["op4_neardup"](spark, SF).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_odd_rows(spark):
    got = neardup.near_duplicates(_odd(spark), 5, 80).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == _components(ODD, 5, 80)
    assert neardup.near_duplicates(_odd(spark).limit(0)).count() == 0


def test_long_lists_without_links_and_chains(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"{passage} " + " ".join(f"w{i}x{j}" for j in range(40)), "en") for i in range(300)]
    base = [f"c{j}" for j in range(200)]
    for k in range(12):  # each like the next, the first not like the last
        base = base[6:] + [f"d{k}x{j}" for j in range(6)]
        rows.append((1000 + k, " ".join(base), "en"))
    got = neardup.near_duplicates(_odd(spark, rows), 3, 85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == _components(rows, 3, 85)


def test_near_copies_in_small_blocks(spark, monkeypatch):
    """Groups and lists that fall into many blocks; copies under one id, and copies without an id."""
    monkeypatch.setattr(neardup, "BLOCK", 3)
    monkeypatch.setattr(neardup, "GROUP_VALUES", 400)
    rng = np.random.default_rng(2)
    rows = []
    for g in range(3):
        base = [f"g{g}x{j}" for j in range(100)]
        for k in range(40):
            text = list(base)
            for at in rng.integers(0, 100, rng.integers(1, 12)):
                text[at] = f"e{rng.integers(0, 60)}"
            rows.append((len(rows), " ".join(text), "en"))
        rows += [(1, rows[-1][1], "en")] * 30 + [(2, " ".join(base), "en")] * 20 + [(None, " ".join([*base[:50], "here", *base[51:]]), "en")] * 2
    got = neardup.near_duplicates(_odd(spark, rows), 3, 85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == _components(rows, 3, 85)
    first = neardup.classes(_odd(spark, [(None, t, "en") for _, t, _ in rows]), 3, 85).filter("first").count()
    assert 0 < first < len(rows)


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_pairs_of_short_texts(spark, words, percent):
    """Sets that a sketch holds whole, with unions that it does not: one word in the middle, or the last one, replaced."""
    rows = []
    for n in range(57, 71):
        for k in range(6):
            text = [f"t{n}x{k}x{j}" for j in range(n)]
            for other in (text, text[: n // 2] + ["other"] + text[n // 2 + 1 :] if k < 4 else text[:-1] + ["other"]):
                rows.append((len(rows), " ".join(other), "en"))
    got = neardup.near_duplicates(_odd(spark, rows), words, percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == _components(rows, words, percent)


def _hits(docs, items, size=8):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for i, text, *_ in docs:
        words, places, found = cut(text), set(), set()
        for item, said in items:
            own = cut(said)
            n = min(size, len(own))
            windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if own else set()
            for k in range(len(words) - n + 1) if n else ():
                if tuple(words[k : k + n]) in windows:
                    places |= set(range(k, k + n))
                    found.add(item)
        ids = sorted(str(x) for x in found)
        out.append((i, len(words), len(places), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_decontamination_of_odd_rows(spark):
    items = [(1, "two three four"), (10, "One two three four five six seven eight nine"), (2, None), (3, ""), (10, "word")]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    docs = [r for r in ODD if r[0] != 6] + [(9, "two-three.four! two three four ß", "en"), (9, "other", "en"), (None, "word two three four", "en"), (None, "x", "en")]
    got = decontam.decontaminate(_odd(spark, docs), benchmark).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got), key=repr) == _hits(docs, items)
    assert all(r.n_hit == 0 for r in decontam.decontaminate(_odd(spark), benchmark.limit(0)).collect())
    assert decontam.decontaminate(_odd(spark).limit(0), benchmark).count() == 0


def test_decontamination_by_shuffle_and_with_columns(spark, monkeypatch):
    docs = [r for r in ODD if r[0] != 6]
    benchmark = spark.createDataFrame([(1, "two three four"), (10, "One two three four five six seven eight nine")], "item_id long, text string")
    wanted = {(r.doc_id, r.n_words, r.n_hit) for r in decontam.decontaminate(_odd(spark, docs), benchmark).collect()}
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    odd = _odd(spark, docs).withColumnRenamed("label", "n_words").withColumnRenamed("words", "row")
    kept = decontam.decontaminate(odd, benchmark, keep=odd.columns)
    assert kept.columns == [*odd.columns, "n_words_", "n_hit", "n_items", "items_sha256", "contaminated"]
    rows = kept.collect()
    assert len(rows) == len(docs) and {(r.doc_id, r.n_words_, r.n_hit) for r in rows} == wanted


def test_decontamination_cuts_words_once_a_text(spark):
    docs, benchmark = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "benchmark"))
    judged = decontam.decontaminate(docs, benchmark, keep=docs.columns)
    plan = judged.filter(~judged.contaminated).select("doc_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(lambda" in plan and "slice(array_remove" not in plan


def test_scores(spark):
    docs = _tables()
    held = {i: _held(i, 5, 1) for i, _, _ in docs}
    token = lambda t: [*(w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())), None]
    counts = Counter(w for i, t, _ in docs if not held[i] for w in token(t))
    n, v = sum(counts.values()), len(counts)
    rows = {r.doc_id: r for r in queries.QUERIES["op6_lm_score"](spark, SF).collect()}
    assert len(rows) == len(docs)
    for i, text, _ in docs:
        own, r = token(text), rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(own), sum(w in counts for w in own), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), rel_tol=1e-9)
        assert r.score < 0
    # The model knows more about held-out texts than single words do.
    out = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_scores_of_odd_rows(spark):
    got = lm.lm_scores(_odd(spark)).collect()
    assert len(got) == len(ODD) and all(math.isfinite(r.score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert lm.lm_scores(_odd(spark).limit(0)).count() == 0


def test_search_recall(spark):
    got = queries.QUERIES["op9_ann"](spark, "/root/testdata/sf0.1").collect()
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], float)
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    right = total = 0
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(1))
        order = [k for k in np.lexsort((ids, far)) if ids[k] != q][:10]
        own = sorted(found[q])
        assert [x[0] for x in own] == list(range(1, 11))
        assert all(math.isclose(x[2], far[ids == x[1]][0], rel_tol=1e-12) for x in own)
        right += len({int(ids[k]) for k in order} & {x[1] for x in own})
        total += 10
    assert right >= 0.95 * total


def test_search_in_several_blocks(spark):
    """Recall against brute force where the vectors fall into blocks, and how few are verified."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in table.collect()]
    ids, vectors = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    got = {}
    for r in ann.nearest(table, every=50, k=10, block_rows=300).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    asked, right, verified = ids[ids % 50 == 0], 0, 0
    assert set(got) == set(asked.tolist()) and all(sorted(x) == list(range(1, 11)) for x in got.values())
    block = ann.Block(ids, vectors)
    for q in asked:
        own = vectors[ids == q][0]
        far = np.sqrt(((vectors - own) ** 2).sum(1))
        order = [k for k in np.lexsort((ids, far)) if ids[k] != q][:10]
        assert all(math.isclose(d, far[ids == i][0], rel_tol=1e-12) for i, d in got[q].values())
        right += len({int(ids[k]) for k in order} & {i for i, _ in got[q].values()})
        verified += block.nearest(own, 10, int(q))[1]
    assert right >= 0.93 * 10 * len(asked)
    assert verified < 0.2 * len(ids) * len(asked)


def test_threshold_misses_as_seldom_as_stated():
    rng = np.random.default_rng(8)
    block = ann.Block(np.arange(10), rng.standard_normal((10, 64)))
    away = rng.standard_normal((4000, 64))
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    counts = (np.abs(away @ block.lines) <= 1.0).sum(1)
    assert 0.05 < (counts < block.threshold).mean() < 0.13


def test_search_of_odd_rows(spark):
    kind = "vec_id long, embedding array<float>, score string"
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, []), (None, [1.0, 1.0])]
    table = spark.createDataFrame([(*r, "s") for r in rows], kind)
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in ann.nearest(table).collect())
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 100), (100, 1, 0), (100, 2, 1), (100, 3, 2)]
    assert ann.nearest(table.limit(0)).count() == 0
    with pytest.raises(ValueError):
        ann.nearest(spark.createDataFrame([(0, [1.0], "s"), (1, [1.0, 2.0], "s")], kind))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    table = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    scored = {r.doc_id: r.predicted for r in queries.QUERIES["op2_quality"](spark, SF).collect()}
    good = stages["quality classifier"](spark, docs, SF)
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == {i for i, p in scored.items() if p}
    kept = {r.doc_id for r in stages["minhash near-dedup"](spark, docs, SF).collect()}
    assert kept == {c for i, n, c in _components([(i, r.text) for i, r in table.items()], 5, 80)}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    contents = langid.dictionaries(docs)
    rejected = {r.doc_id: r.rejected for r in langid.identify(docs, contents).collect()}
    spoken = stages["language id"](spark, docs, SF)
    assert spoken.columns == docs.columns and {r.doc_id for r in spoken.collect()} == {i for i, no in rejected.items() if not no}
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    encoded = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in stages["byte-level bpe"](spark, docs.filter("doc_id % 5 = 0"), SF).collect()}
    assert len(encoded) == sum(i % 5 == 0 for i in table)
    for i, got in encoded.items():
        text = table[i].text or ""
        ids = library.encode_ordinary(text)
        assert got == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    clean = {r.doc_id for r in stages["benchmark decontamination"](spark, docs, SF).collect()}
    assert clean == {i for i, _, n, *_ in _hits([(i, r.text) for i, r in table.items()], items) if n == 0}
    docs.unpersist()


def test_pipeline_stages_judge_rows_without_an_id(spark):
    stages = dict(corpus_pipeline.STAGES)
    long = [f"w{k}" for k in range(100)]
    rows = [(None, " ".join(long), "en"), (None, " ".join([*long, "more"]), "en"), (None, "alone here", "en"), (None, "", "en"), (7, "alone here", "en"), (None, " ".join(long), "en")]
    kept = stages["minhash near-dedup"](spark, _odd(spark, rows), SF).collect()
    # One row of the group without any id, the row with an id of the other, and the row without words.
    assert sorted((repr(r.doc_id), len(r.text) < 100) for r in kept) == [("7", True), ("None", False), ("None", True)]
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, leak, "en"), (None, "clean text", "en"), (3, f"so {leak} so", "en"), (3, "clean as well", "en")]
    clean = stages["benchmark decontamination"](spark, _odd(spark, rows), SF).collect()
    assert sorted(r.text for r in clean) == ["clean as well", "clean text"]


def test_pipeline_of_odd_rows(spark, tmp_path):
    extra = _odd(spark).withColumnRenamed("words", "rejected").withColumnRenamed("label", "row")
    for rows in (extra, extra.limit(0)):
        place = str(tmp_path / str(rows.count()))
        rows.write.parquet(f"{place}/documents.parquet")
        spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
        spark.createDataFrame([(1, "x y")], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
        out = corpus_pipeline.run(spark, place)
        assert {"doc_id", "n_tokens"} <= set(out.columns)
        assert out.count() <= rows.count()

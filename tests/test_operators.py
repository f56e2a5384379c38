"""Golden values and branches of the operators."""

import random
import time
import tracemalloc

import pytest
from pyspark.sql import functions as F

from corpusloom.config import CrawlConfig, ParseConfig
from corpusloom.functions import bloom, chars, dates, dom, urls
from corpusloom.functions import text as T
from corpusloom.operators import bloomset, crawl, documents, extract, lines, order, sentences, wiki
from corpusloom.sources import archive, texts


def _one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first().x


def _verdict(spark, line, **how):
    made = lines.judged(spark.createDataFrame([(line,)], "line string"), **how).collect()
    return (made[0].verdict, made[0].kept, made[0].illegal) if made else None


@pytest.mark.parametrize(
    "line, wanted",
    [
        ("ＡＢＣ１２３　×○中文的一是", ("bad", "ABC123x零中文的一是", "")),  # 6 of 13
        ("的一是不了", ("bad", "的一是不了", "")),
        ("的一是不了在", ("ok", "的一是不了在", "")),
        ("的一是不了在abc", ("bad", "的一是不了在abc", "")),
        ("的" * 51 + "a" * 400, ("ok", "的" * 51 + "a" * 400, "")),
        ("中文字①中文字②", ("err", "中文字①中文字②", "①")),
        ("的一\0\0\0\0\0是①", ("bad", "的一是①", "①")),
        ("的①\0\0\0\0\0是", ("err", "的①是", "①")),
        ("的一是不了在\0\0\0\0人", ("ok", "的一是不了在人", "")),
        ("的一是不了在\U0001f600", ("err", "的一是不了在\U0001f600", "\U0001f600")),
        ("的一是不了在𠀀", ("err", "的一是不了在𠀀", "𠀀")),
        ("的 一\t是不了在`", ("err", "的一是不了在`", "`")),
        ("abcd", None),
    ],
)
def test_line_verdicts(spark, line, wanted):
    assert _verdict(spark, line) == wanted


def test_runs_of_equal_characters_are_optional(spark):
    assert _verdict(spark, "的一是不了在在在在在")[0] == "ok"
    assert _verdict(spark, "的一是不了在在在在在", max_run=5)[0] == "bad"


def _scalar_verdict(line):
    """The rules once more, character by character."""
    import unicodedata

    table = dict(zip(chars.CONVERT_FROM, chars.CONVERT_TO, strict=True))
    kept, han, nuls = [], [], 0
    for c in line:
        c = table.get(c, c)
        n = ord(c)
        if c == "\0":
            nuls += 1
            if nuls == 5:
                return "bad"
            continue
        if c in chars.SPACES:
            continue
        if 0x4E00 <= n <= 0x9FFF or 0x3400 <= n <= 0x4DBF or 0xF900 <= n <= 0xFAFF:
            kept.append(c), han.append(c)
        elif n < 0x10000 and (unicodedata.category(c)[0] == "L" or unicodedata.category(c) in ("Nd", "Nl") or c in chars.LEGAL or 0x3000 <= n <= 0x303F or 0xFF00 <= n <= 0xFFEF or 0x2000 <= n <= 0x206F):
            kept.append(c)
        else:
            return "err"
    return "ok" if len(han) > 5 and (len(han) > 50 or len(han) / len(kept) > 0.7) else "bad"


def test_verdicts_of_random_lines(spark):
    rng = random.Random(1)
    alphabet = "的一是不了在人有我他" * 3 + "aZ09 \t\0\0①→é.,`~（）“”●　𠀀\U0001f600＃Ａ"
    made = ["".join(rng.choice(alphabet[: rng.choice((30, 34, 60))]) for _ in range(rng.randrange(5, 70))) for _ in range(3000)]
    table = spark.createDataFrame(list(enumerate(made)), "n long, line string")
    got = {r.n: r.verdict for r in lines.judged(table, least_length=1).collect()}
    assert got == {n: _scalar_verdict(x) for n, x in enumerate(made)}


def test_conversion_tables():
    assert len(chars.CONVERT_FROM) == len(chars.CONVERT_TO) == 113
    assert chars.checked_map(["ab", "", "cd", "ae"]) == ("ac", "ed")
    assert chars.char_set(["aab", "bc"]) == "abc"
    with pytest.raises(ValueError):
        chars.checked_map(["abc"])


def test_repeats_are_found_by_han_content(spark):
    rows = [(1, 0, "中文内容测试一二a"), (1, 1, "中文内容测试一二b"), (0, 5, "中文内容测试一二c"), (2, 0, "no han at all")]
    got = {(r.doc_id, r.line_no): (r.verdict, r.kept) for r in lines.filtered(spark.createDataFrame(rows, "doc_id long, line_no long, line string")).collect()}
    assert got == {(0, 5): ("kept", "中文内容测试一二c"), (1, 0): ("repeat", "中文内容测试一二a"), (1, 1): ("repeat", "中文内容测试一二b"), (2, 0): ("bad", "nohanatall")}


@pytest.mark.parametrize(
    "line, wanted",
    [
        ("他说：“好。”！对；完", ["他说：“好。”！", "对；", "完"]),
        ("好。「是」。』", ["好。", "「是」。", "』"]),
        ("(a)。b", ["（a）。", "b"]),
        ("。。。。", ["。。。", "。"]),
        ("", []),
        ("无", ["无"]),
    ],
)
def test_sentences(spark, line, wanted):
    assert _one(spark, T.sentences(F.col("x")), x=line) == wanted


def _scalar_sentences(line):
    out, at = [""], 0
    line = line.translate({40: "（", 41: "）"})
    while at < len(line):
        out[-1] += line[at]
        if line[at] in T.TERMINALS:
            for _ in range(2):
                if at + 1 < len(line) and line[at + 1] in T.ABSORBED:
                    at += 1
                    out[-1] += line[at]
            out.append("")
        at += 1
    return [x for x in out if x]


def test_sentences_of_random_lines(spark):
    rng = random.Random(2)
    made = ["".join(rng.choice("的一。？！；”』」()a,. …") for _ in range(rng.randrange(0, 40))) for _ in range(2000)]
    got = spark.createDataFrame(list(enumerate(made)), "n long, x string").select("n", T.sentences(F.col("x")).alias("s")).collect()
    assert {r.n: r.s for r in got} == {n: _scalar_sentences(x) for n, x in enumerate(made)}


def test_quotations(spark):
    assert T.quote_spans("他说“今天，天气很好吗”。走") == ["“今天，天气很好吗”。"]
    assert T.quote_spans("“短，”") == [] and T.quote_spans("“没有标点的一段话”") == []
    assert T.quote_spans("“" + "长" * 21 + "”！！x") == ["“" + "长" * 21 + "”！！"]
    assert T.quote_spans("“外“内，层”面的字”") == ["“外“内，层”面的字”"]
    assert T.quote_spans("“never closes，and on") == [] and T.quote_spans("'" + "a" * 30 + "'") == [] and T.quote_spans(None) == []
    rows = spark.createDataFrame([(1, 0, "x“今天，天气很好吗”y“今天，天气很好吗”")], "doc_id long, line_no long, line string")
    assert sentences.quotations(rows).count() == 2


@pytest.mark.parametrize(
    "text, wanted",
    [("99-01-02", "1999-01-02"), ("08-01-02", "2008-01-02"), ("1899-01-01", None), ("2013-02-30", None), ("2012年02月29日", "2012-02-29"), ("2012.2", None), ("2012/13/01", None), ("123-1-1", None), ("2012-1-a", None), ("a1-1-1", None), ("--", None)],
)
def test_dates(spark, text, wanted):
    found = _one(spark, dates.parse(F.col("x")), x=text)
    assert (found and found.isoformat()) == wanted


def test_date_windows(spark):
    for day, sane, compat in (("2013-12-01", False, True), ("2013-01-15", True, True), ("2012-12-31", False, False), (None, False, False)):
        column = F.col("x").cast("date")
        assert _one(spark, dates.in_window(column, "2013-01-01", "2013-02-01"), x=day) == sane
        assert _one(spark, dates.in_window(column, "2013-01-01", "2013-02-01", compat=True), x=day) == compat
    assert _one(spark, dates.latest(F.col("x")), x="a 2001-01-01 b 2013-02-30 2003年4月5日").isoformat() == "2003-04-05"
    assert _one(spark, dates.latest(F.col("x")), x="nothing") is None
    for window in (("2014-01-01", "2013-01-01"), ("2014", "2015-01-01")):
        with pytest.raises(ValueError):
            dates.check_window(*window)


@pytest.mark.parametrize(
    "href, wanted",
    [
        ("http://b/x", "http://b/x"), ("//b/x", "https://b/x"), ("/x?y", "https://a.com/x?y"), ("x", "https://a.com/p/x"), ("../x", "https://a.com/x"), ("../../x", "https://a.com/x"),
        ("./x/./y", "https://a.com/p/x/y"), ("#f", "https://a.com/p/q?r=1#f"), ("?z", "https://a.com/p/q?z"), ("", "https://a.com/p/q?r=1"), (" x ", "https://a.com/p/x"), ("mailto:me", "mailto:me"), ("..", "https://a.com/"), ("x/..", "https://a.com/p/"),
    ],
)
def test_resolving_links(spark, href, wanted):
    from urllib.parse import urljoin

    got = _one(spark, urls.resolve(F.col("b"), F.col("h")), b="https://a.com/p/q?r=1#old", h=href)
    assert got == wanted
    if href not in ("", " x ") and "../.." not in href:
        assert got == urljoin("https://a.com/p/q?r=1", href)


def test_links_and_rules(spark):
    html = """<a href="/a">1</a><a class=x href='/b?x=1&amp;y=2'>2</a><A HREF=/c>3</A><a name=z>4</a><a href="/a">5</a><link href="/no"><a href="d e">"""
    page = {"u": "http://s/", "h": html}
    assert _one(spark, urls.links(F.col("u"), F.col("h")), **page) == ["http://s/a", "http://s/b?x=1&y=2", "http://s/c", "http://s/d e"]
    assert _one(spark, urls.links(F.col("u"), F.col("h"), accept="/[abc]", reject="/b"), **page) == ["http://s/a", "http://s/c"]
    assert _one(spark, urls.full_match_links(F.col("u"), F.col("h"), r"http://s/(c|d.*)"), **page) == ["http://s/c", "http://s/d%20e"]
    assert _one(spark, urls.links(F.col("u"), F.col("h")), u="no base", h='<a href="/a"><a href="http://x/">') == ["http://x/"]
    assert urls.alternation([]) is None and urls.alternation(["a", "b"]) == "a|b"
    assert urls.replacement_pairs(["a"], ["b"]) == [("a", "b")]
    with pytest.raises(ValueError):
        urls.replacement_pairs(["a"], [])
    assert _one(spark, urls.group(F.col("x"), "a(b)"), x="cab") == "b" and _one(spark, urls.group(F.col("x"), "a(b)"), x="c") is None
    assert _one(spark, urls.file_name(F.col("x")), x="http://a.com/b?c=1:2|" + "d" * 300) == ("acombc=12" + "d" * 300)[:250]
    assert _one(spark, urls.find(F.col("x"), None), x="a") is None
    assert _one(spark, urls.accepted(F.col("x"), None, "b"), x="b") is False and _one(spark, urls.accepted(F.col("x"), None, None), x=None) is False


def test_titles_and_sections(spark):
    assert _one(spark, T.title(F.col("x")), x="http://w/zh-cn/%E4%B8%AD+a") == "中 a"
    assert _one(spark, T.title(F.col("x")), x="http://x") == "/x"
    assert _one(spark, T.after_double_colon(F.col("x")), x="Category::a,b::c") == "a,b"
    source, target = T.simplified_table(spark, "結構化程式設計")
    assert "結構化程式設計".translate(str.maketrans(source, target)) == "结构化程式设计"
    rows = spark.createDataFrame([(1, i, x) for i, x in enumerate(["a", " 参考资料 ", "b", "Category::x", "END::"])], "doc_id long, line_no long, line string")
    assert [r.line for r in wiki.cut_sections(rows).orderBy("line_no").collect()] == ["a", "Category::x", "END::"]
    noted = spark.createDataFrame([(1, 0, "正文[1]结束[编辑]"), (1, 1, " "), (1, 2, "[1]")], "doc_id long, line_no long, line string")
    assert [r.line for r in wiki.strip_footnotes(noted).orderBy("line_no").collect()] == ["正文结束", ""]
    docs = spark.createDataFrame([(2, "http://w/zh-cn/a"), (1, "http://v/zh-cn/a"), (3, "http://w/zh-cn/b")], "doc_id long, url string")
    assert sorted((r.doc_id, r.title) for r in wiki.distinct_titles(docs, ["doc_id"]).collect()) == [(1, "a"), (3, "b")]


def test_sentences_without_repeats_and_with_tags(spark):
    rows = spark.createDataFrame([(1, 0, 0, "好。"), (1, 0, 1, "a"), (2, 0, 0, " 好。"), (2, 1, 0, "")], "doc_id long, line_no long, sent_no long, sentence string")
    kept = sentences.distinct_sentences(rows)
    assert sorted((r.doc_id, r.sentence) for r in kept.collect()) == [(1, "好。"), (2, "")]
    docs = spark.createDataFrame([(1, "t", ["a", "b"]), (2, "u", [])], "doc_id long, title string, categories array<string>")
    assert sorted((r.doc_id, r.title, r.categories or "", r.source) for r in sentences.tagged(kept, docs).collect()) == [(1, "t", "a|b", "wikipedia"), (2, "u", "", "wikipedia")]


def test_frames(spark):
    text = "before\nURL::http://a\nx\n\ny\nEND::\nbetween\nURL::http://b\nz"
    rows = documents.unframed(spark.createDataFrame([("f", text)], "file string, text string")).orderBy("line_no").collect()
    assert [(r.doc_no, r.url, r.line, r.closed) for r in rows] == [(1, "http://a", "x", True), (1, "http://a", "", True), (1, "http://a", "y", True), (2, "http://b", "z", False)]
    docs = spark.createDataFrame([("http://a", "x\ny")], "url string, text string")
    assert documents.framed(docs).first().value == "URL::http://a\nx\ny\nEND::"


def test_gate_and_packing(spark):
    docs = spark.createDataFrame([(i, "x" * n) for i, n in enumerate((0, 50, 51))], "doc_id long, text string")
    assert {r.doc_id: r.verdict for r in documents.gated(docs, 50).collect()} == {1: "discard", 2: "keep"}
    sized = spark.createDataFrame([("s", i, n) for i, n in enumerate((4, 4, 4, 1))], "shard string, doc_id long, size long")
    assert [r.part for r in documents.packed_in_order(sized, "shard", "size", ["doc_id"], 7).orderBy("doc_id").collect()] == [1, 1, 2, 2]
    assert [r.part for r in documents.packed_by_window(sized, "size", ["doc_id"], 7).orderBy("doc_id").collect()] == [1, 1, 2, 2]
    assert documents.large_enough(docs, 101) and not documents.large_enough(docs, 102)
    assert documents.packed_in_order(sized.filter("size > 9"), "shard", "size", ["doc_id"]).count() == 0


def test_numbers_over_many_partitions(spark):
    rows = spark.range(1000, numPartitions=7).select(((F.col("id") * 37) % 1000).alias("id"))
    got = order.numbered(rows, ["id"]).collect()
    assert {r.id: r.n for r in got} == {i: i + 1 for i in range(1000)}
    chunks = documents.batches(rows, ["id"], 300)
    assert {r.chunk: r["count"] for r in chunks.groupBy("chunk").count().collect()} == {0: 300, 1: 300, 2: 300, 3: 100}
    assert order.numbered(rows.filter("id < 0"), ["id"]).count() == 0


def test_bloom_set(spark):
    import hashlib

    digest = b"".join(hashlib.md5(bytes([salt]) + "é".encode()).digest() for salt in range(4))
    wanted = [int.from_bytes(digest[4 * i : 4 * i + 4], "big", signed=True) for i in range(14)]
    assert _one(spark, bloom.hashes(F.col("x"), 14), x="é") == wanted
    c, k = bloom.for_rate(1e-4, 160_000_000)
    assert k == 14 and abs(c - 20.198) < 1e-3 and bloom.for_bits(1000, 100) == 7
    assert bloom.size(c, 160_000_000, saturate=True) == 2**31 - 1 < bloom.size(c, 160_000_000)
    assert abs(bloom.false_positive_rate(c, k) - 6.1e-5) < 1e-6
    words = spark.createDataFrame([(f"w{i}",) for i in range(200)] + [(None,)], "x string")
    held = bloomset.add_all(words, "x", 20_000, k)
    assert bloomset.contains_all(words, "x", held, 20_000, k)
    others = spark.createDataFrame([(f"v{i}",) for i in range(200)], "x string")
    assert bloomset.contains(others, "x", held, 20_000, k).filter("maybe").count() == 0
    assert 0 < bloomset.filled(held, 20_000, k, 200)["share"] < 0.2


HTML = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script><style>p{}</style></head><body>
<nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div id="main" class="box wide"><h1>Head &amp; more</h1><p>One <b>two</b><br>three<p>four</div>
<div class="ad">buy</div><table><tr><td>c1<td>c2<tr><td>c3</table></body></html>"""


def test_tree_and_selectors():
    root = dom.parse(HTML)
    text = lambda s: [dom.plain_text(x) for x in dom.select(root, s)]
    assert text("nav li") == ["A", "B"] and text("div#main p") == ["One two three", "four"] and text("div.box.wide > h1") == ["Head & more"]
    assert text("td") == ["c1", "c2", "c3"] and text("a[href=/b]") == ["B"] and text("h1, .ad") == ["Head & more", "buy"] and text("ul > a") == []
    assert dom.select(root, "script p") == []
    assert dom.plain_text(dom.parse("a\xa0b <i> c</i>")) == "a\xa0b c"
    for wrong in ("p:first", "", "> p", "p +q"):
        with pytest.raises(ValueError):
            dom.selector(wrong)


def test_text_modes():
    visit = lambda h: dom.selected_text(dom.parse(f"<section>{h}</section>"), ["section"], [])
    assert visit("<ul><li>a</li><li>b</li></ul><div>x</div><div>y</div>") == "* a\n* b\nxy\n"
    assert visit("<dl><dt>t</dt><dd>d</dd></dl>") == "t\n\td\n" and visit("") == "" and visit("a   b\n c") == "a b c\n"
    assert dom.selected_text(dom.parse("<p>x"), ["section"], []) is None
    assert dom.selected_text(dom.parse(HTML), ["div"], [".ad"], "br2n") == "Head & more One two \nthree\n four\n"
    with pytest.raises(ValueError):
        dom.selected_text(dom.parse(""), [], [], "other")
    deep = dom.parse("<div>" * 5000 + "x" + "</div>" * 5000)
    assert dom.plain_text(deep) == "x"


def test_strategies(spark):
    article = "<article><p>" + "word " * 30 + "</p><p>" + "more " * 20 + "</p></article>"
    rows = [(1, '<div class="story">said</div>' + article), (2, article + "<nav><a href=x>one two three four</a></nav>"), (3, '<div class="story"></div>' + article), (4, None), (5, '<p class="noarticletext">x</p>' + article)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    how = extract.Extraction(accept=["div.story"], missing=".noarticletext")
    got = {r.page_id: r.text for r in extract.parsed(pages, how, extract.MIXED).collect()}
    long = ("word " * 30).strip() + "\n" + ("more " * 20).strip()
    assert got == {1: "said\n", 2: long, 3: "", 4: "", 5: got[5]} and long in got[5]
    only = {r.page_id: r.text for r in extract.parsed(pages, how).collect()}
    assert only == {1: "said\n", 2: None, 3: "", 4: None, 5: None}
    assert extract.parsed(pages, how, extract.BOILERPLATE).filter("page_id = 2").first().text == long
    with pytest.raises(ValueError):
        extract.parsed(pages, how, "unknown")
    named = extract.selected(spark.createDataFrame([(1, '<div id="catlinks"><ul><li>甲</li><li> </li><li>乙</li></ul></div>'), (2, "x")], "page_id long, html string"), extract.Extraction(accept=["p"], categories="div#catlinks li"))
    assert {r.page_id: r.category_line for r in wiki.category_line(named).collect()} == {1: "Category::甲,乙", 2: "Category::"}


def test_strategy_of_ones_own(spark):
    pages = spark.createDataFrame([(1, "<p>x</p>"), (2, None)], "page_id long, html string")
    got = extract.parsed(pages, extract.Extraction(), lambda html: html and html.upper()).collect()
    assert {r.page_id: (r.text, r.categories) for r in got} == {1: ("<P>X</P>", []), 2: (None, [])}


def test_selectors_reach_any_depth():
    html = "<div><b>" * 30_000 + '<p class="deep">x</p>' + "</b></div>" * 30_000
    assert dom.selected_text(dom.parse(html), ["p.deep"], []) == "x\n"


def test_mixed_strategy_reads_pages_once(spark):
    pages = spark.createDataFrame([(1, "<p>x</p>")], "page_id long, html string")
    plan = extract.parsed(pages, extract.Extraction(accept=["article"]), extract.MIXED)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan and "Window" not in plan


def test_lines_are_converted_once_a_use(spark):
    from corpusloom.plans import registry

    folder = "/root/testdata/sf0.001"
    for name, scans in (("line_filter", 2), ("illegal_histogram", 1), ("doc_reassemble", 1)):
        plan = registry.QUERIES[name](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
        # One to derive the text and one to convert the lines, for each scan.
        assert plan.count("Relation") == scans and plan.count("translate(") <= 2 * scans


@pytest.mark.parametrize("name", ["boilerplate_text", "css_text", "css_text_br2n", "mix_parse"])
def test_references_without_semicolon_as_in_sql(same_as_sql, spark, tmp_path, name):
    from corpusloom.plans import registry

    words = "word " * 20
    body = f"<article><h1>{words}a &amp;&amp</h1><p>{words}&lt &copy; &am &amplt; &quot</p></article>"
    page = f"<html><head><title>t</title></head><body><nav><ul><li>b&amp</li></ul></nav>{body}</body></html>"
    spark.createDataFrame([(1, page)], "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/w")
    next((tmp_path / "w").glob("*.parquet")).rename(tmp_path / "pages.parquet")
    assert same_as_sql(registry.QUERIES[name], registry.ORACLES[name], str(tmp_path)) == 1
    assert dom.plain_text(dom.parse("&amp &notit; &#39; &#39x")) == "& ¬it; ' 'x"
    assert dom.plain_text(dom.parse("&amp &notit; &#39; &#39x", closed=True)) == "&amp &notit; ' &#39x"


def test_quote_spans_in_one_pass():
    def walked(line):
        out, at = [], 0
        while at < len(line):
            found = T.quote_span(line, at)
            out, at = (out + [found[0]], found[1] + 1) if found else (out, at + 1)
        return out

    some = random.Random(7)
    for _ in range(3000):
        line = "".join(some.choice("“”‘’()（）〔[]】【﹏{}'\"。，！甲乙丙丁戊己") * some.choice((1, 1, 1, 9)) for _ in range(some.randint(0, 40)))
        assert T.quote_spans(line) == walked(line), line
    # No mark closes: the work stays in proportion to the line.
    begin = time.process_time()
    assert T.quote_spans("“甲乙" * 20_000) == [] and time.process_time() - begin < 5


def test_han_class_has_a_whole_complement(spark):
    every = "".join(chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000)
    han = "".join(c for c in every if 0x4E00 <= ord(c) <= 0x9FFF or 0x3400 <= ord(c) <= 0x4DBF or 0xF900 <= ord(c) <= 0xFAFF)
    assert _one(spark, chars.han_text(F.col("t")), t=every) == han


def test_repeats_sort_by_a_hash_and_shuffle_good_lines_only(spark):
    some = ["中文内容测试一二" + "相同的开头" * 20 + x for x in "甲乙丙甲乙甲"] + ["short line", "中文内容①测试一二三"]
    rows = spark.createDataFrame([(1, n, x) for n, x in enumerate(some)], "doc_id long, line_no long, line string")
    whole = {r.line_no: r.verdict for r in lines.filtered(rows).collect()}
    assert whole == {0: "kept", 1: "kept", 2: "kept", 3: "repeat", 4: "repeat", 5: "repeat", 6: "bad", 7: "err"}
    assert sorted(r.line_no for r in lines.repeats(rows).collect()) == [3, 4, 5]
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(" in plan(lines.filtered(rows)) and "xxhash64(" in plan(lines.first_of(rows, "line", ["line_no"]))
    assert "LeftAnti" in plan(lines.repeats(rows))


def test_crawl_with_window_and_rewrites(spark):
    page = lambda date, *links: f"{date} " + "".join(f'<a href="{x}">' for x in links)
    web = {"https://h/s": page("2024-05-01", "http://h/a?x=1", "http://h/b", "/gone", "/no"), "https://h/a": page("2020-01-01", "/c"), "https://h/b": page("no date"), "https://h/c": page("2024-06-01")}
    pages = spark.createDataFrame(list(web.items()), "url string, html string")
    seeds = spark.createDataFrame([("http://h/s",), ("http://h/no",)], "url string")
    rules = [("^http:", "https:"), (r"[?].*$", "")]
    got = {r.url: (r.depth, r.status) for r in crawl.crawl_pages(seeds, pages, reject="/no$", replacements=rules, window=("2024-01-01", "2024-12-31")).collect()}
    assert got == {
        "https://h/s": (0, "visited"), "http://h/no": (0, "rejected"), "https://h/a": (1, "date_rejected"), "https://h/b": (1, "date_rejected"),
        "https://h/gone": (1, "failed"), "https://h/c": (2, "visited"),
    }


def test_crawl(spark):
    web = {"s": ["a", "b"], "a": ["b", "c"], "b": ["s"], "c": ["gone", "no"]}
    pages = spark.createDataFrame([(f"http://h/{u}", "".join(f'<a href="/{x}">' for x in out)) for u, out in web.items()], "url string, html string")
    seeds = spark.createDataFrame([("http://h/s",)], "url string")
    got = {r.url[9:]: (r.depth, r.status) for r in crawl.crawl_pages(seeds, pages, reject="/no$").collect()}
    assert got == {"s": (0, "visited"), "a": (1, "visited"), "b": (1, "visited"), "c": (2, "visited"), "gone": (3, "failed")}
    assert {r.url[9:] for r in crawl.crawl_pages(seeds, pages, levels=1).collect()} == {"s", "a", "b"}
    found, missing = crawl.fetched(spark.createDataFrame([("http://h/a",), ("http://h/x",)], "url string"), pages)
    assert found.count() == 1 and [r.url for r in missing.collect()] == ["http://h/x"]
    judged = crawl.judged_urls(spark.createDataFrame([("http://h/no",), ("http://h/1",)], "url string"), None, "/no$", [("^http:", "https:")]).collect()
    assert sorted((r.status, r.target) for r in judged if r.target) == [("accepted", "https://h/1")] and len(judged) == 2
    assert crawl.bootstrapped(seeds, pages).count() == 1


def test_crawl_without_a_limit(spark):
    from corpusloom.plans import registry

    folder = "/root/testdata/sf0.001"
    ids = [r.page_id for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id").collect()]
    depths, level = {0: 0}, [0]
    while level:
        found = {(7 * u + j) % len(ids) for u in level if u in ids for j in (1, 2, 3)} - depths.keys()
        depths |= dict.fromkeys(found, depths[level[0]] + 1)
        level = sorted(found)
    got = {r.url: r.depth for r in registry.QUERIES["crawl_bfs_depth"](spark, folder).collect()}
    assert got == depths and len(got) == len(ids)


def test_bloom_query_on_many_urls(spark, tmp_path):
    from corpusloom.plans import registry

    spark.range(60_000).selectExpr("id AS page_id", "concat('http://h/', id) AS url").write.parquet(f"{tmp_path}/pages.parquet")
    got = registry.QUERIES["bloom_contains"](spark, str(tmp_path)).collect()
    odd = [r.maybe for r in got if int(r.url[9:]) % 2]
    assert len(got) == 60_000 and all(r.maybe for r in got if int(r.url[9:]) % 2 == 0)
    assert sum(odd) <= 0.001 * len(odd)


def test_configuration():
    with pytest.raises(ValueError):
        CrawlConfig(queue=10)
    with pytest.raises(ValueError):
        CrawlConfig(window=("2014-01-01", "2013-01-01"))
    with pytest.raises(ValueError):
        ParseConfig()
    assert ParseConfig(strategy=extract.BOILERPLATE).window is None


def test_archives(spark, tmp_path):
    pages = [("http://a", "x\ny\n"), ("http://b", "emoji \U0001f600 中"), ("http://c", "")]
    framed = "".join(f"{len(h.encode('utf-16-le')) // 2}\n{u}\n{h}" for u, h in pages)
    assert list(archive.records(framed.encode())) == pages
    assert list(archive.records("5\nu\nab".encode())) == [("u", "ab")]
    with pytest.raises(ValueError):
        list(archive.records(b"x\ny\nz"))
    place = tmp_path / "in" / "deep"
    place.mkdir(parents=True)
    (place / "1").write_bytes(framed.encode())
    assert sorted((r.url, r.html) for r in archive.read_archives(spark, str(tmp_path / "in")).collect()) == sorted(pages)
    (tmp_path / "single").mkdir()
    (tmp_path / "single" / "p").write_text("3\nhttp://a\na\nb")
    assert [(r.url, r.html) for r in archive.read_single_records(spark, str(tmp_path / "single")).collect()] == [("http://a", "a\nb")]


def test_archives_are_read_in_chunks(monkeypatch):
    pages = [(f"http://h/{i}", "é\U0001f600中\n" * (i % 7) + "x" * i) for i in range(60)]
    data = "".join(f"{len(h.encode('utf-16-le')) // 2}\n{u}\n{h}" for u, h in pages).encode()
    for size in (1, 2, 3, 7, 1000, len(data), len(data) + 1):
        monkeypatch.setattr(archive, "CHUNK", size)
        assert list(archive.records(data)) == pages
        assert list(archive.records(memoryview(data[:-30])))[:-1] == pages[:-1]
    monkeypatch.undo()
    large = (f"2000\nu\n{'y' * 2000}" * 10_000).encode()
    tracemalloc.start()
    assert sum(1 for _ in archive.records(large)) == 10_000
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < len(large) / 2


def test_text_sources_and_sinks(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "one.filter").write_bytes("URL::u\n中文\nEND::\n".encode("gb18030"))
    (tmp_path / "d" / "two.other").write_text("URL::v\nx\nEND::\n")
    rows = texts.read_framed(spark, str(tmp_path / "d"), glob="*.filter", encoding="GB18030").collect()
    assert [(r.url, r.line) for r in rows] == [("u", "中文")]
    (tmp_path / "t").write_text("ab\ncd\n")
    assert texts.read_char_table(spark, str(tmp_path / "t")) == ("ac", "bd") and texts.read_char_set(spark, str(tmp_path / "t")) == "abcd"
    assert {r.url for r in texts.read_urls(spark, str(tmp_path / "t")).collect()} == {"ab", "cd"}
    judged = lines.filtered(spark.createDataFrame([(1, 0, "的一是不了在"), (1, 1, "①的一是不了在")], "doc_id long, line_no long, line string"))
    texts.write_verdicts(judged, str(tmp_path / "v"))
    assert {r.verdict for r in spark.read.parquet(str(tmp_path / "v")).collect()} == {"kept", "err"}
    texts.write_histogram(lines.illegal_histogram(lines.judged(judged.select("doc_id", "line_no", "line"))), str(tmp_path / "h"))
    assert [r.value for r in spark.read.text(str(tmp_path / "h")).collect()] == ["①=1"]
    texts.write_framed(spark.createDataFrame([("u", "x")], "url string, text string"), str(tmp_path / "f"))
    assert texts.read_framed(spark, str(tmp_path / "f"), glob="*.txt").first().line == "x"


def test_commands(spark, tmp_path):
    from corpusloom.__main__ import main

    spark.createDataFrame([(1, "的一是不了在")], "doc_id long, text string").write.parquet(str(tmp_path / "in"))
    main(["filter", str(tmp_path / "in"), str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).first().verdict == "kept"
    with pytest.raises(SystemExit):
        main(["unknown", "a", "b"])
    web = {"http://h/s": '<a href="/a">', "http://h/a": "", "http://h/other": ""}
    spark.createDataFrame(list(web.items()), "url string, html string").write.parquet(str(tmp_path / "web"))
    (tmp_path / "crawl.json").write_text('{"seeds": ["http://h/s"], "reject": ["/x$"]}')
    main(["crawl", str(tmp_path / "web"), str(tmp_path / "reached"), "--config", str(tmp_path / "crawl.json"), "--metrics", str(tmp_path / "metrics")])
    assert {r.url for r in spark.read.parquet(str(tmp_path / "reached")).collect()} == {"http://h/s", "http://h/a"}
    assert [(r.job, r.name, r.value) for r in spark.read.parquet(str(tmp_path / "metrics")).collect()] == [("crawl", "rows", 2)]
    (tmp_path / "bad.json").write_text('{"queue": 1}')
    with pytest.raises(ValueError):
        main(["crawl", str(tmp_path / "web"), str(tmp_path / "no"), "--config", str(tmp_path / "bad.json")])


def test_a_cut_lineage_leaves_no_shuffled_files(spark):
    import glob
    import time

    from corpusloom.operators.order import cut_lineage

    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {x for d in folders for x in glob.glob(f"{d}/*/shuffle_*")}
    before = files()
    df = spark.range(5_000).selectExpr("id % 700 AS k").groupBy("k").count()
    cut = cut_lineage(df)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert cut.count() == 700 and df.count() == 700
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"

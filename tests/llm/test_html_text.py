import random
from html import escape

import pytest
from hypothesis import given, settings, strategies as st

from opinara.llm.html_text import extract_text, main_text, nearest, page_keys, page_lines, shared_lines

SCHEMA = "page_id long, url string, html string, key long, lines string, shared string"
ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:"</p>"}</style><script>var t="</article>";</script></head>
<body><header class="site">Site</header><nav><ul><li><a href="/a>b">Menu</a></li></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy</div><div id="cookie-notice">We use</div><aside>Side</aside>
<article class="ads"><header><h1>Head &amp; more</h1></header><p><b>One  two<br><p>x&lt;y&gt;
 &eacute;&#233;&nbsp;z</p><p>in<i>lin</i>e</p><form><input name=q>Search</form><p>Load <em>this</em><section class="comments"><p>First!</p>
</section><div><p>Last</p></div></article><section class="comments">Great</section><footer>&copy; me"""
OPEN = "<body><p>Welcome</p><p>{}</p><p>{}</p><p>Call us now</p></body>"


def test_article():
    assert main_text(ARTICLE, []) == "Head & more\nOne two\nx<y> éé z\ninline\nLoad this\nLast"


@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<p>b</div></p>c", "a\nb\nc"), ("<article>", ""),
    ("<article><p>cut of", "cut of"), ("<nav>open<article><p>kept</p></article>", "kept"), ("a < b <p>c", "a < b\nc"),
    ("<main><p>a</p></main><p>b</p>", "a"), ("<p hidden>x</p>y", "y"), ("<div class='x ad-box'>x<div>z</div></div>y", "y"),
    ("<article>a</article>b<article>c</article>", "a\nc"), ("<script>never closed <p>x", ""), ("<svg><p>x</p></svg>y", "y"),
])
def test_cases(html, text):
    assert main_text(html, []) == text


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=25), st.lists(st.integers(0, 4), max_size=25))
def test_shared_lines_are_a_longest_common_subsequence(a, b):
    found = shared_lines(a, b)
    assert len(found) == lcs(a, b) and found == sorted(set(found))
    rest = iter(b)
    assert all(a[i] in rest for i in found)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash", "clash") for r in rows], SCHEMA).repartition(4)


def pages():
    rows = [(i, f"https://h.example/{'ab'[i % 2]}/{i:03d}?q={i}", OPEN.format(f"own {i}", f"more {i}")) for i in range(60)]
    rows += [(100, "https://other.example/x", OPEN.format("alone", "too")), (101, None, OPEN.format("no", "url")),
             (102, "https://h.example/a/000x", None), (103, "https://h.example/a/z", ARTICLE), (104, "https://h.example/a/z", ARTICLE),
             (None, "https://h.example/b/z", ""), (105, "http://[bad", "<p>bad url</p>"), (106, "https://big.example/", "<p>x</p>" * 20000)]
    return rows + [rows[3], rows[3]]


def test_lines_shared_with_the_nearest_page_go(spark):
    got = extract_text(frame(spark, pages())).collect()
    assert len(got) == len(pages())
    texts = {}
    for r in got:
        texts.setdefault(r.page_id, set()).add((r.url, r.text, r.n_chars))
    for i in [k for k in range(60) if k not in (0, 2, 58, 59)]:
        assert {t for _, t, _ in texts[i]} == {f"own {i}\nmore {i}"}, texts[i]
    whole = lambda a, b: f"Welcome\n{a}\n{b}\nCall us now"
    assert {t for _, t, _ in texts[100]} == {whole("alone", "too")} and {t for _, t, _ in texts[101]} == {whole("no", "url")}
    assert {t for _, t, _ in texts[103]} == {t for _, t, _ in texts[104]} == {main_text(ARTICLE, [])}
    assert texts[102] == {("https://h.example/a/000x", "", 0)} and {t for _, t, _ in texts[None]} == {""}
    assert {n for _, _, n in texts[106]} == {20000 * 2 - 1}


def test_pairs_do_not_depend_on_partitions(spark):
    from pyspark.sql import functions as F
    rows = frame(spark, pages()).select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn(
        "key", F.col("page_id")).filter("key is not null").dropDuplicates(["key"])
    keys = page_keys(rows).cache()
    once = {r.key: r.peer for r in nearest(keys).collect()}
    again = {r.key: r.peer for r in nearest(keys.repartition(7)).collect()}
    host = {r.key: (r.host, r.path) for r in keys.collect()}
    assert once == again and all(host[k][0] == host[p][0] for k, p in once.items())
    ordered = sorted((h, p, k) for k, (h, p) in host.items() if h)
    for a, b in zip(ordered, ordered[1:]):
        if a[0] == b[0]:
            assert once[a[2]] == b[2] or once[a[2]] in [k for *_, k in ordered]
    assert once[10] in (8, 12) and 100 not in once and 101 not in once


def test_no_rows(spark):
    out = extract_text(frame(spark, []))
    assert out.collect() == [] and out.columns == ["page_id", "url", "text", "n_chars"]


def test_lines_know_their_place():
    lines, kinds = page_lines(ARTICLE)
    assert dict(zip(lines, kinds))["Menu"] == 0 and dict(zip(lines, kinds))["Last"] == 1
    rnd = random.Random(1)
    for _ in range(200):  # broken markup never raises
        page_lines("".join(rnd.choice([ARTICLE[i:i + 9] for i in range(0, 700, 9)]) for _ in range(40)))


@pytest.mark.parametrize("html, text", [
    ('<article><p class="ad">Buy<p>Body</article>', "Body"), ("<article><p class=ad>Buy<div>Body</div></article>", "Body"),
    ("<article><ul><li class=social>Like<li>Point</ul>Body</article>", "Point\nBody"),
    ("<table><tr><td class=ad>Buy<td>Cell<tr><td>Next</table>Body", "Cell\nNext\nBody"),
    ("<dl><dt class=promo>Buy<dd>Said</dl>Body", "Said\nBody"), ("<div><nav>Menu</div><p>Body", "Body"),
    ("<article><div><span class=ad>Buy</div>Body</article>", "Body"), ("<div><p class=ad>Buy</div>Body", "Body"),
    ("<ul><li class=ad>Buy<ul><li>More</ul>Buy<li>Point</ul>", "Point"), ("<span class=ad>a<span>b</span>c</span>d", "d"),
])
def test_an_aside_without_its_end_tag_ends_with_its_parent_or_at_a_sibling(html, text):
    assert main_text(html, []) == text


@pytest.mark.parametrize("html, text", [
    ("<div>Body</div><aside><article>Teaser</article></aside>", "Body"),
    ("<div>Body</div><section class=comments><article>First!</article><article>Second</article></section>", "Body"),
    ("<aside><article>Teaser</article></aside><article>Body</article>", "Body"),
    ("<div><nav>Menu<article>Body</article></div>", "Body"), ("<form id=all><p>Head<article>Body</article></form>", "Body"),
    ("<div class=overlay><article>Body</article></div>", "Body"), ("<div class=widget><main>Body</main></div>", "Body"),
])
def test_an_article_in_a_closed_aside_is_the_sites(html, text):
    assert main_text(html, []) == text


def texts_of(spark, rows):
    return {r.page_id: r.text for r in extract_text(frame(spark, rows)).collect()}


def test_copies_side_by_side_keep_their_text(spark):
    body = [f"<p>Paragraph {i} of a text that stands on several pages" for i in range(8)]
    copy = lambda i: "<p>Welcome" + "".join(body) + f"<p>read {i}<p>Call us now"
    page = lambda i: f"<p>Welcome<p>The text of page {i} alone<p>And more of page {i}<p>Call us now"
    rows = [(i, f"https://pair.example/{i}", "".join(body)) for i in range(2)]
    rows += [(10 + i, f"https://h.example/a/{i}", page(i)) for i in range(3)]
    rows += [(20 + i, f"https://h.example/b/{i}", copy(i if i > 1 else 0)) for i in range(5)]
    rows += [(30 + i, f"https://h.example/c/{i}", page(3 + i)) for i in range(3)]
    got = texts_of(spark, rows)
    text = "\n".join(p[3:] for p in body)
    assert got[0] == got[1] == text
    assert [got[20 + i] for i in range(5)] == [f"{text}\nread {i if i > 1 else 0}" for i in range(5)]
    assert [got[k] for k in (10, 11, 12, 30, 31, 32)] == [f"The text of page {i} alone\nAnd more of page {i}" for i in range(6)]


def test_a_paragraph_shared_with_the_nearest_page_only_stays(spark):
    quote = "<p>A paragraph that two pages quote"
    page = lambda i, more="": f"<p>Welcome<p>The text of page {i} alone{more}<p>And more of page {i}"
    rows = [(i, f"https://h.example/{i}", page(i, quote if i in (2, 3) else "")) for i in range(6)]
    rows += [(6, "https://h.example/6", rows[2][2])]  # a copy is no third page
    rows += [(10 + i, f"https://two.example/{i}", page(i)) for i in range(2)]
    got = texts_of(spark, rows)
    own = lambda i, more="": f"The text of page {i} alone{more}\nAnd more of page {i}"
    assert got == {i: own(i % 10, "\nA paragraph that two pages quote" if i in (2, 3) else "") for i in (*range(6), 10, 11)} | {6: got[2]}


def test_differencing_decides_in_and_outside_articles(spark):
    page = lambda i: (f"<p>Welcome<h1>Head {i}</h1><article><p>Text {i} of the article<p>Read our terms</article>"
                      f"<div>Body {i} beside the article</div><p>Call us now")
    rows = [(i, f"https://h.example/{i}", page(i)) for i in range(4)]
    rows += [(4, "https://h.example/4", "<p>Own line of the page<article><p>Read our terms</article>")]
    rows += [(9, "https://alone.example/9", page(9))]
    got = texts_of(spark, rows)
    assert [got[i] for i in range(4)] == [f"Head {i}\nText {i} of the article\nBody {i} beside the article" for i in range(4)]
    assert got[4] == "Own line of the page\nRead our terms"
    assert got[9] == "Text 9 of the article\nRead our terms"


def test_articles_keep_ordinary_sentences_of_a_large_host(spark):
    page = lambda i: (f"<nav>Menu</nav><p>Welcome<article><h1>Head {i}</h1><p>Text {i}<p>" + ("Well." if i % 4 < 2 and i < 20 else f"So {i}.")
                      + "<p>Share this text</article><p>Call us now")
    got = texts_of(spark, [(i, f"https://large.example/{i:02d}", page(i)) for i in range(40)])
    assert got == {i: f"Head {i}\nText {i}\n" + ("Well." if i % 4 < 2 and i < 20 else f"So {i}.") for i in range(40)}


def test_no_article_of_the_documents_loses_a_line(spark):
    """Pages made from `documents`: their whole text comes back, and nothing else."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(trim(text)) > 0").orderBy("doc_id").collect()]
    want = {i: "\n".join(" ".join(line.split()) for line in t.split("\n") if line.split()) for i, t in enumerate(texts)}
    page = lambda t: "<p>Welcome<article>" + "".join(f"<p>{escape(line)}</p>" for line in t.split("\n")) + "</article><p>Call us now"
    got = texts_of(spark, [(i, f"https://h{i % 3}.example/{i}", page(t)) for i, t in enumerate(texts)])
    assert [i for i in want if got[i] != want[i]] == []

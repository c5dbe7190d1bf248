"""Main text: parsing, furniture, and style trees against a plain count over all pages."""

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from repweave.llm import site_style as S


@pytest.mark.parametrize("source,text", [
    ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\n\nb"), ("<p>a<br>b\n\t c</p>", "a b c"),
    ("<article><h1>T</h1><p><b>x<br><p>y</p></article><footer>f", "T\n\nx\n\ny"),
    ("fo<b>o</b>b<i>a</i>r", "foobar"), ("a &amp; b &lt;p&gt; &eacute; &#65; &nope; &amp", "a & b <p> é A &nope; &"),
    ("<p>a&nbsp;b</p>", "a b"), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"), ("a<!-- <p>no</p> -->b", "ab"), ("a<!-- open", "a"),
    ("x<script>var t='</p>';</script>y<style>p{}</style><title>no</title>", "xy"), ("a<script>never closed <p>b", "a"),
    ("<p>a</p><a href='x", "a"), ("<p title='>'>a</p>", "a"), ("<p title=\"open>a</p><p>b", "a\n\nb"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "a\n\nb\n\nc\n\nd\n\ne"),
    ("<table><tr><td>a<td>b<tr><th>c</table>", "a\n\nb\n\nc"), ("<dl><dt>a<dd>b<dt>c</dl>", "a\n\nb\n\nc"),
    ("<nav>m</nav><header>h</header><p>t</p><aside>s</aside><form><p>q</p></form><footer>f</footer>", "t"),
    ("<div class='cookie-notice'>n</div><div id=sideBar>s</div><div class=adverb>t</div>", "t"),
    ("<div role=dialog>n</div><div hidden>n</div><div style='display: none'>n</div><p>t</p>", "t"),
    ("<p>a <span class=ad>b <span>c</span></span> d</p>", "a d"), ("<p>a <span class=ad>b</p><p>c</p>", "a\n\nc"),
    ("<div class='sidebar-left'><article><p>t</p></article></div>", "t"),
    ("<article><header><h1>T</h1></header>x<footer>f</footer></article><div>out</div>", "T\n\nx"),
    ("<article>t</article><section class=comments><article class=comment>c</article></section>", "t"),
    ("<article>t<article class=comment>c</article></article>", "t"), ("<article class='post sidebar-none'>t</article>", "t"),
    ("<form><div><h1>T</h1><p>t</p></div></form>", "T\n\nt"), ("<main><h1>T</h1><article>a</article></main><p>o</p>", "T\n\na"),
    ("<article><div class=entry-header><h1>T</h1></div>x</article>", "T\n\nx"), ("<P>A</P><DIV CLASS=AD>b</DIV>", "A"), ("</p></div></x>a</p>", "a"), ("<p>中　文</p>", "中 文"),
])
def test_page_text(source, text):
    assert S.Page(source).main_text() == text


def test_long_and_deep_pages():
    assert S.Page("<p>" + "w " * 300_000).main_text() == " ".join(["w"] * 300_000)
    assert S.Page("<div>" * 20_000 + "x").main_text() == "x"
    assert S.Page("<b><p>" * 20_000 + "x" + "</q></i>" * 20_000).main_text() == "x"


MENU = "<div><ul><li><a href=/>Home</a><li>News<li>About us</ul></div>"
NOTICE = "<div><p>We value your privacy on this site.</p></div>"


def site(n, host="http://a.example", first=0, copies=0):
    rows = []
    for i in range(n):
        own = "".join(f"<p>Text {first + i} part {j} with words of its own.</p>" for j in range(2 + i % 4))
        rows.append((first + i, f"{host}/{i}", f"<body>{MENU}<div><h2>Title {first + i}</h2>{own}</div>{NOTICE}"))
    for i in range(copies):
        rows.append((10_000 + first + i, f"{host}/c{i}",
                     f"<body>{MENU}<div><h2>Same</h2><p>The same article on very many pages of the site.</p></div>{NOTICE}"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit(1) for c in ("host", "id", "element", "value", "k", "m", "key", "bucket", "text")})


def plain(rows, below=S.KEEP_BELOW):
    """The low importances, counted page by page."""
    at, marks = defaultdict(set), defaultdict(set)
    for _, url, source in rows:
        host = 77
        page = S.Page(source or "")
        path, style, content = page.keys(host)
        mark = page.signature()
        marks[host].add(mark)
        for e, v in zip(path[1:], style[1:]):
            at[e, v].add(mark)
        for c in content:
            at[0, c].add(mark)
    m = len(marks[77])
    trust = lambda x: (x - 1) / (x - 1 + S.FEW)
    out, styles = [], defaultdict(list)
    for (e, v), seen in at.items():
        if e:
            styles[e].append(len(seen))
        elif len(seen) > 1:
            out.append((0, 1 - trust(m) * math.log(len(seen)) / math.log(m)))
    for ks in styles.values():
        n = sum(ks)
        if n > 1 and math.log(n) / math.log(m) >= 1 - below:
            spread = -sum(k / n * math.log(k / n) for k in ks) / math.log(n)
            out.append((len(ks), 1 - trust(n) * (1 - spread)))
    return sorted((s, round(i, 9)) for s, i in out if i < below)


def test_importances_equal_plain_count(spark):
    rows = site(40, copies=35)
    got = S.low_importance(frame(spark, rows)).collect()
    assert sorted((int(r["styles"]), round(r["importance"], 9)) for r in got) == plain(rows)
    assert got


@pytest.mark.parametrize("entries", [500_000, 2])
def test_template_goes_and_copies_stay(spark, entries):
    rows = site(40, copies=35)
    for h in range(8):
        rows += site(12, f"https://h{h}.example:80", 1000 * (h + 1))
    # a site of few pages keeps what it repeats; a page without a site has no template
    rows += site(2, "http://small.example", 90_000) + [(95_000, None, f"{NOTICE}<p>t</p>"), (95_001, "no host", NOTICE), (None, None, None)]
    rows += [rows[0], (95_002, "http://a.example/empty", None)]
    got = S.extract(frame(spark, rows), bucket_entries=entries).collect()
    assert len(got) == len(rows)
    want = {}
    for i, _, source in rows:
        body = S.Page(source or "").main_text()
        if i is not None and i < 90_000 or i is not None and 10_000 <= i < 10_100:
            body = "\n\n".join(x for x in body.split("\n\n") if x not in ("Home", "News", "About us", "We value your privacy on this site."))
        want[i] = body
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert "The same article on very many pages of the site." in want[10_000]


def test_repeated_passage_of_articles_stays(spark):
    rows = [(i, f"http://a.example/{i}", f"<div>{MENU}</div><article><p>Own text of page {i}, the longest block there.</p>" + ("<p>A licence that many pages cite.</p>" if i % 3 else "")
             + "<p>Thanks for reading our site.</p></article>") for i in range(60)]
    got = {r["page_id"]: r["text"] for r in S.extract(frame(spark, rows)).collect()}
    own = "Own text of page {}, the longest block there."
    assert got[1] == own.format(1) + "\n\nA licence that many pages cite." and got[3] == own.format(3)


def test_empty_table(spark):
    assert S.extract(frame(spark, site(1)).limit(0)).count() == 0


def test_lost_bucket_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        S.load_bucket(f"{tmp_path}/bucket-0.npz")

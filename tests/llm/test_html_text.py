"""Reading of broken pages, tree matching against brute force, and wrappers of made-up hosts."""

import random
from functools import lru_cache

import pyarrow.parquet as pq
import pytest
from samples import SF

from tributary.llm import html_text, tree_match
from tributary.llm.dom import page

COLUMNS = "page_id long, url string, html string"


def article(html):
    return "\n".join(text for _, text, inside in page(html).blocks if inside)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; text", "plain & text"),
        ("<p>one<p>two", "one\ntwo"),
        ("<p><b>one<br><p>two</b> three", "one\ntwo three"),
        ("<p>a<b>b</b>c <i> d </i>", "abc d"),
        ("<div>a<br>b\n\t c&nbsp;d</div>", "a b c d"),
        ("<p>1 < 2 &lt; 3 &am &#233;&#x1F600;", "1 < 2 < 3 &am é😀"),
        ('<p title="a>b" class=x>t</p>', "t"),
        ('<p title="never closed>t</p><p>u', "t\nu"),
        ("<p>a<!-- <p>b --><p>c<!-- end", "a\nc"),
        ("<script>var t='</p><p>no';</script><style>p{}</style><p>yes", "yes"),
        ("<SCRIPT>no</SCRIPT ><P>yes</P>", "yes"),
        ("<script>never closed <p>no", ""),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"),
        ("<table><tr><td>a<td>b<tr><th>c</table>d", "a\nb\nc\nd"),
        ("<dl><dt>a<dd>b<dt>c</dl>", "a\nb\nc"),
        ("<h1>a</h2>b", "a\nb"),
        ("a</div></p></article>b", "ab"),
        ("<article>in</article>out", "in"),
        ("<main><p>in<nav>menu</nav></main><p>out", "in"),
        ("<main>around<article>in</article></main>", "in"),
        ("<p>x<p>y", "x\ny"),
        ("<nav>menu</nav><header>top</header><aside>side</aside><p>t<footer>foot</footer>", "t"),
        ("<form>Name <input><p>send</form><p>t", "t"),
        ("<form><article>t<button>Buy</button> u</article></form>", "t u"),
        ("<div class='cookie-notice'>we use<p>cookies</div><p>t", "t"),
        ("<div id=comments><article>no</article></div><article>t</article>", "t"),
        ("<article>t<article class=comment>no</article></article>", "t"),
        ("<article><header><h1>t</h1></header><p>u<footer>by</footer></article>", "t\nu"),
        ("<div class='page has-sidebar'><article>t</article></div>", "t"),
        ("<p>t <span class=ad>buy</span> u", "t u"),
        ("<ul><li><a href=x>one</a><li><a>two</a></ul><p>t <a>link</a>", "t link"),
        ("<h2><a>head</a></h2><p>t", "head\nt"),
        ("<head><title>x</title><p>t", "t"),
        ("<html><head><title>x</title>t", "t"),
        ("<body><p>a</body></html><p>b", "a\nb"),
        ("<article><p>cut off <b", "cut off"),
        ("<button>open<article>t</article>", "t"),
        ("<p>a</p>\x00<p>\ud800b", "a\n\x00\n\ud800b"),
    ],
)
def test_pages(html, text):
    assert article(html) == text


def test_long_and_deep_pages():
    words = " ".join(f"w{i}" for i in range(200_000))
    assert article(f"<article><p>{words}</article>") == words
    deep = article("<div>x" * 20_000 + "end")
    assert deep.split("\n") == ["x"] * 19_999 + ["xend"]
    assert len(article("<b>x" * 100_000)) == 100_000
    assert article("<" * 50_000).count("<") == 50_000
    assert article("<a b='" * 5_000) == ""


def test_equal_siblings_are_one_node():
    short, long = (page("<div>" + "<p>t</p>" * n + "<ul><li>a<li>b</ul></div>") for n in (1, 40))
    assert short.shape == long.shape == "html(div(p,ul(li)))"
    assert {place for place, _, _ in long.blocks} == {2, 4}


def largest(a, b) -> int:
    """Nodes of the largest match, straight from the definition."""

    @lru_cache(None)
    def match(x, y):
        if x[0] != y[0]:
            return 0
        rows, columns = x[1], y[1]

        @lru_cache(None)
        def best(i, j):
            if i == len(rows) or j == len(columns):
                return 0
            return max(best(i + 1, j), best(i, j + 1), match(rows[i], columns[j]) + best(i + 1, j + 1))

        return 1 + best(0, 0)

    return match(a, b)


def some_tree(rng, depth=0):
    n = rng.randint(0, 4) if depth < 3 else 0
    return (rng.choice("ab") if depth else "r", tuple(some_tree(rng, depth + 1) for _ in range(n)))


def written(tree) -> str:
    return tree[0] + (f"({','.join(map(written, tree[1]))})" if tree[1] else "")


@pytest.mark.parametrize("cells", [1 << 20, 1])
def test_tree_matching(monkeypatch, cells):
    monkeypatch.setattr(tree_match, "CELLS", cells)
    rng = random.Random(2)
    match = tree_match.Match()
    for _ in range(400):
        a, b = some_tree(rng), some_tree(rng)
        pairs = match.places(written(a), written(b))
        assert len(pairs) == largest(a, b)
        assert len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs)
        keys = [[t.replace("(", "") for t in tree_match._PART.findall(written(t)) if t not in "(),"] for t in (a, b)]
        assert all(keys[0][x] == keys[1][y] for x, y in pairs)


def test_roots_that_differ():
    assert tree_match.Match().places("a(b)", "c(b)") == []


def texts(spark, rows, columns=COLUMNS):
    out = html_text.main_text(spark.createDataFrame(rows, columns))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    rows = out.collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    return rows


def made(n, extra=""):
    """A page without telling names: a line on all pages, one on all but some, and its own text."""
    own = "".join(f"<p>text {n} {i}</p>" for i in range(1 + n % 4))
    return (
        f"<title>page {n}</title><div><div>All about everything</div><h1>Page {n}</h1>"
        f"{extra}<section>{own}</section><div>Read our rules</div></div>"
    )


def wanted(n):
    return "\n".join([f"Page {n}", *(f"text {n} {i}" for i in range(1 + n % 4))])


def test_constant_places_are_template(spark):
    rows = [(n, f"https://A.example/{n}", made(n)) for n in range(30)]
    # Shapes other than the commonest are aligned with it; what only they have is told apart too.
    other = "<table><tr><td>Sold here</td></tr></table>"
    rows += [(n, f"http://a.example:80/{n}", made(n, other)) for n in range(30, 40)]
    got = {r.page_id: r.text for r in texts(spark, rows)}
    assert got == {n: wanted(n) for n in range(40)}


def test_hosts_are_told_apart(spark):
    rows = [(1, "https://a.example/1", made(1)), (2, "https://b.example/1", made(2))]
    got = {r.page_id: r.text for r in texts(spark, rows)}
    assert got == {
        n: f"All about everything\n{wanted(n)}\nRead our rules" for n in (1, 2)
    }


def test_copies_keep_their_text(spark):
    same = "<title>t{}</title><article><h1>Title</h1><p>One text</p></article>"
    rows = [(n, f"https://a.example/{n}", same.format(n)) for n in range(5)]
    rows += [(9, "https://b.example/9", made(1)), (9, "https://b.example/9", made(1))]
    got = [r.text for r in texts(spark, rows)]
    assert got.count("Title\nOne text") == 5
    assert got.count(f"All about everything\n{wanted(1)}\nRead our rules") == 2


def test_edge_rows(spark):
    rows = [
        (1, None, "<p>a"), (2, "https://x.example/", None), (3, "no address", ""), (None, None, None),
        (4, "https://x.example/", "<p>" + "long " * 100_000), (4, "https://x.example/", "<p>b"),
        (5, "https:///path", "<p>c"), (6, "https://user:pw@x.example:8/?u=//y", "<title>q</title><p>d"),
    ]
    clash = [(*r, r[0], "x", "y", "z") for r in rows]
    got = texts(spark, clash, COLUMNS + ", places long, host string, n long, HTML string".replace("n long", "n string"))
    assert sorted((r.page_id or 0, r.text[:3]) for r in got) == [
        (0, ""), (1, "a"), (2, ""), (3, ""), (4, "b"), (4, "lon"), (5, "c"), (6, "d"),
    ]
    assert texts(spark, []) == []
    assert spark.createDataFrame([("https://user:pw@X.example:8/?u=//y",)], "u string").select(
        html_text.host(html_text.F.col("u"))
    ).first()[0] == "x.example"


def test_table_of_pages(spark):
    """The article of each page, cut out by its tags."""
    import html
    import re

    pages = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    got = {r.page_id: r for r in texts(spark, [(r["page_id"], r["url"], r["html"]) for r in pages])}
    assert len(got) == len(pages)
    for r in pages:
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [
            " ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split())
            for b in re.split(r"</?(?:p|h1)>", inner)
        ]
        assert got[r["page_id"]].text == "\n".join(b for b in blocks if b)
        assert got[r["page_id"]].url == r["url"]

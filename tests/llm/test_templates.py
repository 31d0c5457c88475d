import pytest

import brute
from shelfseek.llm import templates

PAGES = [
    ("", []),
    ("<p>a<p>b", ["a", "b"]),
    ("x", ["x"]),
    ('<div class="sidebar">s</div><div>main <b>te</b>xt&nbsp; a</div>', ["main text a"]),
    ("<body><nav>n<main><p>q</main></nav><main><h1>T</h1>a<ul><li>x<li>y</ul></main>", ["T", "a", "x", "y"]),
    ("<article><header><h1>H</h1><p>by</p></header>t<footer>f</footer></article>", ["H", "by", "t"]),
    ('<article>a<div class="comments"><p>c</p></div><header>site</header>b</article>', ["a", "b"]),
    ("<p>cut &am", ["cut &am"]),
    ('<p>x <a href="/q', ["x"]),
    ("<p>a<!-- c", ["a"]),
    ('<script>var t="</p>";</script>z', ["z"]),
    ("a<br>b &lt;c&gt; &#233;", ["a b <c> é"]),
    ('<article><p>1</p></article><article class="comment">no</article><article>2</article>', ["1", "2"]),
    ('<p hidden>h</p><p style="display: none">i</p><form>f</form><p>k</p>', ["k"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
    ("</p></div><p>1 < 2", ["1 < 2"]),
]


#: Names that look like those of adverts or menus, on prose.
NAMED = [
    ("<article><h2 id='related-work'>Related work</h2><p>a</p></article>", ["Related work", "a"]),
    ("<main><section id='search-algorithms'><p>b</p></section></main>", ["b"]),
    ("<article><section id='search'><h3 class='notice'>c</h3>d</section></article>", ["c", "d"]),
    ("<body><div id='share-price'>e</div><p>f <span class='notice'>g</span> h</p>", ["e", "f g h"]),
    ("<article><ul><li class='widget'>i</li></ul><table class='menu'><tr><td>j</table></article>", ["i", "j"]),
    ("<article><p class='commentary'>k</p><p class='comment'>l</p></article>", ["k"]),
    ("<article>m<div class='ad-banner'>n</div><div class='x social share'>o</div></article><div id='sidebar'>p</div>", ["m"]),
    ("<div id='sidebar'>q</div><div class='cookieNotice'>r</div><div>s</div>", ["s"]),
]


@pytest.mark.parametrize("page, expected", [*PAGES, *NAMED])
def test_blocks(page, expected):
    assert [text for text, _ in templates.blocks(page)] == expected


def site_pages():
    rows = []
    for k in range(10):
        body = f'<div><span>Share this now</span></div><div id="x{k}"><p>own text {k}</p><p>a common passage</p></div><div>All rights</div>'
        rows.append((k, f"https://User@WWW.site.example:80/p/{k}", f"<html><body>{body}</body></html>"))
    for k in range(10):
        rows.append((20 + k, f"//other.example/{k}", f"<article><h1>t{k}</h1><p>a common passage</p><div>Follow us</div><p>x{k}</p></article>"))
    rows += [(40, None, None), (41, "no url", ""), (None, "http://one.example", "<p>only</p>"), rows[3], (42, "http://long.example/", "<p>" + "w " * 50_000)]
    return rows


@pytest.mark.parametrize("bound", [templates.BROADCAST_BYTES, 0])
def test_templates_of_a_site(spark, monkeypatch, bound):
    monkeypatch.setattr(templates, "BROADCAST_BYTES", bound)
    rows = site_pages()
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id bigint, url string, html string, host string")
    found = templates.main_text(pages).collect()
    by_id = {r.page_id: r for r in found}
    assert len(found) == len(rows)
    assert by_id[4].text == "own text 4"
    assert by_id[25].text == "t5\na common passage\nx5"
    assert by_id[40].text == by_id[41].text == "" and by_id[None].text == "only"
    assert all(r.n_chars == len(r.text) for r in found) and by_id[42].n_chars == 99_999
    assert templates.main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("bound", [templates.BROADCAST_BYTES, 200, 0])
def test_blocks_on_many_pages_of_a_large_host(spark, monkeypatch, bound):
    """A notice on a fifth of a host's pages goes on a large host too; with 200 bytes only the commonest is broadcast."""
    monkeypatch.setattr(templates, "BROADCAST_BYTES", bound)
    rows = []
    for k in range(300):
        notice = f"<div>Notice {k % 5}</div>" if k < 250 else f"<div>Rare {k // 10}</div>"
        rows.append((k, f"http://large.example/{k}", f"<div>All rights</div>{notice}<div id='x{k}'><p>own {k}</p></div>"))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in templates.main_text(pages).collect()}
    assert found == {k: f"own {k}" if k < 250 else f"Rare {k // 10}\nown {k}" for k in range(300)}


def test_test_pages_as_plain_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    expected = {r.page_id: brute.article_text(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in templates.main_text(pages).collect()} == expected

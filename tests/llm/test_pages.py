import html
import random
import re

import brute
import pytest

from feira.llm.pages import MANY, OWN, Page, main_text
from feira.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("source, text", [
    ("", ""), ("plain &lt;b&gt; &copy; &nbsp; x", "plain <b> © x"),
    ("<div id=main><nav>m</nav><p>A &amp; b<br>c\n d<p>e</div>", "A & b c d\ne"),
    ("<header>H</header><article><header><h1>T</h1></header><p>x <b>y</b><p>z<ul><li>1<li>2</ul>"
     "<div class='comments'><p>no</div><footer>f", "T\nx y\nz\n1\n2"),
    ('<p title="x>y">q</p>', "q"), ('<script>if(a<b)"</p>"</script>t', "t"),
    ('<article>A<div class=ad>no</div>B</article><article class="comment">no</article>', "A\nB"),
    ("<!-- <article>no</article> --><main>m<article>yes</article></main>", "yes"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("<p>a</p></article></p>b<style>x", "a\nb"),
    ('<div hidden>no</div>yes<img src="a">', "yes"), ('<p class="x">1 < 2 and 3 > 2</p>', "1 < 2 and 3 > 2"),
    ('<aside>s</aside><div class="cookie-notice">c</div><form>f</form><p>t</p><div id="sidebar">s</div>', "t"),
    ("<article><p><b>open<br><p>next</article><footer>no", "open\nnext"),
])
def test_extraction(source, text):
    assert Page(source).text() == text


@pytest.mark.parametrize("wrapper", [
    "page has-sidebar", "no-comments", "menu-open", "social-share-enabled", "sidebar", "site-header", "nav"])
@pytest.mark.parametrize("content", ["<article>%s</article>", "<main>%s</main>", "<div role=main>%s</div>"])
def test_wrapper_named_like_a_template(wrapper, content):
    """No name drops an element with an article or a main part, and parts of names drop nothing."""
    text = ("<p>a</p><section id='related-work'><p>b</p></section><div class='widget-content'>c</div>"
            "<div class='nav'>no</div><p>d <span class='ad'>no</span></p>")
    for name in ("class", "id"):
        page = Page(f"<body><div {name}='{wrapper}'><p class=ads>no</p>{content % text}</div></body>")
        assert page.text() == "a\nb\nc\nd" and (page.articles or page.mains)


@pytest.mark.parametrize("unit", ['<a "\'', "<p>", "</p>", "<div>", "<!--", "<li>", "<b><p>", "<td>", "<script", "&", "<"])
def test_long_broken_pages(unit):
    Page(unit * 20000).text()


def test_templates(frame):
    pages = [
        (i, f"http://h.com/{i}",
         f"<body><div><ul><li>home<li>about</ul></div><div><p>text {i}</p></div><div>All rights</div></body>")
        for i in range(20)
    ]
    # A passage that recurs inside articles is no template, and neither are copies of a page.
    pages += [(100 + i, f"http://a.com/{i}", f"<article><p>passage</p><p>own {i}</p></article>") for i in range(20)]
    pages += [(200 + i, f"http://c.com/{i}", "<div>only</div><div>copies</div>") for i in range(20)]
    pages += [(300, None, None), (301, "no host", "<div>All rights</div>"), (3, *pages[3][1:])]
    rows = main_text(frame(pages, SCHEMA)).collect()
    assert len(rows) == len(pages) and all(len(r.text) == r.n_chars for r in rows)
    got = {r.page_id: r.text for r in rows}
    assert got[3] == "text 3" and got[100] == "passage\nown 0" and got[200] == "only\ncopies"
    assert got[300] == "" and got[301] == "All rights"


def test_templates_of_a_large_host(frame):
    """A menu of a section goes whatever share of the host's pages the section has."""
    def page(i):
        menu = f"<ul><li>section {i // 6}<li>home</ul>" if i < 240 else f"<div>alone {i}</div>"
        return f"<body><div>{menu}</div><div><p>text {i}</p><p>pair {i // 4}</p></div><div>All rights</div></body>"

    pages = [(i, f"http://h.com/{i}", page(i)) for i in range(300)]
    pages += [(300 + i, f"http://other.com/{i}", page(i)) for i in range(0, 240, 6)]
    pages.append((7, *pages[7][1:]))
    rows = main_text(frame(pages, SCHEMA)).collect()
    assert len(rows) == len(pages)
    got = {r.page_id: r.text for r in rows}
    for i in range(300):
        assert got[i] == (f"alone {i}\n" if i >= 240 else "") + f"text {i}\npair {i // 4}"
    # Each section is on one page of the other host, its "home" on all.
    assert got[300] == "section 0\ntext 0\npair 0"


PARAGRAPHS = "<p>The bridge was built in three years.</p><p>It carries two tracks, and a path for walkers.</p>"


@pytest.mark.parametrize("page, text", [
    (f"<article><h1>Bridge</h1><div class='body'>{PARAGRAPHS}</div></article><footer>%d</footer>",
     "Bridge\nThe bridge was built in three years.\nIt carries two tracks, and a path for walkers."),
    (f"<article><h1>Bridge</h1><ul><li>arch<li>steel</ul><table><tr><td>1</table></article><footer>%d</footer>",
     "Bridge\narch\nsteel\n1"),
    (f"<div id='content'><h1>Bridge</h1><div class='body'>{PARAGRAPHS}</div></div><footer>%d</footer>",
     "Bridge\nThe bridge was built in three years.\nIt carries two tracks, and a path for walkers."),
    (f"<div id='content'><h1>Bridge</h1><div class='body'>{PARAGRAPHS}</div></div><div>print %d</div>",
     "Bridge\nThe bridge was built in three years.\nIt carries two tracks, and a path for walkers.\nprint %d"),
    (f"<div><main>{PARAGRAPHS}</main></div><div>%d</div>",
     "The bridge was built in three years.\nIt carries two tracks, and a path for walkers."),
])
@pytest.mark.parametrize("copies", [5, 12])
def test_near_copies_keep_their_text(frame, page, text, copies):
    """Copies of an article on one host, whose pages differ in a footer, and other pages there."""
    rows = [(i, f"http://h.com/{i}", f"<body><div><b>Menu</b> home about</div>{page.replace('%d', str(i))}") for i in range(copies)]
    rows += [(100 + i, f"http://h.com/x{i}", f"<body><div><b>Menu</b> home about</div><div><p>Own text of page {i}, and more of it"
              f"</div><div>All rights reserved</div>") for i in range(8)]
    got = {r.page_id: r.text for r in main_text(frame(rows, SCHEMA)).collect()}
    for i in range(copies):
        assert got[i] == text.replace("%d", str(i))
    assert all(got[100 + i] == f"Own text of page {i}, and more of it" for i in range(8))


def test_random_hosts(frame):
    """Pages without any markup of an article, against a plain count."""
    rng = random.Random(5)
    shared = ["home about contact", "we use cookies here", "all rights reserved", "top stories of today", "follow us on"]
    hosts = {}
    for h in range(6):
        pages = []
        for i in range(rng.randint(3, 14)):
            blocks = rng.sample(shared, rng.randint(1, len(shared)))
            blocks.insert(rng.randint(0, len(blocks)), f"text number {rng.randint(0, 9)} of host {h}" * rng.choice([1, 4]))
            pages.append(blocks)
        pages += [list(pages[0]) for _ in range(rng.choice([0, 6]))]
        hosts[f"h{h}.com"] = pages
    rows = [
        (f"{name}/{i}", f"https://{name}/{i}", "".join(f"<div>{b}</div>" for b in blocks))
        for name, pages in hosts.items() for i, blocks in enumerate(pages)
    ]
    got = {r.page_id: r.text for r in main_text(frame(rows, SCHEMA.replace("long", "string"))).collect()}
    want = {}
    for name, pages in hosts.items():
        for i, kept in enumerate(brute.without_templates(pages, MANY, OWN)):
            want[f"{name}/{i}"] = "\n".join(kept)
    assert got == want and any(len(t.split("\n")) == 1 for t in want.values()) and any("\n" in t for t in want.values())


def test_batches_are_cut_by_bytes(frame):
    long = "<div><p>" + "many words " * 100_000 + "</p></div>"
    rows = [(i, f"http://h.com/{i}", long if i % 2 else f"<p>{i}") for i in range(6)]
    got = {r.page_id: r.n_chars for r in main_text(frame(rows, SCHEMA)).collect()}
    assert got == {i: 1_099_999 if i % 2 else 1 for i in range(6)}


def test_empty_table(frame):
    assert main_text(frame([], SCHEMA)).count() == 0


def test_all_pages(spark, sf_dir, table):
    def plain(source):
        article = re.search(r"<article>(.*?)(?:</article>|<footer>)", source, re.S)[1].replace("<br>", " ")
        blocks = re.split(r"</?(?:p|h1)>", article)
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        return "\n".join(line for line in lines if line)

    got = {r.page_id: r.text for r in QUERIES["op9_main_text"](spark, sf_dir).collect()}
    assert got == {k: plain(h) for k, h in table("pages", "page_id", "html")}

import pytest
from pyspark.sql import functions as F

from emolens.llm import html_template

SCHEMA = "page_id long, url string, html string, host string, salt string"


def page(i, body, extra=""):
    return (f"<!DOCTYPE html><html><head><title>T{i}</title><script>var a='<p>';</script></head><body><div class='top'>Site name</div>"
            f"<ul><li><a href='/{i}'>go {i}</a></li><li>home</li></ul><div>{body}</div><div>All rights reserved</div>{extra}</body></html>")


@pytest.mark.parametrize(("html", "text"), [
    ("", ""), ("   ", ""), ("just text &amp; more", "just text & more"), ("<p>a<p>b<br>c", "a\nb c"),
    ("<article><h1>H</h1><p>x <b>y</b>z</p><aside>no</aside><form>no</form></article><p>out</p>", "H\nx yz"),
    ("<nav>n</nav><header>h</header><main><p>m&nbsp;&#33; 3 < 4</p></main><footer>f</footer>", "m ! 3 < 4"),
    ("<body class='has-sidebar'><div id=main><p>t</p></div><div class='cookie-notice'>c</div><section id='comments'><article>c</article>"
     "</section>", "t"),
    ("<p title='a > b'>t</p><!-- <p>no</p> --><style>p{}</style><script>if (a < b) x('</p>')</script><p>u", "t\nu"),
    ("<article><p>kept</p><div class='ad'>no</div><div class='newsletter-box'>no</div><p>too &am &copy</p></article>", "kept\ntoo &am ©"),
    ("<article>a</article><article class='comment'>no</article>", "a"),
])
def test_single_pages(html, text):
    assert html_template.main_text(html, None) == text


def test_templates_find_constant_blocks(spark):
    # no article, no names: only the host's template tells what is fixed
    pages = [(i, f"https://plain.example/{i}", page(i, f"<p>Story {i} begins.</p><p>It ends {i}.</p>"), "x", "y") for i in range(40)]
    pages += [(100, "https://alone.example/", page(100, "<p>Only page.</p>"), "x", "y"),
              (101, None, "<p>no host</p>", None, None), (102, "https://plain.example/null", None, "", ""),
              (103, "https://plain.example/odd", "<p>another layout</p>", "", ""), (103, "https://plain.example/odd", "<p>another layout</p>", "", "")]
    rows = spark.createDataFrame(pages, SCHEMA).repartition(4)
    out = html_template.extract(rows)
    got = {r.page_id: r.text for r in out.collect()}
    assert out.count() == len(pages)
    assert got[7] == "go 7\nStory 7 begins.\nIt ends 7."
    assert got[100] == "Site name\ngo 100\nhome\nOnly page.\nAll rights reserved"
    assert got[101] == "no host" and got[102] == "" and got[103] == "another layout"
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_salting_changes_nothing(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"https://h{i % 2}.example/{i}", page(i, f"<p>Text {i}</p>"), "", "") for i in range(60)], SCHEMA)
    before = {tuple(r) for r in html_template.extract(pages).collect()}
    monkeypatch.setattr(html_template, "PAGES_PER_SALT", 4)
    assert {tuple(r) for r in html_template.extract(pages).collect()} == before


@pytest.mark.parametrize(("html", "text"), [
    ("<div class='content-sidebar-wrap'><main><article><p>t</p></article></main></div>", "t"),
    ("<div class='no-sidebar'><p>t</p></div><div class='sidebar'>s</div>", "t"),
    ("<article class='comments-open'><p>t</p></article>", "t"),
    ("<form id='aspnetForm'><article><p>t</p></article></form>", "t"),
    ("<form id='aspnetForm'><nav>n</nav><div><p>the text of a page</p></div><div class='sidebar'>s</div></form>", "the text of a page"),
    ("<div class='overlay'><main><p>t</p></main></div>", "t"),
    ("<article><div class='entry-header'><h1>H</h1></div><div class='header'>D</div><section class='related-work'><p>r</p></section></article>", "H\nD\nr"),
    ("<main><p>t</p></main><aside><article>no</article></aside><div class='related-posts'><article>no</article></div>", "t"),
    ("<article>t</article><ol class='comment-list'><li><article>no</article></ol><footer><article>no</article></footer>", "t"),
    ("<p>a longer text of the page</p><form>search here</form><div class='share'>s</div>", "a longer text of the page"),
    ("<article><p>t</p><div class='share-buttons'><article>no</article></div></article>", "t"),
])
def test_wrappers(html, text):
    assert html_template.main_text(html, None) == text


def test_template_text_in_articles_goes(spark):
    def story(i, extra="<p>Share this story.</p><p>By the staff</p>"):
        return page(i, f"<article><h1>Title {i}</h1><p>Story {i} begins here and goes on.</p>{extra}<p>It ends with {i}.</p></article>")

    rows = [(i, f"https://a.example/{i}", story(i), "", "") for i in range(20)]
    rows += [(100 + k, f"https://b.example/{k}", story(5, "<p>A long paragraph of the one article.</p>" * 2 + f"<p>Version {k}</p>"), "", "") for k in range(5)]
    out = {r.page_id: r.text for r in html_template.extract(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    for i in range(20):
        assert out[i] == f"Title {i}\nStory {i} begins here and goes on.\nIt ends with {i}."
    for k in range(5):
        assert out[100 + k].startswith("Title 5\nStory 5 begins") and f"Version {k}\nIt ends with 5." in out[100 + k]


def test_copies_are_one_page_of_a_template(spark):
    def copy(i, n):
        return page(i, f"<p>Story {i} begins.</p><p>It ends {i}.</p>"), f"go {i}\nStory {i} begins.\nIt ends {i}.", n

    rows, want = [], {}
    for host, groups in (("three", [copy(1, 3)]), ("half", [copy(1, 3), copy(2, 1), copy(3, 1), copy(4, 1)]), ("rows", [copy(5, 6), copy(6, 2)])):
        for h, text, n in groups:
            for k in range(n):
                i = len(rows)
                rows.append((i, f"https://{host}.example/{'same' if host == 'rows' else i}", h, "", ""))
                want[i] = text if host == "half" else f"Site name\n{text.replace(chr(10), chr(10) + 'home' + chr(10), 1)}\nAll rights reserved"
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert {r.page_id: r.text for r in html_template.extract(pages).collect()} == want


def test_vectors_make_classes(spark):
    pages = spark.createDataFrame([(i, f"https://a.example/{i}", page(i, "<p>t</p>" * (1 + i % 3))) for i in range(9)], "page_id long, url string, html string")
    rows = pages.select(html_template.host_of().alias("host"), F.xxhash64("page_id").alias("key"), "html")
    t = html_template.templates(rows).collect()
    assert len(t) == 1 and t[0].n_pages == 9
    sizes = [len(c.tokens) for c in t[0].classes]
    # the once-a-page tokens first, then list items (twice a page) and paragraphs (by page)
    assert sizes[0] > 10 and len(sizes) >= 3


def test_empty_table(spark):
    assert html_template.extract(spark.createDataFrame([], SCHEMA)).count() == 0

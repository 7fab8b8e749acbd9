from textmill.operators.html import category_links, listing_articles, listing_rows, page_text, visible_text

PAGE = """<html><head><title>T</title></head><body><nav><a>N</a></nav><article><h1>H</h1>
<p>One <a href="x">two</a> .</p><ul><li>L</li></ul><article><p>nested</p></article>
</article><footer>F</footer><script>s</script><!-- c --></body></html>"""

LISTING = """<article><h4>Second</h4><h3>First</h3><a href="./articles/abc">x</a>
<div><a href="./publications/p1">Pub</a><time datetime="2020-10-01T12:00:00Z">1h</time></div></article>
<article><h3>No time</h3><a href="./articles/def">y</a></article>
<article><h3>Fallback</h3><div><a>Paper</a><time datetime="2020-10-02T12:00:00Z">1h</time></div></article>"""


def test_visible_text_fixture():
    assert visible_text(PAGE) == "One two."
    assert visible_text("<div><h6>six</h6><ol><li>item</li></ol></div>") == "six item"


def test_unclosed_tags_and_stray_end_tags():
    # An unmatched end tag is ignored but still ends the text node before it.
    assert visible_text("<div><p>a<b>b</i>c</div><p>d") == "a b c d"
    assert visible_text("<p>x</span>y</p>") == "x y"
    # 120 unclosed <b> under a <ul>: the walk gives up after 100 levels and keeps the text.
    assert visible_text("<ul>" + "<b>" * 120 + "deep") == "deep"
    assert visible_text("<ul>" + "<b>" * 10 + "shallow") == ""


def test_listing_fixture():
    rows = listing_rows(LISTING)
    assert [(r["source"], r["datetime"], r["headline"], r["url"]) for r in rows] == [
        ("Pub", "2020-10-01T12:00:00Z", "First", "https://news.google.com/articles/abc"),
        ("Paper", "2020-10-02T12:00:00Z", "Fallback", "XXX"),
    ]


def test_page_text_runs_on_pages(spark):
    from conftest import SF001
    from textmill.sources.tables import table

    out = page_text(table(spark, SF001, "pages", "page_id", "html"))
    rows = out.collect()
    assert len(rows) == 250
    assert all("track(" not in r.body and "margin:0" not in r.body for r in rows)


def test_very_deep_pages():
    assert visible_text("<b>" * 5000 + "deep" + "</b>" * 5000 + "<p>x") == "deep x"
    assert len(listing_rows("<article>" + "<a>" * 5000 + "<time datetime='t'>")) == 1


def test_listing_and_categories_run_on_rows(spark):
    pages = spark.createDataFrame(
        [(1, LISTING), (2, "<a aria-label='World' href='./w1'>a</a><a aria-label='World' href='./w2'>b</a>"),
         (3, None), (4, "")], "page_id long, html string")
    rows = listing_articles(pages, since="2020-10-02T12:00:00Z").collect()
    assert [(r.page_id, r.headline, r.source) for r in rows] == [(1, "Fallback", "Paper")]
    assert listing_articles(pages).count() == 2
    assert [(r.page_id, r.category, r.url[-3:]) for r in category_links(pages).collect()] == [(2, "World", "/w1")]

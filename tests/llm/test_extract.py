"""Main text of pages: markup, templates of a host, broken pages."""

from spendlens.llm import extract
from spendlens.llm.markup import blocks

PAGES = "page_id long, url string, html string"


def text_of(html, frame=(), fixed=()):
    return extract.article(blocks(html)[0], list(frame), set(fixed))


def test_article_without_what_stands_around_it():
    html = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <header>Top</header><nav><ul><li><a href=x>Menu</a></ul></nav><div class="Cookie-Notice">We use</div><aside>Side</aside>
    <article><header><h1>Title &amp; more</h1></header><p>One<p>two <b>bold
      text</b><br>three</p><div class="ad">Buy</div><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>tail<!-- no --><form>f<input></form>
    <section id="comments"><p>me too</section><blockquote>q&nbsp;q</blockquote></article><footer>&copy;</footer>"""
    assert text_of(html) == ["Title & more", "One", "two bold text three", "a", "b", "c", "d", "tail", "q q"]


def test_broken_pages():
    assert text_of("") == [] and text_of("   ") == []
    assert text_of("a < b && c &lt; d") == ["a < b && c < d"]
    assert text_of("<p>x<!-- never closed <p>y") == ["x"]
    assert text_of("<p>x<script>never closed <p>y") == ["x"]
    assert text_of("</div></p><p>x</article></b>y") == ["xy"]
    assert text_of('<div title="a>b">x</div>') == ["x"]
    assert text_of("<article>" * 300 + "deep") == ["deep"]
    assert text_of("<b>" * 3000 + "x" * 100_000) == ["x" * 100_000]


def pages(n, host="h.example"):
    """Pages of a host without article markup: a frame, a repeated line, varying text."""
    return [
        (i, f"http://{host}/{i}", f"<body><div id=top><a href=/>Home of all</a></div><div id=x><p>Words of page {i} {'v' * i}</p>"
         f"<p>Same on all pages</p></div><div id=low>Line {i % 2} of <a href=/>links and more links</a></div></body>")
        for i in range(n)
    ]


def test_template_of_a_host(spark):
    rows = pages(12) + [(100, "http://one.example/", "<body><div><p>Alone</p></div></body>"), (101, None, None), (102, "x", "")]
    rows += [(103, "http://h.example/copy", pages(12)[3][2]), (103, "http://h.example/copy", pages(12)[3][2])]
    got = extract.extracted(spark.createDataFrame(rows, PAGES)).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows)
    assert all(texts[i] == f"Words of page {i} {'v' * i}".strip() for i in range(12))
    assert texts[100] == "Alone" and texts[101] == texts[102] == "" and texts[103] == texts[3]
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_classes_of_equal_occurrence(spark):
    [row] = extract.templates(spark.createDataFrame(pages(8), PAGES)).collect()
    paths = {f["path"] for f in row["frame"]}
    assert "/body/div.x" in paths and "/body/div.x/p" in paths
    assert len(row["fixed"]) >= 2
    assert extract.slot_of([f.asDict() for f in row["frame"]]).startswith("/body/div.x")


def test_empty_table_and_extra_columns(spark):
    from pyspark.sql import functions as F

    assert extract.extracted(spark.createDataFrame([], PAGES)).count() == 0
    more = spark.createDataFrame(pages(5), PAGES).withColumns({"host": F.lit(1), "text": F.lit("t"), "frame": F.lit(2)})
    assert extract.extracted(more).columns == ["page_id", "url", "text", "n_chars"]


def test_names_mark_whole_and_not_around_the_article():
    body = "<h1>T</h1><p>one</p>"
    for html in (
        f"<body class='single no-sidebar'><article>{body}</article>", f"<body class='sidebar'><article>{body}</article>",
        f"<div class='content has-sidebar'><article>{body}</article></div>", f"<article class='post comments-open'>{body}</article>",
        f"<div class='content has-sidebar'>{body}</div>", f"<div class='modal'><main class='search'>{body}</main></div>",
        f"<div class='widget'><article>{body}</article></div>", f"<form id=aspnetForm><main>{body}</main></form>",
        f"<div class=related><article>no</article></div><article>{body}<article class=comment>no</article></article>",
        f"<article>{body}</article><div id=comments><article class=comment>no</article></div>",
    ):
        assert text_of(html) == ["T", "one"], html
    inside = "<h2 id='related-work'>a</h2><section id='search'>b</section><p id='notice-3'>c</p><div id='menu'>d</div>"
    assert text_of(f"<article>{inside}<div id=comment-7>no</div><div class=share>no</div></article>") == ["a", "b", "c", "d"]
    assert text_of(f"<div>{inside}<div class='siteFooter'>no</div><div id=sidebar>no</div><div class=ad-1>no</div></div>") == ["a", "b", "c"]


def listed(i, n=40):
    """A page without article markup: title outside of the body's element, headings, lists, tables and long paragraphs."""
    from tests.llm.small import prose

    parts = "".join(f"<h2>Heading {i} {k}</h2><p>{prose(100 * i + k, n)}</p><p>{prose(100 * i + k + 50, n)}</p>" for k in range(4))
    more = f"<ul><li>item a {i}</li><li>item b {i}</li></ul><table><tr><td>cell {i}</td></tr></table><blockquote>quote {i}</blockquote>"
    return (
        f"<body><div id=top><a href=/>Home</a></div><div id=all><h1>Title {i}</h1><div class=text>{parts}{more}</div>"
        "<p>The same line under every article</p></div><div id=low><a href=/>About</a></div></body>"
    )


def test_headings_lists_and_title_stay_with_long_paragraphs(spark):
    rows = [(i, f"http://h.example/{i}", listed(i)) for i in range(8)]
    got = {r["page_id"]: r["text"] for r in extract.extracted(spark.createDataFrame(rows, PAGES)).collect()}
    for i in range(8):
        want = extract.blocks(rows[i][2])[0]
        assert got[i].split("\n") == [b.text for b in want if b.text not in ("Home", "About") and not b.text.startswith("The same")]
        assert got[i].startswith(f"Title {i}\nHeading {i} 0\n") and f"item b {i}\ncell {i}\nquote {i}" in got[i]


def test_copies_are_not_a_template(spark):
    rows = [(i, f"http://h.example/{i}", listed(min(i, 6))) for i in range(20)]  # 14 copies of page 6
    near = [(100 + i, f"http://n.example/{i}", listed(i if i < 6 else 6).replace("quote 6", f"quote {i}")) for i in range(16)]
    got = {r["page_id"]: r["text"] for r in extract.extracted(spark.createDataFrame(rows + near, PAGES)).collect()}
    for i in range(20):
        assert got[i].startswith(f"Title {min(i, 6)}\nHeading") and "The same" not in got[i]
    for i in range(16):
        assert got[100 + i].startswith(f"Title {min(i, 6)}\nHeading") and got[100 + i].count("\n") > 12


def test_template_chooses_the_slot_where_articles_are_named(spark):
    def page(i):
        teaser = "<article><p>Read our offer of the year, the same on all pages</p></article>"
        return f"<body><div id=offer>{teaser}</div><div id=x><h1>Title {i}</h1><p>Words {'v' * (i + 1)} of page {i}</p></div></body>"

    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(8)]
    rows += [(50 + i, f"http://a.example/{i}", f"<body><p>By {i}</p><article><h1>T {i}</h1><p>{'w ' * i}e</p></article></body>") for i in range(8)]
    df = spark.createDataFrame(rows, PAGES)
    got = {r["page_id"]: r["text"] for r in extract.extracted(df).collect()}
    assert all(got[i] == f"Title {i}\nWords {'v' * (i + 1)} of page {i}" for i in range(8))
    assert all(got[50 + i] == f"T {i}\n{'w ' * i}e" for i in range(8))
    slots = {r["host"]: extract.slot_of(extract.varying(*([x.asDict() for x in r[n]] for n in ("frame", "fixed")))) for r in extract.templates(df).collect()}
    assert slots == {"h.example": "/body/div.x", "a.example": "/body/article"}


def test_a_class_is_fixed_only_whole_and_in_order():
    lines = [f"<p>line {k}</p>" for k in range(3)]
    fixed = [{"token": extract._token("/body/p", f"line {k}"), "kind": 1, "place": k / 3, "path": "/body/p", "chars": 6} for k in range(3)]
    for shown, want in ((lines, 3), (lines[::-1], 0), (lines[:2], 0)):
        assert len(extract._shown(blocks("<body>" + "".join(shown))[0], fixed)) == want

import html
import re
import time

import pytest

from kiln.llm import catalog, mainbody
from kiln.llm.mainbody import main_text

from .conftest import SF

TEXT = "A sentence, with commas, that is long enough to be scored as a paragraph of the article."


def by_template(page):
    """The article element of the test pages, cut at its paragraph tags."""
    article = page[page.index("<article>") + 9:page.index("</article>")].replace("<br>", " ")
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split())
              for b in re.split(r"</?(?:p|h1)>", article)]
    return "\n\n".join(b for b in blocks if b)


def test_pages_of_the_table(spark, tables):
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in catalog.op4_main_text(spark, SF).collect()}
    assert got == {r.page_id: (r.url, by_template(r.html), len(by_template(r.html)))
                   for r in tables("pages").collect()}


PAGE = """<html><head><title>No</title><style>p{{}}</style></head><body class="has-sidebar">
<header><p>Top of the site, with a long enough line to be scored, really.</p></header>
<nav><ul><li><a href=/>Home</a><li><a href=/x>News, much news, and more news of all kinds</a></ul></nav>
<div id="cookie-notice">We use cookies, many cookies, on this site, do you agree?</div>
<div class="wrap"><div class="{cls}">{body}</div>
<div class="sidebar"><p>Other things, of interest, to readers of this page, and more.</p></div></div>
<section class="user-comments"><p>First, I disagree, with everything, said here in the article.</p></section>
<form><p>Name, address, and other things that we want to know from you.</p></form>
<script>document.write("<p>{text}</p>")</script><footer>&copy; us, all rights, reserved forever</footer></body></html>"""


@pytest.mark.parametrize("cls", ["", "content", "x"])
def test_article_without_its_surroundings(cls):
    body = (f"<h1>Title</h1><p>{TEXT} One &amp; two&nbsp;&lt;b&gt; &#233;\n  three.</p>"
            f"<!-- <p>comment</p> --><p>{TEXT}<br>Next <b>bold</b>ly.<div class=ad>Buy, buy, buy now, please</div>"
            f"<p>Short.<ul><li>First item<li>Second <a href=x>item</a></ul><pre>a\n b</pre>")
    want = ["Title", TEXT + " One & two <b> é three.", TEXT + " Next boldly.", "Short.", "First item",
            "Second item", "a b"]
    assert main_text(PAGE.format(cls=cls, body=body, text=TEXT)).split("\n\n") == want


@pytest.mark.parametrize("cls", ["content with-sidebar", "layout has-sidebar", "site sticky-header",
                                 "post-content no-comments", "sidebar-left wrap", "comments-open page",
                                 "contentWithSidebar", "ad main", "page-header-fixed"])
@pytest.mark.parametrize("tag", ["div", "article", "main"])
def test_wrapper_with_a_hint_word(cls, tag):
    article = f"<{tag}><h1>Title</h1><p>{TEXT} One.</p><p>{TEXT} Two.</p></{tag}>"
    around = ('<div class="sidebar"><p>Other things, of interest, to readers of this page, and more.</p></div>'
              '<ol id="comments"><li class="comment"><article class="comment-body"><p>First, I disagree, with '
              'everything, said here in the article.</p></article></li></ol>')
    want = ["Title", TEXT + " One.", TEXT + " Two."]
    skip = '<body><a href="#x">Skip to content</a>'
    assert main_text(f'{skip}<div class="{cls}">{article}{around}</div></body>').split("\n\n") == want
    assert main_text(f'{skip}<div id="{cls}"><div class=wrap>{article}</div></div>{around}</body>'
                     ).split("\n\n") == want


def test_hints_that_stay():
    comments = "<section id=comments>" + f"<p>I say, {TEXT}</p>" * 20 + "</section>"
    for page in (f"<div><p>{TEXT}</p></div>{comments}", f"<div class=entry><p>{TEXT}</p></div>{comments}",
                 f"<article><p>{TEXT}</p><div class='post-share'><p>Share, {TEXT}</p></div></article>{comments}",
                 f"<p>{TEXT}</p><div class=related>" + f"<article class=promo><p>{TEXT}</p></article>" * 3 + "</div>"):
        assert main_text(f"<body>{page}</body>").startswith(TEXT)
        assert "say" not in main_text(f"<body>{page}</body>") and "Share" not in main_text(f"<body>{page}</body>")
    # nothing else on the page
    assert main_text(f"<body><a href=/>Skip</a><div class=comments><p>{TEXT}</p></div></body>") == TEXT


def test_article_in_sections_and_siblings():
    page = "<body><div class=top><a href=/>a link, to other, places on this site</a></div><article>" + "".join(
        f"<section><h2>Part {k}</h2><p>{TEXT} {k}</p></section>" for k in range(4)) + "</article></body>"
    assert main_text(page).split("\n\n") == [x for k in range(4) for x in (f"Part {k}", f"{TEXT} {k}")]
    page = f"<body><div><p>{TEXT}</p><p>{TEXT}</p><p>{TEXT}</p></div><p>{TEXT} Beside.</p></body>"
    assert main_text(page).endswith("Beside.")


P = f"<p>{TEXT}</p>"
FOUR = f"<div>{P * 4}</div>"


@pytest.mark.parametrize("page,want", [
    # the title beside the container, further out, or in a part of the article named header
    (f"<h1>Title</h1>{FOUR}", ["Title"] + [TEXT] * 4),
    (f"<div><h1>Title</h1></div><div class=wrap>{FOUR}</div>", ["Title"] + [TEXT] * 4),
    (f"<article><div class=header><h1>Title</h1></div>{P}</article>", ["Title", TEXT]),
    (f"<h1>Site</h1><div><h1>Title</h1>{P * 4}</div>", ["Title"] + [TEXT] * 4),
    # parts of an article
    (f"<article>{P}<div class=search-results><p>Found.</p></div></article>", [TEXT, "Found."]),
    (f"<article>{P}<fieldset><legend>Box</legend><p>Boxed.</p></fieldset></article>", [TEXT, "Box", "Boxed."]),
    (f"<article>{P}<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>", [TEXT, "So x=2 holds."]),
    # sections beside the best, and what stands between
    (f"<div><h2>A</h2>{P * 4}</div><div><h2>B</h2>{P}</div><div><h2>C</h2>{P}</div>",
     ["A"] + [TEXT] * 4 + ["B", TEXT, "C", TEXT]),
    (f"<div><h1>Title</h1>{FOUR}<ul><li>one<li>two</ul><div>{P}</div></div>",
     ["Title"] + [TEXT] * 4 + ["one", "two", TEXT]),
    # surroundings beside them
    (f"<h1><a href=/>Site</a></h1><div class=links><a href=/a>{TEXT}</a></div>{FOUR}<div class=promo>{P}</div>"
     f"<fieldset>{P}</fieldset>", [TEXT] * 4),
])
def test_whole_article_and_nothing_else(page, want):
    assert main_text(f"<html><body>{page}</body></html>").split("\n\n") == want


@pytest.mark.parametrize("piece", ["<div>x", "<a b ", '<a b="', "<a b='\"", "<p>x<li>y", "<li><div>x", "<td><tr>x",
                                   '<a ">"', "<!", "</", "</x", "<a<", "&amp;<b>", "<math>x", "<article>x<h1>y"])
def test_a_megabyte_of_tags_that_nothing_closes(piece):
    times = []
    for size in (1 << 18, 1 << 20):
        at = time.process_time()
        main_text(P + piece * (size // len(piece)))
        main_text(piece * (size // len(piece)) + P)
        times.append(time.process_time() - at)
    assert times[1] < 30 and times[1] < 8 * times[0] + 1


@pytest.mark.parametrize("page,text", [
    ("<p>a <b title='x>y'>b</b> <i title=don't>c</i></p>", "a b c"), ("<p x=\"y>one</p><p>two</p>", "one\n\ntwo"),
    (None, ""), ("", ""), ("  \n", ""), ("plain words", "plain words"), ("<p>a<p>b", "a\n\nb"),
    ("<nav>menu</nav>", ""), ("a < b & c > d", "a < b & c > d"), ("<p>x<!-- open", "x"),
    ("<p>x</p><script>open", "x"), ("<p title='a>b' hidden>no</p><p>yes</p>", "yes"),
    ("</div></p><p>ok</p></body></b>", "ok"), ("<div>one<p>two</p>three</div>", "one\n\ntwo\n\nthree"),
])
def test_odd_pages(page, text):
    assert main_text(page) == text


def test_deep_and_long_pages():
    deep = "<div>" * 3000 + f"<p>{TEXT}</p>" + "</div>" * 3000
    assert main_text(deep) == TEXT
    long = "<article>" + f"<p>{TEXT}</p>" * 20_000 + "</article>"
    assert main_text(long) == "\n\n".join([TEXT] * 20_000)


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>x</p>"), (2, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text")
    assert sorted(map(str, map(tuple, mainbody.extract_text(df).collect()))) == sorted(map(str, [
        (1, "u", "", 0), (1, "u", "", 0), (None, None, "x", 1), (2, "v", "", 0)]))
    assert mainbody.extract_text(df.where("1 = 0")).count() == 0

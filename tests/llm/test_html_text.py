from html import unescape

import pytest

from tidemark.llm import html_text as op

LONG = "This paragraph is long enough to be the text of an article and nothing else. " * 4


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("   \n ", ""),
        ("plain words only", "plain words only"),
        ("<p>a &amp; b &#233; &lt;i&gt;<p>c", "a & b é <i>\nc"),
        ("<script>var t='</p>';</script><style>p{}</style><p>one  two\n three", "one two three"),
        ("<article><h1>T</h1><p>x<br>y</p></article><footer>&copy; f</footer>", "T\nx\ny"),
        ("<p>unclosed <b>bold <a href=x>link", "unclosed bold link"),
    ],
)
def test_small_pages(html, text):
    assert op.main_text(html) == text


def page(content):
    links = "".join(f'<li><a href="/{i}">Section number {i}</a></li>' for i in range(12))
    return f"""<!DOCTYPE html><html><head><title>t</title><script>x("<p>no</p>")</script></head><body>
      <header><h1>Site</h1></header><nav><ul>{links}</ul></nav>
      <div class="cookie-notice">We use cookies. {LONG}</div><div class="ad">Buy {LONG}</div>
      {content}
      <aside><p>{LONG}</p></aside><form><label>Name</label><input></form>
      <div id="comments"><article><p>First! {LONG}</p></article></div>
      <footer>about us</footer></body></html>"""


PARAGRAPHS = [LONG.strip(), "Short one.", "Ok.", LONG.strip()]


@pytest.mark.parametrize(
    "begin, end",
    [
        ("<article>", "</article>"),
        ("<main><article>", "</article></main>"),
        ("<div id=content><div>", "</div></div>"),
        ("<section><div class=post>", "</div></section>"),
    ],
)
def test_article_without_its_surroundings(begin, end):
    body = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    assert op.main_text(page(begin + body + end)) == "\n".join(PARAGRAPHS)


def test_parts_of_an_article_that_are_not_its_text():
    inside = (
        f"<article><header><h1>Head</h1></header><div class=post-header>Sub</div><p>{LONG}</p>"
        "<div class='share-buttons'>Share</div>"
        f"<div class=advert>{LONG}</div><ul><li>one<li>two</ul><footer>by me</footer></article>"
    )
    assert op.main_text(page(inside)) == f"Head\nSub\n{LONG.strip()}\none\ntwo"


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<article class='post comments-open'><p>{LONG}</p></article>", LONG.strip()),
        (f"<main class='no-sidebar'><p>{LONG}</p></main>", LONG.strip()),
        (f"<div class='content has-sidebar'><p>{LONG}</p></div>", LONG.strip()),
        (f"<form><div><p>{LONG}</p><p>{LONG}</p></div></form>", f"{LONG.strip()}\n{LONG.strip()}"),
        (
            f"<article><p>{LONG}</p><section id=discussion><h2 id=related-work>Work</h2>"
            "<p id=navy-blue>It is blue.</p></section><div class=share-buttons>no</div></article>",
            f"{LONG.strip()}\nWork\nIt is blue.",
        ),
        (
            f"<article><p>{LONG}</p></article><div id=comments><p>{LONG * 9}</p></div>",
            LONG.strip(),
        ),
    ],
)
def test_names_leave_out_no_text(html, text):
    assert op.main_text(html) == text


PLAIN = LONG.strip()


@pytest.mark.parametrize(
    "html, text",
    [
        # Reader comments, larger than the text, outside of any article.
        (
            f"<div class=post><p>{LONG}</p><p>{LONG}</p><p>Ok.</p></div>"
            f"<div id=comments>{f'<p>First! {LONG}</p>' * 10}</div>",
            f"{PLAIN}\n{PLAIN}\nOk.",
        ),
        # Inside an article, by a name of two words, and as articles of their own.
        (
            f"<article><p>{LONG}</p><div class=user-comments><p>Me too. {LONG * 3}</p></div></article>",
            PLAIN,
        ),
        (
            f"<main><p>{LONG}</p><article class=comment><p>{LONG * 3}</p></article></main>",
            PLAIN,
        ),
        # A notice that is longer than the text and comes first.
        (
            f"<div class=cookie-notice><p>{LONG * 5}</p></div><div><p>{LONG}</p><p>Ok.</p></div>",
            f"{PLAIN}\nOk.",
        ),
        # Adverts inside an article.
        (f"<article><p>{LONG}</p><p class=ad>Buy {LONG}</p><p>Ok.</p></article>", f"{PLAIN}\nOk."),
        (
            f"<article><p>{LONG}</p><div class=advert-box-300>{LONG}</div><p>Ok.</p></article>",
            f"{PLAIN}\nOk.",
        ),
        # Two articles of different length.
        (
            f"<article>{f'<p>{LONG}</p>' * 14}</article><article><p>{LONG}</p></article>",
            "\n".join([PLAIN] * 15),
        ),
        # What only says something about comments or adverts hides nothing.
        (f"<div class=no-ads><div class=has-comments><p>{LONG}</p></div></div><p>Ok.</p>", f"{PLAIN}\nOk."),
        # A page that has nothing else.
        (f"<div id=comments><p>{LONG}</p></div>", PLAIN),
        (f"<div class=sidebar><p>{LONG}</p></div><footer>f</footer>", PLAIN),
        # A form around an article, and one beside it.
        (f"<p>Skip</p><form><article><p>{LONG}</p></article></form>", PLAIN),
        (f"<div><p>{LONG}</p><p>Ok.</p></div><form><p>Name {LONG * 4}</p></form>", f"{PLAIN}\nOk."),
    ],
)
def test_names_decide_whatever_the_size(html, text):
    assert op.main_text(html) == text


@pytest.mark.parametrize("length", [1, 5, 30])
def test_headline_and_lead_before_an_inner_region(length):
    linked = "<p><a href=x>A paragraph that is one link</a></p>"
    body = f"<p>{LONG}</p>{linked}" + f"<p>{LONG}</p>" * length
    html = f"<div id=content><h1>Head</h1><p>The lead.</p><div class=body>{body}</div></div>"
    found = op.main_text(page(html)).split("\n")
    assert found[:4] == ["Head", "The lead.", LONG.strip(), "A paragraph that is one link"]
    assert len(found) == 4 + length


def test_deep_and_long_pages():
    deep = "<div>" * 3000 + "<p>deep text</p>" + "</div>" * 3000
    assert op.main_text(deep) == "deep text"
    assert op.main_text("<b>" * 50000 + "x" + "<hr>" * 50000 + "</p>" * 50000) == "x"
    many = "<article>" + "<p>word word</p>" * 20000 + "</article>"
    assert op.main_text(many).count("\n") == 19999


def test_smoothing_is_a_mean():
    import numpy as np

    assert np.allclose(op.smoothed(np.full(9, 5.0)), 5)
    peak = op.smoothed(np.eye(9)[4])
    assert peak.argmax() == 4 and np.allclose(peak, peak[::-1])


def test_rows(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, None, "")]
    df = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, text string")
    found = sorted((tuple(r) for r in op.extract_text(df).collect()), key=repr)
    assert found == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0), (2, None, "", 0)], key=repr)
    assert op.extract_text(df.limit(0)).collect() == []


def test_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    html = {r.page_id: r.html for r in df.collect()}
    for r in op.extract_text(df).collect():
        article = html[r.page_id].partition("<article>")[2].partition("</article>")[0]
        assert r.n_chars == len(r.text) and r.text
        assert all(line.split()[0] in unescape(article) for line in r.text.split("\n"))

import random
import re
from html import unescape

import pytest

from titleflow.llm import html_text as H

PROSE = ("A paragraph of the article with quite a few words in it, so that its text is dense. " * 4).strip()


def page(article, before="", after=""):
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
            f"<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>About</a></li></ul></nav>{before}{article}{after}"
            f"<footer>&copy; all the rest</footer></body></html>")


@pytest.mark.parametrize("junk", [
    '<div class="ad">Buy this now, it is very cheap and very good for you.</div>',
    '<div id="comments"><p>First! What a nice article this is, dear author.</p></div>',
    '<div class="cookie-notice">We use cookies to do things with your data.</div>',
    '<aside>Read more about other things in our other articles.</aside>',
    '<form><p>Sign up</p><input name=q><button>Go</button></form>',
    '<div role="navigation"><a href=x>one</a> <a href=y>two</a></div>',
    '<header><p>The paper of record since ever</p></header>',
    '<div hidden>never seen</div><div style="display: none">nor this</div>',
    '<script>document.write("<p>script</p>")</script><noscript>no script</noscript><!-- <p>comment</p> -->',
    '<section class="related-posts"><ul><li><a href=z>Another one</a></li></ul></section>',
])
def test_junk_is_left_out(junk):
    article = f"<article><h1>Head</h1><p>{PROSE}</p><p>{PROSE}</p></article>"
    want = "\n\n".join(["Head", PROSE, PROSE])
    assert H.extract(page(article, before=junk)) == want
    assert H.extract(page(article, after=junk)) == want
    plain = f"<div class='content'><h1>Head</h1><p>{PROSE}</p>{junk}<p>{PROSE}</p></div>"
    assert H.extract(page(plain)) == want


def test_blocks_blanks_and_references():
    got = H.extract(page("<article><p>a &amp; b&nbsp;&lt;c&gt; &#233;&#x41;\n\n d<br>e</p><ul><li>x<li>y</ul>"
                         "<table><tr><td>1<td>2</table> tail <b>bold</b>er</article>"))
    assert got == "a & b <c> éA d e\n\nx\n\ny\n\n1\n\n2\n\ntail bolder"


@pytest.mark.parametrize(("broken", "want"), [
    (None, ""), ("", ""), ("   ", ""), ("<html></html>", ""), ("just text", "just text"),
    ("<p>open <b>tags", "open tags"), ("</div></p>stray<p>x", "stray\n\nx"), ("<", "<"), ("a < b", "a < b"),
    ("<p title='>'>q</p>", "q"), ("<!-- never closed <p>x</p>", ""), ("<script>never closed", ""),
    ("<p>cut &am", "cut &am"), ("<p class=\"never closed>x", ""), ("<article><p>x</article", "x"),
])
def test_broken_pages(broken, want):
    assert H.extract(broken) == want


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + "deep text" + "</div>" * 20_000
    assert H.extract(deep) == "deep text"
    long = page("<article>" + f"<p>{PROSE}</p>" * 3000 + "</article>")
    assert H.extract(long) == "\n\n".join([PROSE] * 3000)


def test_random_templates():
    """Articles of the pages' shape, cut off anywhere, against patterns."""
    r = random.Random(8)
    for _ in range(150):
        word = lambda: "".join(r.choice("abcé&;") for _ in range(r.randint(1, 8))).replace("&", "&amp;")
        text = lambda: " ".join(word() for _ in range(r.randint(1, 60)))
        parts = "".join(f"<p>{'<b>' if r.random() < 0.3 else ''}{text()}{r.choice(['</p>', '<br>', '</p>'])}"
                        for _ in range(r.randint(1, 9)))
        html = page(f"<article><h1>{text()}</h1>{parts}</article>", before=f'<div class="ad">{text()}</div>')
        body = re.search("<article>(.*?)</article>", html, re.S)[1]
        blocks = re.split(r"</?(?:h1|p)>", re.sub("<br>", " ", re.sub("</?b>", "", body)))
        want = [" ".join(unescape(b).split()) for b in blocks]
        assert H.extract(html) == "\n\n".join(b for b in want if b)


def test_pages_table(spark):
    rows = [(1, "u", page(f"<article><p>{PROSE}</p></article>"), "x"), (2, None, None, "x"), (3, "w", "", "x"),
            (3, "w", "", "x"), (None, "z", "<p>é€</p>", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in H.extract_pages(pages).collect()), key=str)
    assert got == sorted([(1, "u", PROSE, len(PROSE)), (2, None, "", 0), (3, "w", "", 0), (3, "w", "", 0),
                          (None, "z", "é€", 2)], key=str)
    assert H.extract_pages(pages.limit(0)).count() == 0


@pytest.mark.parametrize("lengths", [(250, 250), (250, 240), (240, 250), (250, 250, 250)])
def test_all_sections_of_an_article_without_article_or_main(lengths):
    texts = [[f"{i}{j}" + "abcd " * (n // 4) for j in range(5)] for i, n in enumerate(lengths)]
    sections = "".join(f"<div>{''.join(f'<p>{t}</p>' for t in own)}</div>" for own in texts)
    want = "\n\n".join(t.strip() for own in texts for t in own)
    assert H.extract(page(f'<div class="content">{sections}</div>')) == want
    if len(set(lengths)) == 1:  # under the body itself a section must reach the body's density
        assert H.extract(page(sections)) == want


@pytest.mark.parametrize("names", ["content has-sidebar", "layout with-sidebar", "post no-comments", "entry has-header",
                                   "sidebar-layout", "page-header-wrap"])
def test_layout_classes_keep_the_article(names):
    junk = '<div class="sidebar"><p>Other things that stand beside.</p></div>'
    article = f"<div class='{names}'><h1>Head</h1><p>{PROSE}</p>{junk}<p>{PROSE}</p></div>"
    assert H.extract(page(article, after=junk)) == "\n\n".join(["Head", PROSE, PROSE])


def test_long_comments_beside_an_article_are_left_out():
    comments = f"<div id='comments'>{f'<p>{PROSE}</p>' * 5}</div>"
    assert H.extract(page(f"<article><p>{PROSE}</p></article>", after=comments)) == PROSE

import html as chars
import re
from pathlib import Path

import pytest

from tendril.llm.html_text import extract_main_text, main_text

GIVEN = "/root/testdata/sf0.001/pages.parquet"


def test_article_without_the_rest():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
    <header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies on this site, please accept all of them now.</div>
    <article><h1>Head&amp;line</h1><p>The first   paragraph of the
    text is <b>bold</b> and has a <a href="x">link</a> in it, as it should be.</p><p>Short.</p><div class="ad">Buy the thing that is on sale in the shop.</div>
    <p>AT&amp;T &lt;tag&gt; &eacute;&#233;&nbsp;x<br>y</p><form><p>Sign up for the letter of the week.</p></form></article>
    <aside><p>The most read of all the stories in the paper today.</p></aside><section id="comments"><article class="comment"><p>I think that this is the best of all the texts I have read.</p></article></section>
    <footer>&copy; the owners of the site and of all that is in it.</footer></body></html>"""
    assert main_text(page) == "Head&line\n\nThe first paragraph of the text is bold and has a link in it, as it should be.\n\nShort.\n\nAT&T <tag> éé x y"


def test_broken_markup():
    assert main_text("<article><p>One sentence of the text, not closed<p>And another of the same kind") == "One sentence of the text, not closed\n\nAnd another of the same kind"
    assert main_text("<p>Cut in the middle of a tag, as it is. <a hre") == "Cut in the middle of a tag, as it is."
    assert main_text("<!-- never closed <p>x</p>") == "" and main_text("<script>x") == "" and main_text(None) == "" and main_text("") == ""
    assert main_text('<div class="ad">open ad<article><p>The text of the page.</p></article>') == "The text of the page."


def test_without_an_article_rules_decide():
    page = "<div><a href=a>One</a> <a href=b>Two</a></div><p>" + "It is one of the things that we have to say in the text of this page. " * 4 + "</p><p>And so.</p>"
    out = main_text(page)
    assert out.startswith("It is one") and out.endswith("\n\nAnd so.") and "Two" not in out


def test_names_of_containers():
    inner = '<div class="post-header"><h1>The head</h1></div><p>The text of the page as it should be read.</p><div class="article-footer share">Share it with all of the others.</div>'
    want = "The head\n\nThe text of the page as it should be read."
    assert main_text(f'<div class="page with-sidebar no-comments"><article class="post">{inner}</article><article class="related teaser"><p>Another one of the stories that are on the site.</p></article></div>') == want
    assert main_text('<div class="has-sidebar"><p>It is the text of the page, and it is as long as it has to be to count.</p></div><div id="sidebar"><p>It is what stands at the side of the page, and it is of no use to us.</p></div>').startswith("It is the text") 


def test_many_blocks_are_linear():
    assert main_text("<article>" + "<p>a</p>" * 20000 + "<div>" * 20000).count("\n\n") == 19999


def test_frame(spark):
    rows = [(1, "u", "<p>Ä text of the day, it is.</p>", 5), (2, None, None, 5), (2, None, None, 5), (None, "v", "", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    out = extract_main_text(df).collect()
    assert len(out) == 4 and {r.n_chars for r in out} == {0, 25} and all(len(r.text) == r.n_chars for r in out)
    assert extract_main_text(df.limit(0)).count() == 0


def test_quotes_open_values_after_an_equals_sign_only():
    rest = "</p><p>And it's here, the second text of the day that we have.</p><p>It is the third, and the last of the texts that we have.</p>"
    want = "One text of the day, it is what we have to say of it.\n\nAnd it's here, the second text of the day that we have.\n\nIt is the third, and the last of the texts that we have."
    for tag in ("<p title=don't>", "<p don't>", "<p title = 'a > b'>", '<p title="it\'s > b" x>', "<p a=b=c' d>"):
        assert main_text(tag + "One text of the day, it is what we have to say of it." + rest) == want


def test_which_article():
    text = "It is one of the things that we have to say in the text of this page, and so it is. "
    body = f"<div><p>{text * 4}</p><p>{text * 5}</p></div>"
    card = "<article><p>A card that is about another of the pages that we have on this site.</p></article>"
    assert main_text(body + card) == f"{text * 4}".strip() + "\n\n" + f"{text * 5}".strip()
    posts = f"<article><p>First. {text * 4}</p></article><article><p>Second. {text * 3}</p></article>"
    assert main_text(posts + card).count("\n\n") == 1 and "card" not in main_text(posts + card)
    assert main_text(f"<p>{text}</p><article><p>{text * 2}</p></article>") == (text * 2).strip()


LINE = "It is one of the things that we have to say in the text of this page, and so it is. "


def test_pages_in_other_languages():
    first = "日本の首都は東京であり、人口は約千四百万人である。政治と経済の中心であり、多くの企業が本社を置いている。歴史は江戸時代にさかのぼる。"
    second = "短い文である。"
    assert main_text(f"<div><p>{first}</p><p>{second}</p><ul><li><a href=a>東京</a></li><li><a href=b>大阪</a></li></ul></div>") == f"{first}\n\n{second}"
    russian = "Столица страны стоит на реке, и в ней живёт много людей, которые приехали сюда из других мест."
    assert main_text(f"<nav><a href=a>Новости</a></nav><p>{russian}</p>") == russian


def test_names_that_may_say_something_else():
    long = (LINE * 3).strip()
    assert main_text(f'<div id="form-of-government"><p>{long}</p><p>And so.</p></div>') == f"{long}\n\nAnd so."
    assert main_text(f'<article><p>{long}</p><div class="promotion-rules"><p>{long}</p></div></article>') == f"{long}\n\n{long}"
    for name in ("promotion-box", "user-reviews", "reader-comments", "comments-thread", "legal-notice", "footer-widgets-3", "promotion-summer"):
        inner = "It is what is for sale in the shop of the site." if name == "promotion-summer" else long
        assert main_text(f'<article><p>{long}</p><div class="{name}"><p>{inner}</p></div></article>') == long, name


def test_links_in_an_article_go_by_their_neighbours():
    long = (LINE * 3).strip()
    linked = "<p><a href=x>One of the papers that we have on it, as a whole</a>.</p>"
    links = "<ul>" + "".join(f"<li><a href=x>Another of the stories of the day, number {k}</a></li>" for k in range(3)) + "</ul>"
    page = f"<article><p>{long}</p>{linked}<p>{long}</p>{links}<p><a href=y>Read more</a></p><p><a href=a>Share it with all</a> <a href=b>Send it to one of them</a></p></article>"
    assert main_text(page) == f"{long}\n\nOne of the papers that we have on it, as a whole.\n\n{long}"


@pytest.mark.skipif(not Path(GIVEN).exists(), reason="the given tables aren't here")
def test_kept_blocks_are_the_pages_own_in_order(spark):
    for r in spark.read.parquet(GIVEN).collect():
        page = "".join(re.sub("<[^>]*>", " ", chars.unescape(re.sub(r"(?is)<(script|style|title)\b.*?</\1>|<!--.*?-->", " ", r.html or ""))).split())
        at = 0
        for block in main_text(r.html).split("\n\n"):
            found = page.find("".join(re.sub("<[^>]*>", " ", block).split()), at)
            assert found >= 0, (r.page_id, block)
            at = found + len("".join(block.split()))

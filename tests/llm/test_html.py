import re
from html import unescape

import pytest

from marketframe.llm import html_extraction as H

from .conftest import clashing

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>if (a < b) "</p>"</script></head><body class="page">
<header>Site</header><nav><ul><li><a href="/a">Menu {0}</a></li></ul></nav><div class="cookie-notice">We use cookies {0}</div>
<aside>Side {0}</aside><main><article><h1>Title {0} &amp; more</h1><p>First <b>bold</b>&nbsp;text<br>of {0}.<p>Second &lt;one&gt; {0}
<ul><li>item {0}<li>other</ul><div class="share">Share this</div><form>Sign up <input value="x"></form></article></main>
<section class="comments"><p>A reader says {0}</p></section><!-- a > b --><footer>&copy; {0}</footer></body></html>"""
WANT = "Title {0} & more\nFirst bold text of {0}.\nSecond <one> {0}\nitem {0}\nother"


def run(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in H.main_text(clashing(df)).collect()}


def test_article_without_the_rest(spark):
    pages = [(i, f"https://Site.example/{i}", PAGE.format(i)) for i in range(5)]
    assert run(spark, pages) == {i: WANT.format(i) for i in range(5)}


def test_odd_pages(spark):
    pages = [(1, None, None), (2, "", ""), (3, "http://a/x", "<"), (4, "http://a/y", "plain text"), (5, "http://b/", "<article>" + "<div>" * 300 + "deep" + "</div>" * 100), (6, "http://c/", "<article><p>" + "word " * 50_000), (7, "http://d", "<article>a &notanentity; &#65;&#x42 </p></b>c<p>d"), (None, "http://d", "<article>x</article>")]
    got = run(spark, pages)
    assert got[1] == got[2] == "" and got[5] == "deep" and got[6] == ("word " * 50_000).strip() and got[None] == "x"
    assert got[4] == "plain text" and got[7] == "a ¬anentity; AB c\nd"


def test_pages_without_an_article(spark):
    page = "<body><div id='top{0}'>Home <a href=/>x</a></div><div class='text'><p>" + "Body text {0} goes on. " * 9 + "</p><p>More {0}.</p></div><div>Imprint</div></body>"
    got = run(spark, [(i, "http://e.org/p", page.format(i)) for i in range(4)])
    assert got[2] == ("Body text 2 goes on. " * 9).strip() + "\nMore 2."


def test_hosts_with_two_templates(spark):
    """Each page's own slots decide, however many pages have the other template, with and without articles."""
    menu = "<div id='top'>Home of all that this site has to offer its readers, day by day</div>"
    one = "<body>" + menu + "<article><p>Story {0}</p></article></body>"
    two = "<body>" + menu + "<div class='content'><p>" + "Other layout {0} here. " * 5 + "</p><p>End {0}.</p></div><div class='footer'>Imprint</div></body>"
    three = "<body>" + menu + "<div class='text'><p>" + "Third layout {0} goes on. " * 20 + "</p></div></body>"
    pages, want = [], {}
    story, other, third = "Story {0}", ("Other layout {0} here. " * 5).strip() + "\nEnd {0}.", ("Third layout {0} goes on. " * 20).strip()
    for host, parts in {"mixed": ((one, story, 30), (two, other, 3)), "few": ((one, story, 1), (two, other, 30)), "plain": ((three, third, 40), (two, other, 2))}.items():
        for html, text, n in parts:
            for _ in range(n):
                i = len(pages)
                pages.append((i, f"http://{host}.org/{i}", html.format(i)))
                want[i] = text.format(i)
    assert run(spark, pages) == want


def test_template_inside_the_article(spark):
    """What stands unchanged in nearly all of many differing pages of a host is template; on a host of copies nothing is."""
    page = "<article><h2>Our series</h2><p>Text {0}</p></article>"
    got = run(spark, [(i, "http://many.org/", page.format(i)) for i in range(20)] + [(100 + i, "http://same.org/", page.format(0)) for i in range(20)])
    assert got[3] == "Text 3" and got[103] == "Our series\nText 0"


def test_matching_is_the_largest():
    def tree(text):
        label, inner = re.fullmatch(r"(\w+)(?:\((.*)\))?", text).groups()
        slot, depth, part = H.Slot(label), 0, ""
        for c in (inner + ",") if inner else "":
            depth += (c == "(") - (c == ")")
            if c == "," and not depth:
                slot.children.append(tree(part))
                part = ""
            else:
                part += c
        return slot

    a, b = tree("r(a(x,y),b,c(z),a(x))"), tree("r(b,a(x,y),c,a(y,x))")
    assert H.matching(a.children, b.children)[0] == 6
    assert H.matching(a.children, a.children)[0] == 8 and H.matching([], b.children)[0] == 0


def test_wrappers_don_t_depend_on_the_order_of_equal_pages(spark, monkeypatch):
    monkeypatch.setattr(H, "MERGED", 2)
    df = spark.createDataFrame([(i, "http://h.org/", PAGE.format(i)) for i in range(40)], "page_id long, url string, html string").repartition(20)
    found = H.wrappers(df, "url", "html").collect()
    assert len(found) == 1 and H.json.loads(found[0]["wrapper"])[1] == 40


@pytest.mark.parametrize("scale", ["sf0.001"])
def test_driver_pages(spark, scale):
    df = spark.read.parquet(f"/root/testdata/{scale}/pages.parquet")
    got = {r["page_id"]: r for r in H.main_text(df).collect()}
    for r in df.collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.DOTALL)[1]
        parts = [" ".join(unescape(re.sub("<[^>]*>", " " if "<br>" in b else "", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert got[r["page_id"]]["text"] == "\n".join(filter(None, parts))
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def test_empty_table(spark):
    assert H.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0

"""Main texts of pages whose article is known, and the scan against all runs."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter

from plumbline.llm import html_extract
from plumbline.llm.html_extract import PRIOR, best_run, main_text


def test_scan_equals_all_runs():
    random.seed(8)
    for _ in range(300):
        scores = [random.randint(-4, 4) for _ in range(random.randint(0, 9))]
        sums = [sum(scores[a:b]) for a, b in itertools.combinations(range(len(scores) + 1), 2)]
        begin, end = best_run(scores)
        assert sum(scores[begin:end]) == max([0, *sums])


ARTICLE = "<h1>A  title &amp; more</h1><p>First <b>bold</b> paragraph\n of the&nbsp;text.<br><p>Second one, <a href='x'>with a link</a>.</p>"
TEXT = "A title & more\nFirst bold paragraph of the text.\nSecond one, with a link."
NAV = "<nav><ul><li><a href='/a'>Home of all</a></li><li><a>News and so on</a></li></ul></nav>"


def page(body, head="<title>t</title><style>p{}</style><script>var t='</p>';</script>"):
    return f"<!DOCTYPE html><html lang='en'><head>{head}</head><body>{body}</body></html>"


def test_known_pages():
    foot = "<footer>&copy; site &middot; words of the site owner</footer>"
    ad = "<!-- <p>no</p> --><div class='ad'>Buy many things here today please</div>"
    thread = "<section id='comments'><p>Great article, I liked all of it and more than that</p></section>"
    form = "<form><label>Your mail</label><p>Write us and we will answer soon enough</p><textarea>x</textarea></form>"
    for body in (
        NAV + ad + f"<article>{ARTICLE}</article>" + foot,
        f"<header>Site name and claim</header>{NAV}<main>{ARTICLE}{thread}</main>{foot}",
        f"{ad}<div class='story'>{ARTICLE}</div><aside>Other stories that you may like</aside>{foot}",
        f"<div role='navigation'><p>A menu of many words to choose from</p></div><article>{ARTICLE}{form}</article>{thread}",
        f"<nav><ul><li>never closed<article>{ARTICLE}</article>{foot}",
        f"<p>Words before the article</p><ARTICLE CLASS='comments-on'>{ARTICLE}</ARTICLE>",
    ):
        assert main_text(page(body), PRIOR) == TEXT, body
    middle = ARTICLE.replace("<p>Second", ad + "<aside>Many other words of another kind in the middle</aside><p>Second")
    assert main_text(page(f"<article>{middle}</article>"), PRIOR) == TEXT
    assert main_text("", PRIOR) == main_text("<p></p>", PRIOR) == main_text(page(NAV), PRIOR) == ""
    assert main_text("plain words < 3 only & nothing", PRIOR) == "plain words < 3 only & nothing"
    assert main_text("<p>one</p><script>never ends <p>two</p>", PRIOR) == "one"
    assert main_text("<p title='a>b'>one &#233;&lt;b&gt;</p><p>two", PRIOR) == "one é<b>\ntwo"


def test_names_of_wrappers():
    foot = "<div class='site-footer footer'>Words of the site owner</div>"
    for name in ("content with-sidebar", "post no-comments", "skip-lazy"):
        side = "<div class='sidebar'><h2>More of it</h2><p>Other stories that you may like</p></div>"
        thread = "<div id='comments'><h2>What readers say</h2>" + "<p>Great article, I liked all of it and more than that</p>" * 20 + "</div>"
        assert main_text(page(f"<div class='header'><h1>Site name</h1></div><div class='{name}'>{ARTICLE}{side}</div>{thread}{foot}"), PRIOR) == TEXT, name
        assert main_text(page(f"{NAV}<div class='{name}'><article>{ARTICLE}</article></div>{foot}"), PRIOR) == TEXT, name
    assert main_text(page(f"<div class='header'><h1>Site name</h1></div><div>{ARTICLE}</div>{foot}"), PRIOR) == TEXT


def test_pages_that_mark_no_article(spark):
    """The sample's pages with their article in a plain element: words, tags and learned names must find it."""
    rows = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, html string")
    weights = html_extract.learn_weights(pages)
    bare = [re.sub(r"<(/?)(?:article|main)\b[^>]*>", r"<\1div>", r) for r in rows]
    kept = lost = more = 0
    for whole, cut in zip(rows, bare, strict=True):
        want, got = (Counter(main_text(x, weights).split()) for x in (whole, cut))
        kept, lost, more = kept + (want & got).total(), lost + (want - got).total(), more + (got - want).total()
    assert lost <= 0.02 * (kept + lost) and more <= 0.05 * (kept + more), (kept, lost, more)


def test_whole_table(spark):
    rows = [(i, f"u{i}", page(NAV + f"<article>{ARTICLE}<p>{'word ' * i}</p></article>")) for i in range(60)]
    rows += [(None, None, None), (1, "u", ""), (2, "long", "<article>" + "<p>many words</p>" * 50_000 + "</article>"), (3, "open", "<a \"" * 20_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string").repartition(3)
    weights = html_extract.learn_weights(pages)
    got = {(r["page_id"], r["url"]): r for r in html_extract.extract(pages, weights).collect()}
    assert len(got) == len(rows)
    for i in range(60):
        want = TEXT + ("\n" + " ".join(["word"] * i) if i else "")
        assert got[i, f"u{i}"]["text"] == want and got[i, f"u{i}"]["n_chars"] == len(want)
    assert got[None, None]["text"] == got[1, "u"]["text"] == ""
    assert got[2, "long"]["text"].count("\n") == 49_999
    empty = pages.limit(0)
    assert html_extract.extract(empty, html_extract.learn_weights(empty)).collect() == []

import html
import re

import pytest

from wxmesh.llm import html_text
from wxmesh.llm.common import table

ARTICLE = ("It was the best of times and it was the worst of times, and this is the text of the page that you are reading now. ",
           "Another long paragraph of the article, which is about the history of the town and of the people who lived there.")


def test_whole_article_of_every_page(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r["page_id"]: r for r in html_text.extract(pages).collect()}
    for p in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        inner = re.sub(r"<[a-z/][^>]*>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))
        want = " ".join(html.unescape(inner).split())
        r = got[p["page_id"]]
        assert (r["text"], r["n_chars"], r["url"]) == (want, len(want), p["url"])


@pytest.mark.parametrize("furniture", [
    "<nav><ul><li><a href=a>Home</a><li><a href=b>News of the day and the week</a></ul></nav>",
    "<header><p>The site of the town and of the people that it was made for and by.</p></header>",
    "<div class='sidebar left'><p>More of the same that you may like to read in the days to come, and others.</p></div>",
    "<aside>The offer that is for you and for all of the others who are in the town today.</aside>",
    "<div id=cookie-consent>We use cookies on this site, and with them we know what you are here for.</div>",
    "<div class='ad-slot top'>Buy the best of the shoes that we have for you and for all of the others.</div>",
    "<form><label>The name of the person that you are</label><select><option>of the</select><button>Go</button></form>",
    "<section id=comments><article class=comment><p>I think that the author is wrong in this, and it was not so.</p></article></section>",
    "<footer><p>All of the rights to the text are with the owners of the site and of the town.</p></footer>",
    "<script>var x = '<p>the text of the script that is not for you</p>';</script><style>p { the: of }</style>",
    "<!-- <p>the text of the comment that is not for you</p> --><noscript><p>the page is best with scripts on</p></noscript>",
    "<div hidden><p>the text that is hidden from you and from all of the others in the town</p></div>",
    "<div style='display: none'><p>the text that is hidden from you and from all of the others in the town</p></div>",
])
@pytest.mark.parametrize("shell", [
    "<html><body class='has-sidebar'>{f}<article><h1>A title</h1><p>{a}</p><p>Yes.</p><p>{b}</p></article></body></html>",
    "<body><div class=wrap><div class=text-column><h1>A title</h1><p>{a}<p>Yes.<p>{b}</div></div>{f}</body>",
])
def test_furniture_goes(furniture, shell):
    page = shell.format(f=furniture, a=ARTICLE[0], b=ARTICLE[1])
    assert html_text.main_text(page) == f"A title {ARTICLE[0].strip()} Yes. {ARTICLE[1]}"


def test_furniture_inside_the_article_goes():
    page = (f"<article><header><h1>T</h1></header><p>{ARTICLE[0]}</p><div class=ad>of the and to in</div>"
            f"<div class=share-buttons><a href=x>Tell</a></div><p>End.</p><footer>by the author</footer></article>")
    assert html_text.main_text(page) == f"T {ARTICLE[0].strip()} End."


def test_open_blocks_follow_their_neighbours():
    page = (f"<div><a href=a>One</a> <a href=b>Two</a></div><div>Short</div><div>{ARTICLE[0]}</div><div>Brief</div><div>{ARTICLE[1]}</div>"
            "<div>Also</div><div><a href=c>Three</a></div><div><a href=d>Four</a></div><div>Small print</div><div><a href=e>Five</a></div>")
    assert html_text.main_text(page) == f"{ARTICLE[0].strip()} Brief {ARTICLE[1]}"


def test_references_white_space_and_broken_markup():
    assert html_text.main_text("<p>a&nbsp;b &lt;i&gt;\n\t &#8364;&#x41;&amp;amp; 3 < 4 <b>bo</b>ld</p>") == "a b <i> €A&amp; 3 < 4 bold"
    assert html_text.main_text("just text") == "just text"
    assert html_text.main_text("<p>cut off <a href='x") == "cut off"
    assert html_text.main_text("<p>x<!-- never closed <p>y") == "x"
    assert html_text.main_text("<script>never closed <p>y") == ""
    assert html_text.main_text("<form action=x><div><main><p>Hi there</p></main></div></form>") == "Hi there"


def test_awkward_and_empty(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<p>text</p>"), (3, "u", "<p>twice</p>"), (3, "u", "<p>twice</p>"),
            (4, "u", "<div>" * 3000 + "deep" + "</div>" * 3000), (5, "u", "<p>" + "long and the of " * 50_000 + "</p>")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = html_text.extract(pages).collect()
    by = sorted((r["page_id"] or 0, r["text"][:5], r["n_chars"]) for r in got)
    assert by == [(0, "text", 4), (1, "", 0), (2, "", 0), (3, "twice", 5), (3, "twice", 5), (4, "deep", 4), (5, "long ", 50_000 * 16 - 1)]
    assert html_text.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("wrapper", ["<div class='legal-news'>", "<section class='social-science'>", "<div class='form-factor'><article>",
                                     "<div id='banner-ads-analysis'>", "<div class='sidebar'>", "<form><div>", "<aside>"])
def test_no_name_empties_a_page(wrapper):
    nav = "<ul><li><a href=a>Home</a><li><a href=b>News</a></ul>"
    assert html_text.main_text(f"{nav}{wrapper}<h2>On it</h2><p>{ARTICLE[0]}</p><p>Yes.</p><p>{ARTICLE[1]}</p>").endswith(
        f"{ARTICLE[0].strip()} Yes. {ARTICLE[1]}")


def neutral(page):
    """The page with every name gone: each block element a plain ``div``."""
    page = re.sub(r' (?:class|id|role)="[^"]*"', "", page)
    return re.sub(r"<(/?)(?:nav|article|footer|ul|li|p|h1)\b", r"<\1div", page)


def test_pages_without_names_go_by_their_text(spark):
    """Only density, length, links and neighbours are left to decide."""
    from collections import Counter

    total = lost = added = 0
    for p in table(spark, "/root/testdata/sf0.01", "pages").collect():
        want, got = Counter(html_text.main_text(p["html"]).split()), Counter(html_text.main_text(neutral(p["html"])).split())
        total, lost, added = total + want.total(), lost + (want - got).total(), added + (got - want).total()
    assert lost < 0.005 * total and added < 0.005 * total


@pytest.mark.parametrize("tag", ["b", "div", "p", "center", "span class=x", "section class=ad"])
def test_a_megabyte_of_nested_tags_takes_no_longer_than_flat_ones(tag):
    import time

    n = 1_000_000 // (len(tag) + 2)
    begun = time.process_time()
    assert html_text.main_text(f"<{tag}>" * n + "deep") in ("deep", "")
    assert html_text.main_text(f"<{tag}>" * (n // 2) + "deep" + f"</{tag.split()[0]}>" * (n // 2)) in ("deep", "")
    assert time.process_time() - begun < 20  # two pages; a scan of the open tags at each tag would take hours


def test_labels_by_the_plain_rules():
    """Both passes written out once more, block by block, on pages of every mixture of blocks."""
    import random

    rng = random.Random(8)
    kinds = [("nav link", 8), (ARTICLE[0].strip(), 0), ("Brief note.", 0), ("Label", 0), ("the of " * 40, 200), ("© owner", 0), ("zq " * 90, 0)]
    for _ in range(400):
        made = [html_text.Block(*rng.choice(kinds), rng.choice([1, -1, 0, 0, 0]), rng.random() < 0.2) for _ in range(rng.randrange(1, 12))]
        for b in made:
            b.text = b.text.strip()
        plain = []
        for b in made:
            n, words = len(b.text), re.findall(r"[^\W\d_]+", b.text.lower())
            share, stops = b.linked / n, sum(w in html_text.STOP_WORDS for w in words) / max(1, len(words))
            plain.append(-1 if b.text[0] == "©" or share > 0.5 or share > 0.2 and n < 120
                         else 1 if share <= 0.2 and (n >= 70 and stops >= 0.2 or n >= 200 and stops >= 0.1) else 0)
        elsewhere = any(b.where == 1 and x >= 0 or b.where == 0 and x == 1 for b, x in zip(made, plain))
        misnamed = not elsewhere and any(b.where == -1 and x == 1 for b, x in zip(made, plain))
        first = []
        for b, x in zip(made, plain):
            if b.where == -1:
                first.append(x if misnamed else -1)
            elif b.where == 1 and b.text[0] != "©":
                first.append(-1 if b.linked > 0.8 * len(b.text) and len(b.text) < 80 else 1)
            else:
                first.append(x)
        assert html_text.decide(made) == first
        second = []
        for k, x in enumerate(first):
            if x == 0:
                left = [(k - j, first[j]) for j in range(k) if first[j]][-1:]
                right = [(j - k, first[j]) for j in range(k + 1, len(first)) if first[j]][:1]
                if left and right and left[0][1] != right[0][1]:
                    sentence = not made[k].linked and len(made[k].text.split()) > 1 and made[k].text.endswith(".")
                    x = (1 if left[0][1] == 1 and sentence else left[0][1] if left[0][0] < right[0][0] else right[0][1]
                         if right[0][0] < left[0][0] or made[k].heading else -1)
                else:
                    x = (left or right or [(0, 1)])[0][1]
            second.append(x)
        assert html_text.inherit(made, first) == second

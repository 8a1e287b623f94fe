import itertools
import random

import numpy as np

from visitlens.llm import html_text as H


def test_min_cut_is_minimal():
    rng = random.Random(2)
    for _ in range(120):
        n = rng.randrange(1, 8)
        source = [float(rng.randrange(6)) for _ in range(n)]
        sink = [float(rng.randrange(6)) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), float(rng.randrange(4))) for _ in range(rng.randrange(10))]
        edges = [e for e in edges if e[0] != e[1]]

        def cost(side):
            return (sum(t if s else f for s, f, t in zip(side, source, sink))
                    + sum(c for a, b, c in edges if side[a] != side[b]))

        best = min(cost(side) for side in itertools.product([True, False], repeat=n))
        assert cost(H.min_cut(source, sink, edges)) == best


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body>
<nav><ul><li><a href=1>Home</a><li><a href=2>More</a></ul></nav><!-- <p>not this</p> -->
<div class="ad">Buy now, it is a very long advert with many words in it.</div>
<article><header><h1>T&eacute;st &amp; title</h1><span class=byline>By someone</span></header>
<p>First   paragraph &copy; 2020,
 with <b>bold and <a href="x>y">a link</a>.<p>Second.</p><form><p>Your mail?</p><input></form>
<script>if (a < b) document.write("</p><p>no</p>");</script><ul><li>item one<li>item two</ul>
<div hidden>secret</div></article><div class="comments"><p>Reader says that this is a long comment, really.</p></div>
<aside><p>Related things.</p></aside><footer>All rights reserved.</footer></body></html>"""


def test_page():
    assert H.main_text(PAGE, H.START) == (
        "Tést & title\nFirst paragraph © 2020, with bold and a link.\nSecond.\nitem one\nitem two")


def test_page_without_article():
    text = H.main_text(
        '<div id=header>Site</div><div class="menu"><a href=x>Home</a> <a href=y>News</a></div><div><h2>Head</h2>'
        "<p>This is a long paragraph of the text, with many words.</p><p>Short.</p><p>Another long one stands here, and it "
        "goes on.</p></div><div class=cookie-notice>We use cookies.</div><div class=sidebar><p>Side, words.</p></div>", H.START)
    assert text == ("Head\nThis is a long paragraph of the text, with many words.\nShort.\n"
                    "Another long one stands here, and it goes on.")


LONG = "This is a long paragraph of the text, with many words, and it goes on."


def test_unmarked_article_beside_a_marked_teaser():
    for word in ("text", "body", "post", "entry", "page", "story", "content"):
        page = (f"<div><h2>Head</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>"
                f"<div><span class={word}>More</span><div class={word}>Read this next.</div></div>"
                "<div><a href=x>Home</a> <a href=y>News</a></div>")
        text = H.main_text(page, H.START)
        assert text.startswith(f"Head\n{LONG}\nShort.\n{LONG}"), word
        assert "Home" not in text


def test_ids_made_from_headings():
    for name in ("related-work", "comments", "search", "legal-notice", "share-and-reply"):
        for a, z in (("<article>", "</article>"), ("<div>", "</div>")):
            page = (f"{a}<p>{LONG}</p><h2 id={name}>What others did</h2><p>{LONG}</p>"
                    f"<section id={name}><h2>More of it</h2><p>{LONG}</p></section>{z}")
            assert H.main_text(page, H.START) == f"{LONG}\nWhat others did\n{LONG}\nMore of it\n{LONG}", (name, a)


def test_classifier_and_cut_decide_on_marked_pages():
    page = H.blocks(f"<article><p>{LONG}</p></article><div class=promo><p>{LONG}</p></div><div><p>{LONG}</p></div>")
    assert [b.state for b in page] == [1, -1, 0]
    for score, kept in ((-11, [False] * 3), (-4, [True, False, False]), (4, [True, False, True]), (11, [True] * 3)):
        weights = np.zeros(len(H.START))
        weights[0] = score
        assert H.label(page, weights) == kept, score
    # A block that the classifier leaves open goes with its neighbours.
    row = H.blocks(f"<article><p>{LONG}</p></article><div class=x>Aye</div><article><p>{LONG}</p></article>")
    weights = np.zeros(len(H.START))
    weights[0] = -0.2
    assert H.label(row, weights) == [True] * 3


def test_broken_pages():
    for page, text in ((None, ""), ("", ""), ("<article><", "<"), ("<article><p>cut &am", "cut &am"),
                       ("<article><p>cut <b", "cut"), ("<article><p>x<!-- open", "x"), ("<script>never", ""),
                       ("</p></div></article>", ""), ("<article>" + "<div>" * 3000 + "deep", "deep")):
        assert H.main_text(page, H.START) == text, page
    long = "<article>" + "<p>word, and word.</p>" * 3000 + "</article><footer>end</footer>"
    assert H.main_text(long, H.START).count("\n") == 2999


def test_training_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 12))
    y = (x[:, 2] > 0).astype(float)
    w = H.train(x, y)
    assert (((x @ w) > 0) == (y > 0)).mean() > 0.9
    assert (H.train(x, np.ones(400)) == H.START).all()


def test_query_columns(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extract(pages, H.fit(pages)).orderBy("page_id").collect()
    assert [r.text for r in got] == ["", *[H.main_text(PAGE, H.START)] * 2]
    none = pages.where("1 = 0")
    assert H.extract(none, H.fit(none)).count() == 0


def test_against_plain_reading(spark):
    """The pages of the given table have one article each."""
    import html
    import re

    from cases import SF_SMALL
    from visitlens.llm.queries import op1_html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    for r in op1_html(spark, SF_SMALL).collect():
        body = re.search(r"(?s)<article>(.*?)(</article>|$)", pages[r.page_id])[1]
        body = re.sub(r"<[^>]*>", "", re.sub(r"<(/?(p|br|h1)\b)[^>]*>", "\0", body))
        lines = [" ".join(html.unescape(x).split()) for x in body.split("\0")]
        assert r.text == "\n".join(x for x in lines if x)
        assert r.n_chars == len(r.text)


def trained(spark):
    from cases import SF_SMALL
    return H.fit(spark.read.parquet(f"{SF_SMALL}/pages.parquet"))


def by_sign(page, weights):
    """What the terminal capacities alone say."""
    found = H.blocks(page)
    score = np.clip(H.features(found) @ weights[:len(H.START)], -H.SCORE, H.SCORE)
    said = [(H.ARTICLE_SAID if b.strong else H.SAID) * max(b.state, -1) + H.ID_SAID * b.hint for b in found]
    return [s + x > 0 and b.state > -2 for b, s, x in zip(found, score, said)]


def test_articles_keep_lists_tables_and_captions(spark):
    weights = trained(spark)
    links = "".join(f"<li><a href=/{i}>source {i}</a></li>" for i in range(6))
    page = (f"<nav><a href=/>Home</a></nav><article><h1>Head</h1><p>{LONG}</p><h2>Sources</h2><ul>{links}</ul>"
            "<table><caption>Figures</caption><tr><td>1</td><td>2</td></tr></table><figure><img src=x><figcaption>A view"
            "</figcaption></figure><div class=share><a href=x>Share this</a></div></article><footer>Imprint</footer>")
    want = ["Head", LONG, "Sources", *[f"source {i}" for i in range(6)], "Figures", "1", "2", "A view"]
    assert H.main_text(page, weights).split("\n") == want


def test_the_cut_corrects_the_sign(spark):
    """Text without markup names: lines and unnamed parts between paragraphs,
    and a linked one, which the classifier alone drops; a sentence and a
    heading among links, which it alone keeps."""
    weights = trained(spark)
    p, links = f"<p>{LONG}</p>", "".join(f"<div><a href=/{k}>part {k}</a></div>" for k in range(4))
    text = [f"{p}<div>Yes</div>{p}", f"{p}<div>So it went</div>{p}", f"{p}{p}<div>{LONG}</div>{p}",
            f"{p}<p><a href=x>See how it went</a></p>{p}"]
    for page in text:
        found = H.blocks(f"<div>{page}</div>")
        assert H.label(found, weights) == [True] * len(found), page
        assert not all(by_sign(f"<div>{page}</div>", weights)), page
    lists = [f"{links}<h4>Topics</h4>{links}",
             "".join(f"<a href=/{k}>part {k}</a><br>" for k in range(4)) + "<p>Some words.</p><a href=/9>x</a>"]
    for page in lists:
        found = H.blocks(f"<div>{page}</div>")
        assert H.label(found, weights) == [False] * len(found), page
        assert any(by_sign(f"<div>{page}</div>", weights)), page


def test_settled_blocks_leave_the_cut_as_it_is():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 30)
        source, sink = ([float(rng.randrange(8)) for _ in range(n)] for _ in range(2))
        edges = [(i - 1, i, float(rng.randrange(4))) for i in range(1, n)]
        edges += [(a, b, 1.0) for a, b in ((rng.randrange(n), rng.randrange(n)) for _ in range(n // 3)) if a != b]
        assert H.min_cut(source, sink, edges) == H._max_flow([a - b for a, b in zip(source, sink)], edges)


def test_deep_nesting_takes_seconds():
    import time
    began = time.time()
    for unit, end in (("<div>word ", ""), ("<span>word ", ""), ("<div><p>word <b>", "</b>"), ("<i>a</div>", "")):
        page = "<body>" + unit * 50_000 + end * 50_000 + f"<article><p>{LONG}</p></article>"
        assert H.main_text(page, H.START).endswith(LONG)
    assert time.time() - began < 60


def test_training_reads_the_ends_of_long_pages(spark):
    filler = f"<div>{'<p>unmarked text.</p>' * 4000}</div>"
    pages = spark.createDataFrame([(i, filler + f"<article><p>{LONG}</p><p>{LONG}</p></article><div class=ad><p>x</p><p>y</p></div>")
                                   for i in range(3)], "page_id long, html string")
    weights = H.fit(pages)
    assert not np.allclose(weights[:len(H.START)], H.START)
    same = [spark.createDataFrame([(7, p) for _ in range(40)], "page_id long, html string") for p in (PAGE, None)]
    assert len(H.fit(same[0], rows=4)) == len(H.START) + H.NEAR and len(H.fit(same[1])) == len(H.START) + H.NEAR

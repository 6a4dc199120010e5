from __future__ import annotations

import html
import math
import random
import re
from itertools import product

import duckdb
import pytest

from pricepanel.llm import content_extraction as ce
from pricepanel.llm.dom import parse

SAMPLE = "/root/testdata/sf0.01/pages.parquet"
PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="site">
<a href="/">Home</a><form class="search"><input>Find it</form></header>
<div id="cookie-banner"><p>We use cookies here.</p></div><main><article><h1>Title &amp; more</h1>
<div class="ad-slot">Buy now</div><p>One <b>bold</b>word and <a href="x">link</a>.</p>
<ul><li><a href=1>First</a></li><li><a href=2>Second</a></li></ul><p>&nbsp;Two&#33;<br>lines</p>
<aside class="related"><h3>See also</h3><ul><li><a href=q>Other</a></li></ul></aside>
<table><tr><td>a<td>b</table></article><section class="comments"><h2>Comments</h2>
<div class="comment"><p>A long comment by some reader who has a lot of time to write it.</p></div>
</section></main><div class="sidebar">Side text</div><form action="/news"><label>Mail</label>
<button>Subscribe</button></form><footer><p>Imprint and all that.</p></footer>
<script>var x="</p>"</script></body></html>"""


@pytest.fixture(scope="module")
def model():
    return ce.fit()


def test_clutter_goes_and_the_article_stays(model):
    assert ce.main_text(PAGE, model) == (
        "Title & more One boldword and link. First Second Two! lines a b"
    )


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<p></p>", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a b"),
        ("<div class=content><p>A<!-- x -->B &lt;c&gt;</div><nav>no</nav>", "AB <c>"),
        ("<script>only()</script>", ""), ("</p></div>a &am b", "a &am b"),
    ],
)
def test_odd_pages(model, page, text):
    assert ce.main_text(page, model) == text


def test_many_comments_do_not_outvote_their_names(model):
    article = "<div class='post'>" + "<p>Hm.</p>" * 300 + "</div>"
    comments = "<div class='comments'>" + "<p>A longer text by a reader.</p>" * 300 + "</div>"
    assert ce.main_text(f"<body>{article}{comments}</body>", model) == " ".join(["Hm."] * 300)


def test_sample_pages_give_their_articles(model):
    for (page,) in duckdb.execute(f"SELECT html FROM '{SAMPLE}'").fetchall():
        article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        article = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", article))
        assert ce.main_text(page, model) == " ".join(html.unescape(article).split())


def test_messages_give_the_marginals_of_all_labellings(model):
    rng = random.Random(1)
    for page in ("<div class=ad><p>x</p><a href=1>y</a></div><p>z</p>", "<nav><b>q</b></nav>t<ul><li>u"):
        nodes = parse(page)
        local = [[0.0, 0.0] for _ in nodes]
        for own, seen in zip(local, ce.evidence(nodes), strict=True):
            for feature, power in seen:
                for s in (0, 1):
                    own[s] += power * model.seen.get(feature, (0.0, 0.0))[s]
        totals = [0.0] * len(nodes)
        whole = 0.0
        for states in product((0, 1), repeat=len(nodes)):
            score = model.root[states[0]] + sum(local[k][s] for k, s in enumerate(states))
            for k, (node, kind) in enumerate(zip(nodes[1:], ce.kinds(nodes)[1:], strict=True), 1):
                table = model.transitions.get(kind, model.unknown)
                score += table[states[node.parent]][states[k]]
            weight = math.exp(score)
            whole += weight
            for k, s in enumerate(states):
                totals[k] += weight * s
        assert ce.marginals(nodes, model) == pytest.approx([t / whole for t in totals])
        assert rng


def test_held_out_layouts_are_labelled_well():
    pages = ce.labelled_pages()
    model = ce.train(p for k, p in enumerate(pages) if k % 4)
    right = total = 0
    for page in pages[::4]:
        nodes = parse(page)
        for node, label, content in zip(nodes, ce.labels(nodes), ce.marginals(nodes, model), strict=True):
            if node.tag == "#text" and label is not None:
                total += len(node.text)
                right += len(node.text) * ((content >= 0.5) == bool(label))
    assert right / total > 0.95


PARAGRAPH = "<p>" + "Lorem ipsum dolor sit amet, consetetur sadipscing elitr. " * 5 + "</p>"


@pytest.mark.parametrize("depth", range(1, 9))
def test_an_article_in_plain_elements_stays_whole(model, depth):
    inside = "<div>" * depth + "<h1>T</h1>" + PARAGRAPH * 12 + "</div>" * depth
    wanted = " ".join(["T", *re.sub("<.*?>", " ", PARAGRAPH * 12).split()])
    assert ce.main_text(f"<html><body>{inside}</body></html>", model) == wanted


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div class=wrap><div class=col><p>Some text here.</p></div></div>", "Some text here."),
        ("<article><div><div><p>Deep one</p></div></div><p>two</p></article>", "Deep one two"),
        (
            "<article><section class=note><h2>Note</h2><p>foo</p></section><p>two</p></article>",
            "Note foo two",
        ),
        ("<center><font>Old text. More text.</font></center>", "Old text. More text."),
    ],
)
def test_nested_and_old_elements(model, page, text):
    assert ce.main_text(page, model) == text


def held_out_page(rng):
    """A page by another rule than the training pages, what is content, and what is not."""
    words = "zeta kilo mora pelin dura santo rivel omen tasca brune".split()
    numbers = []  # the last word of a sentence and of a link occurs once

    def sentence(least, most):
        picked = [rng.choice(words) for _ in range(rng.randrange(least, most))]
        picked.append(f"{words[len(numbers) % 10]}{len(numbers)}")
        numbers.append(picked[-1])
        return " ".join(picked).capitalize() + rng.choice([".", ".", "!", "?"])

    def text(n):
        return " ".join(sentence(6, 18) for _ in range(n))

    def links(n):
        items = [f"<a href='/{k}'>{sentence(1, 3)[:-1]}</a>" for k in range(n)]
        return rng.choice(
            ["<ul><li>" + "</li><li>".join(items) + "</li></ul>", "<div>" + " - ".join(items) + "</div>"]
        )

    def named(tag, name, body):
        return f'<{tag} class="{name}">{body}</{tag}>'

    blocks = []
    for _ in range(rng.randrange(3, 15)):
        body = f"<p>{text(rng.randrange(2, 6))}</p>"
        form = rng.randrange(6)
        if form == 0:
            body = f"<section><h4>{sentence(2, 5)}</h4>{body}{body}</section>"
        elif form == 1:
            body = f"<div><div>{body}</div></div>"
        elif form == 2:
            body = f"<blockquote>{body}</blockquote>"
        elif form == 3:
            body = f"<div class='g{rng.randrange(99)}'>{text(3)}</div>"
        blocks.append(body)
    content = f"<h2>{sentence(3, 8)}</h2>" + "".join(blocks)
    layout = rng.randrange(4)
    depth = rng.randrange(3)
    before, after = [links(rng.randrange(3, 9))], [f"<div>&copy; {rng.choice(words)}</div>"]
    if rng.random() < 0.5:
        before.append(named("div", "site-header", f"<b>{sentence(2, 4)}</b>"))
    if rng.random() < 0.5:
        after.insert(0, named("div", "related-posts", f"<h5>{sentence(1, 3)}</h5>{links(4)}"))
    if rng.random() < 0.5:
        comments = "".join(f"<div><p>{text(2)}</p></div>" for _ in range(rng.randrange(1, 6)))
        after.insert(0, named("div", "comments", comments))
    if layout == 0:  # unnamed
        body = "".join(before) + f"<div>{content}</div>" + "".join(after)
    elif layout == 1:  # nested
        inner = "".join(before) + f"<div><div>{content}</div></div>" + "".join(after)
        body = "<div>" * depth + f"<div>{inner}</div>" + "</div>" * depth
    elif layout == 2:  # sections
        body = "".join(before) + f"<section class='k{depth}'>{content}</section>" + "".join(after)
    else:  # a table
        body = (
            f"{before[0]}<table><tr><td>{links(4)}</td><td>{content}</td></tr></table>{after[-1]}"
        )
        before, after = [before[0], links(4)], [after[-1]]

    def shown(markup):
        return " ".join(html.unescape(re.sub("<[^>]*>", " ", markup)).split())

    return f"<html><body>{body}</body></html>", shown(content), shown(" ".join(before + after))


def test_held_out_plain_layouts(model):
    """Share of the article's characters that are found, and of the clutter's."""
    rng = random.Random(11)
    found = wanted = wrong = clutter = 0
    for _ in range(300):
        page, content, rest = held_out_page(rng)
        got = set(re.findall(r"\w+\d+", ce.main_text(page, model)))
        for text, own in ((content, True), (rest, False)):
            for part in re.findall(r"[^\d]*\d+", text):
                hit = re.search(r"\w+$", part)[0] in got
                found, wanted = found + len(part) * hit * own, wanted + len(part) * own
                wrong, clutter = wrong + len(part) * hit * (not own), clutter + len(part) * (not own)
    assert found / wanted >= 0.95 and wrong / clutter <= 0.05, (found / wanted, wrong / clutter)


def test_pages_of_a_table(spark):
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", "<p>x</p>"), (1, "u", PAGE), (3, "w", "<p>é ß</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'t' AS text", "0 AS n_chars"
    )
    got = [tuple(r) for r in ce.extract(df).collect()]
    assert len(got) == 5 and (3, "w", "é ß", 3) in got and (2, None, "", 0) in got
    assert ce.extract(df.where("false")).count() == 0


def test_a_model_from_a_table_of_marked_pages(spark):
    pages = spark.createDataFrame([(p,) for p in ce.labelled_pages()], "html string")
    assert ce.main_text(PAGE, ce.fit(pages)) == ce.main_text(PAGE, ce.fit())
    assert ce.fit(pages, max_pages=3) == ce.fit(pages.repartition(3), max_pages=3)


def test_deep_and_unclosed_pages(model):
    assert ce.main_text("<div>" * 3 + "<p>core</p>", model) == "core"
    deep = "<div>" * 5000 + "<p>core</p>"
    assert ce.main_text(deep, model) in ("", "core")
    assert [n.tag for n in parse("<p>a<div>b<li>c<li>d</ul>e")][1:] == [
        "p", "#text", "div", "#text", "li", "#text", "li", "#text",
    ]

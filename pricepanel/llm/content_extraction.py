"""Main text of HTML pages by a tree-structured graphical model.

Every node of the DOM, elements and texts, is a variable with two states, content or not.
Two kinds of potentials connect them. One links a child to its parent: how likely a node of
its kind has the state it has, given the parent's; an element without names is of another kind
than one with, and so is one right below an element that is named as content. The other links a node to what can be seen of it: names in class and id, the
length of a link's text, and of elements that hold others the share of links in their text and
their share of the page's text. Both are smoothed relative frequencies over labelled pages. The
potentials of shares are raised to a power, one over the number of siblings of a kind, so that
siblings have one vote together and a long list of comments does not outvote the name of its
element. The DOM is a tree, so passing messages once upward and once downward (sum-product)
gives exact marginals, and the text is what has a marginal of a half or more.

Training pages are a table of html in which the content is marked by an attribute. The
default ones are made by a rule: layouts with and without semantic tags and names, nested, in
sections and in tables, with menus, notices, sidebars, adverts, forms and comments in various
places. At most ``MAX_PAGES`` pages are
used, the first by id. The model is a few hundred numbers, sent to every task; pages are not
shuffled.

The whole page is read. Character references are decoded, white space inside a block becomes
one space, and blocks are joined in page order by one space.

Edge cases: a null, empty or text-free page has an empty text. Elements that are not closed
end with their parent. Scripts, styles and comments are no text. Repeated rows are returned
one by one. Other columns are not touched.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import cycle, product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.dom import BLOCKS, HIDDEN, Node, parse

MAX_PAGES = 500
MARK = "data-content"
SMOOTHING = 0.1

# Parts of class names and ids that tell what an element is for.
HINTS = {
    "advert": ("advert", "ads", "banner", "sponsor", "promo"),
    "comment": ("comment", "disqus", "reply", "reactions"),
    "content": ("article", "content", "entry", "main", "post", "story", "text"),
    "footer": ("footer", "copyright", "bottom"),
    "form": ("form", "login", "newsletter", "search", "signup", "subscribe"),
    "header": ("header", "masthead", "topbar", "logo"),
    "menu": ("breadcrumb", "menu", "nav", "pagination", "tags"),
    "notice": ("alert", "consent", "cookie", "gdpr", "modal", "notice", "popup"),
    "sidebar": ("aside", "related", "share", "sidebar", "social", "widget"),
}
_SHORT_HINTS = {"ad": "advert", "ads": "advert", "nav": "menu"}
_ROLES = {
    "navigation": "menu", "banner": "header", "contentinfo": "footer", "search": "form",
    "complementary": "sidebar", "main": "content", "article": "content", "dialog": "notice",
}
_LENGTHS = (20, 80, 200)
_LINK_SHARES = (0.01, 0.3, 0.7)
_PAGE_SHARES = (0.05, 0.2, 0.5)
_SPLIT = re.compile(r"[^a-z0-9]+")
KNOWN_TAGS = BLOCKS | {"a", "b", "i", "em", "strong", "span", "code", "button", "label", "img"}
# Elements that are made to hold others; names tell them apart.
HOLDERS = frozenset(
    "article aside center div dl font footer form header main nav ol section span table tbody td "
    "tr ul".split()
)


def hints(node: Node) -> list[str]:
    """What the names of an element say it is for."""
    names = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower()
    parts = set(filter(None, _SPLIT.split(names)))
    found = {
        hint
        for hint, words in HINTS.items()
        if any(part.startswith(word) for part in parts for word in words if len(word) > 3)
    }
    found |= {_SHORT_HINTS[part] for part in parts if part in _SHORT_HINTS}
    if role := _ROLES.get(node.attrs.get("role", "").lower()):
        found.add(role)
    return sorted(found)


def kinds(nodes: list[Node]) -> list[str]:
    """The kind of each node that the potential with its parent depends on."""
    found = []
    for node in nodes:
        if node.tag in HIDDEN:
            found.append("hidden")
        elif node.tag in HOLDERS:
            named = any(node.attrs.get(name) for name in ("class", "id", "role"))
            parent = nodes[max(0, node.parent)]
            told = parent.tag in ("article", "main") or "content" in hints(parent)
            found.append(node.tag + ".named" * named + ".inside" * told)
        else:
            known = node.tag == "#text" or node.tag in KNOWN_TAGS
            found.append(node.tag if known else "other")
    return found


def _bucket(value: float, bounds: tuple[float, ...]) -> int:
    return sum(value >= bound for bound in bounds)


def evidence(nodes: list[Node]) -> list[list[tuple[str, float]]]:
    """What can be seen of each node, with the power that its potential is raised to."""
    n = len(nodes)
    linked, hidden = [False] * n, [False] * n
    lengths, in_links = [0] * n, [0] * n
    siblings: Counter = Counter()
    for k, node in enumerate(nodes):
        if node.parent >= 0:
            linked[k] = linked[node.parent] or node.tag == "a"
            hidden[k] = hidden[node.parent] or node.tag in HIDDEN
        if node.tag == "#text" and not hidden[k]:
            lengths[k] = len(node.text.strip())
            in_links[k] = lengths[k] * linked[k]
        if lengths[k] or node.tag != "#text":
            siblings[node.parent, node.tag] += 1
    for k in range(n - 1, 0, -1):
        lengths[nodes[k].parent] += lengths[k]
        in_links[nodes[k].parent] += in_links[k]
    seen = []
    for k, node in enumerate(nodes):
        vote = 1 / max(1, siblings[node.parent, node.tag])
        if node.tag == "#text":
            own = []
            if lengths[k] and linked[k]:
                # Many short texts must not outvote the names around them: only links tell.
                own = [(f"link:{_bucket(lengths[k], _LENGTHS)}", 1.0)]
        else:
            own = [(f"hint:{h}", 1.0) for h in hints(node)]
            if node.tag in HOLDERS and lengths[k]:
                links = _bucket(in_links[k] / lengths[k], _LINK_SHARES)
                share = _bucket(lengths[k] / lengths[0], _PAGE_SHARES)
                own += [(f"links:{links}", vote), (f"share:{share}", vote)]
        seen.append(own)
    return seen


def labels(nodes: list[Node]) -> list[int | None]:
    """1 for content, 0 otherwise, None for blank texts, by the mark on the page.

    An element is content if most of the text in it is; one without text is as its parent.
    """
    marked = [False] * len(nodes)
    inside, total = [0] * len(nodes), [0] * len(nodes)
    for k, node in enumerate(nodes):
        if node.parent >= 0:
            own = node.attrs.get(MARK)
            marked[k] = marked[node.parent] if own is None else own == "1"
    for k in range(len(nodes) - 1, 0, -1):
        node = nodes[k]
        if node.tag == "#text" and nodes[node.parent].tag not in HIDDEN:
            total[k] = len(node.text.strip())
            inside[k] = total[k] * marked[k]
        total[node.parent] += total[k]
        inside[node.parent] += inside[k]
    states: list[int | None] = []
    for k, node in enumerate(nodes):
        if node.tag == "#text" and not node.text.strip():
            states.append(None)
        elif node.tag in HIDDEN:
            states.append(0)
        elif total[k]:
            states.append(int(2 * inside[k] > total[k]))
        else:
            states.append(states[node.parent] if node.parent >= 0 else 0)
    return states


@dataclass(frozen=True)
class Model:
    """Logarithms of potentials, by state, and by parent's and child's state."""

    root: tuple[float, float]
    transitions: dict[str, tuple[tuple[float, float], tuple[float, float]]]
    unknown: tuple[tuple[float, float], tuple[float, float]]
    seen: dict[str, tuple[float, float]]


def train(pages: Iterable[str]) -> Model:
    """Relative frequencies over pages whose content is marked."""
    pairs: Counter = Counter()
    features: Counter = Counter()
    states: Counter = Counter()
    roots: Counter = Counter()
    for html in pages:
        nodes = parse(html)
        label = labels(nodes)
        roots[label[0]] += 1
        for k, (seen, kind) in enumerate(zip(evidence(nodes), kinds(nodes), strict=True)):
            if label[k] is None or k == 0:
                continue
            above = label[nodes[k].parent] or 0
            pairs[kind, above, label[k]] += 1
            pairs[None, above, label[k]] += 1
            for feature, _ in seen:
                features[feature, label[k]] += 1
                states[feature.partition(":")[0], label[k]] += 1

    def rows(of: str | None) -> tuple[tuple[float, float], tuple[float, float]]:
        def row(above: int) -> tuple[float, float]:
            counts = [pairs[of, above, s] + SMOOTHING for s in (0, 1)]
            return tuple(math.log(c / sum(counts)) for c in counts)

        return row(0), row(1)

    names = sorted({f for f, _ in features})
    sizes = Counter(name.partition(":")[0] for name in names)

    def given(feature: str) -> tuple[float, float]:
        group = feature.partition(":")[0]
        return tuple(
            math.log(
                (features[feature, s] + SMOOTHING) / (states[group, s] + SMOOTHING * sizes[group])
            )
            for s in (0, 1)
        )

    trained = sorted({of for of, _, _ in pairs if of is not None})
    return Model(
        tuple(
            math.log((roots[s] + SMOOTHING) / (roots.total() + 2 * SMOOTHING)) for s in (0, 1)
        ),
        {of: rows(of) for of in trained},
        rows(None),
        {name: given(name) for name in names},
    )


def _log_add(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def marginals(nodes: list[Node], model: Model) -> list[float]:
    """The probability that each node is content, by sum-product on the tree."""
    n = len(nodes)
    local = [[0.0, 0.0] for _ in range(n)]
    local[0] = list(model.root)
    for own, seen in zip(local, evidence(nodes), strict=True):
        for feature, power in seen:
            if potential := model.seen.get(feature):
                own[0] += power * potential[0]
                own[1] += power * potential[1]
    tables = [model.transitions.get(kind, model.unknown) for kind in kinds(nodes)]

    # Upward: below[k] gathers the messages of k's children; up[k] is the message of k.
    below = [list(own) for own in local]
    up = [(0.0, 0.0)] * n
    for k in range(n - 1, 0, -1):
        zero, one = below[k]
        table = tables[k]
        up[k] = (
            _log_add(table[0][0] + zero, table[0][1] + one),
            _log_add(table[1][0] + zero, table[1][1] + one),
        )
        above = below[nodes[k].parent]
        above[0] += up[k][0]
        above[1] += up[k][1]

    # Downward: belief of the parent without the child's own message, through the potential.
    belief = [tuple(b) for b in below]
    for k in range(1, n):
        parent = belief[nodes[k].parent]
        zero, one = parent[0] - up[k][0], parent[1] - up[k][1]
        table = tables[k]
        belief[k] = (
            below[k][0] + _log_add(zero + table[0][0], one + table[1][0]),
            below[k][1] + _log_add(zero + table[0][1], one + table[1][1]),
        )
    return [math.exp(b[1] - _log_add(*b)) for b in belief]


def main_text(html: str | None, model: Model) -> str:
    """The text of the nodes that are rather content than not."""
    nodes = parse(html)
    content = marginals(nodes, model)
    blocks: list[list[str]] = [[]]
    path: list[int] = []
    hidden = [False] * len(nodes)
    for k, node in enumerate(nodes):
        while path and path[-1] != node.parent:
            if nodes[path.pop()].tag in BLOCKS:
                blocks.append([])
        if node.parent >= 0:
            hidden[k] = hidden[node.parent] or node.tag in HIDDEN
        if node.tag in BLOCKS:
            blocks.append([])
        if node.tag == "#text" and not hidden[k] and content[k] >= 0.5:
            blocks[-1].append(node.text)
        path.append(k)
    joined = (" ".join("".join(block).split()) for block in blocks)
    return " ".join(filter(None, joined))


_TRAINING_TEXT = (
    "The river rose two metres after the storm and the old bridge was closed to all traffic.",
    "Short line.",
    "In the second year the harvest failed. Farmers sold their tools, left the valley and went "
    "to look for work in the towns along the coast, where the mills were still hiring by the day.",
    "She opened the letter, read it twice and put it back into the drawer without a word. Nobody "
    "asked her about it, neither that evening nor later, when the news had reached the village.",
    "Yes.",
    "Costs fell by a third & output doubled, the report says, though not in every region.",
)


# Names that do not tell what an element is for.
_NEUTRAL = ("", 'class="wrap"', "", 'class="col-8"', 'id="x12"', "", 'class="row inner"')


def labelled_pages() -> list[str]:
    """Pages made by a rule, their content marked: every layout with every kind of clutter."""
    text = cycle(_TRAINING_TEXT)
    on, off = f'{MARK}="1"', f'{MARK}="0"'

    def block(tag: str, names: str, body: str) -> str:
        return f"<{tag} {names} {off}>{body}</{tag}>"

    links = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("home", "news", "about us"))
    boxes = '<label>Mail <input name="m"></label><button>Send</button>'
    clutter = {
        "menu": [("nav", ""), ("div", 'class="menu"'), ("ul", 'id="breadcrumbs"')],
        "header": [("header", ""), ("div", 'class="site-header"'), ("div", 'id="masthead"')],
        "footer": [("footer", ""), ("div", 'id="footer"'), ("div", 'class="copyright"')],
        "sidebar": [("aside", ""), ("div", 'class="sidebar"'), ("section", 'class="related"')],
        "notice": [
            ("div", 'class="cookie-consent"'), ("div", 'class="notice"'), ("dialog", "open"),
        ],
        "advert": [("div", 'class="ad"'), ("div", 'class="advert box"'), ("aside", 'id="sponsor"')],
        "form": [("form", 'action="/s"'), ("div", 'class="newsletter"'), ("form", 'id="login"')],
        "comments": [
            ("section", 'id="comments"'), ("div", 'class="comment"'), ("ol", 'class="comment-list"'),
        ],
    }
    layouts = (
        ("article", ""), ("main", ""), ("div", 'class="content"'), ("div", 'id="post-body"'),
        ("section", 'class="story"'), ("div", ""),
    )
    pages = []
    for round_, ((tag, names), variant) in enumerate(product(layouts, range(24))):
        heading = ("h2", "h3", "h4")[round_ % 3]

        def box(kind_: str) -> str:
            own_tag, own_names = clutter[kind_][(variant + round_) % 3]
            body = {
                "menu": f"<ul>{links}</ul>",
                "header": f"<a href='/'>The Daily</a><p>{next(text)}</p>",
                "footer": f"&copy; The Daily &middot; {next(text)} <a href='/imprint'>Imprint</a>",
                "sidebar": f"<{heading}>More</{heading}><ul>{links}</ul><p>{next(text)}</p>",
                "notice": f"<p>{next(text)}</p><button>Accept</button>",
                "advert": next(text),
                "form": f"<p>{next(text)}</p>{boxes}",
                "comments": f"<{heading}>Replies</{heading}><p><b>Ann</b> {next(text)}</p><p>{next(text)}</p>",
            }[kind_]
            return block(own_tag, own_names, body)

        paragraphs = []
        for k in range(1 + variant % 6):
            ends = "" if variant % 4 == 3 else "</p>"
            strong = "<b>" if k == 0 and variant % 2 else ""
            link = f"<a href='/x'>{next(text)[:30]}</a> " if k % 2 else ""
            paragraphs.append(f"<p>{strong}{next(text)}<br>{link}{next(text)}{ends}")
        if variant % 2 == 0:
            paragraphs.append(f"<ul><li>{next(text)}</li><li>{next(text)}</li></ul>")
        cells = "".join(
            f"<li><a href='/x'>{next(text)[:length]}</a></li>" for length in (7, 12, 12, 18, 40)
        )
        paragraphs.append(f"<{('ul', 'ol')[variant % 2]}>{cells}</{('ul', 'ol')[variant % 2]}>")
        if variant % 3 == 1:
            paragraphs.append(f"<{heading}>{next(text)}</{heading}>")
            paragraphs.append(f"<blockquote>{next(text)}</blockquote>")
        if variant % 3 == 2:
            names_ = _NEUTRAL[round_ % len(_NEUTRAL)]
            own = ("section", "div")[variant % 2]
            body = f"<{heading}>{next(text)[:20]}</{heading}><p>{next(text)}</p>"
            paragraphs.append(f"<{own} {names_}>{body}</{own}><div><div><p>{next(text)}</p></div></div>")
        if variant % 4 == 2:
            paragraphs.append(f"<table><tr><td>{next(text)}</td><td>7</td></tr></table>")
        if variant % 2:
            paragraphs.insert(1, box("advert"))
        if variant % 5 == 4:
            paragraphs.append(box("comments") + box("sidebar"))
        if variant % 5 == 3:
            paragraphs.insert(1, box("notice") + box("form"))
        title = next(text)[:40]
        main = f"<{tag} {names} {on}><h1>{title}</h1>{''.join(paragraphs)}</{tag}>"
        before = box("menu") + box("notice") + box("advert")
        if variant % 2 == 0:
            before = box("header") + before
        after = (box("comments") if variant % 3 else "") + box("sidebar") + box("footer")
        body = f"{before}{main}{after}"
        if variant % 4 == 1:
            body = f'<div id="page">{body}</div>'
        pages.append(
            f"<!DOCTYPE html><html><head><title>{title}</title><style>p {{}}</style></head>"
            f"<body>{body}<script>run()</script></body></html>"
        )
    for k in range(24):
        paragraphs = "".join(f"<p>{next(text)}</p>" for _ in range(1 + k % 4))
        body = (f"<h1>{next(text)}</h1>{paragraphs}", paragraphs, next(text))[k % 3]
        pages.append(f"<html {on}><body>{body}</body></html>" if k % 2 else f"<div {on}>{body}</div>")
    return [*pages, *_plain_pages(text)]


def _plain_pages(text: Iterator[str]) -> list[str]:
    """Layouts without telling names: nested, in sections, in tables, in old tags."""
    names = cycle(_NEUTRAL)
    on, off = f'{MARK}="1"', f'{MARK}="0"'

    def links(n: int, tag: str) -> str:
        words = [next(text)[: 5 + 3 * (i % 4)] for i in range(n)]
        if tag == "ul":
            items = "".join(f"<li><a href='/{i}'>{w}</a></li>" for i, w in enumerate(words))
            return f"<ul {off}>{items}</ul>"
        return f"<{tag} {off}>" + " | ".join(f"<a href='/'>{w}</a>" for w in words) + f"</{tag}>"

    def wrapped(tag: str, depth: int, inside: str) -> str:
        for _ in range(depth):
            inside = f"<{tag} {next(names)}>{inside}</{tag}>"
        return inside

    def inside(k: int) -> str:
        parts = [f"<h{1 + k % 2}>{next(text)[:50]}</h{1 + k % 2}>"] if k % 5 else []
        for j in range(2 + k * 7 % 11):
            body = f"{next(text)} {next(text)}" if j % 3 else f"{next(text)}<br>{next(text)}"
            part = ("<p>{}</p>", "<p>{}</p>", "<div>{}</div>", "<font>{}</font><br>")[
                k % 4 if j % 2 else 0
            ].format(body)
            if (j + k) % 4 == 3:
                part = f"<section {next(names)}><h3>{next(text)[:30]}</h3>{part}</section>"
            elif (j + k) % 4 == 1:
                part = wrapped("div", 1 + k % 3, part)
            parts.append(part)
        if k % 6 == 4:
            parts.append(f"<table><tr><td>{next(text)}</td><td>{k}</td></tr></table>")
        return "".join(parts)

    pages = []
    for k in range(140):
        content = inside(k)
        tag = ("div", "section", "center", "div", "td")[k % 5]
        few = f"<div {off}>&copy; 2020 <a href='/'>{next(text)[:12]}</a></div>"
        menu = links(3 + k % 6, ("ul", "div", "p")[k % 3])
        if k % 4 == 0:
            menu, few = "", ""
        if tag == "td":
            side = f"<td {off}>{links(4, 'ul')}</td>"
            main = f"<td {on} {next(names)}>{content}</td>"
            body = f"<table><tr>{side if k % 2 else ''}{main}{side}</tr></table>"
            pages.append(f"<html><body>{menu}{body}{few}</body></html>")
            continue
        main = f"<{tag} {next(names)} {on}>{content}</{tag}>"
        if k % 3 == 1:
            side = f"<div class='sidebar' {off}><h3>{next(text)[:20]}</h3>{links(5, 'ul')}</div>"
            main = f"{main}{side}"
        if k % 7 == 3:
            posts = "".join(f"<div><p>{next(text)}</p></div>" for _ in range(1 + k % 9))
            main += f"<div class='comments' {off}>{posts}</div>"
        body = wrapped("div", k % 4, f"{menu}{wrapped('div', k % 3, main)}{few}")
        pages.append(f"<html><body>{body}</body></html>")
    return pages


def fit(pages: DataFrame | None = None, html: str = "html", max_pages: int = MAX_PAGES) -> Model:
    """Train on a table of marked pages, or on the default ones."""
    if pages is None:
        return train(labelled_pages())
    first = pages.select(F.col(html).alias("html")).orderBy(F.md5(html), "html").limit(max_pages)
    return train(row["html"] for row in first.collect())


def extract(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    model: Model | None = None,
) -> DataFrame:
    """page_id, url, the main text and its length of every page."""
    fitted = model or fit()

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page, fitted) for page in batch], dtype=object)

    return pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), text_of(F.col(html)).alias("text")
    ).withColumn("n_chars", F.length("text").cast("long"))

"""A small DOM: elements and texts of an HTML page in page order, each with its parent."""

from __future__ import annotations

from dataclasses import dataclass, field
from html.parser import HTMLParser

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
# Text in these is never shown as text.
HIDDEN = frozenset("script style template noscript textarea iframe svg object".split())
# A start of one of the second closes an open one of the first.
_CLOSED_BY = {
    "p": BLOCKS - {"br"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "thead", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option"},
    "head": {"body"},
}
# An implied end does not reach beyond these.
_SCOPES = frozenset("html body table article section div ul ol dl select blockquote".split())


@dataclass
class Node:
    tag: str  # "#text" for texts
    parent: int
    attrs: dict[str, str] = field(default_factory=dict)
    text: str = ""


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#root", -1)]
        self.open = [0]

    def _close_implied(self, tag: str) -> None:
        """End open elements that cannot hold ``tag``, and all that is inside of them."""
        for depth in range(len(self.open) - 1, 0, -1):
            own = self.nodes[self.open[depth]].tag
            if tag in _CLOSED_BY.get(own, ()):
                del self.open[depth:]
                return
            if own in _SCOPES and own != tag:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._close_implied(tag)
        self.nodes.append(Node(tag, self.open[-1], {k: v or "" for k, v in attrs}))
        if tag not in VOID:
            self.open.append(len(self.nodes) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.nodes[self.open[depth]].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data: str) -> None:
        parent = self.open[-1]
        if self.nodes[-1].tag == "#text" and self.nodes[-1].parent == parent:
            self.nodes[-1].text += data
        else:
            self.nodes.append(Node("#text", parent, text=data))


def parse(html: str | None) -> list[Node]:
    """Nodes in page order; the first is the root, and a parent comes before its children."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.nodes

"""Main text of web pages by tag-path ratios.

A page is read into text leaves, each with its path of open elements.  Per path, text
length and punctuation are added up and divided by the number of leaves; the product of
both ratios is smoothed over the leaves in page order, the smoothed values of a path are
fused into their mean, and paths above the threshold (a share of the standard deviation)
are content.  The root is the lowest common ancestor of all content (inside an article, that
article), with what stands between the last heading before it and its start; every block
below it belongs to the article, so headings and short paragraphs stay however little they
weigh.  Boilerplate elements and subtrees that name themselves
boilerplate (a whole class, id or role) take part in none of this, except the page's frame,
headings and elements that hold most of the content.  Reader comments are left out whatever
their length, if the page has an article outside of them.

Pages are independent, so this is one pass without a shuffle; work per page is linear in
its length.

Defined cases: NULL or empty html gives empty text; a page without content gives empty
text; the title counts where a heading in or before the article has it, not from the page's
header element; unclosed and crossed elements are closed by their parents; a NULL identifier or
repeated rows change nothing; other columns pass through, but for one of the name of the
result, which gives way to it.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span"
    " strike strong sub sup time tt u var wbr"
    " math mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr"
    " munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style noscript template head title svg annotation annotation-xml iframe object canvas audio video nav footer aside form button"
    " select textarea menu dialog".split()
)
#: Words that mark boilerplate where a whole class, id or role consists of them (and of ``NEUTRAL`` words).
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation"
    " menu breadcrumb breadcrumbs footer sidebar aside complementary contentinfo comment comments respond disqus reply"
    " replies notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe signup login share"
    " sharing social related recommended pagination pager search skip widget toolbar".split()
)
#: The marks of reader comments and of the page's frame, which may also be qualified.
COMMENTS = frozenset("comment comments respond disqus reply replies".split())
FRAME = COMMENTS | frozenset("nav navbar navigation menu footer sidebar".split())
QUALIFIERS = frozenset("site page main global primary secondary post user reader visitor article blog entry thread".split())
NEUTRAL = frozenset(
    "area bar block body bottom box button buttons container content form group holder inner item items left link links list"
    " outer panel right row section slot top wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that no name silences.
SPOKEN = frozenset(["html", "body", "main", "article"]) | HEADINGS
#: Nor one that holds more than this share of the text on the page's content paths.
MOST = 0.5
#: These mark boilerplate outside the article only.
OUTER = frozenset("header masthead hero".split())
ARTICLE = frozenset(["article", "main"])
#: An element that one of these opens inside of it closes first.
CLOSES = {
    "p": frozenset(
        "p div ul ol dl table section article aside nav header footer form h1 h2 h3 h4 h5 h6 blockquote pre hr main"
        " figure fieldset address details".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
_HOLDS = frozenset(["ul", "ol", "dl", "table", "div", "section", "article"])
#: Elements that a comment mark leaves alone.
_FRAME_TAGS = frozenset(["html", "body", "main"]) | HEADINGS
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")
_NAME = re.compile(r"[a-z]+")

#: Leaves on each side that smoothing looks at, with their weights.
KERNEL = (0.25, 0.5, 0.25)
#: Paths count as content above this share of the standard deviation.
THRESHOLD = 0.5


class _Element:
    __slots__ = ("tag", "path", "parent", "silent", "marked", "article", "depth", "closing", "heading", "comment")

    def __init__(self, tag: str, path: int, parent: _Element | None, silent: bool, marked: bool, article: bool, comment: bool):
        self.tag, self.path, self.parent, self.silent, self.article = tag, path, parent, silent, article
        #: Whether it names itself reader comments.
        self.comment = comment
        #: The nearest element, from this one up, that an element inside of it may close or not reach beyond.
        self.closing: _Element | None = self if tag in CLOSES or tag in _HOLDS else parent.closing if parent else None
        self.heading: str | None = tag if tag in HEADINGS else parent.heading if parent else None
        #: The nearest element, from this one up, that names itself boilerplate.
        self.marked: _Element | None = self if marked else parent.marked if parent else None
        self.depth = parent.depth + 1 if parent else 0


def _marks(token: str, marks: frozenset[str]) -> bool:
    words = set(_NAME.findall(token))
    if marks.isdisjoint(words):
        return False
    return words <= marks | NEUTRAL or (not FRAME.isdisjoint(words & marks) and words <= marks | NEUTRAL | QUALIFIERS)


class _Reader(HTMLParser):
    """Collects leaves (element, block number, text)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.paths: dict[tuple[int, str], int] = {}
        self.at = _Element("", 0, None, False, False, False, False)
        #: All elements, parents before children, and how many of each tag are open.
        self.elements = [self.at]
        self.open: Counter[str] = Counter()
        self.block = 0
        self.leaves: list[tuple[_Element, int, str]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.block += 1
            self._close_for(tag)
        elif tag == "br" and not self.at.silent:
            self.leaves.append((self.at, self.block, " "))
        if tag in VOID:
            return
        names = [value.lower() for key, value in attrs if key in ("class", "id", "role") and value]
        silent = self.at.silent or tag in SILENT
        if not self.at.article and tag == "header":
            silent = True
        marks = MARKED if self.at.article else MARKED | OUTER
        tokens = [token for n in names for token in n.split()]
        marked = tag not in SPOKEN and any(_marks(token, marks) for token in tokens)
        comment = tag not in _FRAME_TAGS and any(_marks(token, COMMENTS) for token in tokens)
        article = self.at.article or tag in ARTICLE
        path = self.paths.setdefault((self.at.path, ".".join([tag, *names[:1]])), len(self.paths) + 1)
        self.at = _Element(tag, path, self.at, silent, marked or comment, article, comment)
        self.elements.append(self.at)
        self.open[tag] += 1

    def _leave(self, element: _Element) -> None:
        """Close everything up to and with ``element``."""
        while self.at is not element:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent
        self.open[element.tag] -= 1
        self.at = element.parent

    def _close_for(self, tag: str) -> None:
        # between two elements of _HOLDS each tag of CLOSES stands open once at most, as it closes itself
        element = self.at.closing
        while element is not None:
            outer = element.parent.closing
            if tag in CLOSES.get(element.tag, ()):
                self._leave(element)
            elif element.tag in _HOLDS:
                return
            element = outer

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.block += 1
        if not self.open[tag]:
            return
        element = self.at
        while element.tag != tag:
            element = element.parent
        self._leave(element)

    def handle_data(self, data: str) -> None:
        if not self.at.silent:
            self.leaves.append((self.at, self.block, data))


def _content_paths(paths: list[int], texts: list[str]) -> set[int]:
    """Paths whose fused ratio exceeds the threshold."""
    length, marks, count = {}, {}, {}
    for path, text in zip(paths, texts):
        length[path] = length.get(path, 0) + len(text)
        marks[path] = marks.get(path, 0) + len(PUNCTUATION.findall(text))
        count[path] = count.get(path, 0) + 1
    ratio = {p: length[p] / count[p] * (1 + marks[p] / count[p]) for p in count}
    values = [ratio[p] for p in paths]
    n = len(values)
    smooth = [
        sum(w * values[min(n - 1, max(0, i + k - 1))] for k, w in enumerate(KERNEL)) for i in range(n)
    ]
    mean = sum(smooth) / n
    limit = THRESHOLD * (sum((v - mean) ** 2 for v in smooth) / n) ** 0.5
    fused: dict[int, float] = {}
    for path, value in zip(paths, smooth):
        fused[path] = fused.get(path, 0.0) + value / count[path]
    return {p for p, v in fused.items() if v >= limit}


def _heavy(elements: list[_Element], leaves: list[tuple[_Element, int, str]]) -> tuple[dict[_Element, int], int]:
    """Text on content paths by element, and in all."""
    content = _content_paths([e.path for e, _, _ in leaves], [t for _, _, t in leaves]) if leaves else set()
    weight: dict[_Element, int] = {}
    whole = 0
    for element, _, text in leaves:
        if element.path in content:
            whole += len(text)
            weight[element] = weight.get(element, 0) + len(text)
    for element in reversed(elements):  # children before their parents
        if element.parent is not None and element in weight:
            weight[element.parent] = weight.get(element.parent, 0) + weight[element]
    return weight, whole


def _discussions(elements: list[_Element]) -> set[_Element]:
    """Elements that are reader comments whatever their length: the page has an article outside of them."""
    inside: dict[_Element, _Element | None] = {}
    for e in elements:
        outer = inside[e.parent] if e.parent is not None else None
        inside[e] = outer or (e if e.comment else None)
    proper = any(e.tag in ARTICLE and inside[e] is None for e in elements)
    if proper:
        return {e for e, top in inside.items() if top is e}
    return set()


def _spoken(elements: list[_Element], leaves: list[tuple[_Element, int, str]]) -> list[tuple[_Element, int, str]]:
    """The leaves outside boilerplate."""
    if all(e.marked is None for e, _, _ in leaves):
        return leaves
    discussions = _discussions(elements)
    weight, whole = _heavy(elements, [x for x in leaves if x[2].strip()])
    quiet: dict[_Element | None, bool] = {None: False}
    for e in elements:
        outer = quiet[e.parent.marked] if e.parent is not None else False
        if e.marked is e:
            light = e.tag not in SPOKEN and weight.get(e, 0) <= MOST * whole
            quiet[e] = outer or e in discussions or light
    return [x for x in leaves if not quiet[x[0].marked]]


def _title(leaves: list[tuple[_Element, int, str]], inside: list[bool], content: int) -> int:
    """Where the headings before the root start: at the last h1, else the last heading.

    A root that opens with a heading has its title; then only an h1 of the same article counts.
    """
    found = [(i, tag) for i in range(content + 1) if leaves[i][2].strip() and (tag := leaves[i][0].heading)]
    titled = any(inside[i] for i, _ in found)
    before = [(i, tag) for i, tag in found if not inside[i] and i < inside.index(True)]
    if titled:
        before = [(i, tag) for i, tag in before if tag == "h1" and leaves[i][0].article]
    return max([i for i, tag in before if tag == "h1"] or [i for i, _ in before] or [len(leaves)])


def main_text(html: str) -> str:
    """Blocks of the article, joined by an empty line."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    elements, every = reader.elements, reader.leaves
    if any(e.article and t.strip() for e, _, t in every):
        every = [x for x in every if x[0].article]
    every = _spoken(elements, every)
    leaves = [x for x in every if x[2].strip()]
    if not leaves:
        return ""
    weight, whole = _heavy(elements, leaves)
    # the lowest common ancestor of all content
    common = [e for e, w in weight.items() if w == whole and e.tag not in INLINE and e.tag not in CLOSES and e.tag not in HEADINGS]
    root = max(common, key=lambda e: e.depth)
    while root.article and root.tag not in ARTICLE:
        root = root.parent
    below = {root}
    for e in elements:
        if e.parent in below:
            below.add(e)
    inside = [e in below for e, _, _ in every]
    start = _title(every, inside, next(i for i, (e, _, _) in enumerate(every) if inside[i] and weight.get(e)))
    first = inside.index(True)
    blocks: dict[int, list[str]] = {}
    for i, (_, block, text) in enumerate(every):
        if inside[i] or start <= i < first:
            blocks.setdefault(block, []).append(text)
    joined = [" ".join("".join(parts).split()) for parts in blocks.values()]
    return "\n\n".join(b for b in joined if b)


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` without its html, with the main text in ``out_col``."""

    @F.arrow_udf("string")
    def extracted(html: pa.Array) -> pa.Array:
        return pa.array([main_text(h.as_py() or "") for h in html], pa.string())

    keep = [F.col(f"`{c}`") for c in pages.columns if c not in (html_col, out_col)]
    return pages.select(*keep, extracted(F.col(f"`{html_col}`").cast("string")).alias(out_col))

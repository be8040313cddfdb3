"""Main text of web pages by the containers that the pages of a host agree on.

Every page scores its containers by the text they hold and names the best by its
generalised path of tags and classes.  The pages of a host vote, and the text is
taken from the winning path again, or from a page's own best container where the
host's path lacks any of its text.  Either is widened to the article around it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubwell.llm.url_filter import split_url
from scrubwell.session import stage

CONTAINERS = frozenset("address article blockquote center dd div fieldset main section td".split())
BLOCKS = CONTAINERS | frozenset(
    "aside body caption details dialog dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hr html legend li menu nav ol option p pre search summary table tbody tfoot th thead "
    "tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their inside is no markup: it is skipped up to the end tag.
RAW = frozenset("script style textarea title".split())
# Their inside is not the page's text; without an end tag they end with what surrounds them.
HIDDEN = frozenset(
    "audio button canvas datalist iframe noembed noframes noscript object select svg template video".split()
)
JUNK_TAGS = frozenset("aside dialog footer header menu nav search".split())
JUNK_ROLES = frozenset(
    "alert banner complementary contentinfo dialog menu navigation search".split()
)
# A class that is one of these speaks for itself, also inside an article.
CLEAR_NAMES = frozenset(
    "ad ads adbox adslot advert advertisement adverts breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus gdpr modal newsletter pager pagination paywall popup promo "
    "promoted share sharing social sponsor sponsored subscribe".split()
)
JUNK_NAMES = frozenset(
    "ad ads adbox adslot advert advertisement adverts banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies discussion disqus footer gdpr header login menu modal nav "
    "navbar navigation newsletter notice notices notification pager pagination paywall popup promo "
    "promoted promotion related replies respond responses search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe toolbar topbar widget widgets".split()
)
# A start tag closes open elements of these kinds, up to the nearest of the second kind.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTROL_TEXT = 80  # characters of a form's text for each control, at most, for the form to be junk
DECAY = 0.9  # of a container's score, per level up
ARTICLES = frozenset(("article", "main"))

_TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*)([^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)>"""
)
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|\b(hidden)\b""")
_GOES_ON = re.compile(r"</?(?:p|div|section|article|main|h[1-6]|ul|ol|li|table|body)[\s>]", re.I)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+")
_DIGITS = re.compile(r"\d+")


@dataclass
class Page:
    """Containers (``parents``, ``paths``, tags, marks) and the blocks of text in order.

    A block is (container, text, link characters, whether a heading).  Container 0 is
    the page.  ``surely`` and ``named`` mark junk, ``hinted`` containers have a name that
    may speak of junk, ``forms`` hold parts of forms, ``controls`` counts these.
    """

    parents: list[int] = field(default_factory=lambda: [0])
    paths: list[str] = field(default_factory=lambda: [""])
    surely: list[bool] = field(default_factory=lambda: [False])
    named: list[bool] = field(default_factory=lambda: [False])
    hinted: list[bool] = field(default_factory=lambda: [False])
    forms: list[bool] = field(default_factory=lambda: [False])
    controls: list[int] = field(default_factory=lambda: [0])
    tags: list[str] = field(default_factory=lambda: [""])
    in_article: list[bool] = field(default_factory=lambda: [False])
    blocks: list[tuple[int, str, int, bool]] = field(default_factory=list)


def _marks(attributes: str) -> tuple[str, bool, bool, bool, bool]:
    """The generalised class or id, whether the element is surely junk, and whether its class or its id
    speaks of it; the last tells whether the class does so clearly."""
    label, surely, named, hinted, clear = "", False, False, False, False
    for name, value, hidden in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if hidden or (name == "aria-hidden" and value == "true"):
            surely = True
        elif name == "role":
            surely = surely or value.lower() in JUNK_ROLES
        elif name == "style":
            surely = surely or "display:none" in value.replace(" ", "").lower()
        elif name in ("class", "id"):
            parts = {part.lower() for part in _NAME_PARTS.findall(value)}
            speaks = not JUNK_NAMES.isdisjoint(parts.union(value.lower().split()))
            named = named or (speaks and name == "class")
            clear = clear or (name == "class" and not CLEAR_NAMES.isdisjoint(value.lower().split()))
            hinted = hinted or (speaks and name == "id")
            if name == "class" or not label:
                label = _DIGITS.sub("", ".".join(sorted(value.split())))
    return label, surely, named, hinted, clear


class _Parser:
    def __init__(self):
        self.page = Page()
        self.stack: list[tuple[str, int]] = []  # open elements with the container around their inside
        self.open: dict[str, int] = {}
        self.hides: list[bool] = []  # for each open element whether its inside is not shown
        self.hidden = 0
        self.text: list[str] = []
        self.link_size = 0

    def _end_block(self) -> None:
        if self.text:
            text = " ".join(html.unescape("".join(self.text)).split())
            if text:
                container = self.stack[-1][1] if self.stack else 0
                heading = not HEADINGS.isdisjoint(self.open)
                self.page.blocks.append((container, text, self.link_size, heading))
            self.text, self.link_size = [], 0

    def _push(self, tag: str, attributes: str) -> None:
        page, around = self.page, self.stack[-1][1] if self.stack else 0
        label, surely, named, hinted, clear = (
            _marks(attributes) if attributes else ("", False, False, False, False)
        )
        if tag == "p" or tag in HEADINGS:
            named, hinted = clear, False
        if tag in ("form", "label", "legend") or tag in HIDDEN:
            page.forms[around] |= tag in ("form", "select", "button", "datalist")
            page.controls[around] += tag in ("select", "button", "datalist")
        if named and not clear and not ARTICLES.isdisjoint(self.open):
            named, hinted = False, True  # inside an article a name alone is no evidence
        in_article = tag == "header" and not ARTICLES.isdisjoint(self.open)
        hides = tag in HIDDEN or (tag in ("label", "legend") and "form" in self.open)
        surely = surely or hides or (tag in JUNK_TAGS and not in_article)
        inside = around
        if tag in CONTAINERS or surely or named or hinted or in_article or tag == "form":
            path = f"{page.paths[around]}/{tag}.{label}" if label else f"{page.paths[around]}/{tag}"
            if len(path) > 200:
                path = "#" + xxhash.xxh64_hexdigest(path)
            inside = len(page.paths)
            page.parents.append(around)
            page.paths.append(path)
            page.surely.append(surely)
            page.named.append(named)
            page.hinted.append(hinted)
            page.forms.append(tag == "form")
            page.controls.append(0)
            page.tags.append(tag)
            page.in_article.append(page.tags[around] in ARTICLES or page.in_article[around])
        self.stack.append((tag, inside))
        self.hides.append(hides)
        self.hidden += hides
        self.open[tag] = self.open.get(tag, 0) + 1

    def _pop_to(self, tag: str) -> None:
        while True:
            popped, _ = self.stack.pop()
            self.hidden -= self.hides.pop()
            self.open[popped] -= 1
            if not self.open[popped]:
                del self.open[popped]
            if popped == tag:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self._end_block()
            if "p" in self.open:
                self._pop_to("p")
            if tag in CLOSES:
                kinds, walls = CLOSES[tag]
                found = None
                for element, _ in reversed(self.stack):
                    if element in walls:
                        break
                    if element in kinds:
                        found = element
                if found:
                    self._pop_to(found)
        elif tag == "br":
            self.text.append(" ")
        if tag == "input" and "hidden" not in attributes.lower():
            self.page.forms[self.stack[-1][1] if self.stack else 0] = True
            self.page.controls[self.stack[-1][1] if self.stack else 0] += 1
        if tag not in VOID and tag not in ("html", "head", "body"):
            self._push(tag, attributes)

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_block()
        if tag in self.open:
            self._pop_to(tag)

    def data(self, text: str) -> None:
        if self.hidden:  # also inside a line of text, which goes on behind it
            return
        self.text.append(text)
        if "a" in self.open:
            self.link_size += len(text.strip())


def parse(source: str) -> Page:
    """Read a page in one pass; whatever is not closed ends with what surrounds it."""
    parser, at, size, last = _Parser(), 0, len(source), source.rfind(">")
    while at < size:
        mark = source.find("<", at)
        if mark < 0:
            mark = size
        if mark > at:
            parser.data(source[at:mark])
        if mark == size:
            break
        if source.startswith("<!--", mark):
            stop = source.find("-->", mark + 4)
            at = size if stop < 0 else stop + 3
            continue
        found = mark < last and (_TAG.match(source, mark) or _LOOSE_TAG.match(source, mark))
        if not found:
            if mark > last and source[mark + 1 : mark + 2].isalpha():
                break  # a tag that the page's end cuts off
            if source.startswith(("<!", "<?", "</"), mark):
                stop = source.find(">", mark)
                at = size if stop < 0 else stop + 1
            else:
                parser.data("<")
                at = mark + 1
            continue
        at, tag = found.end(), found[2].lower()
        if found[1]:
            parser.end(tag)
        elif tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(source, at)
            stop = source.find(">", close.end()) if close else -1
            if stop < 0 and tag in ("textarea", "title"):
                continue  # never closed: the tag alone is dropped
            if stop < 0:  # a script that is never closed ends where markup goes on
                mark = _GOES_ON.search(source, at)
                at = mark.start() if mark else size
                continue
            if not found[3].endswith("/"):
                at = size if stop < 0 else stop + 1
        elif not (tag in HIDDEN and found[3].endswith("/")):
            parser.start(tag, found[3])
    parser._end_block()
    return parser.page


@dataclass
class Scored:
    junk: list[bool]
    scores: list[float]

    def best(self) -> int:
        return max(range(len(self.scores)), key=lambda node: (self.scores[node], -node))


def score(page: Page) -> Scored:
    """Mark junk and score every container by the text inside, less what is links.

    A container that only its names call junk keeps its text if it holds most of the page.
    An id, and a class inside an article, count only beside links, a form, or a place outside the page's
    article.  A form is junk if it has a control for every CONTROL_TEXT characters of its text: around a
    whole page it is only a wrapping.
    """
    count = len(page.parents)
    controls = list(page.controls)
    total, links, own = [0] * count, [0] * count, [0.0] * count
    forms, holds = list(page.forms), [tag in ARTICLES for tag in page.tags]
    for container, text, linked, _ in page.blocks:
        total[container] += len(text)
        links[container] += linked
    for node in range(count - 1, 0, -1):
        forms[page.parents[node]] |= forms[node]
        controls[page.parents[node]] += controls[node]
        holds[page.parents[node]] |= holds[node]
        if not page.surely[node]:
            total[page.parents[node]] += total[node]
            links[page.parents[node]] += links[node]
    junk = [False] * count
    for node in range(1, count):
        outside = holds[0] and not (holds[node] or page.in_article[node])
        hinted = page.hinted[node] and (outside or forms[node] or 2 * links[node] >= total[node])
        named = (page.named[node] or hinted) and 2 * total[node] <= total[0]
        form = page.tags[node] == "form" and total[node] <= CONTROL_TEXT * max(1, controls[node])
        junk[node] = junk[page.parents[node]] or page.surely[node] or named or form
    for container, text, linked, _ in page.blocks:
        if not junk[container]:
            own[container] += len(text) - 2 * linked
    for node in range(count - 1, 0, -1):
        own[page.parents[node]] += DECAY * own[node]
    return Scored(junk, [-1.0 if bad else value for bad, value in zip(junk, own)])


def best_path(source: str) -> str:
    """The path of a page's best container; empty for the page itself."""
    page = parse(source)
    return page.paths[score(page).best()]


def _widen(page: Page, node: int) -> int:
    """The nearest article or main around a container, or else the page."""
    at = node
    while at and page.tags[at] not in ARTICLES:
        at = page.parents[at]
    return at


def _inside(page: Page, junk: list[bool], cores: set[int]) -> list[int]:
    """Numbers of the blocks in the containers and in the articles around them.

    What stands beside a container is left out if it is mostly links and no
    heading, or, where no article is marked, if its id speaks of junk.
    """
    wide = {_widen(page, node) for node in cores}
    count = len(page.parents)
    core, near, doubted = [False] * count, [False] * count, [False] * count
    holds = [node in cores for node in range(count)]
    for node in range(count - 1, 0, -1):
        holds[page.parents[node]] |= holds[node]
    for node in range(count):
        up = page.parents[node]
        core[node] = node in cores or (node > 0 and core[up])
        near[node] = node in wide or (node > 0 and near[up])
        hinted = page.hinted[node] and not page.in_article[node] and not holds[node]
        doubted[node] = hinted or (node > 0 and doubted[up])
    return [
        number
        for number, (at, text, links, heading) in enumerate(page.blocks)
        if not junk[at]
        and (core[at] or (near[at] and not doubted[at] and (heading or 2 * links < len(text))))
    ]


def extract(source: str, path: str | None) -> str:
    """The blocks of text around the containers of a path, joined by newlines."""
    page = parse(source)
    scored = score(page)
    chosen = _inside(page, scored.junk, {scored.best()})
    roots = {node for node, found in enumerate(page.paths) if found == path}
    if roots:
        agreed = _inside(page, scored.junk, roots)
        if set(chosen) <= set(agreed):
            chosen = agreed
    return "\n".join(page.blocks[number][1] for number in chosen)


def host_paths(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """``host, path``: the path that most pages of a host vote for, ties to the smaller path."""
    host, _ = split_url(F.col(url))

    @F.arrow_udf("string")
    def vote(sources: pa.Array) -> pa.Array:
        return pa.array((best_path(text.as_py() or "") for text in sources), pa.string())

    votes = (
        pages.select(host.alias("host"), vote(F.col(source)).alias("path"))
        .groupBy("host", "path")
        .count()
    )
    return votes.groupBy("host").agg(
        F.min_by("path", F.struct(-F.col("count"), F.col("path"))).alias("path")
    )


def main_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html"
) -> DataFrame:
    """``<key>, <url>, text, n_chars`` for every row.

    Null and empty pages have an empty text.  Pages without a host (null address
    or no ``://``) vote together; rows that repeat a page count as often as they
    stand; other columns are ignored.  Only a host's path, one row per host, is
    joined back; a host with very many pages votes in every task before it is counted.
    """
    host, _ = split_url(F.col(url))
    named = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), F.col(source).alias("source"), host.alias("host")
    )

    @F.arrow_udf("string")
    def extracted(sources: pa.Array, paths: pa.Array) -> pa.Array:
        texts = (extract(text.as_py() or "", path.as_py()) for text, path in zip(sources, paths))
        return pa.array(texts, pa.string())

    # written, so that the planner sends the paths to the pages unless they are large
    agreed = stage(host_paths(named, "url", "source"), "host-paths")
    told = named.join(agreed, "host", "left").select(
        "key", "url", extracted(F.col("source"), F.col("path")).alias("text")
    )
    return told.select(
        F.col("key").alias(key),
        F.col("url").alias(url),
        "text",
        F.char_length("text").cast("bigint").alias("n_chars"),
    )

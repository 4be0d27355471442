"""Main text of web pages by paths that the pages of a host agree on.

Each page scores its containers by the running text in them, and votes for the path of its best
one: the tags from the root down with their classes, digits generalised, so that pages of one
template vote alike. Votes are counted per host in Spark. Each page is then read again and gives
the blocks of the containers on the host's winning path, or, where it has none, of its own best.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

from pyspark.sql import Column, DataFrame, functions as F

from recurra.llm.common import map_batches, texts_of
from recurra.session import stage

# Kinds of HTML elements, and words that name what is not the article.
RAW = "script|style|noscript|template|textarea|title|iframe|svg|math|object|canvas|xmp"
SKIPPED = frozenset(
    "head nav header footer aside button select menu dialog audio video map".split()
)
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody "
    "tfoot tr td th caption pre blockquote address hr details summary center fieldset figure "
    "figcaption".split()
)
CONTAINERS = BLOCKS | SKIPPED | {"form"}
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption pre summary figcaption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose end tag may be left out, and what closes them when it starts.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
}
# Parts of names that tell what lies around an article, and what is never one.
AROUND = frozenset(
    "sidebar side-bar menu nav navbar navigation breadcrumb breadcrumbs header masthead footer foot "
    "popup modal social share sharing related recommended widget widgets toolbar pagination pager "
    "login signup search copyright legal disclaimer hidden skip banner".split()
)
NEVER = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo "
    "comment comments disqus replies cookie cookies consent notice gdpr newsletter subscribe".split()
)
#: Parts that make a name say how its element is laid out, and those of an article's own header.
LAYOUT = frozenset("with has no not without hide enabled disabled open closed".split())
OWN = frozenset("entry post article story content".split())

#: A form, or what a part in ``AROUND`` names, with at least this part of its page's running text
#: stays; so does what a part in ``NEVER`` names, if no more than ``LEAST`` lies outside of such.
MOST, LEAST = 0.75, 0.1

_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_HUMPS = re.compile(r"(?<=[a-z])(?=[A-Z])")


def doubts(names: str) -> int:
    """How doubtful class, id and role make an element: 0, 1 (around an article), 2 (never one)."""
    worst = 0
    for name in names.split():
        parts = set(_PARTS.split(_HUMPS.sub("-", name).lower()))
        if parts & LAYOUT:
            continue
        if parts & NEVER:
            return 2
        if parts & AROUND and not (parts & OWN and parts & AROUND == {"header"}):
            worst = 1
    return worst


_START = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s<>/]*+)|<[!?/][^<>]*+>", re.S
)
_IN_TAG = re.compile(r"""(?:[^<>=]++|=(?!\s*["']))*+""")
_QUOTE = re.compile(r"""=\s*(["'])""")
_TO_TAG_END = re.compile(r"[^<>]*+>")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW.split("|")}
#: Raw elements that a start tag closes if it ends in a slash.
SELF_CLOSED = frozenset("svg math object canvas".split())


def _tag_end(html: str, at: int, failed: set[int]) -> int:
    """Where the tag that goes on at ``at`` has its ">", outside of quoted values, or -1 if a "<"
    or the page's end comes first. A quote that never closes is a character like others.

    ``failed`` keeps the places from which no end was found, so that a page costs linear time.
    """
    seen = []
    while at not in failed:
        seen.append(at)
        at = _IN_TAG.match(html, at).end()
        if html[at : at + 1] == ">":
            return at
        quote = _QUOTE.match(html, at)
        if quote is None:
            break
        at = html.find(quote[1], quote.end()) + 1 or quote.end()
    failed.update(seen)
    return -1


def _tokens(html: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Start and end of what is no text; of tags also "/" if they end, the name, attributes."""
    at, failed = 0, set()
    while (start := _START.search(html, at)) is not None:
        at, tag = start.end(), (start["tag"] or "").lower()
        if not tag:
            yield start.start(), at, "", "", ""
            continue
        close = _tag_end(html, at, failed)
        if close < 0:
            plain = _TO_TAG_END.match(html, at)
            if plain is None:
                continue
            close = plain.end() - 1
        attributes, at = html[start.end() : close], close + 1
        if tag in _RAW_END and not start["end"]:
            if not (tag in SELF_CLOSED and attributes.endswith("/")):
                end = _RAW_END[tag].search(html, at)
                at = end.end() if end else len(html)
            tag = ""
        yield start.start(), at, start["end"], tag, attributes


_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_DIGITS = re.compile(r"\d+")


#: Between the steps of a path; no class holds a space.
STEP = " > "


@dataclass(slots=True)
class Node:
    """An element; ``key`` stands for its path, and ``container`` is the next one up that is none
    of the leaves, itself included."""

    tag: str
    step: str
    key: int
    parent: Node | None
    number: int
    skipped: bool
    doubt: int = 0
    container: Node | None = None
    article: Node | None = None
    #: Running text inside, that of it which lies in an article without doubt, and the score.
    running: float = 0.0
    clean: float = 0.0
    score: float = 0.0
    dropped: bool = False

    @property
    def path(self) -> str:
        steps, node = [], self
        while node is not None:
            steps.append(node.step)
            node = node.parent
        return STEP.join(reversed(steps))


@dataclass
class Page:
    """Elements of a page, parents first, and its blocks, each with the element it lies in.

    Paths are numbered by the step they add to another one, so depth costs nothing.
    """

    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[str, Node]] = field(default_factory=list)
    keys: dict[tuple[int, str], int] = field(default_factory=dict)

    def best(self) -> Node | None:
        scored = [n for n in self.nodes if n.score > 0]
        if not scored:
            return None
        top = max(scored, key=lambda n: (n.score, -n.number))
        return top.article or top

    def text(self, path: str | None) -> str:
        """The blocks in containers on ``path``, or in the best one if there are none."""
        out = self.within({n.number for n in self.on(path)}) if path is not None else []
        if not out:
            best = self.best()
            out = self.within({best.number}) if best else []
        return "\n\n".join(out)

    def on(self, path: str) -> list[Node]:
        key = -1
        for step in path.split(STEP):
            key = self.keys.get((key, step), -2)
        return [
            n for n in self.nodes
            if n.key == key and not (n.skipped or n.dropped) and n.container is n
        ]

    def within(self, numbers: set[int]) -> list[str]:
        inside = [False] * len(self.nodes)
        for n in self.nodes:
            inside[n.number] = n.number in numbers or (
                n.parent is not None and inside[n.parent.number]
            )
        return [text for text, node in self.blocks if inside[node.number]]


def read_page(html: str) -> Page:
    """The blocks outside of skipped elements, with the elements that hold them, scored.

    What its names or a form make doubtful is skipped too, unless most of the page's running text
    lies in it (see ``_settle``). The cost is linear in the length of the page.
    """
    page = Page()
    found: list[tuple[str, Node, float]] = []
    here: Node | None = None
    words: list[str] = []
    open_tags: Counter[str] = Counter()
    linked = links = 0

    def end_block() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(words)).split())
        words.clear()
        if text and here is not None and not here.skipped:
            # Running text counts; links count against it.
            gain = max(0, len(text) - 2 * linked) * min(1.0, len(text) / 80)
            found.append((text, here, gain))
        linked = 0

    def open_node(tag: str, attributes: str) -> None:
        nonlocal here
        named = {
            k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)
        } if attributes else {}
        names = " ".join(unescape(named.get(k, "")) for k in ("class", "id", "role"))
        above = here.article if here is not None else None
        of_article = tag == "header" and above is not None and above.tag == "article"
        skipped = (
            (here is not None and here.skipped) or (tag in SKIPPED and not of_article)
            or "hidden" in named or named.get("aria-hidden") == "true"
            or "display:none" in named.get("style", "").replace(" ", "").lower()
        )
        doubt = 0 if tag in ("html", "body", "main", "article") else doubts(names)
        classes = sorted(set(_DIGITS.sub("#", named.get("class", "")).split()))
        step = ".".join([tag, *classes])
        key = page.keys.setdefault((here.key if here is not None else -1, step), len(page.keys))
        node = Node(tag, step, key, here, len(page.nodes), skipped, max(doubt, tag == "form"))
        node.container = here.container if tag in LEAVES and here is not None else node
        node.article = above or (node if tag in ("article", "main") else None)
        if tag == "article" and above is not None and above.tag == "main":
            node.article = node
        page.nodes.append(node)
        open_tags[tag] += 1
        here = node

    def close_to(node: Node) -> None:
        nonlocal here
        while here is not node:
            open_tags[here.tag] -= 1
            here = here.parent

    open_node("", "")
    at = 0
    for start, end, closing, tag, attributes in _tokens(html):
        text = html[at:start]
        at = end
        if text:
            words.append(text)
            linked += len(text) if links else 0
        if not tag:
            continue
        if closing:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in CONTAINERS:
                end_block()
                if open_tags[tag]:
                    while here.tag != tag:
                        close_to(here.parent)
                    close_to(here.parent)
                    links = 0
        elif tag == "br" or tag == "hr":
            words.append(" ")
            if tag == "hr":
                end_block()
        elif tag == "a":
            links += 1
        elif tag in CONTAINERS and tag not in VOID:
            end_block()
            while here.parent is not None and (
                here.tag == "p" or here.tag in CLOSED_BY and tag in CLOSED_BY[here.tag]
            ):
                close_to(here.parent)
            links = 0
            open_node(tag, attributes)
    words.append(html[at:])
    end_block()
    _settle(page, found)
    return page


def _settle(page: Page, found: list[tuple[str, Node, float]]) -> None:
    """Keep or drop the doubtful elements, and score the containers by the blocks that are left.

    A form, or what names place around an article, stays if it holds most of the page's running
    text; an advert, comment or notice only where hardly anything lies outside of such. Where an
    article or main element has text of its own, not in anything doubtful below it, neither stays
    without some of that.
    """
    for _, node, gain in found:
        node.running += gain
    # What is doubtful on the way up to the article: text below it is not the article's own.
    doubtful = [False] * len(page.nodes)
    never = [False] * len(page.nodes)
    for node in page.nodes:
        above = node.parent
        own = node.article is node
        doubtful[node.number] = not own and (
            node.doubt > 0 or above is not None and doubtful[above.number]
        )
        never[node.number] = node.doubt == 2 or above is not None and never[above.number]
        if node.article is not None and not doubtful[node.number]:
            node.clean = node.running
    total = sum(gain for _, _, gain in found)
    elsewhere = sum(gain for _, node, gain in found if not never[node.number])
    for node in reversed(page.nodes):
        if node.parent is not None:
            node.parent.running += node.running
            node.parent.clean += node.clean
    own_text = page.nodes[0].clean > 0
    for node in page.nodes:
        stays = node.running > 0 and (node.clean > 0 or not own_text) and (
            node.running >= MOST * total if node.doubt == 1 else elsewhere <= LEAST * total
        )
        node.dropped = (node.doubt > 0 and not stays) or (
            node.parent is not None and node.parent.dropped
        )
    for text, node, gain in found:
        if node.dropped:
            continue
        page.blocks.append((text, node))
        container, weight = node.container, 1.0
        # Most for the container next to the text.
        while container is not None and weight > 0.1:
            container.score += weight * gain
            parent, weight = container.parent, weight / 2
            container = parent.container if parent is not None else None


def host_of(url: str) -> Column:
    """The host of a URL column in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.try_parse_url(F.col(url), F.lit("HOST")), F.lit("")))


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Per host: its winning path (most votes, the first by name among equals) and the votes."""
    kept = pages.select(host_of(url).alias("host"), html)

    def vote(batch):
        best = [read_page(t).best() for t in texts_of(batch, html)]
        return {"host": batch.column("host"), "path": [b.path if b else None for b in best]}

    votes = map_batches(kept, "host string, path string", vote)
    counted = votes.where("path IS NOT NULL").groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("votes")
    )
    top = F.min(F.struct((-F.col("votes")).alias("less"), "path")).alias("top")
    return counted.groupBy("host").agg(top).select(
        "host", "top.path", (-F.col("top.less")).alias("votes")
    )


def extract(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Per row: key, url, text, n_chars (code points), path (the host's) and votes for it.

    Null or empty html gives an empty text; pages without a host in their URL form one group.
    Repeated rows and null keys give a row each; other columns are left out, so none can clash;
    an empty table gives none. The winning paths are written first, so Spark knows their size
    when it plans the join and broadcasts them only if they are small.
    """
    paths = stage(host_paths(pages, url, html), "host-paths")
    source = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"),
        host_of(url).alias("host"),
    ).join(paths, "host", "left")
    kind = pages.schema[key].dataType.simpleString()

    def read_again(batch):
        texts = [
            read_page(t).text(p)
            for t, p in zip(texts_of(batch, "html"), batch.column("path").to_pylist())
        ]
        return {
            key: batch.column("key"), "url": batch.column("url"), "text": texts,
            "n_chars": list(map(len, texts)), "path": batch.column("path"),
            "votes": batch.column("votes"),
        }

    schema = f"`{key}` {kind}, url string, text string, n_chars long, path string, votes long"
    return map_batches(source.select("key", "url", "html", "path", "votes"), schema, read_again)

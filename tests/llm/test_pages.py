from collections import Counter, defaultdict
from html.parser import HTMLParser
from urllib.parse import urlparse

import pytest

from llm import odd
from recurra.llm import html_text

ARTICLE = "This is a paragraph of the article that is long enough to count as running text."
CASES = {
    f"<body><nav><a href=x>Menu</a></nav><article><h1>A &amp; B</h1><p>{ARTICLE}</article>":
        f"A & B\n\n{ARTICLE}",
    f'<div class="sidebar"><p>{ARTICLE} Side.</p></div><div class="post p7"><p>x  y&nbsp;&eacute;'
    f"</p><p>{ARTICLE}</div><footer>foot</footer>": f"x y é\n\n{ARTICLE}",
    f"<main><p>{ARTICLE}<br>more</p><form>Name <input></form><div class=comments><p>{ARTICLE} No."
    "</p></div></main>": f"{ARTICLE} more",
    f"<script>if (a<b) '<p>no</p>'</script><!-- <p>no</p> --><p>{ARTICLE}</p><style>p</style>":
        ARTICLE,
    f"<table><tr><td>{ARTICLE}<td>cell</table>": f"{ARTICLE}\n\ncell",
    "": "", "plain <b>words": "plain words", "<p>a<p>b": "a\n\nb", "</div></p>z": "z",
    "<!-- open <p>a": "", "<p title='>'>a</p>": "a", '<p title=">a': '',
}


@pytest.mark.parametrize("html", list(CASES)[:-1])
def test_article_text(html):
    assert html_text.read_page(html).text(None) == CASES[html]


def test_tags_have_no_longest_value_nor_most_attributes():
    long, many = "x" * 2500, " ".join(f'a{i}="{i}"' for i in range(150))
    markup = "<p>no</p>" * 300
    for tag in (f'<div class="ad" data-x="{long}">', f"<div {many} class='ad'>",
                f'<div data-props="{markup}" class="ad">'):
        page = f"<article><p>{ARTICLE}</p>{tag}<p>Buy {ARTICLE}</p></div><p>{ARTICLE}</p></article>"
        assert html_text.read_page(page).text(None) == f"{ARTICLE}\n\n{ARTICLE}"


@pytest.mark.parametrize("wrapper", [
    'div class="content with-sidebar"', 'div class="site has-menu"', 'div class="page no-sidebar"',
    'div class="layout header-fixed"', "form", 'div id="login"', 'section class="widget"',
])
def test_wrappers_of_the_whole_page_are_read(wrapper):
    page = (
        f"<body><nav>Menu</nav><{wrapper}><div class=ad><p>Buy this now.</p></div><div class=post>"
        f"<p>{ARTICLE}</p><p>{ARTICLE}</p></div><form><p>Your name</p></form></{wrapper.split()[0]}>"
    )
    assert html_text.read_page(page).text(None) == f"{ARTICLE}\n\n{ARTICLE}"


def test_forms_and_named_parts_beside_the_article_are_skipped():
    page = (
        f"<body><div class=post><p>{ARTICLE}</p><div class='box promo'><p>{ARTICLE} Buy.</p></div>"
        f"<form><p>{ARTICLE} Send.</p></form><p>{ARTICLE}</p></div>"
    )
    assert html_text.read_page(page).text(None) == f"{ARTICLE}\n\n{ARTICLE}"
    page = f"<body><div class=ad>{ARTICLE}</div><article><h1>Short.</h1><p>Short.</article>"
    assert html_text.read_page(page).text(None) == "Short.\n\nShort."


NAMES = [
    "comments-area", "comment-list", "ad-slot", "ad_box", "advert-top", "cookie-banner",
    "cookie-notice", "site-footer", "page-header", "sidebar-left", "main-nav", "newsletter-signup",
    "share-buttons", "widget-area", "pageHeader", "ad1", "box comments", "siteSidebar2",
]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("kind", ["class", "id"])
def test_named_parts_in_and_beside_the_article_are_skipped(name, kind):
    part = f'<div {kind}="{name}"><p>{ARTICLE} Not this, even if it is a little longer.</p></div>'
    for page in (
        f"<article><h1>Title</h1><p>{ARTICLE}</p>{part}<p>{ARTICLE}</p></article>",
        f"<article><h1>Title</h1><p>{ARTICLE}</p><p>{ARTICLE}</p></article>{part}",
        f"{part}<main><h1>Title</h1><p>{ARTICLE}</p><p>{ARTICLE}</p></main>{part}",
        f"<div class=post><h1>Title</h1><p>{ARTICLE}</p><p>{ARTICLE}</p></div>{part}",
        f"<div class=with-sidebar>{part}<div class=post><h1>Title</h1><p>{ARTICLE}</p>{part}<p>"
        f"{ARTICLE}</p></div></div>",
    ):
        assert html_text.read_page(page).text(None) == f"Title\n\n{ARTICLE}\n\n{ARTICLE}"


def test_long_comments_are_never_the_article():
    comments = f'<div class="comments-area">{f"<p>{ARTICLE} Comment.</p>" * 20}</div>'
    for own in ("article", "main", "div"):
        for page in (f"<{own}><p>{ARTICLE}</p><p>{ARTICLE}</p>{comments}</{own}>",
                     f"<{own}><p>{ARTICLE}</p><p>{ARTICLE}</p></{own}>{comments}"):
            text = html_text.read_page(page).text(None)
            assert own == "div" or text == f"{ARTICLE}\n\n{ARTICLE}"
    page = f"<div class='post'><p>{ARTICLE}</p></div>" * 3 + f"<div class=comments><p>{ARTICLE * 9}</p></div>"
    assert ARTICLE * 9 not in html_text.read_page(page).text(None)


def test_own_headers_and_figures_of_an_article_are_read():
    page = (
        f"<header><p>{ARTICLE} Site.</p></header><article><header class='entry-header'><h1>Title</h1>"
        f"</header><p>{ARTICLE}</p><figure><pre>a = 1</pre><img><figcaption>Caption</figcaption>"
        f"</figure><p>{ARTICLE}</p><footer>Tags</footer></article>"
    )
    assert html_text.read_page(page).text(None) == (
        f"Title\n\n{ARTICLE}\n\na = 1\n\nCaption\n\n{ARTICLE}"
    )


@pytest.mark.parametrize("depth", [260, 1000, 20_000])
def test_depth_has_no_limit(depth):
    page = (
        "<div>" * depth + f"<nav>Menu</nav><div class=ad><p>{ARTICLE} Buy.</p></div><div class=post><p>"
        f"{ARTICLE}</p><p>{ARTICLE}</p></div>" + "</div>" * depth + f"<footer>{ARTICLE} End.</footer>"
    )
    read = html_text.read_page(page)
    assert read.text(None) == f"{ARTICLE}\n\n{ARTICLE}" == read.text(read.best().path)


# --- a plain restatement: a tree by the standard parser, all else by its definition -----------


class Tree(HTMLParser):
    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.root = {"tag": "", "up": None, "named": {}, "order": 0, "kids": 0}
        self.all, self.here = [self.root], self.root
        self.pieces, self.blocks, self.raw, self.links = [], [], 0, 0
        self.feed(html)
        self.close()
        self.end()

    def end(self):
        text = " ".join("".join(t for t, _ in self.pieces).split())
        linked = sum(n for _, n in self.pieces)
        self.pieces = []
        if text:
            self.blocks.append((text, self.here, max(0, len(text) - 2 * linked) * min(1, len(text) / 80)))

    def handle_starttag(self, tag, attrs):
        if tag in html_text.RAW.split("|"):
            self.raw += 1
        if self.raw:
            return
        if tag == "br":
            self.pieces.append((" ", 0))
        elif tag == "hr":
            self.end()
        elif tag == "a":
            self.links += 1
        elif tag in html_text.CONTAINERS:
            self.end()
            while self.here["up"] and (self.here["tag"] == "p" or tag in html_text.CLOSED_BY.get(self.here["tag"], ())):
                self.here = self.here["up"]
            self.links = 0
            node = {"tag": tag, "up": self.here, "named": {k: v or "" for k, v in attrs}, "order": len(self.all)}
            self.all.append(node)
            self.here = node

    def handle_endtag(self, tag):
        if tag in html_text.RAW.split("|"):
            self.raw = max(0, self.raw - 1)
        elif self.raw:
            return
        elif tag == "a":
            self.links = max(0, self.links - 1)
        elif tag in html_text.CONTAINERS:
            self.end()
            if any(n["tag"] == tag for n in up(self.here)[:-1]):
                while self.here["tag"] != tag:
                    self.here = self.here["up"]
                self.here, self.links = self.here["up"], 0

    def handle_data(self, data):
        if not self.raw:
            self.pieces.append((data, len(data) if self.links else 0))


def up(node):
    return [node, *up(node["up"])] if node else []


def plain_page(html):
    """Blocks and scores of a page, each by walking the tree from the start."""
    tree = Tree(html)

    def path(n):
        steps = []
        for m in reversed(up(n)):
            classes = sorted(set(html_text._DIGITS.sub("#", m["named"].get("class", "")).split()))
            steps.append(".".join([m["tag"], *classes]))
        return " > ".join(steps)

    def skipped(n):
        tags = [m["tag"] for m in up(n)[1:]]
        return n["tag"] in html_text.SKIPPED and not (n["tag"] == "header" and "article" in tags)

    def doubt(n):
        if n["tag"] in ("html", "body", "main", "article"):
            return 0
        names = " ".join(n["named"].get(k, "") for k in ("class", "id", "role"))
        return max(html_text.doubts(names), n["tag"] == "form")

    def article(n):
        own = [m for m in up(n) if m["tag"] in ("article", "main")]
        if not own:
            return None
        last = own[-1]
        inner = [m for m in own if m["tag"] == "article"]
        return inner[-1] if last["tag"] == "main" and inner else last

    live = [b for b in tree.blocks if not any(map(skipped, up(b[1])))]
    inside = lambda n: [b for b in live if n in up(b[1])]

    def clean(b):
        own = article(b[1])
        return own and not any(doubt(m) for m in up(b[1])[: up(b[1]).index(own)])

    total = sum(b[2] for b in live)
    outside = sum(b[2] for b in live if all(doubt(m) < 2 for m in up(b[1])))
    has_own = sum(b[2] for b in live if clean(b)) > 0

    def dropped(n):
        if not doubt(n):
            return False
        running = sum(b[2] for b in inside(n))
        own = sum(b[2] for b in inside(n) if clean(b)) > 0
        enough = running >= html_text.MOST * total if doubt(n) == 1 else outside <= html_text.LEAST * total
        return not (running > 0 and enough and (own or not has_own))

    kept = [b for b in live if not any(map(dropped, up(b[1])))]
    score = defaultdict(float)
    for _, n, gain in kept:
        holders = [m for m in up(n) if m["tag"] not in html_text.LEAVES]
        weight = 1.0
        for m in holders[:4]:
            score[m["order"]] += weight * gain
            weight /= 2
    best = max(score, key=lambda o: (score[o], -o), default=None)
    best = tree.all[best] if best is not None and score[best] > 0 else None
    best = best and (article(best) or best)
    return tree, kept, path, best


def plain_texts(pages):
    read = {k: plain_page(html or "") for k, _, html in pages}
    votes = defaultdict(Counter)
    for k, host, _ in pages:
        _, _, path, best = read[k]
        if best:
            votes[host][path(best)] += 1
    won = {h: min(v.items(), key=lambda x: (-x[1], x[0]))[0] for h, v in votes.items()}
    out = {}
    for k, host, _ in pages:
        _, kept, path, best = read[k]
        chosen = [t for t, n, _ in kept if any(path(m) == won.get(host) for m in up(n) if m["tag"] not in html_text.LEAVES)]
        out[k] = "\n\n".join(chosen or [t for t, n, _ in kept if best and best in up(n)])
    return out


def test_extraction_is_the_plain_one(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r.page_id, urlparse(r.url or "").hostname or "", r.html) for r in pages.collect()]
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got == plain_texts(rows)


def test_self_closed_drawings_are_empty():
    page = f'<p>{ARTICLE}</p><svg viewBox="0 0 > 1"/><p>{ARTICLE}</p><svg><text>no</text></svg>'
    assert html_text.read_page(page).text(None) == f"{ARTICLE}\n\n{ARTICLE}"


def test_quoted_values_that_end_no_tag_cost_linear_time():
    for part in ("<a b=\"<a b='", "<a b='\"' c=\"'\"", "<a b=\"<a c='x' \"", "<p =' "):
        html_text.read_page(part * 30_000).text(None)
    html_text.read_page("<a b='<a " + "c=\"<a d='\" e='<a" * 30_000).text(None)


def test_unclosed_tags_cost_linear_time():
    for part in ("<div>", "<p ", '<a b="', "<script ", "<!-- ", "<", "<p class='x"):
        html_text.read_page(part * 30_000).text(None)


def test_pages_of_a_host_agree(spark):
    """A page whose own best container is another one follows the others of its host."""
    wide = " ".join([ARTICLE] * 4)
    usual = f'<div class="post 12"><p>{ARTICLE}</p></div><div class="teaser"><p>Short.</p></div>'
    odd_one = f'<div class="post 13"><p>{ARTICLE}</p></div><div class="teaser"><p>{wide}</p></div>'
    rows = [(i, f"http://A.example/{i}", usual) for i in range(5)] + [
        (7, "http://a.example/7", odd_one), (8, "http://b.example/", odd_one), (9, None, None),
        (None, "no url", ""), (9, "http://a.example", "<p>only</p>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_text.extract(pages)
    texts = sorted((r.page_id or -1, r.url or "", r.text, r.n_chars) for r in got.collect())
    assert len(texts) == len(rows) and all(n == len(t) for _, _, t, n in texts)
    by_key = {(i, u): t for i, u, t, _ in texts}
    assert by_key[7, "http://a.example/7"] == ARTICLE
    assert by_key[8, "http://b.example/"] == wide
    assert by_key[9, ""] == by_key[-1, "no url"] == ""
    assert by_key[9, "http://a.example"] == "only"
    assert odd.same_rows(got, html_text.extract(odd.clashing(pages)))
    assert html_text.extract(pages.limit(0)).collect() == []

"""Main text of web pages by a tree-structured graphical model over the DOM.

A page becomes a tree: its block elements, and as leaves the runs of text between their borders. Every node is
content or not. A node's label depends on its parent's through a potential, and what is seen at the node (tag,
words of class, id and role, share of text in links, length) depends on its label. Sum-product messages pass
upward from the leaves and downward from the root; their product is each node's marginal. Leaves whose marginal
is over one half make up the text.

The potentials are counted from labelled pages: a few are part of this module and show every kind of page part
once; the others are a bounded sample of pages that mark their article themselves. Parsing is a single scan with
one regular expression; attribute values and raw text such as scripts are skipped by it. Formulas, the text of
objects and preformatted text are text like any other.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text runs to their closing tag, or to the end of the page, whatever stands in it.
RAW = frozenset("script style iframe textarea title noembed noframes xmp".split())
#: Elements that are seldom content: nodes of their own where they are closed, else only their tag is passed over.
ASIDES = frozenset("svg select button template noscript".split())
MATH = frozenset(
    "math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt mroot mover munder munderover mtable mtr mtd mstyle "
    "mspace mpadded mphantom menclose merror mmultiscripts mprescripts semantics annotation annotation-xml".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img object".split()
) | MATH
#: Elements that end an open paragraph when they begin.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: Elements that end an open one of the same kind, up to the element that holds such lists.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
#: Words of class, id and role that say what a part is for. The rest of such words is not looked at.
KEYWORDS = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs",
    "header": "header banner masthead topbar",
    "footer": "footer contentinfo colophon copyright",
    "aside": "sidebar aside complementary rail widget widgets",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted",
    "notice": "cookie cookies consent notice notices alert popup modal overlay gdpr disclaimer",
    "comment": "comment comments reply replies disqus respond discussion",
    "share": "share sharing social related recommended recommendations newsletter subscribe signup trending",
    "form": "form search login",
    "main": "article content main post entry body text story",
}
_KEYWORD = {word: kind for kind, every in KEYWORDS.items() for word in every.split()}
_AGAINST = frozenset(KEYWORDS) - {"main"}
_OTHER_PARTS = frozenset({"nav", "aside", "footer", "form"}) | ASIDES
#: Elements that only hold others; one with a single element in it and no words of its own is left out.
_WRAPPERS = frozenset("div section center span tbody thead tfoot html body".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>",
    re.DOTALL,
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(slots=True)
class Node:
    tag: str
    kinds: tuple[str, ...] = ()
    children: list[Node] = field(default_factory=list)
    text: str = ""
    #: Characters of text, and those of them in links, in all of the subtree.
    chars: int = 0
    linked: int = 0
    label: int = -1
    #: Whether the page says of this part that it is content (see ``SEED_PAGES``).
    marked: bool = False


def _kinds(attributes: str) -> tuple[str, ...]:
    found = []
    for name, value in _NAMES.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            found += [_KEYWORD[w] for w in map(str.lower, _WORDS.findall(value)) if w in _KEYWORD]
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            found.append("hidden")
        elif name == "style" and _HIDDEN.search(value):
            found.append("hidden")
    return tuple(dict.fromkeys(found))


def parse(page: str) -> Node:
    """The tree of a page. Leaves have the tag ``#text``; elements without text below are left out."""
    root = Node("#root")
    stack: list[Node] = [root]
    # Places of the open elements on the stack, by name: no tag makes a walk over the stack necessary.
    places: dict[str, list[int]] = defaultdict(list)
    pieces: list[str] = []
    plain = linked = depth_a = 0
    at = 0

    def flush() -> None:
        nonlocal plain, linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                share = linked / max(plain + linked, 1)
                leaf = Node("#text", text=text, chars=len(text), linked=round(share * len(text)))
                stack[-1].children.append(leaf)
        plain = linked = 0

    def close(k: int) -> None:
        flush()
        while len(stack) > k:
            node = stack.pop()
            places[node.tag].pop()
            if len(node.children) == 1 and node.tag in _WRAPPERS and not (node.kinds or node.marked):
                if node.children[0].tag != "#text":
                    stack[-1].children.append(node.children[0])
                    continue
            if node.children:
                node.chars = sum(c.chars for c in node.children)
                node.linked = sum(c.linked for c in node.children)
                stack[-1].children.append(node)

    def push(node: Node) -> None:
        places[node.tag].append(len(stack))
        stack.append(node)

    def last(*tags: str) -> int:
        """Place of the last open element of one of these, 0 if there is none."""
        return max((places[x][-1] for x in tags if places[x]), default=0)

    def say(text: str) -> None:
        nonlocal plain, linked
        if text:
            pieces.append(text)
            if depth_a:
                linked += len(text)
            else:
                plain += len(text)

    end = len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if not found:
            rest = page[at:]
            say(rest)
            break
        say(page[at : found.start()])
        at = found.end()
        tag = found[2]
        if not tag:
            continue
        tag = tag.lower()
        if found[1]:
            if tag == "a":
                depth_a = max(depth_a - 1, 0)
            elif tag == "p" and not last("p"):
                flush()
            if k := last(tag):
                close(k)
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            if not found[3].rstrip().endswith("/"):
                if tag == "xmp":
                    flush()
                    push(Node("pre", _kinds(found[3])))
                    say(html.escape(page[at : stop.start() if stop else end]))
                    close(len(stack) - 1)
                at = stop.end() if stop else end
            pieces.append(" ")
            continue
        if tag in ASIDES:
            # Closed if the next tag of this name is a closing one.
            stop = re.compile(rf"<(/?){tag}\b[^>]*>", re.I).search(page, at)
            if not (stop and stop[1]) or found[3].rstrip().endswith("/"):
                pieces.append(" ")
                continue
            # Without words in it, it does not part the text around it.
            if not _TOKEN.sub("", page[at : stop.start()]).strip():
                at = stop.end()
                pieces.append(" ")
                continue
        if tag == "br":
            pieces.append(" ")
            continue
        kinds = _kinds(found[3]) if found[3] else ()
        if tag in INLINE:
            if tag == "a":
                depth_a = 1
            # An inline element that is said to be no content is a node of its own.
            if tag != "img" and any(k in _AGAINST or k == "hidden" for k in kinds):
                flush()
                push(Node(tag, kinds))
            continue
        if tag in ENDS_PARAGRAPH:
            if last("p") > last("td", "th", "button", "object"):
                close(last("p"))
        elif tag in SIBLINGS:
            same, holders = SIBLINGS[tag]
            while (k := last(*same)) > last(*holders):
                close(k)
                if stack[k - 1].tag not in same:
                    break
        flush()
        depth_a = 0
        if tag not in VOID:
            push(Node(tag, kinds, marked=" data-c" in found[3]))
    close(1)
    root.chars = sum(c.chars for c in root.children)
    root.linked = sum(c.linked for c in root.children)
    return root


def features(node: Node) -> tuple[str, ...]:
    """What is seen at a node, as names with a fixed number of values each."""
    share = node.linked / node.chars if node.chars else 0.0
    links = "0" if share < 0.1 else "1" if share < 0.5 else "2" if share < 0.9 else "3"
    size = str(min(max(node.chars, 1).bit_length() // 2, 5))
    if node.tag == "#text":
        ended = "1" if node.text[-1] in ".!?…\"”:;" else "0"
        return (f"leaf links {links}", f"leaf size {size}", f"leaf ended {ended}")
    tag = node.tag if node.tag in _KNOWN_TAGS else "other"
    return (f"tag {tag} {links}", *(f"kind {k}" for k in node.kinds))


_KNOWN_TAGS = frozenset(
    "#root html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre figure "
    "figcaption nav header footer aside form a span svg select button template noscript".split()
)

# Labelled pages. The mark data-c opens a part that is content.
SEED_PAGES = (
    "<html><body><header class='site-header'><a href=/>Home</a><p>The daily paper of the town</p></header>"
    "<nav class=menu><ul><li><a href=/a>News</a></li><li><a href=/b>Sport</a></li></ul></nav><main data-c>"
    "<article><header><h1>A heading of some words</h1></header><p>The first paragraph tells what happened in the "
    "town, at some length, and with a <a href=/x>link</a> in it.</p><h2>Further on</h2><p>The second paragraph goes on "
    "with the story and comes to an end.</p><ul><li>One thing that was seen there</li><li>Another one</li></ul>"
    "<table><tr><th>Place</th><td>The old town hall</td></tr></table>"
    "<blockquote>It was said by those who were there.</blockquote></article></main><aside class=sidebar><h3>Latest</h3>"
    "<ul><li><a href=/1>Something else that happened elsewhere</a></li></ul><p>All of it on our other pages.</p></aside>"
    "<footer class=footer><p>Copyright of the paper. All rights reserved.</p><a href=/t>Terms</a></footer></body></html>",
    "<body><div id=cookie-notice class=notice><p>We use cookies to make this site better for you.</p><a>Accept</a></div>"
    "<div id=header class=header><p>Name of the site</p><form class=search><p>Search here</p></form></div>"
    "<div class=content data-c><h1>How it is done</h1><p>To do this one first takes the thing by the end and turns it "
    "until it holds.</p><pre>do this and then that</pre><table><tr><td>first</td><td>10</td></tr></table><p>Then it is "
    "done.</p></div><div class=ad><p>Buy the best things here today, for less.</p></div><div class=share><a>Share</a>"
    "</div><section class=comments id=comments><h3>Comments</h3><div class=comment><p>I liked this one very much, thank "
    "you for all of it.</p></div><div class=comment><p>Not so sure that this is right.</p></div><form class=form><p>Leave "
    "a reply to this.</p></form></section><div class=sidebar><p>About this site and who writes it.</p></div>"
    "<div id=footer class=footer><p>Made by us with care.</p></div></body>",
    "<body><nav><a href=/>Home</a><a href=/c>Contact</a></nav><div data-c><div><h1>Title of a plain page</h1><div><p>Some "
    "pages have no names on their parts, only text in paragraphs, one after the other.</p><p>Those are content all the "
    "same, as they are long and have few links.</p><ol><li>First</li><li>Second</li></ol></div></div></div>"
    "<div class=related><h3>More</h3><ul><li><a href=/2>Another page</a></li></ul></div><div class=newsletter><p>Get our "
    "letter every week by mail.</p><form><p>Your address</p></form></div><aside><p>An aside on something else entirely."
    "</p></aside><footer>Imprint <a href=/i>here</a></footer></body>",
    "<body><header><h2>Journal</h2><ul class=nav><li><a href=/a>All</a></li></ul></header><article class=post data-c><h1>On "
    "a thing</h1><section><h2>Start</h2><p>It begins here and is told in full.</p></section><section><h2>End</h2><p>It ends "
    "here.</p><dl><dt>Word</dt><dd>What it means in this text.</dd></dl></section><figure><figcaption>A picture of the "
    "thing</figcaption></figure></article><section id=respond class=comments><ol><li><p>Reader: this was a good read, thanks."
    "</p></li></ol></section><div class=popup><p>Subscribe now and never miss a thing.</p></div><div class=banner><p>Sale "
    "ends soon.</p></div><footer><p>All text is ours.</p><nav><a>Up</a></nav></footer></body>",
    "<body><article data-c><h1>Short</h1><p>Yes.</p><p>No.</p><p>Perhaps one day.</p></article></body>",
    "<body><button>Menu</button><svg><text>Logo</text></svg><noscript>Please turn on scripts to see this page.</noscript>"
    "<template><p>Name of a thing and what it costs.</p></template><select><option>English</option><option>German"
    "</option></select><article data-c><h1>A page with tools</h1><p>What it tells is in this paragraph alone.</p></article>"
    "<button>Up</button></body>",
)


@dataclass
class Potentials:
    """Logarithms: of the label of a node given its parent's, and of what is seen given the label."""

    pair: tuple[tuple[float, float], tuple[float, float]]
    seen: dict[str, tuple[float, float]]


def _label(root: Node, seed: bool = False) -> None:
    """Label by the page's own marks. Of a seed page that is the mark; else an article is content, and what in
    it is for something else is not. A node that holds content is labelled so, too.
    """
    order: list[tuple[Node, bool | None]] = []
    stack: list[tuple[Node, bool | None]] = [(root, None)]
    while stack:
        node, inside = stack.pop()
        if seed:
            inside = inside or node.marked
        else:
            if inside is None and node.tag in ("article", "main"):
                inside = True
            if inside and (node.tag in _OTHER_PARTS or any(k in _AGAINST or k == "hidden" for k in node.kinds)):
                inside = False
        order.append((node, inside))
        stack.extend((c, inside) for c in node.children)
    for node, inside in reversed(order):
        node.label = int(bool(inside) or any(c.label for c in node.children))


def count_labels(root: Node, counts: Counter, weight: float = 1.0) -> None:
    stack = [(root, 1)]
    while stack:
        node, above = stack.pop()
        counts["pair", above, node.label] += weight
        for name in features(node):
            counts[name, node.label, 1] += weight
        counts["leaf" if node.tag == "#text" else "node", node.label, 1] += weight
        stack.extend((c, node.label) for c in node.children)


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages to counts of their labels, once per task. Pages that mark no article teach nothing."""
    counts: Counter = Counter()
    for batch in batches:
        for page in batch.column(0).to_pylist():
            root = parse(page)
            _label(root)
            if root.label:
                count_labels(root, counts)
                counts["pages", 0, 0] += 1
    names, a, b = zip(*counts, strict=True) if counts else ((), (), ())
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(counts.values(), pa.float64())],
        ["__name", "__a", "__b", "__n"],
    )


def potentials(counts: Counter) -> Potentials:
    """Smoothed shares. A feature's kinds are read against the number of nodes of the same sort and label."""
    pair = []
    for above in (0, 1):
        n = [counts["pair", above, below] + 0.5 for below in (0, 1)]
        pair.append(tuple(math.log(x / sum(n)) for x in n))
    seen = {}
    for name in sorted({k[0] for k in counts if " " in k[0]}):
        sort = "leaf" if name.startswith("leaf") else "node"
        shares = [(counts[name, y, 1] + 0.5) / (counts[sort, y, 1] + 5.0) for y in (0, 1)]
        seen[name] = (math.log(shares[0]), math.log(shares[1]))
    return Potentials((pair[0], pair[1]), seen)


def train_pages(pages: DataFrame, sample_pages: int = 2000, html_col: str = "html") -> Potentials:
    """Potentials from the seed pages and a sample of about ``sample_pages`` pages, chosen by a hash.

    Spark counts the sample; a few hundred counts come to the driver. The seed pages, together, weigh as much
    as the sample.
    """
    rows = pages.select(F.col(html_col).cast("string").alias("__html")).where("__html IS NOT NULL")
    n = rows.count()
    counts: Counter = Counter()
    if n:
        unit = F.pmod(F.xxhash64("__html"), F.lit(1_000_000))
        sample = rows.where(unit < min(1_000_000, math.ceil(1_000_000 * sample_pages / n)))
        found = sample.mapInArrow(_sample_counts, "__name string, __a int, __b int, __n double")
        found = found.groupBy("__name", "__a", "__b").agg(F.sum("__n").alias("__n"))
        counts.update({(r["__name"], r["__a"], r["__b"]): r["__n"] for r in found.collect()})
    weight = max(1.0, counts.pop(("pages", 0, 0), 0) / len(SEED_PAGES))
    for page in SEED_PAGES:
        root = parse(page)
        _label(root, seed=True)
        count_labels(root, counts, weight)
    return potentials(counts)


def _add(a: float, b: float) -> float:
    """Logarithm of the sum of two numbers given by their logarithms."""
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def marginals(root: Node, model: Potentials) -> list[tuple[Node, float]]:
    """(node, probability that it is content) in page order, by messages upward and then downward."""
    order, parent = [], []
    stack = [(root, -1)]
    while stack:
        node, up = stack.pop()
        me = len(order)
        order.append(node)
        parent.append(up)
        stack.extend((c, me) for c in reversed(node.children))
    pair, seen = model.pair, model.seen
    inner0, inner1 = [0.0] * len(order), [0.0] * len(order)
    for k, node in enumerate(order):
        for name in features(node):
            if name in seen:
                s = seen[name]
                inner0[k] += s[0]
                inner1[k] += s[1]
    up0, up1 = [0.0] * len(order), [0.0] * len(order)
    for k in range(len(order) - 1, 0, -1):
        up0[k] = _add(pair[0][0] + inner0[k], pair[0][1] + inner1[k])
        up1[k] = _add(pair[1][0] + inner0[k], pair[1][1] + inner1[k])
        inner0[parent[k]] += up0[k]
        inner1[parent[k]] += up1[k]
    # The node above the root counts as content.
    down0, down1 = [0.0] * len(order), [0.0] * len(order)
    down0[0], down1[0] = pair[1]
    out = []
    for k, node in enumerate(order):
        if k:
            above = parent[k]
            rest0 = down0[above] + inner0[above] - up0[k]
            rest1 = down1[above] + inner1[above] - up1[k]
            down0[k] = _add(rest0 + pair[0][0], rest1 + pair[1][0])
            down1[k] = _add(rest0 + pair[0][1], rest1 + pair[1][1])
        a, b = down0[k] + inner0[k], down1[k] + inner1[k]
        out.append((node, 1 / (1 + math.exp(min(a - b, 700.0)))))
    return out


def main_text(page: str | None, model: Potentials) -> str:
    if not page:
        return ""
    found = marginals(parse(page), model)
    return "\n\n".join(node.text for node, p in found if node.tag == "#text" and p > 0.5)


def _extract(model: Potentials):
    """Rows whose last column is the page to rows (other columns, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(page, model) for page in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string())], [*part.schema.names[:-1], "text"]
                )

    return run


def extract_text(
    pages: DataFrame, model: Potentials, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html"
) -> DataFrame:
    """The columns ``keep`` and ``text``: blocks of content in page order, joined by an empty line.

    Defined cases: a null, empty or text-free page has an empty text; text outside any element is a block;
    unclosed elements end where HTML ends them or with the page (raw text such as scripts swallows the rest of it);
    of an svg, select, button, template or noscript that is not closed only the tag is left out; repeated rows get equal results; an empty
    table gives no rows.
    """
    names = [f"__p{k}" for k in range(len(keep))]
    rows = pages.select(
        *[F.col(c).alias(p) for c, p in zip(keep, names, strict=True)], F.col(html_col).cast("string").alias("__html")
    )
    kinds = "".join(f"{p} {rows.schema[p].dataType.simpleString()}, " for p in names)
    out = rows.mapInArrow(_extract(model), f"{kinds}text string")
    return out.withColumnsRenamed(dict(zip(names, keep, strict=True)))

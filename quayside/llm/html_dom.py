"""Page parsing for op2: a tree of block elements and text runs, and features of its nodes."""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np

#: Quotes count after an equals sign only. A quoted value of any length may hold ">" if it ends like a value: a quote that is
#: not closed, or only by the opening quote of a later value, does not take the rest of the page.
_VALUE = r"""(?:"[^">]*"|'[^'>]*'|"[^"]*"(?=[\s/>])|'[^']*'(?=[\s/>])|[^\s"'>][^\s>]*+)"""
_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>[^>=]++|=\s*+{_VALUE}?)*+)>", re.S)
_ATTR = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TOKEN = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

# HTML element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe xmp".split())  # no markup inside
HIDDEN = frozenset("noscript template svg annotation annotation-xml object select button canvas audio video head".split())  # no text of the page
BLOCK = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption"
    " nav header footer aside menu form fieldset legend blockquote pre figure figcaption address details summary dialog"
    " hgroup search center hr".split()
)
CLOSES = {  # opening the key closes an open one of these, up to the boundary
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
GROUPS = (
    ("article", "main"),
    ("section", "div", "center", "figure", "details", "dialog"),
    ("p", "blockquote", "pre", "figcaption"),
    ("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"),
    ("ul", "ol", "li", "dl", "dt", "dd", "menu"),
    ("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"),
    ("nav", "header", "footer", "aside", "search", "address"),
    ("form", "fieldset", "legend"),
)
# Tokens of class, id and role attributes by what they tell.
ATTRIBUTE_TOKENS = (
    ("article", "content", "entry", "post", "story", "main", "body", "text", "prose", "page"),
    ("nav", "navigation", "navbar", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc", "tabs", "skip"),
    ("ad", "ads", "advert", "advertisement", "advertising", "promo", "promotion", "sponsor", "sponsored", "banner", "adsense", "offer"),
    ("comment", "comments", "reply", "replies", "disqus", "discussion", "respond", "responses", "thread", "feedback"),
    ("footer", "foot", "copyright", "legal", "colophon", "imprint", "credits"),
    ("header", "head", "masthead", "topbar", "logo", "branding"),
    ("sidebar", "side", "aside", "widget", "related", "recommended", "recommendations", "popular", "trending", "more", "tags", "tag", "rail"),
    ("cookie", "cookies", "consent", "gdpr", "notice", "alert", "newsletter", "subscribe", "subscription", "signup", "popup", "modal", "overlay", "dialog", "complementary", "contentinfo"),
    ("share", "sharing", "social", "follow", "login", "search", "form", "hidden"),
)
_WHICH = {w: i for i, words in enumerate(ATTRIBUTE_TOKENS) for w in words}
_GROUP = {t: i for i, tags in enumerate(GROUPS) for t in tags}
N_FEATURES = 2 * len(GROUPS) + 3 * len(ATTRIBUTE_TOKENS) + 30


class Node:
    __slots__ = ("tag", "marks", "parent", "children", "text", "link_chars", "truth", "inputs")

    def __init__(self, tag: str, parent: int, marks: tuple[int, ...] = (), truth: bool | None = None):
        self.tag, self.parent, self.marks, self.truth = tag, parent, marks, truth
        self.children: list[int] = []
        self.text = ""
        self.link_chars = self.inputs = 0


def _marks(attrs: str) -> tuple[tuple[int, ...], bool | None]:
    """Which attribute tokens stand in class, id and role; the label of a training page."""
    if not attrs or attrs.isspace():
        return (), None
    found, truth = set(), None
    for m in _ATTR.finditer(attrs):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role", "aria-label"):
            found.update(_WHICH[t] for t in _TOKEN.findall(_CAMEL.sub(" ", value).lower()) if t in _WHICH)
        elif name == "hidden" or (name == "style" and "display:none" in value.replace(" ", "").lower()):
            found.add(len(ATTRIBUTE_TOKENS) - 1)
        elif name == "data-truth":
            truth = value == "1"
    return tuple(found), truth


def parse(page: str) -> list[Node]:
    """Block elements and text runs in page order; node 0 is the root. A run's tag is ``#text``."""
    nodes = [Node("#root", -1)]
    stack: list[tuple[str, int]] = [("#root", 0)]  # (tag, its block node)
    open_ = Counter()  # elements on the stack
    run: list[str] = []
    links = [0, 0]  # characters of the run in links; hidden elements that are open
    at, size = 0, len(page)
    last = page.rfind(">") + 1  # no tag ends behind it
    if page.rfind("<!--") >= last:
        last = size

    def flush() -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                parent = stack[-1][1]
                node = Node("#text", parent)
                node.text, node.link_chars = text, min(links[0], len(text))
                nodes[parent].children.append(len(nodes))
                nodes.append(node)
            run.clear()
        links[0] = 0

    def close(upto: int) -> None:
        for tag, _ in stack[upto:]:
            open_[tag] -= 1
            links[1] -= tag in HIDDEN
        del stack[upto:]

    def add(tag: str, node: int) -> None:
        stack.append((tag, node))
        open_[tag] += 1

    while at < size:
        m = _TAG.search(page, at, last)
        end = m.start() if m else size
        if end > at and not links[1]:
            piece = page[at:end]
            run.append(piece)
            if open_["a"]:
                links[0] += len(piece.strip())
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = size
            continue
        tag = tag.lower()
        if m[1]:
            if tag in BLOCK and not links[1]:
                flush()
            if open_[tag]:
                where = next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag)
                ended = [t for t, _ in stack[where:]]
                if any(t in BLOCK for t in ended) and (not links[1] or (tag not in HIDDEN and any(t in HIDDEN for t in ended))):
                    flush()
                if tag in HIDDEN:
                    run.append(" ")
                close(where)
            continue
        if tag in RAW:
            if tag == "textarea":
                nodes[stack[-1][1]].inputs += 1
            stop = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = size if stop is None else stop.start()
            run.append(" ")
            continue
        if tag in BLOCK and open_["head"]:  # the head ends where the body begins, said or not
            close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == "head"))
        if tag in ("input", "select", "button"):
            nodes[stack[-1][1]].inputs += 1
        if tag in ("select", "button") and open_[tag]:  # one in another closes it
            close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag))
        if tag == "br":
            run.append(" ")
            continue
        if tag in VOID and tag != "hr":
            continue
        if tag in HIDDEN:
            run.append(" ")
            if not (tag == "svg" and m[3].endswith("/")):
                add(tag, stack[-1][1])
                links[1] += 1
            continue
        if links[1]:  # inside a hidden element only its own kind of ends count
            if tag not in VOID:
                add(tag, stack[-1][1])
            continue
        if tag not in BLOCK:
            add(tag, stack[-1][1])
            continue
        flush()
        closing, bounds = CLOSES.get(tag, ({"p"}, {"div", "article", "section", "main", "body", "td", "th", "li", "blockquote", "form", "aside", "footer", "header"}))
        if any(open_[t] for t in closing):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in closing:
                    close(i)
                    break
                if stack[i][0] in bounds:
                    break
        if tag == "hr":
            continue
        marks, truth = _marks(m[3])
        parent = stack[-1][1]
        nodes[parent].children.append(len(nodes))
        add(tag, len(nodes))
        nodes.append(Node(tag, parent, marks, truth))
    flush()
    return nodes


def features(nodes: list[Node]) -> np.ndarray:
    """A row for each node: its element, attribute tokens (own, inherited, of its subtree), depth,
    density of text, links and elements in the subtree, its place among its siblings and in the page."""
    n, g, a = len(nodes), len(GROUPS), len(ATTRIBUTE_TOKENS)
    chars = [0.0] * n
    words = [0.0] * n
    stops = [0.0] * n
    links = [0.0] * n
    tags = [0.0] * n
    runs = [0.0] * n
    inputs = [0.0] * n
    depth = [0] * n
    before = [0.0] * n
    group, group_above = [0] * n, [0] * n  # a bit for each group, and for each kind of tokens
    mark, mark_above = [0] * n, [0] * n
    seen = 0.0
    for i, node in enumerate(nodes):
        p = node.parent
        if p >= 0:
            depth[i] = depth[p] + 1
            group_above[i] = group_above[p] | group[p]
            mark_above[i] = mark_above[p] | mark[p]
        k = _GROUP.get(node.tag)
        if k is not None:
            group[i] = 1 << k
        for k in node.marks:
            mark[i] |= 1 << k
        before[i] = seen
        if node.tag == "#text":
            t = node.text
            chars[i], words[i], links[i], runs[i] = len(t), t.count(" ") + 1, node.link_chars, 1
            stops[i] = t.count(".") + t.count("!") + t.count("?") + t.count(",")
            seen += len(t)
        else:
            tags[i] = 1
            inputs[i] = node.inputs
    mark_below = mark.copy()
    for i in range(n - 1, 0, -1):  # children stand after their parents
        p = nodes[i].parent
        chars[p] += chars[i]
        words[p] += words[i]
        stops[p] += stops[i]
        links[p] += links[i]
        tags[p] += tags[i]
        runs[p] += runs[i]
        inputs[p] += inputs[i]
        mark_below[p] |= mark_below[i]
    total = max(1.0, chars[0])
    place, like = [0] * n, [1] * n
    kin = [(0.0, 0.0, 0.0, 0.0)] * n  # of the siblings of the same kind: characters, in links, signs that end clauses, the most characters
    best = [0.0] * n  # the most characters of a child
    for i, node in enumerate(nodes):
        if node.children:
            alike: dict[tuple, list[int]] = {}
            for at, j in enumerate(node.children):
                place[j] = at
                alike.setdefault((nodes[j].tag, nodes[j].marks), []).append(j)
            for own in alike.values():
                sums = sum(chars[j] for j in own), sum(links[j] for j in own), sum(stops[j] for j in own), max(chars[j] for j in own)
                for j in own:
                    like[j], kin[j] = len(own), sums
            best[i] = max(chars[j] for j in node.children)
    left, right, family = [0.0] * n, [0.0] * n, [1] * n
    for node in nodes:
        row = node.children
        for at, j in enumerate(row):
            family[j] = len(row)
            if at:
                left[j] = chars[row[at - 1]]
                right[row[at - 1]] = chars[j]
    p = np.maximum([node.parent for node in nodes], 0)
    chars_, words_, links_, stops_, tags_, best_ = (np.array(v, np.float64) for v in (chars, words, links, stops, tags, best))
    s, same, kin_ = np.array(family, np.float64), np.array(like, np.float64), np.array(kin, np.float64)
    some, of_kin = np.maximum(chars_, 1), kin_[:, 0]
    bits = lambda values, width: (np.array(values)[:, None] >> np.arange(width)) & 1
    rest = (
        [node.tag == "#text" for node in nodes], depth, np.log1p(chars_), np.log1p(words_), chars_ / np.maximum(words_, 1),
        stops_ / np.maximum(words_, 1), links_ / some, np.log1p(chars_ / np.maximum(tags_, 1)), np.log1p(tags_), np.log1p(runs),
        inputs, chars_ / total, chars_ / some[p], links_[p] / some[p], np.log1p(chars_[p]), np.log1p(s),
        same / s, np.array(place) / s, np.log1p(chars_[p] / s), np.log1p(left), np.log1p(right), np.array(before) / total, [len(node.children) for node in nodes],
        np.log1p(of_kin / same), kin_[:, 1] / np.maximum(of_kin, 1), np.log1p(kin_[:, 2]), np.log1p(kin_[:, 3]), of_kin / total, np.log1p(best_[p]), np.log1p(best_),
    )
    named = (bits(group, g), bits(group_above, g), bits(mark, a), bits(mark_above, a), bits(mark_below, a))
    return np.concatenate((*named, np.stack(rest, axis=1)), axis=1).astype(np.float32)


# Tags that stand beside each other in one text.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure table tr td th".split())
TIES = (2.0, 1.0, 0.5)  # between siblings of one kind in prose, between two kinds in prose, between others of one kind


def tie(nodes: list[Node], a: int, b: int) -> float:
    """What it costs, as a difference of log-probabilities, if of two neighbouring siblings only one is kept. Prose is an
    element of ``PROSE``, or one that holds nothing but a run of text, most of it not in links."""
    x, y = nodes[a], nodes[b]
    if x.marks != y.marks:
        return 0.0
    prose = True
    for node in (x, y):
        one = nodes[node.children[0]] if len(node.children) == 1 else None
        alone = one is not None and one.tag == "#text"
        prose &= (node.tag in PROSE or alone) and not (alone and 2 * one.link_chars > len(one.text))
    if x.tag == y.tag:
        return TIES[0] if prose else TIES[2]
    return TIES[1] if prose else 0.0


def decode(nodes: list[Node], p: np.ndarray) -> list[bool]:
    """The likeliest choice of nodes in which none is kept without its parent, and no element without one of its children
    (whence no ancestor and descendant contradict each other), less the ties of neighbouring siblings that part.
    One pass up the tree, with one along each row of children, and one pass down."""
    p = np.clip(p.astype(np.float64), 1e-6, 1 - 1e-6)
    drop, keep = np.log1p(-p).tolist(), np.log(p).tolist()
    never = -np.inf
    # along a row: 0 none kept so far, 1 some kept but not the last, 2 the last kept; which state each came from
    come: list[tuple[int, int]] = [(0, 0)] * len(nodes)
    last = [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):  # keep: with the best choice below; drop: all below dropped
        none, some, end = 0.0, never, never
        before, gone = None, 0.0
        for c in nodes[i].children:
            t = 0.0 if before is None else tie(nodes, before, c)
            to_some = (some, 1) if some >= end - t else (end - t, 2)
            to_end = max((none - t, 0), (some - t, 1), (end, 2))
            come[c] = to_some[1], to_end[1]
            none, some, end = none + drop[c], to_some[0] + drop[c], to_end[0] + keep[c]
            gone += drop[c]
            before = c
        if nodes[i].children:
            best = max((some, 1), (end, 2), (none, 0) if i == 0 else (never, 0))
            keep[i] += best[0]
            last[i] = best[1]
        elif nodes[i].tag != "#text":
            keep[i] = never
        drop[i] += gone
    chosen = [False] * len(nodes)
    chosen[0] = True
    for i, node in enumerate(nodes):
        if chosen[i]:
            state = last[i]
            for c in reversed(node.children):
                chosen[c] = state == 2
                state = 0 if state == 0 else come[c][state - 1]
    return chosen


def text_of(nodes: list[Node], chosen: list[bool]) -> str:
    return "\n".join(node.text for node, c in zip(nodes, chosen, strict=True) if c and node.tag == "#text")

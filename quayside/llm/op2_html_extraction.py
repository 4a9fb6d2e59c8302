"""HTML extraction: gradient-boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of block elements and text runs. Every node has features: its element,
attribute tokens (its own, inherited, and of its subtree), depth, the subtree's density of text, links
and elements, and statistics of its siblings. Spark's gradient-boosted trees give each node the
probability that it holds main text. Decoding picks the likeliest choice of nodes in which no
node is kept without its parent, by one pass up and one down the tree.

There are no labelled pages, so the classifier is trained on a bounded sample: of ``SAMPLE`` pages
(those whose ids hash lowest) the nodes in ``article`` or ``main`` elements, outside of anything whose
element or attributes name navigation, notices, adverts and the like, count as main text. From the
same pages' texts, ``COMPOSED`` pages are put together with varied markup (semantic or bare elements;
sidebars, notices, forms, reader comments, related links inside and outside of the main part), whose labels
are known. Fitting happens once, on at most a few ten thousand nodes; pages are then read, whole,
where they lie, without a shuffle.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, share, shared_value, table
from .html_dom import ATTRIBUTE_TOKENS, GROUPS, Node, decode, features, parse, text_of

SAMPLE = 120
COMPOSED = 800
SAMPLE_CHARS = 200_000  # longer pages are not used for training
TREES, DEPTH = 30, 6
_OUTSIDE = set(GROUPS[6]) | set(GROUPS[7])

# Fillers for composed pages where a sample has no text to borrow.
FILLER = (
    "The committee met on Tuesday to discuss the proposal, and several members asked for more time before a vote.",
    "Researchers found that the river had changed its course twice in the last century, which surprised local farmers.",
    "Prices rose slightly in the second quarter, although demand remained steady across most regions.",
    "She opened the window, looked out over the harbour, and decided to walk into town despite the rain.",
    "The museum will display more than forty paintings, many of which have never been shown in public.",
    "A new bridge is expected to shorten the journey by half an hour once construction is finished next year.",
)
SHORT = ("Home", "About us", "Contact", "Products", "News", "Archive", "Log in", "Help", "Search", "Privacy policy", "Terms of use")


# ---------------------------------------------------------------- training data


def truth_of(nodes: list[Node]) -> list[bool]:
    """Labels of a sampled page's nodes from its own markup: runs in article or main, and all above them."""
    inside, out = [False] * len(nodes), [False] * len(nodes)
    good = [False] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        p = node.parent
        inside[i] = inside[p] or node.tag in GROUPS[0]
        out[i] = out[p] or (node.tag in _OUTSIDE and not (node.tag == "header" and inside[p])) or any(m > 0 for m in node.marks)
        good[i] = node.tag == "#text" and inside[i] and not out[i]
    for i in range(len(nodes) - 1, 0, -1):
        good[nodes[i].parent] |= good[i]
    return good


def told_truth(nodes: list[Node]) -> list[bool]:
    """Labels of a composed page: data-truth of the nearest element that has it."""
    inside, good = [False] * len(nodes), [False] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        inside[i] = inside[node.parent] if node.truth is None else node.truth
        good[i] = node.tag == "#text" and inside[i]
    for i in range(len(nodes) - 1, 0, -1):
        good[nodes[i].parent] |= good[i]
    return good


def compose(rng: random.Random, texts: list[str]) -> str:
    """A page of random layout; elements of the main text carry data-truth."""
    esc = lambda t: html.escape(t, quote=False)
    say = lambda: esc(rng.choice(texts))
    few = lambda lo, hi: esc(" ".join(rng.choice(texts).split()[: rng.randint(lo, hi)]) or "text")
    chance = lambda x: rng.random() < x
    named = chance(0.55)  # elements with telling names
    marked = chance(0.75)  # attributes with telling tokens
    plain = not named and chance(0.4)  # no attributes at all

    def attr(kind: int, always: bool = False) -> str:
        if plain or not (named is False or always or chance(0.85)):
            return ""
        token = rng.choice(ATTRIBUTE_TOKENS[kind]) if marked or chance(0.5) else rng.choice(("box", "c1", "row", "x7", "wrap", "col"))
        if kind and chance(0.15):
            token = rng.choice(ATTRIBUTE_TOKENS[0]) + "-" + token
        elif not kind and chance(0.3):
            token += "-" + rng.choice(("side", "wrap", "area", "left", "inner", "main", "body", "column", "1"))
        return f" {rng.choice(('class', 'id', 'class'))}=\"{token}{rng.choice(('', '-box', ' wide', '-1', ''))}\""

    def box(tag: str, kind: int, body: str) -> str:
        tag = tag if named else "div"
        return f"<{tag}{attr(kind)}>{body}</{tag}>"

    def links(lo: int, hi: int, between: str = " ") -> str:
        return between.join(f'<a href="/{i}">{esc(rng.choice(SHORT)) if chance(0.5) else few(1, 4)}</a>' for i in range(rng.randint(lo, hi)))

    def link_list(lo: int, hi: int) -> str:
        if chance(0.3):
            return links(lo, hi, rng.choice((" ", " | ", "<br>", " &gt; ")))
        return "<ul>" + "".join(f"<li>{a}</li>" for a in links(lo, hi, "\n").split("\n")) + "</ul>"

    para = lambda t: f"<p>{t}</p>" if chance(0.6) else t
    legal = lambda: rng.choice(("&copy; ", "Copyright ", "", "")) + (esc(rng.choice(SHORT)) if chance(0.2) else few(1, 10))

    def junk(i: int) -> str:
        return (
            lambda: box("nav", 1, link_list(2, 8)),
            lambda: box("div", 2, para(say()) if chance(0.7) else few(3, 12)),
            lambda: box("section", 3, f"<h3>{rng.choice(('Comments', few(1, 2)))}</h3>" + "".join(f"<div{attr(3)}><b>{few(1, 2)}</b>{para(say() if chance(0.7) else few(4, 20))}</div>" for _ in range(rng.randint(1, 5)))),
            lambda: box("footer", 4, para(legal()) if chance(0.7) else links(1, 4, " | ")),
            lambda: box("header", 5, (links(1, 1) if chance(0.5) else few(1, 5)) + (link_list(2, 5) if chance(0.5) else "")),
            lambda: box("aside", 6, f"<h4>{few(1, 3)}</h4>" + (link_list(2, 6) if chance(0.7) else para(say()))),
            lambda: box("div", 7, para(few(6, 25)) + (f'<a href="#">{few(1, 2)}</a>' if chance(0.5) else "")),
            lambda: box("form", 8, f"<label>{few(1, 5)}</label><input type=text><button>Send</button>{para(few(2, 8)) if chance(0.6) else ''}"),
            lambda: box("div", 8, links(1, 4)),
            lambda: box("div", 1, " ".join(f'<a href="/p{i}">{i}</a>' for i in range(1, rng.randint(3, 6))) + (f" <a href='/n'>{few(1, 1)}</a>" if chance(0.5) else "")),
        )[i]()

    some = lambda kinds, x: "".join(junk(k) for k in kinds if chance(x))
    mark = lambda part, truth: re.sub(r"^<(\w+)", rf'<\1 data-truth="{truth}"', part)
    inside = lambda kinds: mark(junk(rng.choice(kinds)), 0)

    def text_part(bare: bool) -> str:
        """A part of the main text; in a bare layout paragraphs are div elements."""
        kind, text = rng.random(), say() if chance(0.75) else few(1, 12)
        block = "div" if bare else "p"
        if kind < 0.1:
            return f"<h2>{few(2, 8)}</h2>"
        if kind < 0.17:
            return "<ul>" + "".join(f"<li>{few(3, 15)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if kind < 0.21:
            return f"<blockquote><p>{text}</p></blockquote>"
        if kind < 0.26:
            return "<table>" + "".join(f"<tr><td>{few(1, 4)}</td><td>{few(1, 6)}</td></tr>" for _ in range(rng.randint(2, 4))) + "</table>"
        if kind < 0.29:
            return "<dl>" + "".join(f"<dt>{few(1, 2)}</dt><dd>{few(4, 15)}</dd>" for _ in range(rng.randint(1, 3))) + "</dl>"
        if kind < 0.32:
            return f"<pre>{few(3, 20)}</pre>"
        if kind < 0.35:
            return f"<figure><img src=x><figcaption>{few(3, 10)}</figcaption></figure>"
        if kind < 0.42:
            return f"<p><b>{text}<br>" if not bare else f"<div>{text}<br><br>{say()}</div>"
        if kind < 0.5:
            return f'<{block}>{text} <a href="/x">{few(1, 6)}</a> {few(2, 9)}</{block}>'
        if kind < 0.53:
            return f"<{block}>{text} <math><mi>{few(1, 1)}</mi><mo>=</mo><mn>2</mn></math> {few(2, 9)}</{block}>"
        return f"<{block}>{text}</{block}>"

    bare, parts = chance(0.25), []
    for _ in range(rng.choice((1, 2, 3, 3, 4, 5, 8, 12))):
        parts.append(text_part(bare))
        if chance(0.1):
            parts.append(inside((1, 2, 5, 6, 7, 8)))
    if chance(0.15):
        parts.append(inside((2, 3, 5, 8, 9)))
    title = f"<h1>{few(1, 10)}</h1>" if chance(0.85) else ""
    if title and chance(0.15):
        title = f"<{'header' if named else 'div'}{attr(5) if chance(0.5) else attr(0)}>{title}</{'header' if named else 'div'}>"
    if chance(0.1):
        parts.insert(0, inside((8,)))
    if chance(0.2):
        parts = [f"<section>{''.join(parts[k : k + 2])}</section>" for k in range(0, len(parts), 2)]
    top, bottom = some((0, 4, 1, 6, 7), 0.5), some((5, 1, 2, 6, 7, 3), 0.45)
    layout = rng.random()
    if layout < 0.15:  # no element around the main text
        own = "".join(x if 'data-truth="0"' in x.split(">", 1)[0] else mark(x, 1) for x in (title, *parts))
        return f"<html><head><title>x</title></head><body>{top if chance(0.6) else ''}{own}{bottom if chance(0.6) else ''}</body></html>"
    text = title + "".join(parts)
    if chance(0.08):  # one run of text
        text = (title if chance(0.5) else "") + "<br><br>".join(say() for _ in range(rng.randint(1, 5)))
    if layout < 0.3:  # a table for a layout
        cell = f'<td data-truth="1">{text}</td>'
        side = f"<td{attr(1)}>{link_list(2, 7)}</td>" if chance(0.8) else ""
        after = f"<td>{junk(5)}</td>" if chance(0.3) else ""
        head = f"<tr><td colspan=2>{links(1, 4, ' | ') if chance(0.6) else junk(4)}</td></tr>" if chance(0.5) else ""
        foot = f"<tr><td colspan=2>{legal()}</td></tr>" if chance(0.5) else ""
        return f"<html><body>{top if chance(0.3) else ''}<table>{head}<tr>{side}{cell}{after}</tr>{foot}</table>{bottom if chance(0.3) else ''}</body></html>"
    tag = rng.choice(("article", "main", "div", "section")) if named else "div"
    main = f'<{tag}{attr(0, True) if tag == "div" or chance(0.3) else ""} data-truth="1">{text}</{tag}>'
    if chance(0.35):  # columns
        main = f"<div{attr(0) if chance(0.5) else ''}>{some((0, 5), 0.5)}{main}{some((2, 5, 6), 0.4)}</div>"
    for _ in range(rng.choice((0, 0, 0, 1, 2))):
        main = f"<div{attr(0) if chance(0.5) else ''}>{main}</div>"
    return f"<html><head><title>x</title></head><body>{top}{main}{bottom}</body></html>"


def examples(pages: list[str], n_composed: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of the nodes of sampled and composed pages."""
    rng, xs, ys, texts = random.Random(seed), [], [], []
    for page in pages:
        nodes = parse(page)
        truth = truth_of(nodes)
        texts += [n.text for n in nodes if n.tag == "#text" and 20 < len(n.text) < 2000]
        if truth[0]:
            xs.append(features(nodes)[1:])
            ys.append(np.array(truth[1:], np.float64))
    texts = texts[:20_000] or list(FILLER)
    for _ in range(n_composed):
        nodes = parse(compose(rng, texts if rng.random() < 0.9 else list(FILLER)))
        xs.append(features(nodes)[1:])
        ys.append(np.array(told_truth(nodes)[1:], np.float64))
    return np.concatenate(xs), np.concatenate(ys)


class Trees:
    """The fitted trees as arrays, for evaluating many nodes at once."""

    def __init__(self, trees: list[str], weights: list[float]):
        self.weights = weights
        self.trees = [self._read(t.splitlines()[1:]) for t in trees]

    @staticmethod
    def _read(lines: list[str]) -> tuple[np.ndarray, ...]:
        feature, cut, left, right, value = [], [], [], [], []
        rest = iter(lines)

        def node() -> int:
            line, i = next(rest), len(feature)
            feature.append(0), cut.append(0.0), left.append(i), right.append(i), value.append(0.0)
            if m := re.search(r"If \(feature (\d+) <= (\S+)\)", line):
                feature[i], cut[i] = int(m[1]), float(m[2])
                left[i] = node()
                next(rest)  # Else
                right[i] = node()
            else:
                value[i] = float(re.search(r"Predict: (\S+)", line)[1])
                cut[i] = np.inf
            return i

        node()
        return np.array(feature), np.array(cut), np.array(left), np.array(right), np.array(value)

    def probability(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.zeros(len(x)), np.arange(len(x))
        for w, (feature, cut, left, right, value) in zip(self.weights, self.trees, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = np.where(x[rows, feature[at]] <= cut[at], left[at], right[at])
            score += w * value[at]
        return 1 / (1 + np.exp(-2 * score))


def train(pages: DataFrame, sample: int = SAMPLE, composed: int = COMPOSED) -> Trees:
    """Fit on a bounded sample of ``pages(page_id, html)``; with no pages, on composed ones alone."""
    spark = pages.sparkSession
    usable = pages.filter(F.length("html").between(1, SAMPLE_CHARS))
    ids = usable.filter("page_id is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    picked = usable.join(F.broadcast(ids), "page_id").select("page_id", "html").limit(2 * sample)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame[frame["html"] != ""].sort_values(["page_id", "html"])
        x, y = examples(frame["html"].tolist(), composed)
        return pd.DataFrame({"x": list(x.astype(np.float64)), "label": y})

    # one task takes the sample: its rows and bytes are bounded by the parameters above
    seed_row = spark.range(1).select(F.lit(0).cast("long").alias("page_id"), F.lit("").alias("html"))
    nodes = picked.union(seed_row).withColumn("one", F.lit(1)).groupBy("one").applyInPandas(run, "x array<double>, label double")
    data = nodes.select(array_to_vector("x").alias("features"), "label").coalesce(1).cache()
    fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=32, seed=7, maxMemoryInMB=64).fit(data)
    data.unpersist()
    return Trees([t.toDebugString for t in fitted.trees], list(fitted.treeWeights))


# ---------------------------------------------------------------- extraction


def extract(pages: DataFrame, trees: Trees) -> DataFrame:
    """(page_id, url, text, n_chars), a row for each row of ``pages(page_id, url, html)``.

    A null or empty page has the text ''. Blocks are joined by one line feed; white space in a block,
    non-breaking space included, is one space. Extra columns are ignored; repeated rows each give their
    row. A page of any length is taken whole, by one task. What an element shows only where its own
    content cannot be shown (in video, audio, canvas, object, noscript) is no text.
    """
    shared = share(pages.sparkSession, trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared_value(shared)
        for batch in batches:
            column, texts = batch.column("html"), []
            for at in range(0, len(column), 64):
                doms = [parse(column[i].as_py() or "") for i in range(at, min(at + 64, len(column)))]
                p = trees.probability(np.concatenate([features(d) for d in doms]))
                ends = np.cumsum([len(d) for d in doms])
                texts += [text_of(d, decode(d, q)) for d, q in zip(doms, np.split(p, ends[:-1]), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def html_extraction(pages: DataFrame) -> DataFrame:
    pages = only(pages, page_id="long", url="string", html="string")
    return extract(pages, train(pages))


def op2_html_extraction(spark, sf_dir: str) -> DataFrame:
    return html_extraction(table(spark, sf_dir, "pages"))


QUERIES = {"op2_html_extraction": op2_html_extraction}
ORACLE_SQL: dict[str, str] = {}

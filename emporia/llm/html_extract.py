"""Main text of web pages with boosted trees over DOM nodes and hierarchical decoding.

Each block of a page is a row of features: density of text, links and tags in its subtree, attribute tokens of its own
and of those above it, depth and statistics among its siblings. Gradient-boosted trees give the odds that a block
belongs to the article or holds it. Decoding picks the set of blocks with the highest total odds in which every chosen
block has a chosen parent, so an answer never keeps a block inside one that it drops.

Pages carry no labels, so the trees learn from pages that are laid out anew: the texts of a bounded sample of pages are
put into random layouts, in which the place of the article is known.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import pick
from emporia.llm.dom import Page, attributes, parse
from emporia.sources.shared import written

#: Pages whose texts the training layouts are made of, in expectation, and layouts for each.
SAMPLE_PAGES = 300
LAYOUTS = 3
TREES, DEPTH = 20, 4

TAGS = [
    ("article", "main"), ("section",), ("div",), ("p",), ("h1",), ("h2", "h3", "h4", "h5", "h6"), ("li", "dd", "dt"),
    ("ul", "ol", "dl", "menu"), ("nav",), ("header", "hgroup"), ("footer",), ("aside",), ("form", "fieldset"),
    ("table", "tbody", "thead", "tr", "td", "th"), ("blockquote", "pre", "figure", "figcaption"), ("body", "html", "#root"),
    ("#text",), ("head",), ("dialog",),
]
TAG_GROUP = {tag: i for i, group in enumerate(TAGS) for tag in group}
TOKENS = [
    "article content post entry story main body text blog news prose copy".split(),
    "ad ads advert advertisement adverts banner sponsor sponsored promo promotion promoted dfp taboola outbrain".split(),
    "nav menu navbar navigation breadcrumb breadcrumbs topbar toolbar pagination pager tabs links skip".split(),
    "header masthead head top branding logo".split(),
    "footer bottom copyright legal colophon foot".split(),
    "sidebar side aside widget widgets rail related recommended trending popular more".split(),
    "comment comments reply replies respond discussion disqus thread reader readers feedback".split(),
    "form login signup subscribe subscription newsletter search register signin".split(),
    "cookie cookies consent notice notices alert popup modal overlay gdpr privacy disclaimer warning dialog".split(),
    "share social sharing follow author bio tags meta byline".split(),
]
TOKEN_GROUP = {token: i for i, group in enumerate(TOKENS) for token in group}
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_DENSITY = 17
WIDTH = _DENSITY + len(TAGS) + 2 * len(TOKENS) + 1


def _token_flags(raw: str) -> tuple[list[int], bool, str]:
    """Token groups among class, id and role, whether the block is hidden, and the training mark."""
    if not raw or "=" not in raw and "hidden" not in raw:
        return [], False, ""
    found = attributes(raw)
    words = _SPLIT.split(" ".join(found.get(k, "") for k in ("class", "id", "role")))
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or bool(_HIDDEN.search(found.get("style", "")))
    return [TOKEN_GROUP[w] for w in {x.lower() for x in words} if w in TOKEN_GROUP], hidden, found.get("data-part", "")


def features(page: Page) -> tuple[np.ndarray, list[str]]:
    """A row of features for every block, and the training marks that the blocks bear."""
    blocks = page.blocks
    n = len(blocks)
    chars, links, tags = [b.chars for b in blocks], [b.links for b in blocks], [b.tags for b in blocks]
    controls, marks, runs = [b.controls for b in blocks], [b.marks for b in blocks], [b.run_count for b in blocks]
    paragraphs = [int(b.tag == "p") for b in blocks]
    order = sorted(range(1, n), key=lambda i: -blocks[i].depth)
    for i in order:
        up = blocks[i].parent
        chars[up] += chars[i]
        links[up] += links[i]
        tags[up] += tags[i]
        controls[up] += controls[i]
        marks[up] += marks[i]
        runs[up] += runs[i]
        paragraphs[up] += paragraphs[i]
    total = max(chars[0], 1)
    out = np.zeros((n, WIDTH), np.float32)
    parts = [""] * n
    above: list[frozenset[int]] = [frozenset()] * n
    veiled = [False] * n
    before = [0] * n
    rows = []
    for i in sorted(range(n), key=lambda i: blocks[i].depth):
        block = blocks[i]
        own, hidden, parts[i] = _token_flags(block.attributes)
        up = block.parent
        inherited = above[up] if up >= 0 else frozenset()
        veiled[i] = hidden or (up >= 0 and veiled[up])
        above[i] = inherited | frozenset(own) if own else inherited
        seen = before[i]
        kinds: dict[str, int] = {}
        for k, c in enumerate(block.children):
            before[c] = seen
            seen += chars[c]
            kinds[blocks[c].tag] = kinds.get(blocks[c].tag, 0) + 1
        size = len(block.children)
        for k, c in enumerate(block.children):
            near = chars[block.children[k - 1]] if k else 0
            after = chars[block.children[k + 1]] if k + 1 < size else 0
            rows.append((c, k / size, size, kinds[blocks[c].tag], near, after))
        own_chars = max(chars[i], 1)
        out[i, :11] = (
            block.depth,
            np.log1p(chars[i]),
            links[i] / own_chars,
            chars[i] / total,
            tags[i] / own_chars,
            chars[i] / max(runs[i], 1),
            paragraphs[i],
            marks[i] / own_chars,
            controls[i],
            chars[i] / max(chars[up], 1) if up >= 0 else 1.0,
            before[i] / total,
        )
        out[i, _DENSITY + TAG_GROUP.get(block.tag, 2)] = 1
        for t in own:
            out[i, _DENSITY + len(TAGS) + t] = 1
        for t in inherited:
            out[i, _DENSITY + len(TAGS) + len(TOKENS) + t] = 1
        out[i, WIDTH - 1] = veiled[i]
    for c, place, size, same, near, after in rows:
        out[c, 11:17] = (place, size, same, near / total, after / total, len(blocks[c].children))
    return out, parts


def choose(page: Page, odds: list[float]) -> list[int]:
    """Blocks of the best consistent choice: the highest total odds with every chosen block's parent chosen."""
    blocks = page.blocks
    gain = list(odds)
    order = sorted(range(1, len(blocks)), key=lambda i: -blocks[i].depth)
    for i in order:
        if gain[i] > 0:
            gain[blocks[i].parent] += gain[i]
    kept = [False] * len(blocks)
    kept[0] = True
    for i in reversed(order):
        kept[i] = kept[blocks[i].parent] and gain[i] > 0
    return [i for i, k in enumerate(kept) if k]


def text_of(page: Page, chosen: list[int]) -> str:
    """The runs of the chosen blocks in page order, joined by blank lines."""
    return "\n\n".join(page.texts[r] for r in sorted(r for i in chosen for r in page.blocks[i].runs))


def _wrap(tag: str, names: str, inside: str, part: str = "") -> str:
    attribute = f' class="{names}"' if names else ""
    return f"<{tag}{attribute}{f' data-part={part}' if part else ''}>{inside}</{tag}>"


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;")


def _article(rng: random.Random, texts: list[str]) -> str:
    inside = f"<h1>{_escaped(texts[0][:80])}</h1>" if rng.random() < 0.85 else ""
    for text in texts:
        roll = rng.random()
        if roll < 0.08:
            inside += _wrap("h2", "", _escaped(" ".join(text.split()[:6])))
        elif roll < 0.14:
            inside += "<ul>" + "".join(f"<li>{_escaped(t)}</li>" for t in text.split(". ")[:5]) + "</ul>"
        elif roll < 0.18:
            inside += _wrap("blockquote", "", _escaped(text))
        elif roll < 0.24:
            inside += _wrap(*rng.choice([("div", "ad"), ("aside", ""), ("div", "share"), ("div", "related")]), _small(rng, text), "b")
        if roll >= 0.06:
            words = _escaped(text).split(" ")
            if len(words) > 8 and rng.random() < 0.2:
                words[3] = f'<a href="/x">{words[3]}</a>'
            inside += f"<p>{' '.join(words)}" + ("</p>" if rng.random() < 0.9 else "")
    tag, names = rng.choice(
        [("article", ""), ("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "post-content"),
         ("div", "entry"), ("div", "article-body"), ("section", "story"), ("div", "")]
    )
    made = _wrap(tag, names, inside, "c")
    return _wrap(rng.choice(["div", "main", "section"]), rng.choice(["", "wrapper", "container", "page"]), made) if rng.random() < 0.4 else made


def _small(rng: random.Random, text: str) -> str:
    return _escaped(" ".join(text.split()[: rng.randint(2, 16)]))


def _list(rng: random.Random, words: list[str]) -> str:
    links = "".join(f'<li><a href="/{i}">{_escaped(w)}</a></li>' for i, w in enumerate(words[: rng.randint(3, 9)]))
    return f"<ul>{links}</ul>"


def _boilerplate(rng: random.Random, text: str) -> str:
    words = text.split() or ["x"]
    listed, short = _list(rng, words), _small(rng, text)
    long = _escaped(text[:400])
    form = f'<form><label>{short}</label><input name="q"><button>{_escaped(words[0])}</button></form>'
    kinds = [
        ("nav", "", listed), ("div", "menu", listed), ("ul", "nav", listed.replace("<ul>", "").replace("</ul>", "")),
        ("header", "", short + listed), ("div", "header", short), ("footer", "", "&copy; " + short), ("footer", "", long),
        ("div", "footer", short + listed), ("aside", "", f"<p>{long}</p>"), ("div", "sidebar", listed + f"<p>{short}</p>"),
        ("aside", "sidebar", f"<h3>{short}</h3>" + listed), ("div", "ad", short), ("div", "advert", long), ("div", "banner", short),
        ("div", "ads", f"<p>{short}</p>"), ("div", "cookie-notice", f"<p>{long}</p>"), ("div", "notice", short),
        ("div", "popup", form), ("form", "", form), ("div", "newsletter", form), ("div", "login", form),
        ("section", "comments", "".join(f"<div class=comment><p>{long}</p></div>" for _ in range(rng.randint(1, 5)))),
        ("div", "comments", f"<h3>{short}</h3><ol><li><p>{long}</p></li><li><p>{short}</p></li></ol>"),
        ("div", "reader-comments", f"<p>{long}</p>"), ("div", "related", listed), ("div", "share", listed),
        ("div", "breadcrumb", short), ("dialog", "", f"<p>{short}</p>"), ("section", "promo", f"<p>{long}</p>"),
        ("div", "", listed), ("div", "copyright", "&copy; " + short),
    ]
    tag, names, inside = rng.choice(kinds)
    if names and rng.random() < 0.3:
        return f'<{tag} id="{names}" data-part=b>{inside}</{tag}>'
    return _wrap(tag, names, inside, "b")


def layout(texts: list[str], seed: int) -> str:
    """A page with the article at a known place, among random parts made of the same texts."""
    rng = random.Random(seed)
    noise = [_boilerplate(rng, rng.choice(texts)) for _ in range(rng.randint(1, 7))]
    cut = rng.randint(0, len(noise))
    count = min(len(texts), rng.choice([1, 1, 2, 4, 8, 12]))
    first = rng.randint(0, len(texts) - count)
    middle = _article(rng, texts[first : first + count])
    if rng.random() < 0.4 and noise:
        middle = _wrap("div", rng.choice(["", "row", "layout"]), middle + noise.pop())
    return f"<html><head><title>{_escaped(texts[0][:60])}</title></head><body>{''.join(noise[:cut])}{middle}{''.join(noise[cut:])}</body></html>"


def labels(page: Page, parts: list[str]) -> list[int]:
    """1 for blocks of the article and those that hold it, 0 for all others."""
    blocks = page.blocks
    state = [0] * len(blocks)
    inside = [""] * len(blocks)
    for i in sorted(range(len(blocks)), key=lambda i: blocks[i].depth):
        inside[i] = parts[i] or (inside[blocks[i].parent] if i else "")
        state[i] = int(inside[i] == "c")
    for i in sorted(range(1, len(blocks)), key=lambda i: -blocks[i].depth):
        if state[i] and inside[blocks[i].parent] != "b":
            state[blocks[i].parent] = 1
    return state


def _training_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows, marks = [], []
        for page_id, html in zip(batch["page_id"], batch["html"], strict=True):
            texts = [t for t in parse(html).texts if len(t) > 1]
            if not texts:
                continue
            for k in range(LAYOUTS):
                page = parse(layout(texts, int(page_id) * LAYOUTS + k))
                found, parts = features(page)
                rows += found[1:].astype(float).tolist()
                marks += labels(page, parts)[1:]
        yield pd.DataFrame({"features": rows, "label": np.array(marks, float)})


@dataclass
class Trees:
    """Boosted trees as arrays: feature (-1 at a leaf), threshold, children, value and weight of each tree."""

    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    weights: list[float]

    def odds(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for (feature, threshold, left, right, value), weight in zip(self.nodes, self.weights, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                split = feature[at]
                goes = rows[every, np.maximum(split, 0)] <= threshold[at]
                at = np.where(split < 0, at, np.where(goes, left[at], right[at]))
            total += weight * value[at]
        return 2 * total


def _arrays(root) -> tuple[np.ndarray, ...]:
    """A fitted tree's nodes, numbered from its root."""
    rows: list[list[float]] = []

    def walk(node) -> int:
        at = len(rows)
        rows.append([-1, 0.0, at, at, node.prediction()])
        if node.subtreeDepth() > 0:
            split = node.split()
            rows[at][0], rows[at][1] = split.featureIndex(), split.threshold()
            rows[at][2] = walk(node.leftChild())
            rows[at][3] = walk(node.rightChild())
        return at

    walk(root)
    held = np.array(rows, float)
    return held[:, 0].astype(int), held[:, 1], held[:, 2].astype(int), held[:, 3].astype(int), held[:, 4]


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Trees:
    """Trees fitted by Spark on layouts of about ``sample_pages`` pages, drawn by a hash of the page id."""
    known = pick(pages, "page_id", "html").filter(F.col("html").isNotNull() & F.col("page_id").isNotNull())
    count = known.count()
    part = F.pmod(F.xxhash64(F.lit("sample"), "page_id"), F.lit(1_000_000)) / 1_000_000
    drawn = known.filter(part * count < sample_pages)
    rows = written(drawn.mapInPandas(_training_rows, "features array<double>, label double"), "layout-rows")
    if rows.select("label").distinct().count() < 2:
        return Trees([], [])
    data = rows.select(array_to_vector("features").alias("features"), "label").coalesce(4)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=11, maxBins=64).fit(data)
    return Trees([_arrays(t._java_obj.rootNode()) for t in model.trees], list(model.treeWeights))


def extractor(trees: Trees):
    """A column function from markup to the main text."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            out: list[str] = []
            held = list(htmls)
            for at in range(0, len(held), 256):
                pages = [parse(h) for h in held[at : at + 256]]
                rows = [features(p)[0] for p in pages]
                odds = trees.odds(np.concatenate(rows)).tolist()
                begin = 0
                for page, found in zip(pages, rows, strict=True):
                    out.append(text_of(page, choose(page, odds[begin : begin + len(found)])))
                    begin += len(found)
            yield pd.Series(out, dtype=object)

    return extract


def main_text(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row.

    Character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined in
    page order by a blank line. Null and empty markup, and pages without an article, give an empty text; with no
    page to learn from all texts are empty. Repeated rows each appear, and an empty table gives no rows.
    """
    trees = trees or train(pages)
    made = pick(pages, "page_id", "url", "html").select("page_id", "url", extractor(trees)("html").alias("text"))
    return made.withColumn("n_chars", F.length("text").cast("long"))

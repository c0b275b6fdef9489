"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page is parsed into its block elements; text inside them, through inline elements, is cut at
block borders.  Every block gets features: the subtree's text, link and tag density, tokens of
its class, id and role (and of its ancestors'), its depth, its place and its siblings' text.
Gradient-boosted trees give each block the log-odds of holding main text, as a correction of
what names say (``NAMED`` against furniture, as much for content, nothing otherwise).  Decoding picks the
most likely labelling in which no kept block lies in a dropped one: bottom-up, a block is
dropped with all below it or kept with the best choice for each child.

There are no labels, so the trees learn from markup that names its purpose: in a sample of up to
``SAMPLE`` pages (least hash of the id) that have an
article or main element, the blocks in the largest one are main text unless they or an
ancestor inside it are named as furniture (tag or attribute token).  A page of more than
``LONGEST_SAMPLE`` characters is described whole, too, but shown by ``SAMPLED_BLOCKS`` blocks drawn from all of it.  Each sample page is also shown
with names blanked out, so the trees learn to do without them, and once more with depth, place
and number of siblings drawn from other blocks, so that they don't learn one site's layout.

Defined cases: null html is the empty page, whose text is empty; unclosed and unknown tags,
truncated pages and plain text are parsed leniently; a slash does not end a script or another raw
element, as in HTML; without any page to learn from, blocks
named as furniture are dropped and the others kept; rows are independent, so ties, repeated
rows and other columns do not matter.  Pages are read whole.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.llm.boosted_trees import BoostedTrees
from lumen.llm.shared import drawn, text_of, thinned

SAMPLE, LONGEST_SAMPLE = 400, 100_000
#: Blocks of a sample page that is longer.
SAMPLED_BLOCKS = 500
#: Log-odds of a block that a name speaks for or against.
NAMED = 6.0
#: Words, share of linked characters and stops a word of prose that outvotes an ambiguous name.
PROSE_WORDS, PROSE_LINKED, PROSE_STOPS = 120, 0.1, 0.04
#: Pages decoded together.
SLICE = 64

# HTML's element groups.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption""".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
UNSEEN = set("head script style noscript template title iframe svg annotation annotation-xml canvas audio video select button textarea".split())
RAW = set("script style textarea title noscript iframe".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
# Names of page furniture and of content, as tags and as tokens of class, id and role.
FURNITURE_TAGS = set("nav header footer aside form menu dialog address".split())
FURNITURE = set("""ad ads advert adverts advertisement aside banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright
discussion footer form gdpr header login menu meta modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted
related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe tags teaser toolbar widget""".split())
#: Of these, words that also head prose (related work, a social history, a meta-analysis).
AMBIGUOUS = set("header meta related share social tags".split())
CONTENT_TAGS = {"article", "main"}
CONTENT = set("article content main body post entry story text".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|</([a-zA-Z][^\s/>]*+)[^>]*+>"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*+)([^>]*+)>|<[a-zA-Z/!?][^>]*+\Z|[^<]++|<", re.S)
#: A tag that ends in a slash of its own, not in that of an unquoted value.
EMPTY = re.compile(r"(?:\A|[\s\"'])/\Z")
NAMES = re.compile(r"(?:\bclass|\bid|\brole|\bitemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block:
    """A block element: its parent, its texts in order with their place on the page, and its counts."""

    __slots__ = ("tag", "parent", "children", "depth", "names", "elements", "own", "linked", "stops", "words")

    def __init__(self, tag: str, parent: Block | None, names: str):
        self.tag, self.parent, self.children, self.names = tag, parent, [], names
        self.depth = parent.depth + 1 if parent else 0
        self.elements = self.own = self.linked = self.stops = self.words = 0
        if parent:
            parent.children.append(self)


def parse(page: str) -> tuple[list[Block], list[tuple[Block, str]]]:
    """A page's blocks in order, parents first, and its pieces of text with the block each is in."""
    root = Block("html", None, "")
    blocks, pieces = [root], []
    stack: list[tuple[str, Block]] = [("html", root)]
    block, text, unseen, links, at = root, [], 0, 0, 0

    def cut() -> None:
        joined = " ".join(references.unescape("".join(text)).split())
        text.clear()
        if joined:
            pieces.append((block, joined))
            block.own += len(joined)
            block.words += joined.count(" ") + 1
            block.stops += sum(joined.count(c) for c in ".,;:!?")

    def close(depth: int) -> None:
        """Close all open elements from ``depth`` on."""
        nonlocal block, unseen, links
        cut()
        for tag, _ in stack[depth:]:
            unseen -= tag in UNSEEN
            links -= tag == "a"
        del stack[depth:]
        block = stack[-1][1]

    while at < len(page):
        match = TOKEN.match(page, at)
        at = match.end()
        token = match[0]
        if token[0] != "<" or token == "<":
            if not unseen:
                text.append(token)
                if links:
                    block.linked += len(token)
            continue
        if match[1]:
            tag = match[1].lower()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    if tag in BLOCKS:
                        close(depth)
                    else:
                        unseen -= tag in UNSEEN
                        links -= tag == "a"
                        del stack[depth]
                    break
                if stack[depth][0] in BLOCKS and tag not in BLOCKS:
                    break
            continue
        tag = (match[2] or match[4] or "").lower()
        if not tag:
            continue
        attributes = match[3] if match[2] else match[5]
        if tag in BLOCKS or tag in ("br", "body"):
            if tag == "br":
                text.append(" ")
            else:
                ends = CLOSED_BY.get(tag, set()) | ({"p"} | HEADINGS if tag in HEADINGS else {"p"})
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in ends:
                        close(depth)
                        break
                    if stack[depth][0] in BLOCKS and stack[depth][0] not in ("tbody", "thead"):
                        break
        block.elements += 1
        if tag == "html" or tag in VOID and tag != "hr":
            continue
        if tag in BLOCKS:
            cut()
            names = " ".join(a or b or c for a, b, c in NAMES.findall(attributes)) if attributes else ""
            inner = Block(tag, block, names)
            blocks.append(inner)
            if tag != "hr":
                block = inner
                stack.append((tag, inner))
        elif tag in RAW:
            # a slash does not end these, unless nothing else does
            end = re.compile(f"</{tag}\\s*>", re.I).search(page, at)
            at = end.end() if end else at if EMPTY.search(attributes) else len(page)
        elif not EMPTY.search(attributes):
            stack.append((tag, block))
            unseen += tag in UNSEEN
            links += tag == "a"
    cut()
    return blocks, pieces


def named(block: Block, tags: set[str], tokens: set[str]) -> int:
    return (block.tag in tags) + sum(w.lower() in tokens for w in WORDS.findall(block.names)) if block.names else int(block.tag in tags)


def furniture_named(blocks: list[Block]) -> list[int]:
    """How many names speak of furniture in each block.

    Ambiguous words do not count where a block inside content holds prose: as many words as
    ``PROSE_WORDS``, with stops and hardly a link.  The trees judge such a block by its shape.
    """
    order = {id(b): k for k, b in enumerate(blocks)}
    sums = [[b.own, b.linked, b.stops, b.words] for b in blocks]
    for k in range(len(blocks) - 1, 0, -1):
        above = sums[order[id(blocks[k].parent)]]
        for j in range(4):
            above[j] += sums[k][j]
    inside, out = [False] * len(blocks), []
    for k, b in enumerate(blocks):
        chars, linked, stops, words = sums[k]
        up = order[id(b.parent)] if b.parent else 0
        inside[k] = inside[up] or b.tag in CONTENT_TAGS
        prose = inside[up] and words >= PROSE_WORDS and linked <= PROSE_LINKED * chars and stops >= PROSE_STOPS * words
        out.append(named(b, FURNITURE_TAGS, FURNITURE - AMBIGUOUS if prose else FURNITURE))
    return out


def describe(blocks: list[Block], blank: bool = False) -> np.ndarray:
    """The features of a page's blocks; blank: as if no tag or attribute named a purpose."""
    order = {id(b): k for k, b in enumerate(blocks)}
    n = len(blocks)
    up = np.array([order[id(b.parent)] if b.parent else -1 for b in blocks])
    own = np.array([[b.own, b.linked, b.elements + 1, b.stops, b.words, 1] for b in blocks], float)
    below = own.copy()
    for k in range(n - 1, 0, -1):
        below[up[k]] += below[k]
    furniture = np.zeros(n) if blank else np.array(furniture_named(blocks), float)
    content = np.array([0 if blank else named(b, CONTENT_TAGS, CONTENT) for b in blocks], float)
    above_furniture, above_content = np.zeros(n), np.zeros(n)
    siblings, place = np.ones(n), np.zeros(n)
    for k in range(1, n):
        above_furniture[k] = above_furniture[up[k]] + furniture[up[k]]
        above_content[k] = above_content[up[k]] + content[up[k]]
        around = blocks[k].parent.children
        siblings[k] = len(around)
    for b in blocks:
        for k, child in enumerate(b.children):
            place[order[id(child)]] = (k + 1) / len(b.children)
    chars, linked, elements, stops, words, _ = below.T
    parent = np.maximum(up, 0)
    sibling_chars = (chars[parent] - own[parent, 0]) / siblings
    tag = np.array([[b.tag == "p", b.tag in HEADINGS, b.tag in ("li", "ul", "ol", "dl", "dt", "dd"), b.tag in ("td", "th", "tr", "table"),
                     b.tag in ("div", "section", "article", "main")] for b in blocks], float)
    page = max(1.0, chars[0])
    return np.column_stack([
        np.array([b.depth for b in blocks]), np.log1p(chars), np.log1p(own[:, 0]), linked / (chars + 1), chars / elements,
        stops / (words + 1), chars / (words + 1), chars / page, np.log1p(siblings), place, np.log1p(sibling_chars),
        np.log1p(below[:, 5]), chars[parent] / page, linked[parent] / (chars[parent] + 1),
        furniture, content, above_furniture, above_content, tag])


# Columns of ``describe``: what differs from site to site, and the counts of names.
LAYOUT, NAMES_AT = [0, 8, 9], 14


def prior(features: np.ndarray) -> np.ndarray:
    """What the names say: furniture anywhere above outweighs content."""
    furniture, content, above_furniture, above_content = features[:, NAMES_AT:NAMES_AT + 4].T
    return np.where(furniture + above_furniture > 0, -NAMED, np.where(content + above_content > 0, NAMED, 0.0))


def weak_labels(blocks: list[Block]) -> np.ndarray | None:
    """Which blocks hold or lie in main text by the page's own names; None if it names no content."""
    order = {id(b): k for k, b in enumerate(blocks)}
    size = np.array([b.own for b in blocks], float)
    for k in range(len(blocks) - 1, 0, -1):
        size[order[id(blocks[k].parent)]] += size[k]
    roots = [k for k, b in enumerate(blocks) if b.tag in CONTENT_TAGS]
    if not roots or not size.max():
        return None
    root = max(roots, key=lambda k: (size[k], -k))
    labels, furniture = np.zeros(len(blocks), bool), furniture_named(blocks)
    labels[root] = True
    for k in range(root + 1, len(blocks)):
        b = blocks[k]
        labels[k] = labels[order[id(b.parent)]] and not furniture[k]
    b = blocks[root].parent
    while b:
        labels[order[id(b)]] = True
        b = b.parent
    return labels


def examples(page: str) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The features of a page's blocks, those without names, and the labels; None if it names no content."""
    blocks, _ = parse(page)
    labels = weak_labels(blocks)
    return None if labels is None else (describe(blocks), describe(blocks, blank=True), labels)


def packed_examples(page: str) -> bytes | None:
    """``SAMPLED_BLOCKS`` of a page's examples."""
    found = examples(page)
    if found is None:
        return None
    at = np.sort(np.random.default_rng(8).permutation(len(found[2]))[:SAMPLED_BLOCKS])
    return np.column_stack([part[at] for part in found]).astype(float).tobytes()


def unpacked_examples(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width = describe([Block("html", None, "")]).shape[1]
    rows = np.frombuffer(packed).reshape(-1, 2 * width + 1)
    return rows[:, :width], rows[:, width:-1], rows[:, -1] > 0


def fit(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> BoostedTrees | None:
    """The trees from the examples of pages."""
    if not found:
        return None
    x = [features for shown, blank, _ in found for features in (shown, blank)]
    y = [labels for _, _, labels in found for _ in range(2)]
    rows, labels, draw = np.vstack(x), np.concatenate(y), np.random.default_rng(8)
    moved = np.vstack(x[1::2])
    for column in LAYOUT:
        moved[:, column] = moved[draw.permutation(len(moved)), column]
    rows, labels = np.vstack([rows, moved]), np.concatenate([labels, *y[1::2]])
    return BoostedTrees.fit(rows, labels.astype(float), prior(rows))


def decode(blocks: list[Block], logits: np.ndarray) -> list[bool]:
    """The most likely labels in which a kept block's parent is kept; the root is kept."""
    order = {id(b): k for k, b in enumerate(blocks)}
    up = [order[id(b.parent)] if b.parent else -1 for b in blocks]
    total = logits.astype(float).tolist()              # of the subtree, if all of it is kept
    best = list(total)                                 # of the subtree, if its root is kept
    for k in range(len(blocks) - 1, 0, -1):
        total[up[k]] += total[k]
        best[up[k]] += max(best[k], -total[k])
    keep = [True] * len(blocks)
    for k in range(1, len(blocks)):
        keep[k] = keep[up[k]] and best[k] > -total[k]
    return keep


def extract(pages: list[str], model: BoostedTrees | None) -> list[str]:
    """The main text of each page, blocks joined by an empty line."""
    parsed = [parse(p) for p in pages]
    x = np.vstack([describe(blocks) for blocks, _ in parsed])
    found = prior(x) + 1 if model is None else model.logits(x, prior(x))
    logits = np.split(found, np.cumsum([len(blocks) for blocks, _ in parsed])[:-1])
    out = []
    for (blocks, pieces), score in zip(parsed, logits, strict=True):
        keep = {id(b) for b, k in zip(blocks, decode(blocks, score), strict=True) if k}
        out.append("\n\n".join(t for b, t in pieces if id(b) in keep))
    return out


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> BoostedTrees | None:
    rows = pages.select(F.col(id_col).alias("id"), text_of(html_col).alias("html"))
    total = pages.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            short = [t if len(t) <= LONGEST_SAMPLE else None for t in texts]
            packed = [packed_examples(t) if s is None else None for t, s in zip(texts, short, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(short, pa.string()), pa.array(packed, pa.binary())],
                                             names=["id", "short", "packed"])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, short string, packed binary"
    sampled = drawn(thinned(rows, "id", sample, total).mapInArrow(run, schema), "id", sample, total).collect()
    found = [examples(page) for page in sorted(r["short"] for r in sampled if r["short"] is not None)]
    found += [unpacked_examples(b) for b in sorted(bytes(r["packed"]) for r in sampled if r["packed"] is not None)]
    return fit([f for f in found if f is not None])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              sample: int = SAMPLE) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    model = pages.sparkSession.sparkContext.broadcast(train(pages, id_col, html_col, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                texts = extract(rows.column(2).to_pylist(), model.value)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), text_of(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")

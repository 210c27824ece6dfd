"""Main text of web pages by a tree-structured graphical model over the DOM.

A tolerant scanner turns a page into its element tree, with one more leaf for each run of text. Every node is content or
not. Node potentials are linear in features of the node (tag, words of class, id and role, text and link lengths, place);
edge potentials tie a child to its parent. Sum-product messages go up from the leaves and down from the root, for all
pages of a batch at once, one depth at a time, and give exact marginals. Text leaves with a content marginal of at least
one half are the main text.

Training maximises the likelihood of labelled pages (gradient: observed minus expected counts, from the same messages),
drawn towards a prior that knows the usual words for boilerplate. Pages label themselves where their author marked the
article: text inside <article> or <main>, outside of boilerplate elements, is content. Each such page is also learned with its marking taken for plain divisions.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pieces

#: Pages that training reads at most, in the order of a hash of their ids, and the largest of them.
SAMPLE_PAGES, SAMPLE_CHARS = 600, 200_000
#: What follows a tag's name: a quote opens a value only behind an equals sign, any other one is a character of a name.
ATTRIBUTES = r"(?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'<>][^\s<>]*)|[^<>])*+"
#: Elements whose content is no text go whole, up to their end tag; one that closes itself holds nothing.
WHOLE = "script|style|textarea|noscript|template|svg|select|iframe|object|title"
SCAN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<({WHOLE})(?=[\s/>])(?:{ATTRIBUTES}(?<=/)>|{ATTRIBUTES.replace('[^<>])*+', '[^>])*+')}(?:>.*?(?:</\1\s*>|\Z)|\Z))"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({ATTRIBUTES})(?:>|\Z|(?=<))",
    re.S | re.I,
)
NAMING = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
#: What the start of a tag closes: an open element of the first set, up to one of the second.
CLOSES = {
    "p": ({"p"}, {"div", "article", "section", "td", "li", "body", "main", "blockquote"}),
    "li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
BLOCKS_CLOSE_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul", "figure"}
TAGS = ("#text", "html", "body", "div", "p", "article", "main", "section", "h1", "h2", "h3", "ul", "ol", "li", "a", "nav", "header", "footer", "aside", "form", "table", "td", "blockquote", "pre", "figure", "figcaption", "button", "dl", "head")
BAD_TAGS = ("nav", "header", "footer", "aside", "form", "button", "head")
GOOD_TAGS = ("article", "main")
BAD_WORDS = re.compile(r"\b(?:ads?|advert\w*|banner|breadcrumb\w*|comments?|cookie\w*|consent|dialog|disclaimer|disqus|footer|footnav|header|legal|login|masthead|menu|modal|nav\w*|newsletter|notice\w*|pager|pagination|popup|promo\w*|recommend\w*|related|repl(?:y|ies)|search|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|tags?|teaser|toolbar|widget|alert|complementary|contentinfo|navigation)\b", re.I)
GOOD_WORDS = re.compile(r"\b(?:article|body|content|entry|main|post|story|text)\b", re.I)
MEASURES = ("bad words", "good words", "text length", "link share", "long text", "stops", "shift", "depth")
FEATURES = len(TAGS) + 1 + len(MEASURES)
#: How much the edge potentials weigh at first: a child is like its parent.
PRIOR_EDGE, PULL, STEPS, RATE = 1.5, 0.05, 150, 0.1


@dataclass
class Page:
    """The nodes of a page in page order: parents come before children."""

    parent: list[int]
    tag: list[str]
    names: list[str]
    text: list[str]
    hidden: list[bool]


def parse(source: str) -> Page:
    """The element tree, with a #text leaf for each run of text; scripts, styles, comments and titles are no nodes."""
    page = Page([-1], ["#root"], [""], [""], [False])
    stack, last = [0], 0
    places: dict[str, list[int]] = {}  # where on the stack the open elements of a name are
    add = lambda tag, names, text, hidden: (page.parent.append(stack[-1]), page.tag.append(tag), page.names.append(names), page.text.append(text), page.hidden.append(hidden))

    def run(raw: str) -> None:
        if raw and not raw.isspace():
            add("#text", "", html.unescape(raw), page.hidden[stack[-1]])
        elif raw:
            add("#text", "", " ", page.hidden[stack[-1]])

    for m in SCAN.finditer(source):
        run(source[last : m.start()])
        last = m.end()
        tag = m[3]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                run(m[0][9:-3].replace("&", "&amp;"))
            continue
        tag = tag.lower()
        if m[2]:
            _close(page, stack, places, {tag}, set())
            continue
        if tag in CLOSES:
            _close(page, stack, places, *CLOSES[tag], every=True)
        elif tag in BLOCKS_CLOSE_P:
            _close(page, stack, places, {"p"}, {"div", "article", "section", "td", "li", "body", "main", "blockquote"})
        attributes = m[4] or ""
        names = " ".join(a or b or c for a, b, c in NAMING.findall(attributes)) if "=" in attributes else ""
        add(tag, re.sub(r"[_-]+|(?<=[a-z])(?=[A-Z])", " ", names), "", page.hidden[stack[-1]] or _hides(attributes))
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            places.setdefault(tag, []).append(len(stack))
            stack.append(len(page.tag) - 1)
    run(source[last:])
    return page


def _hides(attributes: str) -> bool:
    """A hidden attribute, aria-hidden="true" or a style with display:none; of repeated attributes the first counts."""
    lower = attributes.lower()
    if "hidden" not in lower and "display" not in lower:
        return False
    found: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    shown = sorted(DISPLAY.findall(re.sub(r"/\*.*?\*/", " ", found.get("style", ""), flags=re.S)), key=lambda x: x[1] != "")
    return "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true" or bool(shown and shown[-1][0].lower() == "none")


def _close(page: Page, stack: list[int], places: dict[str, list[int]], tags: set[str], until: set[str], every: bool = False) -> None:
    """Leave the innermost open element of ``tags`` (with ``every`` also those around it), but none of ``until``."""
    floor = max((places[t][-1] for t in until if places.get(t)), default=0)
    inside = [places[t] for t in tags if places.get(t) and places[t][-1] > floor]
    if not inside:
        return
    cut = min(own[bisect_right(own, floor)] for own in inside) if every else max(own[-1] for own in inside)
    for node in stack[cut:]:
        places[page.tag[node]].pop()
    del stack[cut:]


_TAG = {t: i for i, t in enumerate(TAGS)}


def features(page: Page) -> np.ndarray:
    n = len(page.tag)
    parent = np.array(page.parent)
    own = np.array([len(t) if t != " " else 0 for t in page.text], np.float64)
    stops = np.array([t.count(". ") + t.count(", ") + t.endswith(".") for t in page.text], np.float64)
    total, linked, points = own.copy(), np.zeros(n), stops.copy()
    depth = np.zeros(n)
    inside = np.zeros(n, bool)
    for k in range(1, n):
        depth[k] = depth[parent[k]] + 1
        inside[k] = inside[parent[k]] or page.tag[k] == "a"
    linked[inside] = own[inside]
    for k in range(n - 1, 0, -1):
        total[parent[k]] += total[k]
        linked[parent[k]] += linked[k]
        points[parent[k]] += points[k]
    out = np.zeros((n, FEATURES))
    out[np.arange(n), [_TAG.get(t, len(TAGS)) for t in page.tag]] = 1
    base = len(TAGS) + 1
    named = [k for k in range(n) if page.names[k]]
    for k in named:
        out[k, base] = bool(BAD_WORDS.search(page.names[k]))
        out[k, base + 1] = bool(GOOD_WORDS.search(page.names[k]))
    out[:, base + 2] = np.log1p(total) / 5
    out[:, base + 3] = linked / np.maximum(total, 1)
    out[:, base + 4] = total > 200
    out[:, base + 5] = np.minimum(points, 20) / 10
    out[:, base + 6] = 1
    out[:, base + 7] = np.minimum(depth, 12) / 10
    return out


def prior() -> np.ndarray:
    """Weights before training: links, boilerplate tags and words speak against content, article tags and text for it."""
    w = np.zeros(FEATURES)
    for t in BAD_TAGS:
        w[_TAG[t]] = -4
    for t in GOOD_TAGS:
        w[_TAG[t]] = 3
    base = len(TAGS) + 1
    w[base : base + 8] = (-5, 1, 0.5, -2, 0.5, 0.5, -0.5, 0)
    return w


@dataclass
class Forest:
    """The trees of several pages as flat arrays, and their nodes by depth."""

    x: np.ndarray
    parent: np.ndarray
    levels: list[np.ndarray]
    start: np.ndarray


def forest(pages: list[Page]) -> Forest:
    sizes = np.array([len(p.tag) for p in pages])
    start = np.concatenate([[0], np.cumsum(sizes)])
    parent = np.concatenate([np.where(np.array(p.parent) < 0, -1, np.array(p.parent) + s) for p, s in zip(pages, start, strict=False)])
    depth = np.zeros(len(parent), np.int64)
    for k in range(len(parent)):  # parents come first
        if parent[k] >= 0:
            depth[k] = depth[parent[k]] + 1
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max() + 1)))
    return Forest(np.vstack([features(p) for p in pages]), parent, levels, start)


def _log_sum(a: np.ndarray) -> np.ndarray:
    return np.logaddexp(a[..., 0], a[..., 1])


def marginals(f: Forest, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(content marginal of each node, pair marginals [node, parent state, child state]) by messages up and down."""
    n = len(f.parent)
    node = np.zeros((n, 2))
    node[:, 1] = f.x @ weights
    up, inner = np.zeros((n, 2)), node.copy()  # inner: own potential and all messages from below
    for level in reversed(f.levels[1:]):
        up[level] = _log_sum(inner[level][:, None, :] + edges[None])
        np.add.at(inner, f.parent[level], up[level])
    belief = inner.copy()
    for level in f.levels[1:]:
        above = belief[f.parent[level]] - up[level]
        down = _log_sum(above[:, None, :] + edges.T[None])
        belief[level] = inner[level] + down - down.max(1, keepdims=True)
    probability = np.exp(belief[:, 1] - _log_sum(belief))
    child = np.concatenate(f.levels[1:]) if len(f.levels) > 1 else np.zeros(0, np.int64)
    pair = np.zeros((n, 2, 2))
    joint = (belief[f.parent[child]] - up[child])[:, :, None] + edges[None] + inner[child][:, None, :]
    joint -= joint.max((1, 2), keepdims=True)
    joint = np.exp(joint)
    pair[child] = joint / joint.sum((1, 2), keepdims=True)
    return probability, pair


def labels(page: Page) -> np.ndarray | None:
    """1 for nodes of the marked article, outside of boilerplate; None where no article is marked."""
    n = len(page.tag)
    out, inside, out_of = np.zeros(n), np.zeros(n, bool), np.zeros(n, bool)
    for k in range(1, n):
        p = page.parent[k]
        out_of[k] = out_of[p] or page.tag[k] in ("nav", "footer", "aside", "form", "button") or bool(page.names[k] and BAD_WORDS.search(page.names[k]))
        inside[k] = inside[p] or page.tag[k] in GOOD_TAGS
        out[k] = inside[k] and not out_of[k]
    return out if inside.any() else None


@dataclass
class Model:
    weights: np.ndarray
    edges: np.ndarray


def train(sources: list[str]) -> Model:
    """Maximum likelihood on pages whose article is marked; without any, the prior."""
    pages = [parse(s) for s in sources]
    marked = [(p, y) for p in pages if (y := labels(p)) is not None]
    weights, edges = prior(), np.array([[PRIOR_EDGE, 0.0], [0.0, PRIOR_EDGE]])
    if not marked:
        return Model(weights, edges)
    # once more without the marking, as plain divisions: most pages of the web mark no article
    bare = [Page(p.parent, ["div" if t in GOOD_TAGS else t for t in p.tag], p.names, p.text, p.hidden) for p, _ in marked]
    f = forest([p for p, _ in marked] + bare)
    y = np.concatenate([y for _, y in marked] * 2)
    child = np.flatnonzero(f.parent >= 0)
    truth = np.zeros((2, 2))
    np.add.at(truth, (y[f.parent[child]].astype(int), y[child].astype(int)), 1)
    scale = len(y)
    first, second = np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)
    start = np.concatenate([weights, edges.ravel()])
    now = start.copy()
    for step in range(1, STEPS + 1):  # Adam
        p, pair = marginals(f, now[:FEATURES], now[FEATURES:].reshape(2, 2))
        gradient = np.concatenate([f.x.T @ (y - p), (truth - pair[child].sum(0)).ravel()]) / scale - PULL / 100 * (now - start)
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        now = now + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    return Model(now[:FEATURES], now[FEATURES:].reshape(2, 2))


def main_texts(model: Model, sources: list[str]) -> list[str]:
    """The main text of each page; white space is one space, blocks are joined by one space."""
    pages = [parse(s) for s in sources]
    f = forest(pages)
    content = marginals(f, model.weights, model.edges)[0] >= 0.5
    out = []
    for page, at in zip(pages, f.start[:-1], strict=True):
        parts, block = [], None
        around: list[int] = []  # the nearest element of each node that is a block, itself included
        for k, text in enumerate(page.text):
            tag = page.tag[k]
            around.append(around[page.parent[k]] if tag in INLINE or tag == "#text" else k)
            if tag == "#text":
                if content[at + k] and not page.hidden[k]:
                    own = around[k]
                    if own != block:
                        parts.append(" ")
                        block = own
                    parts.append(text)
            elif tag not in INLINE:
                parts.append(" ")
        out.append(" ".join("".join(parts).split()))
    return out


def sample(pages: DataFrame, count: int = SAMPLE_PAGES) -> list[str]:
    """At most ``count`` pages with a marked article, in the order of a hash; only these come to the driver."""
    found = pages.where(F.col("html").rlike("(?i)<(article|main)[ >]") & (F.length("html") <= SAMPLE_CHARS))
    mixed = F.xxhash64(F.col("page_id").cast("string"), F.lit("pages"))
    ids = found.select(mixed.alias("mixed")).distinct().orderBy("mixed").limit(count)
    rows = found.withColumn("mixed", mixed).join(F.broadcast(ids), "mixed").select("mixed", "html").dropDuplicates(["mixed"])
    return [r.html for r in sorted(rows.collect(), key=lambda r: (r.mixed, r.html))]


def fit(pages: DataFrame, count: int = SAMPLE_PAGES) -> Model:
    return train(sample(pages.select("page_id", "html"), count))


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text, n_chars of every row; null, empty and text-free pages have an empty text.

    Repeated rows and null ids are kept as they are; an empty table gives an empty table; other columns are not read,
    whatever their names; a page is parsed whole, in time that grows with its length; nothing is shuffled.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sources in pieces(batches, "html", 1 << 20):
            texts = main_texts(shared.value, sources.to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(work, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")

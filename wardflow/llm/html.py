"""Main text of web pages by gradient-boosted trees over DOM nodes and hierarchical decoding.

Every element is described by its subtree's text density, link share, attribute tokens, depth and place among its
siblings.  Boosted trees give the probability that it belongs to the article.  Decoding works down from the
root: the labelling of all elements with the largest likelihood in which no element of a dropped subtree is kept
and no element is kept below a dropped ancestor.

Pages carry no labels.  The trees are trained on a bounded sample of pages, labelled by the elements HTML itself
names (``article``, ``nav``, ...), each in several disguises: names changed to ``div`` with common class names, and
blocks of other pages added as sidebars, notices, forms and comments.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, per_text, tune

FIT_PAGES = 300
VARIANTS = 3

# Kinds of elements, by the HTML standard (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section select"
    " noscript summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("td th tr tbody thead tfoot option".split())
# The page itself; text directly below it stands in blocks without a name.
SHELL = frozenset(("#root", "html", "body", "head"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Words of class names, ids and roles that name parts of a page (fixed values).
BOILER_WORDS = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent copyright disclaimer discussion footer form gdpr header disqus legal links login masthead"
    " menu modal nav navbar navigation newsletter notice pagination popup promo promoted recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe"
    " tags teaser toolbar topbar widget".split()
)
MAIN_WORDS = frozenset("article articlebody blog body content entry main maincontent page post story text".split())
GROUPS = (("nav", "menu"), ("header",), ("footer",), ("aside",), ("form", "select", "fieldset"), ("article",), ("main",), ("section",), ("p", "blockquote", "pre"), tuple(HEADINGS), ("ul", "ol", "dl"), ("li", "dt", "dd"), ("table", "tr", "td", "th", "tbody"))
GROUP_OF = {tag: i + 1 for i, tags in enumerate(GROUPS) for tag in tags}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL)
# The same without regard to quotes, for the rest of a page whose quotes do not match.
_UNQUOTED = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([A-Za-z][^\s/>]*)([^>]*)>", re.DOTALL)
_OPENING = re.compile(r"<(?=/?[A-Za-z]|[!?])")
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "names", "parent", "children", "depth", "chars", "links", "words", "stops", "size", "keep")

    def __init__(self, tag: str, names: frozenset, parent: Node | None) -> None:
        self.tag, self.names, self.parent = tag, names, parent
        # Text and elements in order; inline elements leave their text to the block around them.
        self.children: list = []
        self.depth = parent.depth + 1 if parent else 0
        self.chars = self.links = self.words = self.stops = self.size = 0
        self.keep = True


def _next_token(html: str, at: int, token: re.Pattern, last: int) -> tuple[re.Match | None, re.Pattern]:
    """The next tag or comment, and the pattern for what follows; ``last`` is the place of the page's last ``>``.

    Every character is looked at a bounded number of times: behind the last ``>`` no tag can end, and once a tag is
    not closed although a ``>`` follows, the quotes of the page do not match and are not regarded any more.
    """
    while (begin := _OPENING.search(html, at)) is not None:
        i = begin.start()
        if i > last and html[i + 1] not in "!?":
            return None, token
        if (m := token.match(html, i)) is not None:
            return m, token
        token = _UNQUOTED
        if (m := token.match(html, i)) is not None:
            return m, token
        at = i + 1
    return None, token


def parse(html: str) -> Node:
    """The tree of block elements, however deep.  Unclosed and stray tags are repaired as browsers do for the common cases."""
    root = Node("#root", frozenset(), None)
    open_nodes, in_link, pos, at = [root], 0, 0, 0
    # How often each tag is open, and the tags that end nowhere ahead.
    opened: Counter[str] = Counter()
    endless: set[str] = set()
    token, last = _TOKEN, html.rfind(">")

    def close() -> str:
        tag = open_nodes.pop().tag
        opened[tag] -= 1
        return tag

    while True:
        m, token = _next_token(html, at, token, last)
        if m is None:
            break
        if m.start() > pos:
            _text(open_nodes[-1], html[pos : m.start()], in_link)
        at = pos = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                in_link = max(0, in_link - 1)
            if tag in BLOCK and opened[tag]:
                while close() != tag:
                    pass
            continue
        if tag in RAW:
            # Nothing in it is text of the page; it ends at its own end tag only.
            closed = m[3].endswith("/")
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(html, at) if not closed and tag not in endless else None
            if end is None and not closed:
                endless.add(tag)
            at = pos = end.end() if end else (len(html) if tag in ("script", "style") and not closed else at)
            continue
        if tag == "br":
            _holder(open_nodes[-1], "").children.append(" ")
        if tag == "a":
            in_link += 1
        if tag not in BLOCK or tag in VOID:
            if tag == "hr":
                open_nodes[-1].children.append(Node("hr", frozenset(), open_nodes[-1]))
            continue
        if tag in CLOSES_P and open_nodes[-1].tag == "p":
            close()
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option") and open_nodes[-1].tag in ((tag,) if tag in ("li", "tr", "option") else ("dt", "dd") if tag in ("dt", "dd") else ("td", "th")):
            close()
        names = frozenset(w.lower() for a in _ATTRIBUTE.finditer(m[3]) for w in _SPLIT.split(a[2] or a[3] or a[4] or "") if w)
        node = Node(tag, names, open_nodes[-1])
        open_nodes[-1].children.append(node)
        open_nodes.append(node)
        opened[tag] += 1
    if pos < len(html):
        _text(open_nodes[-1], html[pos:], in_link)
    _sum_up(root)
    return root


def _holder(node: Node, text: str) -> Node:
    """The block that text belongs to: of text directly below the page a nameless one, up to the next block."""
    if node.tag not in SHELL:
        return node
    last = node.children[-1] if node.children else None
    if isinstance(last, Node) and last.tag == "#text":
        return last
    if not text.strip():
        return node
    run = Node("#text", frozenset(), node)
    node.children.append(run)
    return run


def _text(node: Node, raw: str, in_link: int) -> None:
    text = unescape(raw) if "&" in raw else raw
    node = _holder(node, text)
    node.children.append(text)
    n = len(text.strip())
    if n:
        node.chars += n
        node.words += text.count(" ") + 1
        node.stops += sum(map(text.count, ".!?"))
        if in_link:
            node.links += n


def _sum_up(root: Node) -> None:
    """Adds what lies below to every element, children before their parents."""
    for node in reversed(nodes_of(root)):
        node.size += 1
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.links += node.links
            up.words += node.words
            up.stops += node.stops
            up.size += node.size


def nodes_of(root: Node) -> list[Node]:
    """All elements, parents before children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


N_FEATURES = 20


def describe(nodes: list[Node]) -> np.ndarray:
    """One row of features per element."""
    whole = max(1, nodes[0].chars)
    rows = []
    boiler: dict[Node, int] = {}
    main: dict[Node, int] = {}
    # Place among the siblings, their number, the longest of them, and those of the same tag: told by the parent.
    among: dict[Node, tuple[int, int, int, int]] = {}
    for node in nodes:
        up = node.parent
        own_boiler = 1 if not BOILER_WORDS.isdisjoint(node.names) or node.tag in ("nav", "footer", "aside", "form", "header", "menu", "button", "select", "dialog") else 0
        own_main = 1 if not MAIN_WORDS.isdisjoint(node.names) or node.tag in ("article", "main") else 0
        boiler[node] = max(own_boiler, boiler.get(up, 0))
        main[node] = max(own_main, main.get(up, 0))
        if node in among:
            place, siblings, longest, alike = among[node]
        else:
            place, siblings, longest, alike = 0, 1, node.chars, 1
        below = [c for c in node.children if isinstance(c, Node)]
        tags, most = Counter(c.tag for c in below), max((c.chars for c in below), default=0)
        for i, child in enumerate(below):
            among[child] = i, len(below), most, tags[child.tag]
        rows.append((
            GROUP_OF.get(node.tag, 0), node.depth, np.log1p(node.chars), node.chars / whole, node.links / max(1, node.chars), np.log1p(node.words), node.stops / max(1, node.words),
            node.chars / node.size, np.log1p(node.size), own_boiler, own_main, boiler[node], main[node], place / siblings, siblings, alike / siblings,
            node.chars / max(1, longest), up.links / max(1, up.chars) if up else 0.0, GROUP_OF.get(up.tag, 0) if up else 0, node.chars / max(1, node.words),
        ))
    return np.array(rows, np.float32)


def decode(nodes: list[Node], chance: np.ndarray) -> None:
    """Sets ``keep``: the most likely labelling without a kept element below a dropped one."""
    p = np.clip(chance, 1e-4, 1 - 1e-4)
    yes, no = np.log(p), np.log(1 - p)
    index = {node: i for i, node in enumerate(nodes)}
    # Elements without text say nothing.
    yes[[i for i, n in enumerate(nodes) if not n.chars]] = no[[i for i, n in enumerate(nodes) if not n.chars]] = 0.0
    drop, best = no.copy(), yes.copy()
    for i in range(len(nodes) - 1, -1, -1):
        for child in nodes[i].children:
            if isinstance(child, Node):
                j = index[child]
                drop[i] += drop[j]
                best[i] += max(best[j], drop[j])
    for i, node in enumerate(nodes):
        # Root, html and body are the page: they are kept for what is below them.
        shell = node.tag in SHELL
        node.keep = (node.parent is None or node.parent.keep) and (shell or best[i] > drop[i])


def text_of(root: Node) -> str:
    """Blocks of kept elements in page order, white space inside a block as one space, empty blocks left out."""
    out: list[str] = []
    stack: list = [root]
    held: list[str] = []

    def flush() -> None:
        block = _SPACE.sub(" ", "".join(held)).strip()
        if block:
            out.append(block)
        held.clear()

    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            held.append(item)
        else:
            flush()
            if item.keep:
                stack.append(None)
                stack.extend(reversed(item.children))
    flush()
    return "\n".join(out)


class Boosted:
    """Gradient-boosted depth-limited regression trees for the logistic loss, on binned features."""

    def __init__(self, rounds: int = 30, depth: int = 4, rate: float = 0.3, bins: int = 32) -> None:
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, self.bins + 1)[1:-1])) for k in range(x.shape[1])]
        binned, share_good = self._binned(x), float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.start = float(np.log(share_good / (1 - share_good)))
        score = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            score += self._walk(binned, tree)
        return self

    def _grow(self, binned: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner, leaves, width = 2**self.depth - 1, 2**self.depth, self.bins + 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, width)
        at = np.zeros(len(gradient), np.int64)
        for level in range(self.depth):
            first = 2**level - 1
            best = np.full(2**level, 1e-6)
            for k in range(binned.shape[1]):
                cell = (at - first) * width + binned[:, k]
                g = np.bincount(cell, gradient, 2**level * width).reshape(-1, width).cumsum(axis=1)
                h = np.bincount(cell, hessian, 2**level * width).reshape(-1, width).cumsum(axis=1)
                gain = g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                where = gain.argmax(axis=1)
                top = gain[np.arange(len(gain)), where]
                better = top > best
                best[better] = top[better]
                feature[first : first + len(best)][better] = k
                cut[first : first + len(best)][better] = where[better]
            at = 2 * at + 1 + (binned[np.arange(len(at)), feature[at]] > cut[at])
        value = self.rate * np.bincount(at - inner, gradient, leaves) / (np.bincount(at - inner, hessian, leaves) + 1)
        return feature, cut, value

    def _walk(self, binned: np.ndarray, tree: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        feature, cut, value = tree
        at = np.zeros(len(binned), np.int64)
        rows = np.arange(len(binned))
        for _ in range(self.depth):
            at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
        return value[at - len(feature)]

    def chance(self, x: np.ndarray) -> np.ndarray:
        binned, score = self._binned(x), np.full(len(x), self.start)
        feature, cut, value = (np.stack(t) for t in zip(*self.trees))
        # All trees at once: rows by trees.
        at = np.zeros((len(x), len(self.trees)), np.int64)
        tree, rows = np.arange(len(self.trees)), np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = 2 * at + 1 + (binned[rows, feature[tree, at]] > cut[tree, at])
        return 1 / (1 + np.exp(-(score + value[tree, at - feature.shape[1]].sum(axis=1))))


def disguise(html: str, spare: list[str], seed: int) -> str:
    """A page with other names for its parts and with added blocks that are no article; variant 0 is the page itself."""
    rng = random.Random(seed)
    if seed % VARIANTS == 0:
        return html
    bare = rng.random() < 0.3
    if bare:
        html = re.sub(r"(?is)(<article\b[^>]*>)(.*?)(?=</article>)", lambda m: m[1] + _loose(m[2], rng.random() < 0.7), html)
    blocks = []
    for names in (("sidebar", "widget related"), ("cookie-notice", "consent banner"), ("comments", "discussion"), ("newsletter signup", "promo")):
        name, text = rng.choice(names), rng.choice(spare)
        inner = f"<p>{text}</p>" * rng.randint(1, 3)
        blocks.append(rng.choice([f'<div class="{name}" data-off="1">{inner}</div>', f'<aside data-off="1">{inner}</aside>', f'<section id="{name.split()[0]}" data-off="1">{inner}</section>', f'<form data-off="1">{inner}<label>{text[:40]}</label></form>', f'<header data-off="1"><p>{text[:80]}</p></header>']))
    if rng.random() < 0.7:
        before = rng.random() < 0.5
        html = re.sub(r"(?i)<article" if before else r"(?i)</article>", lambda m: blocks[0] + blocks[1] + m[0] if before else m[0] + blocks[2] + blocks[3], html, count=1)
    if rng.random() < 0.3:
        html = re.sub(r"(?i)</article>", lambda m: blocks[2] + m[0], html, count=1)
    if bare:
        html = re.sub(r"(?i)</?article\b[^>]*>", "", html)
        links = " | ".join(f'<a href="/{k}">{rng.choice(spare)[: rng.randint(4, 20)]}</a>' for k in range(rng.randint(2, 8)))
        html = re.sub(r"(?i)<body\b[^>]*>", lambda m: m[0] + links, html, count=1) if rng.random() < 0.5 else re.sub(r"(?i)</body>", lambda m: f"{links} &copy; {rng.choice(spare)[:30]}{m[0]}", html, count=1)
    elif rng.random() < 0.5:
        main = rng.choice(["post-content", "entry-content", "story-body", "main", "article-text"])
        html = re.sub(r"(?i)<article", f'<div data-on="1" class="{main}"', html)
        html = re.sub(r"(?i)</article>", "</div>", html)
    if rng.random() < 0.5:
        for tag, name in (("nav", "menu"), ("footer", "footer"), ("aside", "sidebar"), ("header", "topbar")):
            html = re.sub(rf"(?i)<{tag}", f'<div data-off="1" class="{name}"', html)
            html = re.sub(rf"(?i)</{tag}>", "</div>", html)
    return html


# Stands in text that belongs to the article, in training only.
_ON = "\ue000"


def _loose(inner: str, text: bool) -> str:
    """The blocks of an article as they stand without it: paragraphs as text with line breaks, or by themselves."""
    if text:
        inner = re.sub(r"(?i)</p>", "<br><br>", re.sub(r"(?i)<p\b[^>]*>", _ON, inner))
    return re.sub(r"(?i)<(p|h[1-6]|ul|ol|table|blockquote|pre|section|div)\b", r'<\1 data-on="1"', inner)


_MARKED = re.compile(r"\bdata-(on|off)=\"1\"")


def teach(html: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Features and labels of the elements of a page that names its article; None if it names none."""
    marks = re.sub(r"data-(on|off)=\"1\"( class=\")?", lambda m: f'class="zz{m[1]} ' if m[2] else f'role="zz{m[1]}"', html)
    truth, plain = nodes_of(parse(marks)), nodes_of(parse(_MARKED.sub("", html).replace(_ON, "")))
    if len(truth) != len(plain):
        return None
    label: dict[Node, bool] = {}
    for node in truth:
        up = label.get(node.parent, False)
        on = node.tag in ("article", "main") or "zzon" in node.names or node.tag == "#text" and any(_ON in c for c in node.children)
        off = node.tag in ("nav", "footer", "aside", "form", "header") or "zzoff" in node.names or not BOILER_WORDS.isdisjoint(node.names)
        label[node] = (up or on) and not off
    if not any(label.values()):
        return None
    use = [i for i, n in enumerate(truth) if n.chars and n.tag not in SHELL]
    return describe(plain)[use], np.array([label[truth[i]] for i in use], float)


def fit(pages: DataFrame, html_col: str = "html", fit_pages: int = FIT_PAGES) -> Boosted | None:
    """Trees trained on about ``fit_pages`` pages that name their article, each in ``VARIANTS`` forms; None if there are none."""
    # Only pages that name their article can teach; which of them do depends on the pages alone.
    named = pages.select(column(html_col).alias("html")).where(F.col("html").rlike(r"(?i)<(article|main)\b")).withColumn("pick", F.xxhash64("html"))
    every = max(1, named.count() // fit_pages)
    sample = named.where(F.pmod("pick", F.lit(every)) == 0).dropDuplicates(["pick"])

    def examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pick, html in zip(batch["pick"], batch["html"]):
                texts = re.findall(r"<p>([^<]{40,400})", html)[:60] or ["Read more about this."]
                for v in range(VARIANTS):
                    if (got := teach(disguise(html, texts, VARIANTS * (pick % 1_000_003 + 1) + v))) is not None:
                        yield pd.DataFrame({"pick": [pick], "v": [v], "x": [got[0].tobytes()], "y": [got[1].tobytes()]})

    rows = sample.mapInPandas(examples, "pick bigint, v int, x binary, y binary").collect()
    rows.sort(key=lambda r: (r["pick"], r["v"]))
    if not rows:
        return None
    x = np.concatenate([np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES) for r in rows])
    return Boosted().fit(x, np.concatenate([np.frombuffer(r["y"]) for r in rows]))


def main_text(html: str | None, model: Boosted) -> str:
    if not html:
        return ""
    root = parse(html)
    nodes = nodes_of(root)
    decode(nodes, model.chance(describe(nodes)))
    return text_of(root)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", fit_pages: int = FIT_PAGES) -> DataFrame:
    """Per page: ``page_id, url, text, n_chars``.

    Null, empty and text-free pages give the empty string.  Repeated rows each keep their row; only the three columns
    named are read.  If no page names its article there is nothing to learn from, and every element
    counts as article except those whose own name or class says otherwise.
    """
    tune(pages.sparkSession)
    model = fit(pages, html_col, fit_pages)
    sent = pages.sparkSession.sparkContext.broadcast(None if model is None else (model.edges, model.trees, model.start))

    def start():
        made = Boosted()
        if sent.value is None:
            return lambda html: (lambda t: (t, len(t)))(_by_names(html))
        made.edges, made.trees, made.start = sent.value
        return lambda html: (lambda t: (t, len(t)))(main_text(html, made))

    out = per_text(start, "text string, n_chars bigint", column(html_col))
    return pages.select(column(id_col).alias("page_id"), column(url_col).alias("url"), out.alias("r")).select("page_id", "url", "r.*")


def _by_names(html: str | None) -> str:
    if not html:
        return ""
    root = parse(html)
    nodes = nodes_of(root)
    x = describe(nodes)
    decode(nodes, np.where(x[:, 11] > 0, 0.05, 0.95))
    return text_of(root)

"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element is a node with the label content or not. A node's potential comes from its tag,
the words of its class and id, and the text below it; another links its label to its
parent's. Messages are passed up from the leaves and down again (sum-product), which gives
every node its exact marginal; all pages of a batch are worked on at once, depth by depth.
Text goes out where its block's marginal favours content.

The potentials are trained by maximum likelihood on labelled pages: a bounded sample of the
given pages that mark their article, each in its own form and in forms rebuilt with other
tags, with and without telling names, and with sidebars, notices, forms, adverts and
comments put in, whose labels are known because they were put in.

Defined results: NULL and empty html, and pages without content, give an empty text; broken
markup is read as far as it goes, in linear time: after a value whose quotes never end any ``>``
ends a tag, and a tag that never ends ends the page; repeated rows give the same text.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.llm import arrays
from deskmill.operators.skew import join_null_safe

#: Pages that the model is trained on, before they are rebuilt.
SAMPLE = 240
FEATURES = 1 << 13
#: Bytes of html whose nodes are worked on together.
BATCH_BYTES = 1 << 19

#: Elements that begin and end a block, have no end tag, or hold no text of the page.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot "
    "th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = frozenset("head script style noscript template title textarea svg math iframe object canvas audio video select button".split())
RAW_TAGS = frozenset("script style textarea title iframe noscript".split())
HEAD_TAGS = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
CLOSES_P = BLOCK_TAGS - {"body", "html", "option", "tbody", "td", "tfoot", "th", "thead", "tr"}
CLOSED_BY_OWN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

_PLAIN = r"<!--(?:.*?--!?>|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)%s>|[^<]+|<"
#: A quoted value may hold ``>``. Nothing is tried in two ways, so the time is linear.
_TOKEN = re.compile(_PLAIN % r"""((?>[^>=]++|=\s*+"[^"]*"|=\s*+'[^']*'|=)*+)""", re.DOTALL)
#: For what follows a tag whose quotes never end: any ``>`` ends a tag.
_LOOSE = re.compile(_PLAIN % r"([^>]*)", re.DOTALL)
_TAG_START = re.compile(r"</?[a-zA-Z]")
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_LABEL = re.compile(r'data-content="([01])"')
_WORD = re.compile(r"[a-zA-Z]+")
_SPACE = re.compile(r"\s+")
_ENDS = re.compile(r"[.!?,;:]")


class Tree:
    """Elements of one page in page order: parents, features, and text blocks by element."""

    def __init__(self, source: str):
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.names: list[str] = []
        self.label: list[int] = []
        self.blocks: list[tuple[int, str]] = []
        self.in_link: list[int] = []  # characters of link text, by element
        self._read(source)

    def _open(self, tag: str, attributes: str, parent: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.names.append(" ".join(filter(None, (g for m in _NAMES.findall(attributes) for g in m))).lower() if "=" in attributes else "")
        mark = _LABEL.search(attributes) if "data-content" in attributes else None
        self.label.append(int(mark[1]) if mark else self.label[parent] if parent >= 0 else 0)
        self.in_link.append(0)
        return len(self.parent) - 1

    def _read(self, source: str) -> None:
        """Read the page once. Where each tag is open is kept, so that no step searches the stack."""
        stack = [self._open("html", "", -1)]
        open_at: dict[str, list[int]] = {"html": [0]}  # depths, by tag
        blocks = [0]  # depths of open blocks
        at, silent, link = 0, 0, 0
        pending: list[str] = []
        owner = 0
        token = _TOKEN

        def deepest(tag: str) -> int:
            return open_at[tag][-1] if open_at.get(tag) else 0

        def flush() -> None:
            if pending:
                text = _SPACE.sub(" ", html.unescape("".join(pending))).strip()
                if text:
                    self.blocks.append((owner, text))
                pending.clear()

        def close_to(depth: int) -> None:
            nonlocal silent, link, owner
            while len(stack) > depth:
                tag = self.tag[stack.pop()]
                open_at[tag].pop()
                silent -= tag in SILENT_TAGS
                link -= tag == "a"
                if tag in BLOCK_TAGS:
                    flush()
                    blocks.pop()
                    owner = stack[blocks[-1]]

        while at < len(source):
            m = token.match(source, at)
            if m[0] == "<" and _TAG_START.match(source, at):  # its quotes never end, or there is no > to come
                token = _LOOSE
                m = token.match(source, at)
                if m[0] == "<":
                    break  # the page ends inside a tag
            at = m.end()
            if m[2] is None:
                text = m[0]
                if text[0] == "<" and len(text) > 1:
                    continue  # a comment or a declaration
                if self.tag[stack[-1]] == "head" and not text.isspace():
                    close_to(len(stack) - 1)
                if not silent:
                    pending.append(text)
                    if link:
                        self.in_link[owner] += len(text)
                continue
            tag = m[2].lower()
            if m[1]:  # an end tag
                depth = 0 if tag in ("html", "body") else deepest(tag)
                if depth and (tag in BLOCK_TAGS or depth > blocks[-1]):
                    close_to(depth)
                continue
            if tag == "html":
                mark = _LABEL.search(m[3])
                self.label[0] = int(mark[1]) if mark else 0
                continue
            if self.tag[stack[-1]] == "head" and tag not in HEAD_TAGS:
                close_to(len(stack) - 1)  # its end tag may be left out
            if tag == "br":
                pending.append(" ")
            if tag in CLOSES_P and self.tag[stack[blocks[-1]]] == "p":
                close_to(blocks[-1])
            if tag in CLOSED_BY_OWN and deepest(tag) > max(deepest(t) for t in CLOSED_BY_OWN[tag]):
                close_to(deepest(tag))
            if tag in BLOCK_TAGS:
                flush()
            node = self._open(tag, m[3], stack[-1])
            if tag in VOID_TAGS or m[3].endswith("/"):
                continue
            if tag in RAW_TAGS:
                end = re.compile(f"</{tag}", re.IGNORECASE).search(source, at)
                at = end.start() if end else len(source)
            open_at.setdefault(tag, []).append(len(stack))
            if tag in BLOCK_TAGS:
                blocks.append(len(stack))
                owner = node
            stack.append(node)
            silent += tag in SILENT_TAGS
            link += tag == "a"
        flush()

    def text(self, content: np.ndarray) -> str:
        """Blocks of the elements marked, joined in page order."""
        return "\n".join(text for node, text in self.blocks if content[node])


def _bucket(value: int) -> int:
    return min(9, int(value).bit_length())


_hashed: dict[str, int] = {}


def _feature(name: str) -> int:
    if len(_hashed) > 50_000:
        _hashed.clear()
    if name not in _hashed:
        _hashed[name] = zlib.crc32(name.encode()) % FEATURES
    return _hashed[name]


def node_features(tree: Tree) -> list[list[int]]:
    """Hashed features of every element."""
    n = len(tree.parent)
    below, own, links, marks = [0] * n, [0] * n, list(tree.in_link), [0] * n
    for node, text in tree.blocks:
        own[node] += len(text)
        marks[node] += len(_ENDS.findall(text)) if len(text) < 400 else 5
    below = own.copy()
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = tree.parent[i]
        below[p] += below[i]
        links[p] += links[i]
        marks[p] += marks[i]
    out = []
    for i in range(n):
        tag = tree.tag[i]
        density = min(4, 4 * links[i] // max(1, below[i]))
        shape = f"{_bucket(below[i])}"
        found = [f"t {tag}", f"l {shape}", f"k {density}", f"m {min(3, marks[i])}", f"o {_bucket(own[i])}", f"tl {tag} {min(8, _bucket(below[i]))} {density}"]
        names = tree.names[i]
        if names:
            found += [f"c {word}" for word in _WORD.findall(names)]
        else:
            found.append("no name")
        out.append([_feature(f) for f in found])
    return out


class Forest:
    """Elements of many pages as flat arrays, ready for message passing."""

    def __init__(self, trees: list[Tree]):
        sizes = [len(t.parent) for t in trees]
        self.starts = np.cumsum([0, *sizes])
        self.parent = np.concatenate([np.array(t.parent) + (s if s else 0) for t, s in zip(trees, self.starts, strict=False)] or [np.zeros(0, int)])
        self.parent[self.starts[:-1]] = -1
        features = [f for t in trees for f in node_features(t)]
        self.owner = np.repeat(np.arange(len(features)), [len(f) for f in features])
        self.feature = np.array([x for f in features for x in f], np.int64)
        self.kind = np.array([_feature(f"e {tag}") % KINDS for t in trees for tag in t.tag], np.int64)
        depth = np.zeros(len(self.parent), np.int64)
        for t, s in zip(trees, self.starts, strict=False):
            own: list[int] = []
            for p in t.parent:
                own.append(0 if p < 0 else own[p] + 1)
            depth[s : s + len(own)] = own
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(depth.max() + 2)) if len(depth) else [0]
        self.levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


#: Groups of tags that have parent-child potentials of their own.
KINDS = 256


def _lse(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def marginals(forest: Forest, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of content for every element, and of each pair of labels of parent and child.

    ``weights`` scores content by feature; ``edges[kind, parent label, child label]``.
    """
    n = len(forest.parent)
    up = np.zeros((n, 2))  # the element's potential and the messages of its children
    up[:, 1] = np.bincount(forest.owner, weights[forest.feature], minlength=n)
    pair = edges[forest.kind]
    sent = np.zeros((n, 2))  # message to the parent, by the parent's label
    for level in reversed(forest.levels[1:]):
        for y in (0, 1):
            sent[level, y] = _lse(up[level, 0] + pair[level, y, 0], up[level, 1] + pair[level, y, 1])
        parents = forest.parent[level]
        low = parents.min()
        for y in (0, 1):
            sums = np.bincount(parents - low, sent[level, y])
            up[low : low + len(sums), y] += sums
    down = np.zeros((n, 2))
    both = np.zeros((n, 2, 2))
    for level in forest.levels[1:]:
        parents = forest.parent[level]
        above = up[parents] + down[parents] - sent[level]
        for y in (0, 1):
            down[level, y] = _lse(above[:, 0] + pair[level, 0, y], above[:, 1] + pair[level, 1, y])
        joint = above[:, :, None] + pair[level] + up[level][:, None, :]
        joint -= joint.max(axis=(1, 2), keepdims=True)
        joint = np.exp(joint)
        both[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
    belief = up + down
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), both


# -- labelled pages ---------------------------------------------------------------------------

_ARTICLE = re.compile(r"<(article|main)\b([^>]*)>(.*?)</\1>", re.DOTALL | re.IGNORECASE)
_NAV = re.compile(r"<(nav|footer|header|aside)\b([^>]*)>(.*?)</\1>", re.DOTALL | re.IGNORECASE)

_PARAGRAPH = re.compile(r"<p>([^<]*)</p>", re.IGNORECASE)

#: What a paragraph may be in place of ``<p>``.
OTHER_BLOCKS = ["<pre>{}</pre>", "<blockquote><p>{}</p></blockquote>", "<ul><li>{}</li></ul>", "<table><tr><td>{}</td></tr></table>", "<div>{}</div>", "<h2>{}</h2>"]

#: Names of classes in rebuilt pages, plainly, by what they stand for.
CONTENT_NAMES = "post content entry story article main body text".split()
OTHER_NAMES = {
    "nav": "menu navbar navigation nav links topnav".split(),
    "footer": "footer bottom copyright legal siteinfo".split(),
    "header": "header masthead banner topbar branding".split(),
    "aside": "sidebar related widget rail aside".split(),
}
ADVERT_NAMES = "ad ads advert sponsored promo banner".split()
NOTICE_NAMES = "cookie consent notice alert gdpr popup".split()
COMMENT_NAMES = "comments comment replies discussion respond".split()
FORM_NAMES = "newsletter subscribe search signup form".split()


def rebuilt(source: str, form: int, other: str, pick: np.random.Generator) -> str | None:
    """A labelled page: ``data-content`` tells the label of an element and all below it.

    Form 0 keeps the page, with parts put into its article; 1 uses telling names in place of tags;
    2 leaves out names of the content; 3 leaves the content's blocks in the body; from 1 on, other
    parts are put in around and inside. ``other`` is foreign text.
    """
    found = list(_ARTICLE.finditer(source))
    if len(found) != 1:
        return None
    m = found[0]
    choose = lambda names: str(pick.choice(names))
    before, inside, after = source[: m.start()], m[3], source[m.end() :]
    if pick.random() < 0.3:  # content need not be in sentences
        inside = re.sub(r"[.,:!?](?=[\s<])", "", inside)
        if pick.random() < 0.5:  # nor in long paragraphs
            each = int(pick.integers(1, 8))
            inside = re.sub(r"((?:[^\s<>]+ ){%d}[^\s<>]+) (?=[^<>]*</p>)" % each, r"\1</p><p>", inside)
    if form and pick.random() < 0.4:  # nor long
        inside = "".join(p[0] for p in list(_PARAGRAPH.finditer(inside))[: int(pick.integers(1, 4))]) or inside
    if form and pick.random() < 0.5:  # nor in paragraphs only
        inside = _PARAGRAPH.sub(lambda p: str(pick.choice(OTHER_BLOCKS)).format(p[1]) if pick.random() < 0.3 else p[0], inside)
    rename = lambda k: f'<div class="{choose(OTHER_NAMES[k[1].lower()])}" data-content="0">{k[3]}</div>'
    if form:
        before, after = _NAV.sub(rename, before), _NAV.sub(rename, after)
    words = other.split()
    some = lambda n: html.escape(" ".join(words[(at := int(pick.integers(0, max(1, len(words) - n)))) : at + n]))
    linked = "".join(f'<li><a href="/x">{some(2)}</a></li>' for _ in range(int(pick.integers(3, 7))))
    side = f'<{choose(["aside", "div"])} class="{choose(OTHER_NAMES["aside"])}" data-content="0"><h3>{some(2)}</h3><ul>{linked}</ul></div></aside>'
    notice = f'<div class="{choose(NOTICE_NAMES)}" data-content="0"><p>{some(int(pick.integers(8, 30)))}</p><button>{some(1)}</button></div>'
    advert = f'<div class="{choose(ADVERT_NAMES)}" data-content="0">{some(int(pick.integers(4, 16)))}</div>'
    asked = f'<form class="{choose(FORM_NAMES)}" data-content="0"><label>{some(3)}</label><input type="text"><p>{some(6)}</p></form>'
    said = "".join(f'<div class="comment"><p>{some(int(pick.integers(5, 40)))}</p></div>' for _ in range(int(pick.integers(1, 5))))
    tag = choose(["div", "section"])
    comments = f'<{tag} {choose(["class", "id"])}="{choose(COMMENT_NAMES)}" data-content="0"><h3>{some(1)}</h3>{said}</{tag}>'
    head = f'<header data-content="0"><a href="/">{some(2)}</a><p>{some(5)}</p></header>'
    name = f' class="{choose(CONTENT_NAMES)}"' if form == 1 else ""
    kind = choose(["div", "section", "main"]) if form == 1 else choose(["article", "div"])
    if pick.random() < 0.5:
        inside = re.sub(r"(<h1.*?</h1>)", r"<header>\1</header>", inside, count=1, flags=re.DOTALL)
    bare = f'<aside data-content="0">{some(int(pick.integers(1, 12)))}</aside>'
    form_only = f'<form data-content="0">{some(int(pick.integers(1, 6)))}</form>'
    first_said = f'<{tag} class="{choose(COMMENT_NAMES)}" data-content="0">{some(int(pick.integers(1, 6)))}</{tag}>'
    parts = [p for p in (advert, asked, comments, bare, form_only, first_said) if pick.random() < 0.4]
    if form == 0:
        return f'{before}<{m[1]}{m[2]} data-content="1">{inside}{"".join(parts)}</{m[1]}>{after}'
    outside = [p for p in (side, notice, advert, asked, comments) if pick.random() < 0.6]
    if form == 3:
        if pick.random() < 0.3:  # nor in blocks at all
            return f'<html data-content="1">{re.sub(r"<[^>]*>", " ", inside)}'
        lone = [head, notice, *outside] if pick.random() < 0.5 else []
        cut = len(lone) // 2
        return f'<html><body data-content="1">{"".join(lone[:cut])}{inside}{"".join(lone[cut:])}</body></html>'
    return f'{before}{head}{notice}<{kind}{name} data-content="1">{inside}{"".join(parts)}</{kind}>{"".join(outside)}{after}'


def train(pages: list[str], seed: int = 7, rounds: int = 120) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights and parent-child potentials by gradient ascent on the likelihood."""
    pick = np.random.default_rng(seed)
    made = []
    plain = [_SPACE.sub(" ", re.sub(r"<[^>]*>", " ", p)) for p in pages]
    for i in range(max(SAMPLE, len(pages)) if pages else 0):  # few pages are rebuilt more than once
        for form in range(4):
            made.append(rebuilt(pages[i % len(pages)], form, plain[(i + form) % len(pages)], pick))
    trees = [Tree(p) for p in made if p]
    weights, edges = np.zeros(FEATURES), np.zeros((KINDS, 2, 2))
    edges[:, 0, 0] = edges[:, 1, 1] = 1.0  # a child is like its parent, if nothing speaks against it
    if not trees:
        weights[_feature("t article")] = weights[_feature("t main")] = 4.0
        return weights, edges
    forest = Forest(trees)
    truth = np.array([y for t in trees for y in t.label], float)
    child = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((len(truth), 2, 2))
    seen[child, truth[forest.parent[child]].astype(int), truth[child].astype(int)] = 1
    moments = [np.zeros(FEATURES), np.zeros(FEATURES), np.zeros_like(edges), np.zeros_like(edges)]
    for step in range(1, rounds + 1):
        content, both = marginals(forest, weights, edges)
        slope = np.bincount(forest.feature, (truth - content)[forest.owner], minlength=FEATURES) / len(trees) - 1e-3 * weights
        lean = np.zeros_like(edges)
        np.add.at(lean, forest.kind[child], (seen - both)[child])
        lean = lean / len(trees) - 1e-4 * edges
        for k, (value, gradient) in enumerate(((weights, slope), (edges, lean))):  # Adam
            first, second = moments[2 * k], moments[2 * k + 1]
            first += 0.1 * (gradient - first)
            second += 0.01 * (gradient * gradient - second)
            value += 0.15 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    return weights, edges


_RESULT = "page_id long, url string, text string, n_chars long"


def _extract(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, edges = shared.value
        for batch in arrays.slices(batches, "html", BATCH_BYTES):
            trees = [Tree(source or "") for source in batch.column("html").to_pylist()]
            forest = Forest(trees)
            content = marginals(forest, weights, edges)[0] > 0.5
            texts = [t.text(content[s:]) for t, s in zip(trees, forest.starts, strict=False)]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *made], ["page_id", "url", "text", "n_chars"])

    return run


def _articles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages that mark one article, the only ones to learn from."""
    for batch in batches:
        one = [sum(1 for _ in _ARTICLE.finditer(source or "")) == 1 for source in batch.column("html").to_pylist()]
        yield batch.filter(pa.array(one, pa.bool_()))


def main_text(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    order = F.xxhash64("page_id", "url")
    found = pages.mapInArrow(_articles, pages.schema)
    keys = found.select("page_id", "url").orderBy(order, "page_id", "url").limit(sample)
    marked = join_null_safe(found, F.broadcast(keys.distinct()), ["page_id", "url"], "left_semi").limit(2 * sample)
    sources = sorted(r["html"] for r in marked.select("html").collect() if r["html"])
    shared = pages.sparkSession.sparkContext.broadcast(train(sources))  # of fixed size
    return pages.mapInArrow(_extract(shared), _RESULT)

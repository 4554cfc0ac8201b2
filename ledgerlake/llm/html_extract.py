"""Main text of web pages by a tree-structured graphical model.

A page's block elements and text runs are the nodes of its tree, each with a hidden state
(content, other). Log-linear potentials join a node's state with its features (`columns`: tag,
words of class and id, length, share of links, ...) and with its parent's state, by tag. Sum-
product messages go up from the leaves and down from the root, for all trees of a batch at once,
level by level; they are exact on trees. Text runs whose marginal of content is 0.5 or more are
the main text. Training maximises the likelihood of labelled pages, with expected counts from
the same messages.

Labelled pages come from a bounded sample of the table: `SAMPLE_PAGES` pages (the smallest
hashes of their keys), up to `SAMPLE_CHARS` characters each. What a page marks as article or
main is content; navigation, headers, footers, asides, forms and what a class or id names as a
notice, advert, sidebar or comment are not. A page without such a mark carries no labels. Each
sampled page's words also fill `LAYOUTS` random layouts (`layouts`), whose blocks are labelled
as they are laid out, in all usual mark-ups of the same roles; so the model does not depend on
the few layouts of one site. Everything else covers all pages and whole texts.

Parsing is lenient: missing end tags, unknown tags, quotes and comments that never end, and
pages cut anywhere are read as far as they go, in time linear in the page. Inline elements join
their text to the block; white space (also no-break spaces) becomes one space.

Defined results: a null or empty page has an empty text; pages without any block of content have
an empty text; if no sampled page has words, the words of `FILLER` are laid out; repeated rows
have equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common

SAMPLE_PAGES = 240
SAMPLE_CHARS = 40_000
LAYOUTS = 5
STEPS = 120
RATE = 0.2
BETAS = (0.9, 0.99)
L2 = 1e-4
# Characters of the pages that one pass of messages takes (one page at least).
PASS_CHARS = 2_000_000
FILLER = "the quick brown fox jumps over the lazy dog while seven wizards brew five jugs of potion"

# Tags of HTML by what they do.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr nobr input picture source".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset(
    "script style template svg math head title noscript iframe object noframes noembed textarea select datalist audio "
    "video canvas map".split())
RAW = frozenset("script style title textarea iframe noframes noembed noscript template svg math".split())
P_ENDS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dt dd tr td th".split())
# A start tag ends the open element of its group, up to the element that holds the group.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
}
OTHER_TAGS = frozenset("nav header footer aside form dialog button menu".split())
# Words of class and id attributes by the role that they usually name.
CONTENT_NAMES = "article content main post entry story body text page single blog news".split()
OTHER_NAMES = {
    "menu": "nav navigation menu navbar topnav breadcrumb breadcrumbs pagination toc links tabs".split(),
    "header": "header masthead banner branding logo topbar tagline".split(),
    "footer": "footer copyright colophon legal imprint bottom".split(),
    "sidebar": "sidebar aside widget related recommended trending popular secondary rail tags archive".split(),
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay paywall newsletter subscribe disclaimer".split(),
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion promoted banner commercial".split(),
    "form": "form search login signup contact poll feedback".split(),
    "comments": "comment comments commentlist reply replies respond discussion disqus review reviews responses".split(),
    "share": "share sharing social follow toolbar rating author byline meta".split(),
}
_NEGATIVE = frozenset(w for role, ws in OTHER_NAMES.items() if role != "share" for w in ws)

_TOKEN = re.compile(
    r"""<(?:!--(?P<comment>.*?(?:--!?>|\Z))|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"""
    r"""(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)|[!?/][^>]*(?:>|\Z))""", re.S)
_NAMES = re.compile(r"""(?:^|[\s/"'])(class|id|role|x-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SENTENCE_END = tuple(".!?…:;\"'»”)")

TAGS = [*"#text p div article section main body nav header footer aside form ul ol li dl dt dd h1 h2 h3 h4 h5 h6 "
        "table tbody tr td th blockquote pre figure figcaption address fieldset button label center details summary "
        "dialog menu".split(), "?"]
KIND = {t: i for i, t in enumerate(TAGS)}
_UNKNOWN = KIND["?"]
NAME_BUCKETS = 1 << 16
NAMES_KEPT = 4
# Sizes of the feature columns, in order: tag, parent's tag, characters, share of links by
# tag, end of a sentence by parent's tag, children, depth; NAMES_KEPT hashed names follow.
_SIZES = [len(TAGS), len(TAGS), 16, 5 * len(TAGS), 3 * len(TAGS), 6, 6]
_STARTS = np.concatenate([[0], np.cumsum(_SIZES)])[:-1].astype(np.int64)
FEATURES = sum(_SIZES) + NAME_BUCKETS
_NAME_START = FEATURES - NAME_BUCKETS


@dataclass
class Tree:
    """Nodes of a page, parents before children, and the text in page order: pieces
    (node, text), node -1 for a block's edge."""

    parent: list[int] = field(default_factory=list)
    kind: list[int] = field(default_factory=list)
    names: list[tuple[int, ...]] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)  # 0 no text, 1 as a sentence does, 2 otherwise
    label: list[int] = field(default_factory=list)  # 1, 0, or -1 where nothing is said
    pieces: list[tuple[int, str]] = field(default_factory=list)

    def add(self, parent: int, kind: int, names: tuple[int, ...] = (), label: int = -1) -> int:
        self.parent.append(parent)
        self.kind.append(kind)
        self.names.append(names)
        self.chars.append(0)
        self.linked.append(0)
        self.ends.append(0)
        self.label.append(label)
        return len(self.parent) - 1


_name_cache: dict[str, tuple[tuple[int, ...], bool]] = {}


def _names(value: str) -> tuple[tuple[int, ...], bool]:
    """Hashed words of class and id, and whether one names a role that is no content."""
    if value not in _name_cache:
        if len(_name_cache) > 50_000:
            _name_cache.clear()
        words = list(dict.fromkeys(w.lower() for w in _WORDS.findall(value)))
        _name_cache[value] = (tuple(1 + zlib.crc32(w.encode()) % (NAME_BUCKETS - 1) for w in words[:NAMES_KEPT]),
                              any(w in _NEGATIVE for w in words))
    return _name_cache[value]


def parse(page: str, labelled: bool = False) -> Tree:
    """The tree of a page. If `labelled`, nodes are labelled by the marks of the page (see the
    module) or by its `x-label` attributes."""
    tree = Tree()
    root = tree.add(-1, KIND["body"], (), 0)
    stack: list[tuple[str, int]] = [("body", root)]  # open block elements and their nodes
    run, in_link, at = -1, False, 0
    end = len(page)
    while at <= end:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            text = page[at:stop]
            if "&" in text:
                text = entities.unescape(text)
            if run < 0 and not text.isspace():
                run = tree.add(stack[-1][1], 0, (), tree.label[stack[-1][1]])
            if run >= 0:
                tree.pieces.append((run, text))
                n = len(text) - text.count(" ")
                tree.chars[run] += n
                if in_link:
                    tree.linked[run] += n
                if not text.isspace():
                    tree.ends[run] = 1 if text.rstrip().endswith(_SENTENCE_END) else 2
        if not m:
            break
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                in_link = not m["end"]
            continue
        if tag == "br":
            tree.pieces.append((-1, " "))
            continue
        if m["end"]:
            if any(t == tag for t, _ in stack[1:]):
                while stack.pop()[0] != tag:
                    pass
                run, in_link = -1, False
                tree.pieces.append((-1, " "))
            continue
        if tag in NO_TEXT and tag != "head":
            if tag in RAW or not m["attrs"].endswith("/"):
                close = re.compile(f"</{tag}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).search(page, at)
                # A raw element that never ends takes the rest; others only themselves.
                at = close.end() if close else end if tag in RAW else at
            continue
        run, in_link = -1, False
        tree.pieces.append((-1, " "))
        if tag in ("html", "head", "body"):  # one root, whether the page says so or not
            continue
        if tag in P_ENDS and stack[-1][0] == "p":
            stack.pop()
        if tag in SIBLINGS:
            own, holders = SIBLINGS[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in own:
                    del stack[i:]
                    break
                if stack[i][0] in holders:
                    break
        if tag in VOID:
            continue
        names, negative, mark = (), False, None
        if "=" in m["attrs"]:
            values = {k.lower(): a or b or c for k, a, b, c in _NAMES.findall(m["attrs"])}
            mark = values.pop("x-label", None)
            if values:
                names, negative = _names(" ".join(values.values()))
        up = tree.label[stack[-1][1]]
        label = up
        if labelled:
            if mark is not None:
                label = int(mark)
            elif tag in OTHER_TAGS or negative:
                label = 0
            elif tag in ("article", "main"):
                label = 1
        stack.append((tag, tree.add(stack[-1][1], KIND.get(tag, _UNKNOWN), names, label)))
    return tree


@dataclass
class Forest:
    """The trees of several pages as arrays: parent (-1 for roots), kind, the nodes of each
    level with those of one parent side by side, where each parent's begin and which parents
    these are, and the numbers of the active features (a row per node)."""

    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]
    groups: list[tuple[np.ndarray, np.ndarray]]
    columns: np.ndarray

    def add_up(self, to: np.ndarray, level: int, values: np.ndarray) -> None:
        """Add the values of a level's nodes to their parents' rows of `to`."""
        starts, parents = self.groups[level]
        to[parents] += np.add.reduceat(values, starts, axis=0)


def forest(trees: list[Tree]) -> Forest:
    sizes = [len(t.parent) for t in trees]
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    join = lambda name: np.fromiter((x for t in trees for x in getattr(t, name)), np.int64, sum(sizes))
    parent, kind, chars, linked, ends = (join(n) for n in ("parent", "kind", "chars", "linked", "ends"))
    shift = np.repeat(starts, sizes)
    parent = np.where(parent >= 0, parent + shift, -1)
    # Levels: parents come before their children, so a node is ready when its parent is.
    depth = np.zeros(len(parent), np.int64)
    todo = np.flatnonzero(parent >= 0)
    levels = [np.flatnonzero(parent < 0)]
    order = np.argsort(parent[todo], kind="stable")
    todo, first = todo[order], parent[todo][order]
    while len(levels[-1]):
        a, b = np.searchsorted(first, levels[-1], "left"), np.searchsorted(first, levels[-1], "right")
        n = b - a
        nxt = todo[np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
        depth[nxt] = len(levels)
        levels.append(nxt)
    levels.pop()
    groups = []
    for level in levels:
        begins = np.flatnonzero(np.diff(parent[level], prepend=-2))
        groups.append((begins, parent[level][begins]))
    f = Forest(parent, kind, levels, groups, np.empty((len(parent), 7 + NAMES_KEPT), np.int64))
    children = np.zeros(len(parent), np.int64)
    for i in range(len(levels) - 1, 0, -1):
        f.add_up(chars, i, chars[levels[i]])
        f.add_up(linked, i, linked[levels[i]])
        f.add_up(children, i, np.ones(len(levels[i]), np.int64))
    share = linked / np.maximum(chars, 1)
    link = np.where(chars == 0, 4, np.digitize(share, [0.05, 0.35, 0.75]))
    up_kind = kind[np.maximum(parent, 0)]
    columns = f.columns
    columns[:, 0] = kind
    columns[:, 1] = up_kind
    columns[:, 2] = np.minimum(np.ceil(np.log2(chars + 1)), 15)
    columns[:, 3] = link * len(TAGS) + np.where(kind == 0, up_kind, kind)
    columns[:, 4] = ends * len(TAGS) + up_kind
    columns[:, 5] = np.minimum(np.ceil(np.log2(children + 1)), 5)
    columns[:, 6] = np.minimum(depth // 2, 5)
    columns[:, :7] += _STARTS
    columns[:, 7:] = _NAME_START  # the bucket of no name
    for t, start in zip(trees, starts):
        for i, names in enumerate(t.names):
            if names:
                columns[start + i, 7:7 + len(names)] = _NAME_START + np.array(names)
    return f


@dataclass
class Model:
    """weights: of the features in the state content; edges: [tag, parent's state, state]."""

    weights: np.ndarray
    edges: np.ndarray


def marginals(f: Forest, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """P(content) of each node, and P(parent's state, state) of each (zero for roots)."""
    own = np.zeros((len(f.parent), 2))
    own[:, 1] = model.weights[f.columns].sum(axis=1)
    up, edge = own, model.edges[f.kind]
    sent = np.zeros_like(up)
    for i in range(len(f.levels) - 1, 0, -1):
        level = f.levels[i]
        sent[level] = np.logaddexp(edge[level, :, 0] + up[level, 0, None], edge[level, :, 1] + up[level, 1, None])
        f.add_up(up, i, sent[level])
    belief = up.copy()
    joint = np.zeros((len(f.parent), 2, 2))
    for level in f.levels[1:]:
        above = belief[f.parent[level]] - sent[level]
        both = edge[level] + above[:, :, None] + up[level][:, None, :]
        belief[level] = np.logaddexp(both[:, 0], both[:, 1])
        both -= both.max(axis=(1, 2), keepdims=True)
        e = np.exp(both)
        joint[level] = e / e.sum(axis=(1, 2), keepdims=True)
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -60, 60))), joint


def train(trees: list[Tree]) -> Model:
    """Maximum likelihood with a Gaussian prior, by Adam on all labelled trees at once, with a rate that falls to nothing."""
    f = forest(trees)
    y = np.concatenate([np.array(t.label) for t in trees]).clip(0, 1)
    model = Model(np.zeros(FEATURES), np.zeros((len(TAGS), 2, 2)))
    inner = np.flatnonzero(f.parent >= 0)
    seen = np.zeros_like(model.edges)
    np.add.at(seen, (f.kind[inner], y[f.parent[inner]], y[inner]), 1)
    flat, per_node = f.columns.ravel(), f.columns.shape[1]
    n, params = max(1, len(trees)), [model.weights, model.edges]
    mean, square = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
    for step in range(1, STEPS + 1):
        p, joint = marginals(f, model)
        expected = np.stack([np.bincount(f.kind[inner], weights=joint[inner, a, b], minlength=len(TAGS))
                             for a in (0, 1) for b in (0, 1)], axis=-1).reshape(-1, 2, 2)
        got = np.bincount(flat, weights=np.repeat(y - p, per_node), minlength=FEATURES)
        for x, g, m, v in zip(params, (got, seen - expected), mean, square):
            g = g / n - L2 * x
            m += (1 - BETAS[0]) * (g - m)
            v += (1 - BETAS[1]) * (g ** 2 - v)
            x += RATE * (1 - step / (STEPS + 1)) * (m / (1 - BETAS[0] ** step)) / (np.sqrt(v / (1 - BETAS[1] ** step)) + 1e-9)
    return model


def texts_of(trees: list[Tree], model: Model) -> list[str]:
    """The main text of each page."""
    if not trees:
        return []
    f = forest(trees)
    p = marginals(f, model)[0]
    out, start = [], 0
    for t in trees:
        keep = (p[start:start + len(t.parent)] >= 0.5).tolist()
        out.append(" ".join("".join(x for node, x in t.pieces if node < 0 or keep[node]).split()))
        start += len(t.parent)
    return out


# -- layouts ------------------------------------------------------------------

def _tag(tag: str, inner: str, names: str = "", label: int | None = None, rng: random.Random | None = None) -> str:
    attr = ""
    if names := re.sub(r"[^\w-]", "", names):
        attr = f' {"id" if rng and rng.random() < 0.3 else "class"}="{names}"'
    if label is not None:
        attr += f' x-label="{label}"'
    return f"<{tag}{attr}>{inner}</{tag}>"


def layout(words: list[str], rng: random.Random) -> str:
    """A random page of `words` whose elements carry their labels."""
    def some(least: int, most: int) -> str:
        at, n = rng.randrange(len(words)), rng.randint(least, most)
        return entities.escape(" ".join((words[at:] + words)[:n]), quote=False)

    def sentence(least: int = 6, most: int = 40) -> str:
        return some(least, most).rstrip(".,;:") + rng.choice(".....!?")

    def link(least: int = 1, most: int = 4) -> str:
        return f'<a href="/{rng.randrange(999)}">{some(least, most)}</a>'

    def named(role: str) -> str:
        name = rng.choice(OTHER_NAMES[role])
        return rng.choice([name, name, f"{name}-{rng.choice(['box', 'area', 'wrap', 'list', 'block', 'inner'])}",
                           f"{rng.choice(['site', 'my', 'top', 'user', 'the'])}-{name}"])

    def links(n: int) -> str:
        return "".join(f"<li>{link()}</li>" for _ in range(n))

    def menu() -> str:
        body = rng.choice([f"<ul>{links(rng.randint(2, 9))}</ul>", " | ".join(link() for _ in range(rng.randint(2, 7)))])
        return rng.choice([_tag("nav", body, "", 0), _tag("div", body, named("menu"), 0, rng),
                           _tag("ul", links(rng.randint(2, 9)), named("menu"), 0, rng),
                           _tag("nav", body, named("menu"), 0, rng), _tag("menu", links(4), "", 0)])

    def header() -> str:
        h = rng.choice(["h1", "h2", "h3", "p", "div"])
        body = rng.choice(["", f"<{h}>{some(1, 6)}</{h}>", f"<{h}>{some(1, 6)}</{h}>", f"<{h}>{link()}</{h}>"])
        body += rng.choice(["", f"<p>{some(3, 10)}</p>", menu(), some(1, 5)])
        return rng.choice([_tag("header", body, "", 0), _tag("div", body, named("header"), 0, rng),
                           _tag("header", body, named("header"), 0, rng)])

    def footer() -> str:
        body = rng.choice([f"&copy; {some(1, 3)} &middot; {some(3, 16)}", f"<p>&copy; 2020 {some(2, 9)}</p>",
                           f"<p>{sentence(5, 30)}</p><ul>{links(4)}</ul>", f"<div>{link()} {link()} {some(2, 12)}.</div>"])
        return rng.choice([_tag("footer", body, "", 0), _tag("footer", body, "", 0),
                           _tag("div", body, named("footer"), 0, rng), _tag("footer", body, named("footer"), 0, rng)])

    def notice() -> str:
        body = rng.choice([sentence(6, 30), f"<p>{sentence(6, 40)}</p>", f"<p>{sentence()}</p><button>{some(1, 2)}</button>",
                           f"{sentence()} {link()}"])
        return rng.choice([_tag("div", body, named("notice"), 0, rng), _tag("div", body, named("notice"), 0, rng),
                           _tag("dialog", body, "", 0), _tag("p", sentence(), named("notice"), 0, rng),
                           _tag("section", body, named("notice"), 0, rng)])

    def advert() -> str:
        h = rng.choice(["h2", "h3", "h4"])
        body = rng.choice([some(3, 20), sentence(4, 30), f"<p>{sentence()}</p>", f"{link(2, 8)}", f"<{h}>{some(2, 6)}</{h}><p>{sentence()}</p>"])
        return rng.choice([_tag("div", body, named("advert"), 0, rng), _tag("div", body, named("advert"), 0, rng),
                           _tag("aside", body, named("advert"), 0, rng), _tag("p", sentence(), named("advert"), 0, rng),
                           _tag("section", body, named("advert"), 0, rng)])

    def sidebar() -> str:
        h = rng.choice(["h2", "h3", "h4", "b", "p"])
        body = rng.choice([f"<{h}>{some(1, 4)}</{h}><ul>{links(rng.randint(2, 8))}</ul>", f"<{h}>{some(1, 4)}</{h}><p>{sentence()}</p>",
                           f"<p>{sentence(10, 50)}</p><p>{sentence()}</p>", f"<div>{some(4, 20)}</div><ol>{links(4)}</ol>"])
        return rng.choice([_tag("aside", body, "", 0), _tag("aside", body, named("sidebar"), 0, rng),
                           _tag("div", body, named("sidebar"), 0, rng), _tag("section", body, named("sidebar"), 0, rng),
                           _tag("div", body, named("sidebar"), 0, rng)])

    def form() -> str:
        body = rng.choice([f"<label>{some(1, 4)}</label><input name=q><button>{some(1, 2)}</button>",
                           f"<p>{sentence(4, 20)}</p><input type=text><textarea>{some(1, 9)}</textarea>",
                           f"<fieldset>{some(1, 4)} <select><option>{some(1, 3)}</option></select> {some(2, 9)}</fieldset>"])
        inner = _tag("form", body, rng.choice(["", named("form")]), 0, rng)
        return rng.choice([inner, inner, _tag("div", inner, named("form"), 0, rng)])

    def comments() -> str:
        one = lambda: rng.choice([
            f"<p>{sentence(4, 60)}</p>", f"<div>{some(1, 2)}</div><p>{sentence(8, 60)}</p>", sentence(5, 50),
            f"<b>{some(1, 2)}</b>: {sentence(4, 40)}"])
        many = lambda tag, name="": "".join(_tag(tag, one(), name) for _ in range(rng.randint(1, 5)))
        name = rng.choice(["", "comment", "reply"])
        body = f"<h3>{some(1, 3)}</h3>" * rng.randint(0, 1) + rng.choice([
            f"<ol>{many('li', name)}</ol>", many("div", name), many("article", "comment"), f"<ul>{many('li')}</ul>"])
        return rng.choice([_tag("div", body, named("comments"), 0, rng), _tag("section", body, named("comments"), 0, rng),
                           _tag("aside", body, named("comments"), 0, rng)])

    def paragraph() -> str:
        text = sentence(1, 90)
        if rng.random() < 0.25:
            text += f" <b>{some(1, 3)}</b> {link()} {sentence(3, 30)}"
        if rng.random() < 0.1:
            text += f"<br>{sentence(3, 20)}"
        if rng.random() < 0.15:  # names that say nothing
            return _tag(rng.choice(["p", "div"]), text, rng.choice(words).strip(".,") if rng.random() < 0.5 else "lead", None, rng)
        return rng.choice([f"<p>{text}</p>"] * 8 + [
            f"<p><b>{some(2, 12)}<br><p>{text}</p>", f"<div>{text}</div>", f"<blockquote><p>{text}</p></blockquote>",
            f"<ul><li>{text}</li><li>{some(2, 12)}</li></ul>", f"<ol><li>{some(1, 9)}<li>{sentence()}</ol>", text,
            f"<pre>{text}</pre>", f"<table><tr><td>{some(1, 5)}</td><td>{some(1, 8)}</td></tr></table>",
            f"<figure><figcaption>{sentence(3, 14)}</figcaption></figure>", f"<section><h2>{some(1, 6)}</h2><p>{text}</p></section>",
            f"<dl><dt>{some(1, 3)}<dd>{text}</dl>", f"<h2>{some(1, 8)}</h2><p>{text}</p>", f"<h3>{some(1, 8)}</h3>{text}"])

    def article() -> str:
        blocks = [f"<{h}>{some(1, 12)}</{h}>" for h in rng.choice([["h1"], ["h1"], ["h2"], ["h1", "h2"], []])]
        blocks += [paragraph() for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 12]))]
        for other in (advert, sidebar, form, notice, menu, footer, header):
            if rng.random() < 0.1:
                blocks.insert(rng.randrange(len(blocks) + 1), other())
        if rng.random() < 0.15:
            blocks.append(comments())
        body = "".join(blocks)
        name = rng.choice(CONTENT_NAMES)
        name = rng.choice([name, name, f"{name}-{rng.choice(CONTENT_NAMES)}", f"{name}-wrap"])
        if rng.random() < 0.3:
            body = _tag("div", body, rng.choice(["", name]), None, rng)
        return rng.choice([_tag("article", body, "", 1), _tag("article", body, name, 1, rng), _tag("main", body, "", 1),
                           _tag("div", body, name, 1, rng), _tag("div", body, name, 1, rng), _tag("section", body, name, 1, rng),
                           _tag("main", f"<article>{body}</article>", "", 1), _tag("div", body, "", 1), _tag("td", body, "", 1)])

    before = [x() for x in (header, menu, notice, advert, form, menu) if rng.random() < 0.45]
    beside = [x() for x in (sidebar, sidebar, advert, menu, form) if rng.random() < 0.3]
    after = [x() for x in (comments, sidebar, form, notice, footer) if rng.random() < 0.4]
    body = article()
    middle = [*beside, body] if rng.random() < 0.4 else [body, *beside]
    if rng.random() < 0.3:
        middle = [_tag("div", "".join(middle), rng.choice(["", "wrapper", "container", "row", "layout"]), 0, rng)]
    page = "".join([*before, *middle, *after, *([footer()] if rng.random() < 0.7 else [])])
    if rng.random() < 0.25:
        page = _tag("div", page, rng.choice(["", "wrapper", "container", "site", "page"]), 0, rng)
    ends = "</body></html>" if rng.random() < 0.8 else ""
    return f'<!DOCTYPE html><html><head><title>{some(1, 9)}</title></head><body>{page}{ends}'


def layouts(pages: list[str], per_page: int = LAYOUTS) -> list[str]:
    """`per_page` random layouts of the words of each page; the same for the same pages."""
    everyone = Model(np.zeros(FEATURES), np.zeros((len(TAGS), 2, 2)))
    out = []
    for i, page in enumerate([p for p in texts_of([parse(p) for p in pages], everyone) if p] or [FILLER]):
        rng = random.Random(i)
        out += [layout(page.split(), rng) for _ in range(per_page)]
    return out


def labelled(pages: list[str]) -> list[Tree]:
    """The trees of the pages that mark their content themselves, and of the layouts."""
    own = [t for t in (parse(p, True) for p in pages) if 1 in t.label]
    for t in own:
        t.label = [max(x, 0) for x in t.label]
    return own + [parse(p, True) for p in layouts(pages)]


def sample(pages: DataFrame, key: str, html: str, n: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> list[str]:
    """The first `chars` characters of `n` pages. The draws are made on numbers (`n` a task
    reach the driver), then the pages of the drawn ones are read, one for equal draws."""
    draw = F.xxhash64(F.col(f"`{key}`"), F.col(f"`{html}`"))
    some = pages.where(F.length(f"`{html}`") > 0)
    least = [r.draw for r in some.select(draw.alias("draw")).distinct().orderBy("draw").limit(n).collect()]
    if not least:
        return []
    drawn = some.where(draw <= least[-1]).select(draw.alias("draw"), F.substring(F.col(f"`{html}`"), 1, chars).alias("page"))
    return sorted(r.page for r in drawn.groupBy("draw").agg(F.min("page").alias("page")).collect())


def extract(pages: DataFrame, carry: list[str], key: str = "page_id", html: str = "html", model: Model | None = None
            ) -> DataFrame:
    """(doc, main_text) per row; `doc` is a struct of the columns `carry`. Without a model, one
    is trained on a sample of the pages."""
    spark = pages.sparkSession
    model = model or train(labelled(sample(pages, key, html)))
    shared = spark.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def texts(values: list) -> list[list[str]]:
            values = [v or "" for v in values]
            out: list[str] = []
            for a, b in common.byte_batches(values, PASS_CHARS):
                out += texts_of([parse(v) for v in values[a:b]], m)
            return [out]

        return texts

    return common.map_texts(pages, carry, html, "main_text string", make)


def op12_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = extract(common.table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.select("doc.page_id", "doc.url", F.col("main_text").alias("text"),
                        F.char_length("main_text").cast("long").alias("n_chars"))

"""Main text of web pages by a graphical model over the element tree.

A page becomes a tree: block elements, and below them their stretches of text. Every node is content
or not. Its score comes from weights of its features (tag, words of its class, id and role, and for
text its length, share of links and ending); a pair of parent and child has a potential for each
combination of labels. Sum-product messages pass upward from the leaves and downward from the root,
which gives every node's exact marginal; stretches of text that are more likely content than not are
the main text. Weights maximize the likelihood of the labelled pages that ``labelled_pages`` writes
from a seed, with the same messages for the gradient.

Pages are worked on where they are read, a batch of trees at a time and level by level in numpy.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.common import ready

#: Pull of the weights towards zero while they are learned.
RIDGE = 0.02
#: Fixed values of the markup language: elements that start a block, that hold no text of the page,
#: that have no end tag, and that end an open paragraph.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
SKIPPED = frozenset(
    "applet audio button canvas datalist embed head iframe noframes noscript option script select style svg template "
    "textarea title video".split()
)
RAW = frozenset("script style textarea title iframe noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_PARAGRAPH = BLOCKS - frozenset("body caption html legend tbody td tfoot th thead tr summary".split())
#: An element of the key ends an open one of the first set, unless one of the second stands between.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
}
SCOPE = frozenset(["table", "td", "th", "caption", "html"])

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)", re.S
)
_NAMES = re.compile(r"""\b(class|id|role|data-content)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CUE = re.compile(r"[A-Za-z][a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Tree:
    """Nodes of one page in page order; a parent comes before its children."""

    parents: list[int] = field(default_factory=list)
    features: list[list[str]] = field(default_factory=list)
    texts: dict[int, str] = field(default_factory=dict)
    marks: dict[int, bool] = field(default_factory=dict)


def _attributes(raw: str) -> tuple[list[str], bool | None]:
    """Cue words of an element, and its label if it carries one."""
    cues, mark = [], None
    for name, *values in _NAMES.findall(raw):
        value = "".join(values)
        if name.lower() == "data-content":
            mark = value == "1"
        else:
            cues += [f"cue={word.lower()}" for word in _CUE.findall(value)]
    return cues, mark


def _text_features(text: str, linked: int, parent_tag: str) -> list[str]:
    words = text.count(" ") + 1
    share = linked / max(1, len(text))
    return [
        "text",
        f"in={parent_tag}",
        f"words={min(7, words.bit_length())}",
        f"links={0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.8 else 3}",
        f"links={share >= 0.8}&words={words >= 8}",
        f"stop={text[-1] in '.!?:…”\"'}&words={words >= 8}",
        f"sign={'©' in text}",
    ]


def parse(page: str) -> Tree:
    """The tree of a page, however broken: open elements end with the page, stray ends are dropped.

    An element without text of the page that is never closed starts nothing: what follows is read on.
    If only a later one of its kind is closed, it ends with the element it stands in.
    """
    tree = Tree()
    tree.parents.append(-1)
    tree.features.append(["root"])
    stack: list[tuple[str, int]] = [("#root", 0)]
    paragraphs, linked_depth, skip, skip_depth = 0, 0, "", 0
    skipped: list[str] = []  # open block elements inside of what is skipped
    last_ends: dict[str, int] = {}
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                tag, parent = stack[-1]
                tree.texts[len(tree.parents)] = text
                tree.parents.append(parent)
                tree.features.append(_text_features(text, linked, tag))
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal paragraphs, linked_depth
        flush()
        while len(stack) > depth:
            paragraphs -= stack.pop()[0] == "p"
        if linked_depth > len(stack):
            linked_depth = 0

    def close(targets: frozenset[str], until: frozenset[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in targets:
                return pop_to(depth)
            if stack[depth][0] in until:
                return None
        return None

    at, size = 0, len(page)
    while at < size:
        match = _MARKUP.search(page, at)
        end = match.start() if match else size
        if end > at and not skip:
            text = page[at:end]
            text = html_lib.unescape(text) if "&" in text else text
            pieces.append(text)
            if linked_depth:
                linked += len(text.strip())
        if not match:
            break
        at = match.end()
        slash, name, raw = match.groups()
        if name is None:
            continue
        name = name.lower()
        if skip:
            if name == skip:
                skip_depth += -1 if slash else 0 if name in VOID or raw.endswith("/") else 1
                if skip_depth <= 0:
                    skip = ""
            elif skip == "head" and (name == "body" or name in BLOCKS and not slash and name not in ("html", "hr")):
                skip = ""  # a head without an end
            elif name in BLOCKS or name == "foreignobject":
                if slash and name in skipped:
                    while skipped.pop() != name:
                        pass
                elif slash and any(tag == name for tag, _ in stack):
                    skip = ""  # the element around ends
                elif skip == "svg" and not slash and name in BLOCKS and "foreignobject" not in skipped:
                    skip = ""  # no block stands in a drawing
                elif not slash and name not in VOID and not raw.endswith("/"):
                    skipped.append(name)
            if skip or name in SKIPPED:
                if name in RAW and not slash:
                    at = _past_raw(page, at, name)
                continue
        if name in SKIPPED:
            if slash or name in VOID or raw.endswith("/"):
                continue
            if name in RAW:
                at = _past_raw(page, at, name)
                continue
            if name != "head" and name not in last_ends:
                last_ends[name] = _last_end(page, name)
            if name == "head" or last_ends[name] > at:
                skip, skip_depth = name, 1
                skipped.clear()
            continue
        if name in BLOCKS:
            if slash:
                if name == "p" and not paragraphs:
                    flush()
                else:
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth][0] == name:
                            pop_to(depth)
                            break
                    else:
                        flush()
                continue
            flush()
            if name in ("html", "body") and len(stack) > 1 and any(tag == name for tag, _ in stack):
                continue
            if paragraphs and name in ENDS_PARAGRAPH:
                close(frozenset(["p"]), SCOPE)
            if name in ENDS:
                close(*ENDS[name])
            if name in VOID:
                continue
            cues, mark = _attributes(raw) if raw else ([], None)
            node = len(tree.parents)
            tree.parents.append(stack[-1][1])
            tree.features.append([f"tag={name}", *cues])
            if mark is not None:
                tree.marks[node] = mark
            stack.append((name, node))
            paragraphs += name == "p"
        elif name == "a":
            linked_depth = 0 if slash else len(stack)
        elif name == "br":
            pieces.append(" ")
    pop_to(1)
    flush()
    return tree


def _last_end(page: str, name: str) -> int:
    """Where the last end tag of a kind stands, -1 if there is none."""
    return max((match.start() for match in re.finditer(rf"</{name}\b", page, re.I)), default=-1)


def _past_raw(page: str, at: int, name: str) -> int:
    """Where the text of an element without markup inside ends; the end of the page if it never does."""
    match = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
    return match.end() if match else len(page)


# --- the model ----------------------------------------------------------------------------------


@dataclass
class Forest:
    """Trees side by side, parents by number, nodes grouped by depth."""

    parents: np.ndarray
    owner: np.ndarray  # node of each feature
    feature: np.ndarray  # its number
    kind: np.ndarray  # of the edge to the parent: 0 element, 1 text
    levels: list[np.ndarray]


def grow(trees: list[Tree], names: dict[str, int]) -> Forest:
    """Features that are not known are left out."""
    sizes = np.array([len(t.parents) for t in trees], np.int64)
    base = np.append(0, np.cumsum(sizes))[:-1]
    parents = np.concatenate([np.array(t.parents) + b for t, b in zip(trees, base)]) if trees else np.zeros(0, np.int64)
    roots = np.zeros(len(parents), bool)
    roots[base] = True
    parents[roots] = -1
    depth = np.zeros(len(parents), np.int64)
    for b, tree in zip(base.tolist(), trees):
        own = [0] * len(tree.parents)
        for i, p in enumerate(tree.parents[1:], 1):
            own[i] = own[p] + 1
        depth[b : b + len(own)] = own
    order = np.argsort(depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    kind = np.zeros(len(parents), np.int64)
    owner, feature = [], []
    node = 0
    for tree in trees:
        for i, features in enumerate(tree.features):
            for name in features:
                number = names.get(name)
                if number is not None:
                    owner.append(node)
                    feature.append(number)
            kind[node] = i in tree.texts
            node += 1
    return Forest(
        parents, np.array(owner, np.int64), np.array(feature, np.int64), kind, np.split(order, cuts) if len(order) else []
    )


@dataclass
class TreeModel:
    names: dict[str, int]
    weights: np.ndarray  # per feature, for content
    edges: np.ndarray  # kind, label of the parent, label of the child

    def unary(self, forest: Forest) -> np.ndarray:
        scores = np.zeros((len(forest.parents), 2))
        scores[:, 1] = np.bincount(forest.owner, self.weights[forest.feature], len(forest.parents))
        return scores

    def messages(self, forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Beliefs of all nodes, and per edge what parent and child say without each other."""
        up = np.zeros((len(forest.parents), 2))
        below = self.unary(forest)
        for level in forest.levels[:0:-1]:
            up[level] = _log_sum(self.edges[forest.kind[level]] + below[level][:, None, :], 2)
            for label in (0, 1):
                below[:, label] += np.bincount(forest.parents[level], up[level, label], len(below))
        beliefs = below.copy()
        above = np.zeros_like(below)
        for level in forest.levels[1:]:
            above[level] = beliefs[forest.parents[level]] - up[level]
            beliefs[level] += _log_sum(self.edges[forest.kind[level]] + above[level][:, :, None], 1)
        return beliefs, above, below

    def content(self, forest: Forest) -> np.ndarray:
        """Probability of content for every node."""
        beliefs, _, _ = self.messages(forest)
        return 1 / (1 + np.exp(np.clip(beliefs[:, 0] - beliefs[:, 1], -60, 60)))


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis=axis)) + top.squeeze(axis)


def fit(trees: list[Tree], labels: np.ndarray, rounds: int = 150, rate: float = 0.3) -> TreeModel:
    names: dict[str, int] = {}
    for tree in trees:
        for features in tree.features:
            for name in features:
                names.setdefault(name, len(names))
    forest = grow(trees, names)
    model = TreeModel(names, np.zeros(len(names)), np.zeros((2, 2, 2)))
    inner = np.flatnonzero(forest.parents >= 0)
    kind, parent = forest.kind[inner], forest.parents[inner]
    seen_edges = np.zeros((2, 2, 2))
    np.add.at(seen_edges, (kind, labels[parent], labels[inner]), 1)
    history = [np.full_like(model.weights, 1e-6), np.full_like(model.edges, 1e-6)]
    for _ in range(rounds):
        beliefs, above, below = model.messages(forest)
        content = 1 / (1 + np.exp(np.clip(beliefs[:, 0] - beliefs[:, 1], -60, 60)))
        slope = np.bincount(forest.feature, (labels - content)[forest.owner], len(names)) - RIDGE * model.weights
        joint = above[inner][:, :, None] + model.edges[kind] + below[inner][:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        expected = np.stack([joint[kind == k].sum(axis=0) for k in (0, 1)])
        for weight, gradient, seen in zip(
            (model.weights, model.edges), (slope, seen_edges - expected - RIDGE * model.edges), history
        ):
            seen += gradient**2
            weight += rate * gradient / np.sqrt(seen)
    return model


# --- labelled pages -----------------------------------------------------------------------------


def labelled_pages(count: int = 1000, seed: int = 11) -> list[str]:
    """Pages of many layouts; ``data-content`` says for an element whether it is the main text."""
    rng = random.Random(seed)
    pick, chance = rng.choice, lambda p: rng.random() < p
    syllables = "an er on the in re ti en la que de ou ion ch sch ung be st le ar os co mi da ver".split()
    # fixed values: names that sites give to the parts of their pages
    menus = "nav navbar navigation menu main-menu topnav site-nav breadcrumb breadcrumbs pagination pager toc tabs nav-links".split()
    heads = "header site-header masthead top-bar topbar branding logo page-header banner-top".split()
    feet = "footer site-footer bottom copyright colophon legal footer-links foot".split()
    sides = "sidebar aside widget related recommended popular trending tags tag-cloud archive more-stories side rail".split()
    notices = (
        "cookie cookie-banner cookie-notice consent gdpr notice alert banner popup modal overlay newsletter subscribe "
        "subscription paywall signup announcement message warning toast privacy"
    ).split()
    adverts = "ad ads advert advertisement adsense sponsored sponsor promo promotion ad-slot ad-banner ad-container".split()
    talks = "comments comment comment-list responses replies discussion disqus thread reply comment-body user-comments".split()
    shares = "share social social-links share-buttons follow author-box byline meta post-meta".split()
    mains = (
        "content main-content article article-body post post-content entry entry-content story story-body body-text text "
        "page-content main article-content blog-post"
    ).split()

    def words(low: int, high: int) -> str:
        made = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        return " ".join(made).capitalize()

    def sentences(low: int, high: int) -> str:
        end = pick([".", ".", ".", "!!", "?", " |", "%%%", ""])
        return " ".join(words(3, 14) + end for _ in range(rng.randint(low, high)))

    def named(tag: str, names: list[str], inner: str, mark: int) -> str:
        label = f' data-content="{mark}"'
        form = rng.random()
        attribute = f' class="{pick(names)}{pick(["", "", " wide", " c1"])}"' if form < 0.75 else f' id="{pick(names)}"'
        return f"<{tag}{attribute}{label}>{inner}</{tag}>"

    def bare(tag: str, inner: str, mark: int) -> str:
        return f'<{tag} data-content="{mark}">{inner}</{tag}>'

    def links(low: int, high: int, size: int = 3) -> str:
        return "".join(f'<li><a href="/x">{words(1, size)}</a></li>' for _ in range(rng.randint(low, high)))

    def heading() -> str:
        level = rng.randint(1, 5)
        return f"<h{level}>{words(1, 4)}</h{level}>"

    def menu() -> str:
        inner = pick([f"<ul>{links(2, 9)}</ul>", " | ".join(f'<a href="/">{words(1, 2)}</a>' for _ in range(rng.randint(2, 7)))])
        return bare("nav", inner, 0) if chance(0.5) else named(pick(["div", "nav", "ul", "section"]), menus, inner, 0)

    def head() -> str:
        inner = pick([f'<a href="/">{words(1, 3)}</a>', f"<h1>{words(1, 3)}</h1>", f"<p>{words(2, 8)}</p>", f"<div>{words(1, 4)}</div>{menu()}"])
        return bare("header", inner, 0) if chance(0.5) else named(pick(["div", "header"]), heads, inner, 0)

    def foot() -> str:
        inner = pick([f"&copy; {words(1, 4)} &middot; {sentences(1, 2)}", f"<p>&copy; 2024 {words(2, 9)}</p>", f"<ul>{links(2, 6)}</ul><p>{sentences(1, 2)}</p>", sentences(1, 3)])
        return bare("footer", inner, 0) if chance(0.6) else named("div", feet, inner, 0)

    def side() -> str:
        inner = heading() * chance(0.6) + pick([f"<ul>{links(2, 7, 8)}</ul>", f"<p>{sentences(1, 3)}</p>", f'<p><a href="/">{words(3, 9)}</a></p>' * rng.randint(1, 3)])
        return bare("aside", inner, 0) if chance(0.5) else named(pick(["div", "aside", "section"]), sides, inner, 0)

    def notice() -> str:
        inner = heading() * chance(0.2) + pick([sentences(1, 3), f"<p>{sentences(1, 3)}</p>", f"<p>{sentences(1, 2)} <a href='/'>{words(1, 2)}</a></p><button>{words(1, 2)}</button>"])
        return named(pick(["div", "div", "section", "aside", "p"]), notices, inner.replace("<p>", "<div>").replace("</p>", "</div>"), 0)

    def advert() -> str:
        inner = pick([sentences(1, 2), f"<p>{sentences(1, 3)}</p>", f'<a href="http://a.example/">{words(2, 8)}</a>'])
        return named(pick(["div", "div", "aside", "section", "ins"]).replace("ins", "div"), adverts, inner, 0)

    def form() -> str:
        inner = f"<label>{words(1, 4)}</label><input type=text>" * rng.randint(1, 3) + f"<p>{sentences(1, 2)}</p>" * chance(0.5) + f"<button>{words(1, 2)}</button>"
        return bare("form", inner, 0)

    def talk() -> str:
        entry = lambda: named(pick(["div", "li", "article"]), talks, f"<b>{words(1, 2)}</b><p>{sentences(1, 6)}</p>", 0)
        return named(pick(["div", "section", "section", "ol", "ul"]), talks, heading() * chance(0.8) + "".join(entry() for _ in range(rng.randint(1, 5))), 0)

    def share() -> str:
        return named(pick(["div", "ul", "p"]), shares, " ".join(f'<a href="/">{words(1, 2)}</a>' for _ in range(rng.randint(2, 5))), 0)

    def paragraph() -> str:
        text = sentences(1, 8)
        if chance(0.3):  # a word or two is a paragraph, too, and so are the cells of a broken table
            text = pick([words(1, 2), words(1, 2) + ".", f"{words(1, 1)} | {words(1, 1)}.", " | ".join(words(1, 1) for _ in range(9))])
        if chance(0.2):
            text += f' <a href="/y">{words(1, 4)}</a> {sentences(1, 2)}'
        return pick([f"<p>{text}</p>"] * 5 + [f"<p><b>{text}<br>", f"<p>{text}", f"<div>{text}</div>", f"<blockquote>{text}</blockquote>"])

    def body() -> str:
        parts = [f"<h1>{words(2, 12)}</h1>"] * chance(0.85)
        if chance(0.15):
            parts = [bare("header", "".join(parts) + f"<p>{words(3, 10)}</p>", 1)]
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            parts.append(
                paragraph()
                if kind < 0.78
                else heading()
                if kind < 0.86
                else f"<ul>{''.join(f'<li>{sentences(1, 2)}</li>' for _ in range(rng.randint(1, 5)))}</ul>"
                if kind < 0.92
                else f"<table><tr><th>{words(1, 2)}</th><td>{words(1, 4)}</td></tr></table>"
                if kind < 0.94
                else f"<pre>{words(2, 9)}</pre>"
                if kind < 0.96
                else f"<figure><img src=x><figcaption>{words(2, 9)}</figcaption></figure>"
                if kind < 0.98
                else pick([advert, share, side, notice])()
            )
        return "".join(parts)

    def page() -> str:
        if chance(0.05):  # nothing but text
            return f'<html data-content="1"><body data-content="1">{pick([sentences(1, 5), body(), f"<p>{words(1, 3)}</p>"])}'
        inner = body()
        shape = rng.random()
        core = (
            bare("article", inner, 1)
            if shape < 0.4
            else named(pick(["div", "section", "article", "main"]), mains, inner, 1)
            if shape < 0.75
            else bare("main", bare("div", inner, 1), 1)
            if shape < 0.85
            else bare("div", inner, 1)
        )
        around = [pick([menu, head, side, notice, advert, form]) for _ in range(rng.choice([0, 0, 1, 2, 3, 4]))]
        after = [pick([side, notice, advert, form, talk, talk, share, menu]) for _ in range(rng.randint(0, 3))]
        parts = [*[make() for make in around], core, *[make() for make in after]]
        if chance(0.75):
            parts.append(foot())
        inside = "".join(parts)
        if chance(0.2):
            inside = f"<div>{inside}</div>"
        if chance(0.03):
            return sentences(1, 6)
        if chance(0.1):
            return inside  # a fragment
        title = f"<title>{words(2, 8)}</title>"
        end = "" if chance(0.1) else "</body></html>"
        return f"<!DOCTYPE html><html><head><meta charset=utf-8>{title}<style>p{{}}</style></head><body>{inside}{end}"

    return [page() for _ in range(count)]


def labels_of(tree: Tree) -> np.ndarray:
    """Text takes the label of the nearest marked element; an element that of most of its text."""
    size = len(tree.parents)
    mark = [False] * size
    for i in range(1, size):
        mark[i] = tree.marks.get(i, mark[tree.parents[i]])
    weight = np.zeros((size, 2))
    for i in range(size - 1, 0, -1):
        if i in tree.texts:
            weight[i, int(mark[i])] += len(tree.texts[i])
        weight[tree.parents[i]] += weight[i]
    # text outside of all elements is not marked: nothing but text is the main text
    alone = not tree.marks
    return np.array(
        [int(alone or (mark[i] if not weight[i].any() else weight[i, 1] >= weight[i, 0])) for i in range(size)]
    )


@lru_cache(maxsize=1)
def trained_model() -> TreeModel:
    """The model learned from the built-in labelled pages; a few seconds on the driver."""
    trees = [parse(page) for page in labelled_pages()]
    return fit(trees, np.concatenate([labels_of(tree) for tree in trees]))


def main_texts(pages: list[str], model: TreeModel) -> list[str]:
    """For each page the stretches of text that are content, in page order, joined by line ends."""
    trees = [parse(page) for page in pages]
    content = model.content(grow(trees, model.names))
    found, base = [], 0
    for tree in trees:
        found.append("\n".join(text for i, text in tree.texts.items() if content[base + i] > 0.5))
        base += len(tree.parents)
    return found


def extract(pages: DataFrame, model: TreeModel | None = None, batch_chars: int = 1 << 21) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars``: the main text of every page, empty if it has none.

    Null html is an empty page. Broken markup is read as far as it goes. One row per input row,
    whatever its ids; extra columns are not looked at; no rows give no rows.
    """
    shared = ready(pages.sparkSession).sparkContext.broadcast(model or trained_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts: list[str] = []
            held: list[str] = []
            size = 0
            for page in rows.column(2):
                held.append(page.as_py() or "")
                size += len(held[-1])
                if size > batch_chars:
                    texts += main_texts(held, shared.value)
                    held, size = [], 0
            texts += main_texts(held, shared.value)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), "url", F.col("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )

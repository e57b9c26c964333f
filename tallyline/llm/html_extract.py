"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A tolerant parser turns a page into nodes and text blocks. Each node has features: subtree
text, link and sentence density, depth, place in the page and among its siblings, its
attribute tokens (hashed, and by family where a token names a purpose), and how much of the
page the nearest ancestor with such a name holds. Gradient-boosted trees give each node the
log odds that it belongs to the article. The decoder then picks the best labelling in which
no node is kept inside a dropped one: a node's worth is its log odds plus the worth of the
children that are worth keeping.

No page comes with labels. The trees learn from a bounded sample of pages, labelled by their
own landmarks (elements and attribute tokens that name their purpose), and from the same
pages with more planted in them, built from the page's own words, whose label is known
whatever its name: menus, notes and teasers without a name, and articles in elements whose
name misleads. So names are evidence, and structure can overrule them.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

# Element kinds of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title template iframe svg".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul caption option legend".split())
_INLINE_BREAK = frozenset(("br", "wbr"))
# What an opening tag closes, up to the nearest of the elements that hold it.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
           "body": ({"head"}, set())}
_P_ENDS = _BLOCK - {"body", "head", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "legend"}
_P_BARRIER = frozenset("table td th button object caption html body div article section main li blockquote".split())

# Words in tags and attributes that name a block's purpose.
FAMILIES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs skip",
    "header": "header masthead topbar banner",
    "footer": "footer copyright colophon legal imprint",
    "side": "aside sidebar sidebars rail widget widgets related recommended recommendations trending popular teaser",
    "advert": "ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion",
    "notice": "cookie cookies consent gdpr notice notices alert banner popup modal overlay newsletter subscribe paywall noscript",
    "comment": "comment comments commentlist reply replies disqus discussion respond",
    "form": "form login signup signin search searchbox fieldset input contact select button",
    "share": "share sharing social follow",
    "content": "article main content post entry story prose",
}
_FAMILY = list(FAMILIES)
_OF_TOKEN: dict[str, int] = {}
for _i, _name in enumerate(_FAMILY):
    for _token in FAMILIES[_name].split():
        _OF_TOKEN[_token] = _OF_TOKEN.get(_token, 0) | 1 << _i
_CONTENT = 1 << _FAMILY.index("content")
_HEADER = 1 << _FAMILY.index("header")
_BOILER = (1 << len(_FAMILY)) - 1 - _CONTENT

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>""")
_ODD_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*+)>")      # quotes that do not close
_NAMED = re.compile(r"""\b(?:class|id|role|aria-label|itemprop|data-component)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE = re.compile(r"[.!?,;:]")


@dataclass
class Page:
    tags: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    own: list[int] = field(default_factory=lambda: [0])          # families as bits
    hashed: list[int] = field(default_factory=lambda: [0])       # attribute tokens as bits
    truth: dict[int, int] = field(default_factory=dict)          # planted nodes: 1 article, 0 not
    pieces: list[tuple[int, int, str]] = field(default_factory=list)   # (block, node, text)


_HASHED = 32
_TRUTH = re.compile(r'\bdata-truth="([01])"')


def _families(tag: str, attributes: str) -> tuple[int, int]:
    """Families that the tag and the attribute tokens name, and the hashed tokens, as bits."""
    found, hashed = _OF_TOKEN.get(tag, 0), 0
    if attributes and "=" in attributes:
        for match in _NAMED.finditer(attributes):
            for token in _TOKEN.findall(match[1] or match[2] or match[3] or ""):
                token = token.lower()
                found |= _OF_TOKEN.get(token, 0)
                hashed |= 1 << zlib.crc32(token.encode("utf-8", "replace")) % _HASHED
    return found, hashed


def parse(text: str, planted: bool = False) -> Page:
    """Nodes and text pieces of a page in one pass; anything malformed is text or is closed
    where its container ends. Scripts, styles, templates, text areas, frames and drawings leave nothing.
    In `planted` pages the labels of planted elements are read."""
    page = Page()
    open_nodes, block, at, end = [0], 0, 0, len(text)
    is_open: Counter[str] = Counter()

    def close_from(depth: int) -> None:
        for node in open_nodes[depth:]:
            is_open[page.tags[node]] -= 1
        del open_nodes[depth:]

    while at < end:
        less = text.find("<", at)
        if less < 0:
            less = end
        if less > at:
            page.pieces.append((block, open_nodes[-1], text[at:less]))
        if less == end:
            break
        after = text[less + 1:less + 2]
        if after in ("!", "?"):
            closing = "-->" if text.startswith("<!--", less) else ">"
            stop = text.find(closing, less + 2)
            at = end if stop < 0 else stop + len(closing)
            continue
        match = _TAG.match(text, less) or _ODD_TAG.match(text, less)
        if match is None:
            named = after.isalpha() or (after == "/" and text[less + 2:less + 3].isalpha())
            if named:                              # a tag that never ends
                break
            page.pieces.append((block, open_nodes[-1], "<"))
            at = less + 1
            continue
        at = match.end()
        tag = match[2].lower()
        if match[1]:
            if is_open[tag] > 0:
                depth = len(open_nodes) - 1
                while page.tags[open_nodes[depth]] != tag:
                    depth -= 1
                close_from(depth)
            if tag in _BLOCK:
                block += 1
            continue
        if tag in _P_ENDS and is_open["p"] > 0:
            for depth in range(len(open_nodes) - 1, 0, -1):
                if page.tags[open_nodes[depth]] == "p":
                    close_from(depth)
                    break
                if page.tags[open_nodes[depth]] in _P_BARRIER:
                    break
        if tag in _CLOSES:
            closed, holders = _CLOSES[tag]
            last = len(open_nodes)
            for depth in range(len(open_nodes) - 1, 0, -1):
                if page.tags[open_nodes[depth]] in holders:
                    break
                if page.tags[open_nodes[depth]] in closed:
                    last = depth
            close_from(last)
        if tag in _BLOCK:
            block += 1
        if tag in _RAW:
            if not match[3].endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(text, at)
                at = stop.end() if stop else end
            continue
        if tag in _VOID:
            if tag in _INLINE_BREAK:
                page.pieces.append((block, open_nodes[-1], " "))
            continue
        page.tags.append(tag)
        page.parents.append(open_nodes[-1])
        own, hashed = _families(tag, match[3])
        page.own.append(own)
        page.hashed.append(hashed)
        if planted and (known := _TRUTH.search(match[3])):
            page.truth[len(page.tags) - 1] = int(known[1])
        if not (match[3].endswith("/") and tag not in _BLOCK):
            open_nodes.append(len(page.tags) - 1)
            is_open[tag] += 1
    return page


_REST = 24
_FEATURES = 2 * len(_FAMILY) + _REST + _HASHED
_PAGES_AT_ONCE = 64


def features(page: Page) -> np.ndarray:
    """(node, feature), as the module's text says."""
    n = len(page.tags)
    parents = page.parents
    chars, linked, marks, words, depth, above, prose = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    in_link, named = [False] * n, [-1] * n         # nearest node, itself included, with a name of something else
    for i in range(1, n):
        up = parents[i]
        depth[i] = depth[up] + 1
        in_link[i] = in_link[up] or page.tags[i] == "a"
        own = page.own[i]
        if own & _HEADER and above[up] & _CONTENT:     # an article's own heading
            own &= ~_HEADER
        above[i] = above[up] | own
        named[i] = i if own & _BOILER else named[up]
    for _, node, text in page.pieces:
        size = len(text.strip())
        if size:
            chars[node] += size
            words[node] += text.count(" ") + 1
            found = len(_SENTENCE.findall(text))
            marks[node] += found
            if found and size > 40 and not in_link[node]:
                prose[node] += size
            if in_link[node]:
                linked[node] += size
    below = [1] * n
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        up = parents[i]
        chars[up] += chars[i]
        linked[up] += linked[i]
        marks[up] += marks[i]
        words[up] += words[i]
        prose[up] += prose[i]
        below[up] += below[i]
        children[up].append(i)
    out = np.zeros((n, _FEATURES), np.float32)
    bits = np.arange(len(_FAMILY))
    out[:, :len(_FAMILY)] = (np.array(page.own)[:, None] >> bits) & 1
    out[:, len(_FAMILY):2 * len(_FAMILY)] = (np.array(above)[:, None] >> bits) & 1
    c, l, b = np.array(chars, float), np.array(linked, float), np.array(below, float)
    w = np.array(words, float)
    same, place, brothers, share = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for up, kids in enumerate(children):
        if kids:
            kids = kids[::-1]
            names = [page.tags[k] for k in kids]
            counts = {t: names.count(t) for t in set(names)}
            for k, (kid, name) in enumerate(zip(kids, names)):
                brothers[kid], place[kid], same[kid] = len(kids), k / len(kids), counts[name] / len(kids)
                share[kid] = chars[kid] / max(1, chars[up])
    tags = page.tags
    rest = [np.log1p(c), np.log1p(w), l / np.maximum(1, c), c / b, np.array(marks) / np.maximum(1, w), np.log1p(b),
            np.array(depth), brothers, place, same, share, [t == "p" for t in tags],
            [t in ("li", "td", "dd") for t in tags], [len(t) == 2 and t[0] == "h" and t[1].isdigit() for t in tags]]
    density = l / np.maximum(1, c)
    up, near = np.maximum(np.array(parents), 0), np.array(named)
    has, near = near >= 0, np.maximum(near, 0)
    p = np.array(prose, float)
    around = density.copy()                            # most linked of the node and what holds it, the page aside
    whole = p / np.maximum(1, c)
    for i in range(1, n):
        if parents[i] > 0:
            around[i] = max(around[i], around[parents[i]])
    levels = np.array(depth)
    rest += [c / max(1, chars[0]), density[up], whole, whole[up], np.where(has, c[near] / max(1, chars[0]), -1),
             np.where(has, density[near], -1), np.where(has, p[near] / max(1, prose[0]), -1),
             np.where(has, levels - levels[near], -1), np.arange(n) / n, around]
    for k, column in enumerate(rest):
        out[:, 2 * len(_FAMILY) + k] = column
    out[:, -_HASHED:] = (np.array(page.hashed, np.int64)[:, None] >> np.arange(_HASHED)) & 1
    return out


def weak_labels(page: Page) -> np.ndarray:
    """1 where no named landmark around a node says that it is not the article; what is planted
    has its own label, which holds below it until something else is named or planted there."""
    n = len(page.tags)
    label, above = np.ones(n, np.int8), [0] * n
    for i in range(1, n):
        own, up = page.own[i], page.parents[i]
        if own & _HEADER and above[up] & _CONTENT:
            own &= ~_HEADER
        above[i] = above[up] | own
        if i in page.truth:
            above[i] = above[up] & _CONTENT if page.truth[i] else above[i] | _BOILER
        label[i] = not above[i] & _BOILER
    return label


def planted(text: str, dice: random.Random) -> str:
    """The page with blocks planted around and in its article, some that name their purpose in
    the ways pages do and some that do not, with links, lists and misleading names in the
    article that belong to it, and with elements around it whose name misleads."""
    words = re.findall(r"\w{2,}", re.sub(r"<[^>]*>", " ", text))[:400] or ["word"]

    def prose(n: int) -> str:
        return " ".join(dice.choice(words) for _ in range(n)).capitalize() + "."

    def link(n: int = 2) -> str:
        return f'<a href="/x">{prose(n)[:-1]}</a>'

    def block(family: str) -> str:
        token = dice.choice(FAMILIES[family].split())
        name = dice.choice([token, f"{token}-box", f"main-{token}", f"site {token}"])
        body = dice.choice([f"<p>{prose(dice.randint(3, 60))}</p>", prose(dice.randint(2, 30)),
                            "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(dice.randint(2, 6))) + "</ul>",
                            f"<h3>{prose(2)}</h3><p>{prose(dice.randint(5, 80))}</p><p>{prose(20)} {link()}</p>"])
        plain = {"menu": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form"}
        if family in plain and dice.random() < 0.5:
            return f"<{plain[family]}>{body}</{plain[family]}>"
        return f'<{(e := dice.choice(["div", "section"]))} {dice.choice(["class", "id"])}="{name}">{body}</{e}>'

    def links() -> str:
        n = dice.randint(3, 8)
        return dice.choice([
            "<ul>" + "".join(f"<li>{link(dice.randint(1, 3))}</li>" for _ in range(n)) + "</ul>",
            " | ".join(link(1) for _ in range(n)), "".join(f"<div>{link(2)}</div>" for _ in range(n)),
            "".join(f"<p>{link(dice.randint(2, 6))}</p>" for _ in range(n)),
            "<table>" + "".join(f"<tr><td>{link(2)}</td></tr>" for _ in range(n)) + "</table>"])

    def unnamed() -> str:
        """A menu, teasers or a note that nothing names."""
        holder = dice.choice(["div", "div", "ul", "p", "section", "table"])
        name = dice.choice(["", "", f' class="{dice.choice(words)}"', f' class="c{dice.randint(1, 99)}"', ' class="row"', ' class="inner wrap"'])
        if holder == "ul":
            body = "".join(f"<li>{link(dice.randint(1, 4))}</li>" for _ in range(dice.randint(3, 8)))
        elif holder == "table":
            body = "".join(f"<tr><td>{link(2)}</td></tr>" for _ in range(dice.randint(3, 6)))
        elif holder == "p":
            body = dice.choice([" ".join(link(1) for _ in range(4)), f"{prose(3)} {link(1)} {link(1)}"])
        else:
            body = dice.choice([links(), links(), f"<h3>{link(3)}</h3>{links()}", f"<span>{prose(4)} {dice.randint(1990, 2030)}</span> {link(1)} {link(1)}"])
        return f'<{holder}{name} data-truth="0">{body}</{holder}>'

    def misnamed() -> str:
        """Part of the article whose name says something else."""
        token = dice.choice([t for f in ("side", "notice", "form", "header", "menu", "share") for t in FAMILIES[f].split()])
        name = dice.choice([f"{token}-{dice.choice(words)}", f"{dice.choice(words)}-{token}", token])
        named = f'{dice.choice(["id", "class"])}="{name}" data-truth="1"'
        return dice.choice([f"<h2 {named}>{prose(4)}</h2><p>{prose(30)}</p>", f"<p {named}>{prose(dice.randint(20, 60))}</p>",
                            f"<section {named}><h2>{prose(2)}</h2><p>{prose(40)}</p><p>{prose(25)} {link(2)}</p></section>",
                            f"<div {named}><p>{prose(50)}</p><p>{prose(30)}</p></div>"])

    boiler = [f for f in _FAMILY if f != "content"]
    inside = dice.choice([f"<p>{link()}</p>", "<ul>" + "".join(f"<li>{prose(5)} {link()}</li>" for _ in range(3)) + "</ul>",
                          f"<h2>{prose(3)}</h2><p>{prose(2)}</p>", f"<blockquote>{prose(12)}</blockquote>",
                          f"<div><p>{prose(30)}</p><p>{link()}</p></div>", f"<p>{link()} {link()}</p>"])
    out = text
    if "</article>" in out:
        late = block(dice.choice(["comment", "share", "advert", "notice"])) if dice.random() < 0.5 else ""
        odd = misnamed() if dice.random() < 0.5 else ""
        out = out.replace("</article>", inside + odd + late + "</article>", 1)
        if dice.random() < 0.4:                       # an element around the article with a misleading name
            token = dice.choice([t for f in boiler for t in FAMILIES[f].split()])
            name = dice.choice([f"has-{token}", f"no-{token}", f"with-{token}", f"{token}-page", token])
            holder = dice.choice(["div", "div", "section", "form", "main"])
            out = out.replace("<article>", f'<{holder} class="{name}" data-truth="1"><article>', 1).replace("</article>", f"</article></{holder}>", 1)
        if dice.random() < 0.4:                       # pages without the landmark
            holder = dice.choice(["div", 'div class="content"', "main", "section", 'div id="post"'])
            out = out.replace("<article>", f"<{holder}>", 1).replace("</article>", f"</{holder.split()[0]}>", 1)

    def some() -> str:
        found = [block(f) for f in dice.sample(boiler, dice.randint(0, 4))] + [unnamed() for _ in range(dice.randint(0, 3))]
        dice.shuffle(found)
        return "".join(found)

    if "<body>" in out:
        whole = dice.choice(["", "", "form", "div"])      # an element around all of the page
        token = dice.choice([t for f in boiler for t in FAMILIES[f].split()])
        body = dice.choice(["<body>", f'<body class="no-{token}" data-truth="1">', f'<body class="{token}-left" data-truth="1">'])
        opened = f'<{whole} class="has-{token}" data-truth="1">' if whole else ""
        out = out.replace("<body>", body + opened + some(), 1)
        return out.replace("</body>", some() + (f"</{whole}>" if whole else "") + "</body>", 1)
    return out.replace("</body>", some() + "</body>", 1)


@dataclass
class Trees:
    """Boosted regression trees of a fixed depth, as arrays (tree, inner node) and (tree, leaf)."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += leaf[at - (2**depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.3, bins: int = 32) -> Trees:
    """Logistic gradient boosting with second-order leaves over quantile bins."""
    y = y.astype(np.float64)
    if not len(y) or y.min() == y.max():
        base = 4.0 if not len(y) or y[0] > 0.5 else -4.0
        none = np.zeros((0, 2**depth - 1))
        return Trees(base, none.astype(np.int64), none, np.zeros((0, 2**depth)))
    base = float(np.log(y.mean() / (1 - y.mean())))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    odds, trees = np.full(len(y), base), []
    # yes-no features of all nodes of a level are one product, the others one count each
    yes_no = [f for f, e in enumerate(edges) if len(e) == 1]
    graded = [f for f, e in enumerate(edges) if len(e) > 1]
    is_yes = binned[:, yes_no].T.astype(np.float64)
    rows = np.arange(len(y))

    def gain(g: np.ndarray, w: np.ndarray, g_all: np.ndarray, w_all: np.ndarray) -> np.ndarray:
        return g**2 / (w + 1) + (g_all - g)**2 / (w_all - w + 1) - g_all**2 / (w_all + 1)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-odds))
        gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            nodes, first = 2**level, 2**level - 1
            place = at - first
            sums = np.stack([np.bincount(place, v, nodes) for v in (gradient, weight)])
            best = np.full(nodes, 1e-6)

            def take(f: int, found: np.ndarray, bounds: np.ndarray) -> None:
                better = found > best + 1e-9
                best[better], feature[first:first + nodes][better] = found[better], f
                threshold[first:first + nodes][better] = bounds[better]

            spread = np.zeros((2, len(y), nodes))
            spread[0, rows, place], spread[1, rows, place] = gradient, weight
            right = is_yes @ spread                                       # (gradient or weight, feature, node)
            gains = gain(sums[0] - right[0], sums[1] - right[1], sums[0], sums[1])
            by_feature = dict(zip(yes_no, gains))
            for f in graded:
                n = len(edges[f]) + 1
                cell = place * n + binned[:, f]
                left = [np.cumsum(np.bincount(cell, v, nodes * n).reshape(nodes, n), axis=1)[:, :-1] for v in (gradient, weight)]
                by_feature[f] = gain(left[0], left[1], sums[0][:, None], sums[1][:, None])
            for f in sorted(by_feature):
                found = by_feature[f]
                if found.ndim == 1:
                    take(f, found, np.full(nodes, edges[f][0]))
                else:
                    k = found.argmax(axis=1)
                    take(f, found[np.arange(nodes), k], edges[f][k])
            chosen = feature[at]
            at = 2 * at + 1 + (x[rows, chosen] > threshold[at])
        leaves = at - (2**depth - 1)
        g, w = (np.bincount(leaves, v, 2**depth) for v in (gradient, weight))
        leaf = rate * g / (w + 1)
        odds += leaf[leaves]
        trees.append((feature, threshold, leaf))
    return Trees(base, *(np.stack(part) for part in zip(*trees)))


def decode(parents: list[int], odds: np.ndarray) -> list[bool]:
    """Which nodes stay: the labelling with the highest sum of log odds in which a kept
    node's parent is kept. The root always stays."""
    n = len(parents)
    worth = [float(o) for o in odds]
    for i in range(n - 1, 0, -1):
        if worth[i] > 0:
            worth[parents[i]] += worth[i]
    stay = [True] * n
    for i in range(1, n):
        stay[i] = stay[parents[i]] and worth[i] > 0
    return stay


def block_text(page: Page, stay: list[bool]) -> str:
    """Kept pieces, decoded; white space is one space in a block, and blocks are lines."""
    lines, current, held = [], -1, []
    for block, node, text in page.pieces:
        if block != current:
            if held:
                lines.append(" ".join("".join(held).split()))
            current, held = block, []
        if stay[node]:
            held.append(entities.unescape(text) if "&" in text else text)
    if held:
        lines.append(" ".join("".join(held).split()))
    return "\n".join(line for line in lines if line)


def fit(pages: DataFrame, id: str = "page_id", html: str = "html", sample_pages: int = 120,
        nodes_per_page: int = 400, versions: int = 4) -> Trees:
    """Trees from at most `sample_pages` pages (those with the lowest hash of id and text),
    each as it is and in `versions` with planted blocks, and at most `nodes_per_page` nodes of each."""
    key = F.xxhash64(id, html)
    some = pages.where(F.length(html) > 0)
    chosen = [r[0] for r in some.select(key.alias("k")).distinct().orderBy("k").limit(sample_pages).collect()]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for version in (text, *(planted(text, random.Random(k + i)) for i in range(versions))):
                    page = parse(version, planted=True)
                    x, y = features(page)[1:nodes_per_page], weak_labels(page)[1:nodes_per_page]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k]), pa.array([x.astype("<f4").tobytes()], pa.binary()),
                         pa.array([y.tobytes()], pa.binary())], ["k", "x", "y"])

    rows = (some.select(key.alias("k"), F.col(html).alias("html")).where(F.col("k").isin(chosen))
            .dropDuplicates(["k"]).mapInArrow(learn, "k bigint, x binary, y binary")
            .groupBy("k").agg(F.sort_array(F.collect_list(F.struct("x", "y"))).alias("v")).orderBy("k").collect())
    found = [version for row in rows for version in row["v"]]
    x = [np.frombuffer(v["x"], "<f4").reshape(-1, _FEATURES) for v in found]
    y = [np.frombuffer(v["y"], np.int8) for v in found]
    return boost(np.concatenate(x) if x else np.zeros((0, _FEATURES), np.float32),
                 np.concatenate(y) if y else np.zeros(0, np.int8))


def extract(pages: DataFrame, model: Trees, html: str = "html") -> DataFrame:
    """`pages` with `text` (main text) and `n_chars` (its code points); other columns stay.

    A null or empty page has the empty text, as has one with nothing to keep. Equal pages
    have equal texts. One narrow pass; a column of either name is replaced.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)     # a fixed number of trees

    @F.pandas_udf(StringType())
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for at in range(0, len(texts), _PAGES_AT_ONCE):
                pages_ = [parse(text or "") for text in texts.iloc[at:at + _PAGES_AT_ONCE]]
                odds = shared.value.log_odds(np.concatenate([features(page) for page in pages_]))
                ends = np.cumsum([len(page.tags) for page in pages_])
                for page, own in zip(pages_, np.split(odds, ends[:-1])):
                    out.append(block_text(page, decode(page.parents, own)))
            yield pd.Series(out, dtype=object)

    return pages.withColumn("text", main_text(F.col(html))).withColumn("n_chars", F.length("text").cast("bigint"))

"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks. Each block is described by its tag path (element names, classes
and ids), its hashed words and a few numbers; a bidirectional LSTM reads the whole sequence, so every block is
judged with the document around it. The network is trained in numpy on rendered pages of many layouts
whose blocks are known, and is the same every time.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import map_batches

# Element names of HTML by their part in block building.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
                   "tbody td tfoot th thead tr ul").split())
RAW = "script|style|title|textarea"  # hold no markup, and reach to the page's end where theirs is missing
DROPPED = frozenset("noscript template svg iframe select".split())  # go with their content, if they have an end
# An open element that an opening one closes, and where the search for it stops.
IMPLIED_END = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
               "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
               **{t: ("p", "article section div td th li aside main body") for t in BLOCK - {"br", "body", "html", "head", "option"} if t not in ("li", "dt", "dd", "tr", "td", "th")}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})(?=[\s/>])(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s<>/]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+|[^<>]*)>|<[!?][^<>]*>", re.S | re.I)
_NAMES = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in DROPPED}
_UNQUOTED = re.compile(r"=\s*[^\s\"'][^\s\"']*/\Z")  # the stroke belongs to a value, as in <a href=x/>
_LINK = re.compile(r"(?:^|[\s\"'/])href\s*=", re.I)
_WORD_PARTS = re.compile(r"[A-Za-z][a-z]*|\d+")

PATHS, WORDS, PATH_SIZE, WORD_SIZE, NUMBERS, HIDDEN = 2048, 4096, 16, 8, 5, 16
INPUT = PATH_SIZE + WORD_SIZE + NUMBERS
PAGES, EPOCHS = 1600, 6
BATCH_CELLS = 60_000


class Element:
    """An open element with those around it. ``size`` counts the hashes of the whole path."""

    __slots__ = ("name", "hashes", "link", "parent", "depth", "size")

    def __init__(self, name: str, hashes: tuple[int, ...], link: bool, parent: Element | None):
        self.name, self.hashes, self.link, self.parent = name, hashes, link, parent
        self.depth = parent.depth + 1 if parent else 0
        self.size = len(hashes) + (parent.size if parent else 0)


@dataclass
class Block:
    text: str
    path: Element | None  # innermost element; its chain of parents is the path, however deep
    linked: float


def _hash(token: str, size: int) -> int:
    return zlib.crc32(token.encode()) % size


@lru_cache(maxsize=20_000)
def _element(name: str, attributes: str) -> tuple[tuple[int, ...], bool]:
    """Hashed description of an opening tag, and whether it is a link."""
    tokens = [f"<{name}"]
    for m in _NAMES.finditer(attributes):
        kind, value = m[1].lower(), next((g for g in m.groups()[1:] if g), "")
        if kind in ("hidden", "aria-hidden"):
            tokens.append("hidden")
        else:
            tokens += [f".{p.lower()}" for p in _WORD_PARTS.findall(value) if not p.isdigit()]
    return tuple(_hash(t, PATHS) for t in tokens), name == "a" and _LINK.search(attributes) is not None


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks in page order; white space inside a block becomes one space, character references are decoded."""
    out: list[Block] = []
    stack: list[Element] = []
    held: Counter[str] = Counter()  # names on the stack, so that no tag looks for what is not open
    pieces: list[str] = []
    linked = links = 0  # characters inside links, and links now open
    endless: set[str] = set()  # dropped elements without an end further on

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, stack[-1] if stack else None, min(1.0, linked / len(text))))
            pieces.clear()
        linked = 0

    def leave(first: int, last: int):
        nonlocal links
        for element in stack[first:last]:
            held[element.name] -= 1
            links -= element.link
        del stack[first:last]

    def pop_to(names: str, stops: str = ""):
        wanted, limits = names.split(), stops.split()
        if not any(held[name] for name in wanted):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name in wanted:
                leave(i, len(stack))
                return
            if stack[i].name in limits:
                return

    def add(text: str):
        nonlocal linked
        pieces.append(text)
        if links:
            linked += len(text)

    page = page or ""
    at = 0
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if name in BLOCK:
            flush()
        if m[2]:
            pop_to(name)
        else:
            if name in IMPLIED_END:
                pop_to(*IMPLIED_END[name])
            if name in VOID or m[4].endswith("/") and not _UNQUOTED.search(m[4]):
                continue
            if name in DROPPED and name not in endless:
                if end := _ENDS[name].search(page, at):
                    at = end.end()
                    continue
                endless.add(name)
            if name == "a" and held["a"]:  # links do not nest: one left open ends here, what it holds stays open
                inner = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].name == "a")
                leave(inner, inner + 1)
            hashes, link = _element(name, m[4])
            stack.append(Element(name, hashes, link, stack[-1] if stack else None))
            held[name] += 1
            links += link
    if at < len(page):
        rest = page[at:]
        add(rest[:rest.rfind("<")] if re.search(r"<[/!?a-zA-Z][^>]*\Z", rest) else rest)
    flush()
    return out


def describe(blocks: list[Block]):
    """Ragged word hashes, and the numbers of each block."""
    words = [[_word_hash(w) for w in b.text.lower().split()] for b in blocks]
    n = len(blocks)
    numbers = np.array([[np.log1p(len(b.text)) / 6, b.linked, float(b.text[-1] in ".!?:;\"'”»"), i / n, min(1.0, 10 / n)]
                        for i, b in enumerate(blocks)], np.float32).reshape(n, NUMBERS)
    return words, numbers


@lru_cache(maxsize=100_000)
def _word_hash(word: str) -> int:
    return zlib.crc32(word.strip(".,;:!?\"'()").encode()) % WORDS


def path_hashes(element: Element | None) -> list[int]:
    """All hashes of a path, from the outermost element on."""
    chain = []
    while element is not None:
        chain.append(element.hashes)
        element = element.parent
    return [h for hashes in reversed(chain) for h in hashes]


def _path_means(table: np.ndarray, leaves: list[Element | None]) -> np.ndarray:
    """Mean vector of each path. Sums pass from parents to children, depth by depth, so an element is added up once."""
    number: dict[int, int] = {}
    elements: list[Element] = []
    for element in leaves:
        while element is not None and id(element) not in number:
            number[id(element)] = len(elements)
            elements.append(element)
            element = element.parent
    out = np.zeros((len(leaves), table.shape[1]), np.float32)
    if not elements:
        return out
    sizes = np.array([len(e.hashes) for e in elements])
    flat = np.fromiter((h for e in elements for h in e.hashes), np.int64, int(sizes.sum()))
    sums = np.add.reduceat(table[flat], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)
    above = np.array([number[id(e.parent)] if e.parent else -1 for e in elements])
    depths = np.array([e.depth for e in elements])
    order = np.argsort(depths, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depths[order])) + 1)[1:]:
        sums[level] += sums[above[level]]
    inside = [i for i, e in enumerate(leaves) if e is not None]
    at = np.array([number[id(leaves[i])] for i in inside])
    out[inside] = sums[at] / np.array([leaves[i].size for i in inside])[:, None]
    return out


def _means(table: np.ndarray, ragged: list[list[int]]) -> np.ndarray:
    sizes = np.array([len(r) for r in ragged])
    flat = np.fromiter((x for r in ragged for x in r), np.int64, int(sizes.sum()))
    out = np.zeros((len(ragged), table.shape[1]), np.float32)
    filled = np.flatnonzero(sizes)
    if len(filled):
        starts = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
        out[filled] = np.add.reduceat(table[flat], starts, axis=0) / sizes[filled, None]
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Embeddings, one LSTM in each direction and a linear output."""

    parts: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Labeller:
        shapes = {"paths": (PATHS, PATH_SIZE), "words": (WORDS, WORD_SIZE), "out": (2 * HIDDEN, 1)}
        shapes |= {f"{k}{d}": s for d in "fb" for k, s in (("in", (INPUT, 4 * HIDDEN)), ("rec", (HIDDEN, 4 * HIDDEN)))}
        parts = {k: (rng.normal(0, 1, s) * (0.3 if k in ("paths", "words") else s[0] ** -0.5)).astype(np.float32) for k, s in shapes.items()}
        for d in "fb":
            parts[f"bias{d}"] = np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN)
        return cls(parts | {"offset": np.zeros(1, np.float32)})

    def inputs(self, paths, words, numbers) -> np.ndarray:
        return np.concatenate([_means(self.parts["paths"], paths), _means(self.parts["words"], words), numbers], axis=1)

    def _run(self, x: np.ndarray, lengths: np.ndarray, d: str, keep: bool):
        """One direction over [time, page, input]; pages are sorted by length, longest first."""
        steps, pages, _ = x.shape
        projected = x @ self.parts["in" + d] + self.parts["bias" + d]
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out, trace = np.zeros((steps, pages, HIDDEN), np.float32), []
        for t in range(steps):
            n = int(np.searchsorted(-lengths, -t, "left"))  # pages longer than t
            z = projected[t, :n] + h[:n] @ self.parts["rec" + d]
            i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            before_h, before_c = h, c
            h, c = h.copy(), c.copy()
            c[:n] = f * before_c[:n] + i * g
            h[:n] = o * np.tanh(c[:n])
            out[t, :n] = h[:n]
            if keep:
                trace.append((n, i, f, o, g, before_h, before_c, c))
        return out, trace

    @staticmethod
    def _turn(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each page's sequence back to front."""
        t = np.arange(x.shape[0])[:, None]
        at = np.where(t < lengths, lengths - 1 - t, t)
        return x[at, np.arange(x.shape[1])]

    def logits(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
        ahead, trace_f = self._run(x, lengths, "f", keep)
        back, trace_b = self._run(self._turn(x, lengths), lengths, "b", keep)
        both = np.concatenate([ahead, self._turn(back, lengths)], axis=2)
        return (both @ self.parts["out"])[..., 0] + self.parts["offset"], both, trace_f, trace_b

    def _back(self, x, lengths, d, trace, error):
        """Gradients of one direction; also those of its inputs."""
        rec = self.parts["rec" + d]
        dz_all = np.zeros(x.shape[:2] + (4 * HIDDEN,), np.float32)
        d_rec = np.zeros_like(rec)
        dh, dc = np.zeros(error.shape[1:], np.float32), np.zeros(error.shape[1:], np.float32)
        for t in range(len(trace) - 1, -1, -1):
            n, i, f, o, g, before_h, before_c, c = trace[t]
            dh = dh + error[t]
            tanh_c = np.tanh(c[:n])
            dcn = dc[:n] + dh[:n] * o * (1 - tanh_c ** 2)
            dz = np.concatenate([dcn * g * i * (1 - i), dcn * before_c[:n] * f * (1 - f), dh[:n] * tanh_c * o * (1 - o), dcn * i * (1 - g ** 2)], axis=1)
            dz_all[t, :n] = dz
            d_rec += before_h[:n].T @ dz
            dh, dc = dh.copy(), dc.copy()
            dh[:n], dc[:n] = dz @ rec.T, dcn * f
        flat = dz_all.reshape(-1, 4 * HIDDEN)
        return {"in" + d: x.reshape(-1, INPUT).T @ flat, "rec" + d: d_rec, "bias" + d: flat.sum(axis=0)}, dz_all @ self.parts["in" + d].T

    def gradients(self, pages: list, labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        order = sorted(range(len(pages)), key=lambda i: -len(labels[i]))
        pages, labels = [pages[i] for i in order], [labels[i] for i in order]
        lengths = np.array([len(y) for y in labels])
        x, y = np.zeros((lengths[0], len(pages), INPUT), np.float32), np.zeros((lengths[0], len(pages)), np.float32)
        for k, (page, label) in enumerate(zip(pages, labels)):
            x[:len(label), k] = self.inputs(*page)
            y[:len(label), k] = label
        logit, both, trace_f, trace_b = self.logits(x, lengths, keep=True)
        inside = np.arange(lengths[0])[:, None] < lengths
        error = np.where(inside, _sigmoid(logit) - y, 0).astype(np.float32)[..., None] / inside.sum()
        grads = {"out": both.reshape(-1, 2 * HIDDEN).T @ error.reshape(-1, 1), "offset": error.sum().reshape(1)}
        to_both = error @ self.parts["out"].T
        more, dx_f = self._back(x, lengths, "f", trace_f, to_both[..., :HIDDEN])
        turned = self._turn(x, lengths)
        more_b, dx_b = self._back(turned, lengths, "b", trace_b, self._turn(to_both[..., HIDDEN:], lengths))
        dx = dx_f + self._turn(dx_b, lengths)
        grads |= more | more_b
        for name, which, columns in (("paths", 0, slice(0, PATH_SIZE)), ("words", 1, slice(PATH_SIZE, PATH_SIZE + WORD_SIZE))):
            ragged = [r for page in pages for r in page[which]]
            sizes = np.array([len(r) for r in ragged])
            value = np.concatenate([dx[:n, k, columns] for k, n in enumerate(lengths)]) / np.maximum(sizes, 1)[:, None]
            flat = np.fromiter((h for r in ragged for h in r), np.int64, int(sizes.sum()))
            grads[name] = np.zeros_like(self.parts[name])
            np.add.at(grads[name], flat, np.repeat(value, sizes, axis=0).astype(np.float32))
        return grads

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Probability of main text for every block of every page; pages of like length are read together."""
        out: list = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: -len(pages[i]))
        while order:
            size = max(1, BATCH_CELLS // len(pages[order[0]]))
            group, order = order[:size], order[size:]
            lengths = np.array([len(pages[i]) for i in group])
            x = np.zeros((lengths[0], len(group), INPUT), np.float32)
            paths = _path_means(self.parts["paths"], [b.path for i in group for b in pages[i]])
            paths = np.split(paths, np.cumsum(lengths)[:-1])
            for k, i in enumerate(group):
                words, numbers = describe(pages[i])
                x[:lengths[k], k] = np.concatenate([paths[k], _means(self.parts["words"], words), numbers], axis=1)
            p = _sigmoid(self.logits(x, lengths)[0])
            for k, i in enumerate(group):
                out[i] = p[:lengths[k], k]
        return out


class _Renderer:
    """Pages of many layouts with the label of every block they show."""

    # Names that sites commonly give to their parts.
    MAIN = ("article", 'div class="post"', 'div id="content"', 'main', 'div class="entry-content"', 'section class="article-body"', 'div class="story"', 'div class="post-body"', 'article class="single"')
    SIDE = {
        "menu": ("nav", 'div class="menu"', 'ul class="navbar"', 'div id="nav"', 'div class="breadcrumb"', 'nav class="pagination"', 'div class="top-menu"'),
        "header": ("header", 'div class="header"', 'div id="masthead"', 'header class="site-header"'),
        "footer": ("footer", 'div class="footer"', 'div id="footer"', 'footer class="site-footer"', 'div class="copyright"'),
        "sidebar": ("aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="widget"', 'aside class="related"', 'div class="related-posts"', 'div class="share-buttons"', 'div class="social"'),
        "notice": ('div class="cookie-notice"', 'div id="cookie-banner"', 'div class="notice"', 'div class="alert"', 'div class="consent"', 'div role="alert"', 'div class="disclaimer"'),
        "advert": ('div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="sponsored"', 'aside class="promo"', 'div class="ad-banner"', 'div id="advertisement"', 'section class="advertisement"'),
        "form": ("form", 'form class="search"', 'div class="newsletter"', 'form id="login"', 'div class="subscribe"'),
        "comments": ('div id="comments"', 'section class="comments"', 'ol class="comment-list"', 'div class="comment"', 'section id="reader-comments"', 'div class="discussion"', 'div class="replies"'),
    }
    WORDS = {
        "menu": "home news about contact sport archive login sitemap products".split(), "header": "welcome daily site search".split(),
        "footer": "© copyright all rights reserved privacy terms imprint".split(), "sidebar": "related popular latest share tweet follow tags".split(),
        "notice": "we use cookies accept privacy policy consent notice".split(), "advert": "buy now sponsored offer sale advertisement deal".split(),
        "form": "name email subscribe search submit password send".split(), "comments": "reply posted by said ago comment report like".split(),
    }

    def __init__(self, rng: np.random.Generator):
        self.rng = rng
        self.parts = ["".join(rng.choice(list("aeioubcdfghlmnprstvwéäöñç"), int(rng.integers(1, 4)))) for _ in range(150)]

    def text(self, least: int, most: int) -> str:
        rng = self.rng
        words = ["".join(rng.choice(self.parts, int(rng.integers(1, 4)))) for _ in range(int(rng.integers(least, most + 1)))]
        out = " ".join(words).capitalize()
        return out + (rng.choice([".", ".", "", "?", "!"]))

    def boilerplate(self, kind: str) -> list[tuple[str, int]]:
        rng = self.rng
        own = self.WORDS[kind]
        opening = str(rng.choice(self.SIDE[kind]))
        name = opening.split()[0]
        out: list[tuple[str, int]] = [(f"<{opening}>", -1)]
        some = lambda: str(rng.choice(own)) if rng.random() < 0.35 else self.text(1, 2)
        if kind in ("menu",) or kind in ("sidebar", "footer", "header") and rng.random() < 0.4:
            item = "li" if rng.random() < 0.8 or name in ("ul", "ol") else "div"
            if item == "li" and name not in ("ul", "ol"):
                out.append(("<ul>", -1))
            for _ in range(rng.integers(2, 9)):
                out += [(f"<{item}><a href='/x'>", -1), (some(), 0), (f"</a></{item}>", -1)]
            if item == "li" and name not in ("ul", "ol"):
                out.append(("</ul>", -1))
        else:
            inner = "li" if name == "ol" else str(rng.choice(["p", "div", "span", "", "h3"]))
            for _ in range(rng.integers(1, 7 if kind == "comments" else 3)):
                lead = f"<{inner}>" if inner else "<br>"
                words = self.text(1, 45) if rng.random() < (0.8 if kind in ("comments", "advert", "notice", "footer") else 0.3) else some()
                if kind == "form" and rng.random() < 0.6:
                    words = f"<label>{some()}</label> <input name=q> <button>{some()}</button>"
                    out += [(f"{lead}{words.split('<button>')[0]}", 0), (f"<button>{words.split('<button>')[1]}", 0)]
                else:
                    out.append((lead + (some() + " " if rng.random() < 0.4 else "") + words, 0))
                out.append((f"</{inner}>" if inner else "<br>", -1))
        return out + [(f"</{name}>", -1)]

    def article(self) -> list[tuple[str, int]]:
        rng = self.rng
        opening = str(rng.choice(self.MAIN))
        out: list[tuple[str, int]] = [(f"<{opening}>", -1)]
        if rng.random() < 0.85:
            out += [("<h1>", -1), (self.text(2, 14), 1), ("</h1>", -1)]
        for _ in range(rng.integers(1, 14)):
            roll = rng.random()
            if roll < 0.72:
                body = self.text(1, 70 if rng.random() < 0.8 else 4)
                if rng.random() < 0.2:
                    body = f"<b>{body}"
                if rng.random() < 0.2:
                    body += f" <a href='/y'>{self.text(1, 4)}</a> {self.text(1, 10)}"
                out += [("<p>", -1), (body, 1), (str(rng.choice(["</p>", "</p>", "</p>", "<br>", ""])), -1)]
            elif roll < 0.8:
                out += [("<h2>", -1), (self.text(2, 8), 1), ("</h2>", -1)]
            elif roll < 0.87:
                out.append(("<ul>", -1))
                for _ in range(rng.integers(1, 5)):
                    out += [("<li>", -1), (self.text(2, 12), 1), ("</li>", -1)]
                out.append(("</ul>", -1))
            elif roll < 0.92:
                tag = str(rng.choice(["blockquote", "pre", "figcaption", "td"]))
                around = ("<table><tr>", "</tr></table>") if tag == "td" else ("", "")
                out += [(f"{around[0]}<{tag}>", -1), (self.text(3, 30), 1), (f"</{tag}>{around[1]}", -1)]
            else:
                out += self.boilerplate(str(rng.choice(["advert", "sidebar", "form", "notice"])))
        if rng.random() < 0.1:
            out += self.boilerplate("comments")
        return out + [(f"</{opening.split()[0]}>", -1)]

    def page(self) -> list[tuple[str, int]]:
        rng = self.rng
        out: list[tuple[str, int]] = [("<!DOCTYPE html><html><head><title>x</title><script>var a='<p>';</script></head><body>", -1)]
        for kind in rng.permutation(["menu", "header", "notice", "advert", "sidebar", "form"])[:rng.integers(0, 5)]:
            out += self.boilerplate(str(kind))
        wrap = rng.random() < 0.4
        out += [(f"<div class='{rng.choice(['wrapper', 'container', 'page', 'row'])}'>", -1)] * wrap + self.article()
        for kind in rng.permutation(["comments", "advert", "sidebar", "form", "menu", "notice"])[:rng.integers(0, 4)]:
            out += self.boilerplate(str(kind))
        out += [("</div>", -1)] * wrap
        return out + (self.boilerplate("footer") if rng.random() < 0.8 else []) + [("</body></html>", -1)]

    def example(self) -> tuple[list[Block], np.ndarray]:
        """Blocks as the parser sees them; a mark written into each text carries its label through."""
        marked = "".join(piece if label < 0 else re.sub(r"(^(?:<[^>]*>)*)", lambda m: f"{m[0]}\x02{label}", piece, count=1) for piece, label in self.page())
        blocks = [b for b in blocks_of(marked)]
        labels = []
        for b in blocks:
            found = re.findall("\x02([01])", b.text)
            labels.append(float(found[0]) if found else (labels[-1] if labels else 0.0))
            b.text = re.sub("\x02[01]", "", b.text).strip() or "."
        return blocks, np.array(labels, np.float32)


@lru_cache(maxsize=1)
def train(seed: int = 5, pages: int = PAGES, epochs: int = EPOCHS) -> Labeller:
    rng = np.random.default_rng(seed)
    renderer = _Renderer(rng)
    made = [x for x in (renderer.example() for _ in range(pages)) if x[0]]
    data, labels = [([path_hashes(b.path) for b in blocks], *describe(blocks)) for blocks, _ in made], [y for _, y in made]
    net = Labeller.fresh(rng)
    first = {k: np.zeros_like(v) for k, v in net.parts.items()}
    second = {k: np.zeros_like(v) for k, v in net.parts.items()}
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for i in range(0, len(data), 32):
            at, t = order[i:i + 32], t + 1
            for k, g in net.gradients([data[j] for j in at], [labels[j] for j in at]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net.parts[k] -= (0.01 * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return net


def main_texts(pages: list[str | None], net: Labeller) -> list[str]:
    split = [blocks_of(p) for p in pages]
    return ["\n".join(b.text for b, p in zip(blocks, chances) if p >= 0.5) for blocks, chances in zip(split, net.label(split))]


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, in one pass without a shuffle.

    Null and empty html give an empty text; repeated rows are each read, an empty table gives none. Broken markup is read as far as it goes; a tag cut off at the end is no text.
    Only page_id, url and html are read.
    """
    sent = pages.sparkSession.sparkContext.broadcast(train())
    kind = pages.schema["page_id"].dataType.simpleString()

    def make():
        net = sent.value

        def step(ids, urls, htmls):
            texts = []
            for i in range(0, len(htmls), 1000):
                texts += main_texts(htmls[i:i + 1000], net)
            return {"page_id": ids, "url": urls, "text": texts, "n_chars": [len(t) for t in texts]}
        return step

    return map_batches(pages, ["page_id", "url", F.col("html")], f"page_id {kind}, url string, text string, n_chars bigint", make)

"""Main text of web pages by a recurrent labeller of their blocks.

Every block becomes a vector of its tag path, its hashed words and a few measures; a bidirectional LSTM in numpy
reads the blocks of the whole page and says of each whether it belongs to the article. It is trained on the driver
from a bounded sample of pages: their article elements say which blocks are main text, and the same blocks are laid
out anew between menus, notices, adverts, forms, sidebars and comments of many spellings, so that it does not hang on
one layout. The weights (under 1 MB) are broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.llm.common import slices
from dockline.llm.page_blocks import PATH_TERMS, Page, path_term, read_page

SAMPLE_PAGES, SAMPLE_BYTES = 300, 1 << 16     # pages learnt from, and the largest of them
WORD_TERMS, PATH_SIZE, WORD_SIZE, HIDDEN = 2048, 16, 8, 16
NEAR = 3                                      # innermost elements that have vectors of their own
MEASURES = 8
LAYOUTS, EPOCHS, BATCH, RATE, WINDOW, DEAF = 3, 5, 32, 0.015, 96, 0.5
MOST_BLOCKS = 200_000                         # blocks whose vectors are held at once, unless one page has more
STEPS = 2048                                  # blocks of a page multiplied at once

# --- fixed values: what the elements and class words of pages mean -----------
MAIN = {"t:article", "t:main"}
OTHER = {"t:nav", "t:header", "t:footer", "t:aside", "t:form", "t:button", "t:select", "t:title", "t:noscript", "t:menu", "t:dialog",
         "t:textarea", "t:iframe", "t:template", "t:svg", "t:fieldset", "t:label", "c:ad", "c:ads", "c:advert", "c:sponsored",
         "c:cookie", "c:notice", "c:comments", "c:comment", "c:sidebar", "c:related", "c:share", "c:newsletter", "c:breadcrumb"}
HEADINGS = {"t:h1", "t:h2", "t:h3", "t:h4", "t:h5", "t:h6"}
MAIN_PATHS = ["article", "main", "article.post", "div.article", "div.content", "div.post content", "section.story", "div.entry content",
              "div.main", "main.content article", "div.body text", "section.article body"]
OTHER_PATHS = {
    "menu": ["nav", "nav.main menu", "div.nav", "div.menu", "ul.navigation", "div.navbar", "div.breadcrumb", "ul.pagination", "div.toc", "menu",
             "header nav", "div.topbar links", "div.sitemap"],
    "head": ["header", "header.site header", "div.header", "div.masthead", "div.logo", "div.banner", "div.site title"],
    "foot": ["footer", "div.footer", "footer.site footer", "div.copyright", "div.legal", "div.colophon", "div.bottom"],
    "side": ["aside", "aside.sidebar", "div.sidebar", "div.widget", "div.related", "div.recommended", "aside.related posts", "div.popular",
             "div.author bio", "div.tags", "div.teaser list", "section.more"],
    "notice": ["div.notice", "div.cookie", "div.cookie banner", "div.consent", "div.alert", "div.gdpr", "div.popup", "div.modal", "dialog", "div.message",
               "div.paywall", "div.warning", "noscript"],
    "advert": ["div.ad", "div.ads", "div.advert", "div.sponsored", "div.promo", "aside.ad", "div.advertisement", "ins.adsbygoogle", "div.ad slot",
               "div.sponsor", "section.promo"],
    "form": ["form", "form.search", "form.subscribe", "div.newsletter form", "form.login", "form.comment form", "div.signup", "div.share", "div.social", "form label",
             "form fieldset", "form select"],
    "comment": ["div.comments", "section.comments", "div.comment", "ol.comment list", "div.comments div.comment", "div.discussion", "div.replies", "aside.comments",
                "section.responses", "div.disqus thread", "div.feedback"],
}
LEAVES = {"menu": ["ul li a", "a", "li a", "span"], "head": ["h1", "a", "h1", "div", "p"], "foot": ["p", "", "div", "ul li a"], "side": ["p", "ul li a", "h3", "div", ""],
          "notice": ["p", "", "div", "span", "button"], "advert": ["", "p", "a", "div"], "form": ["label", "button", "option", "p", ""],
          "comment": ["p", "div p", "li p", "div", "h4", "li"]}
# -----------------------------------------------------------------------------


@dataclass
class Blocks:
    """The blocks of several pages in a row: terms of their paths and words, measures, and blocks per page.

    ``path`` may hold the finished path vectors instead of terms.
    """

    path: list[np.ndarray] | np.ndarray
    near: list[np.ndarray]
    words: list[np.ndarray]
    measures: np.ndarray
    sizes: np.ndarray


def _measures(texts: list[str], linked: list[int], near: list[list[str]]) -> np.ndarray:
    """Length, words, share in links, ends like a sentence, marks within, digits, and place in the page from both ends."""
    out = np.zeros((len(texts), MEASURES), np.float32)
    for i, (text, links, own) in enumerate(zip(texts, linked, near)):
        n = len(text)
        out[i, :6] = (np.log1p(n) / 6, np.log1p(text.count(" ") + 1) / 5, links / n, text[-1] in ".!?:…\"'”)",
                      min(1.0, 20 * (text.count(",") + text.count(".")) / n), any(t in HEADINGS for t in own))
    place = np.arange(len(texts))
    out[:, 6] = 1 / (1 + place)
    out[:, 7] = 1 / (len(texts) - place) if len(texts) else 0
    return out


def _word_terms(text: str) -> np.ndarray:
    return np.fromiter((crc32(w.encode("utf-8", "replace")) % WORD_TERMS for w in text.lower().split()), np.int32)


def path_terms(elements: list[list[str]]) -> np.ndarray:
    return np.array([path_term(t[0], t[2:]) for own in elements for t in own], np.int32)


def blocks_of(sequences: list[list[tuple[list[list[str]], str, int]]]) -> Blocks:
    """Blocks from (path, text, characters in links), page by page."""
    path, near, words, measures = [], [], [], [np.zeros((0, MEASURES), np.float32)]
    for page in sequences:
        path += [path_terms(elements) for elements, _, _ in page]
        near += [path_terms(elements[-NEAR:]) for elements, _, _ in page]
        words += [_word_terms(text) for _, text, _ in page]
        measures.append(_measures([t for _, t, _ in page], [n for _, _, n in page], [[w for e in p[-NEAR:] for w in e] for p, _, _ in page]))
    return Blocks(path, near, words, np.concatenate(measures), np.array([len(p) for p in sequences], np.int64))


def _means(table: np.ndarray, terms: list[np.ndarray]) -> np.ndarray:
    """The mean vector of each list of terms; zeros for an empty list."""
    sizes = np.fromiter(map(len, terms), np.int64, len(terms))
    out = np.zeros((len(terms), table.shape[1]), np.float32)
    some = sizes > 0
    if some.any():
        starts = np.cumsum(sizes[some]) - sizes[some]
        out[some] = np.add.reduceat(table[np.concatenate(terms)], starts, axis=0) / sizes[some, None]
    return out


def _spread(grad: np.ndarray, terms: list[np.ndarray], rows: int) -> np.ndarray:
    """The gradient of a table whose means have the gradient ``grad``."""
    sizes = np.fromiter(map(len, terms), np.int64, len(terms))
    out = np.zeros((rows, grad.shape[1]), np.float32)
    some = np.flatnonzero(sizes)
    if len(some):
        np.add.at(out, np.concatenate([terms[i] for i in some]), np.repeat(grad[some] / sizes[some, None], sizes[some], axis=0))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _places(sizes: np.ndarray, backward: bool) -> tuple[np.ndarray, np.ndarray]:
    """For step and page the row of its block in reading order, and whether there is one."""
    first = np.cumsum(sizes) - sizes
    step = np.arange(sizes.max(initial=0))[:, None]
    there = step < sizes
    at = first + (sizes - 1 - step if backward else step)
    return np.where(there, at, 0), there


class Labeller:
    """Embeddings, one LSTM in either direction and a logistic output over both."""

    def __init__(self, seed: int = 0):
        pick = np.random.default_rng(seed)
        size = 2 * PATH_SIZE + WORD_SIZE + MEASURES
        draw = lambda *shape, by: (pick.standard_normal(shape) * by).astype(np.float32)
        self.weights = {"path": draw(PATH_TERMS, PATH_SIZE, by=0.3), "near": draw(PATH_TERMS, PATH_SIZE, by=0.3), "words": draw(WORD_TERMS, WORD_SIZE, by=0.1),
                        "out": draw(2 * HIDDEN + size, by=0.1), "bias": np.zeros(1, np.float32)}
        for way in ("f", "b"):
            self.weights |= {f"x{way}": draw(size, 4 * HIDDEN, by=size ** -0.5), f"h{way}": draw(HIDDEN, 4 * HIDDEN, by=HIDDEN ** -0.5),
                             f"s{way}": np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN)}

    def vectors(self, blocks: Blocks) -> np.ndarray:
        w = self.weights
        path = blocks.path if isinstance(blocks.path, np.ndarray) else _means(w["path"], blocks.path)
        return np.concatenate([path, _means(w["near"], blocks.near), _means(w["words"], blocks.words), blocks.measures], axis=1)

    def _read(self, x: np.ndarray, sizes: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """State after each block in one direction; ``keep`` takes what the gradient needs."""
        w, hidden = self.weights, np.zeros((len(x), HIDDEN), np.float32)
        at, there = _places(sizes, way == "b")
        h = c = np.zeros((len(sizes), HIDDEN), np.float32)
        for first in range(0, len(at), STEPS):
            drive = x[at[first:first + STEPS]] @ w[f"x{way}"] + w[f"s{way}"]
            for t, z in enumerate(drive, first):
                gates = z + h @ w[f"h{way}"]
                go = _sigmoid(gates[:, :3 * HIDDEN])
                i, f, o = go[:, :HIDDEN], go[:, HIDDEN:2 * HIDDEN], go[:, 2 * HIDDEN:]
                g = np.tanh(gates[:, 3 * HIDDEN:])
                before = (h, c)
                c = f * c + i * g
                squashed = np.tanh(c)
                h = o * squashed
                on = there[t]
                hidden[at[t][on]] = h[on]
                if keep is not None:
                    keep.append((at[t], on, i, f, o, g, squashed, *before))
        return hidden

    def scores(self, blocks: Blocks) -> np.ndarray:
        """How likely each block is main text, 0 to 1."""
        x = self.vectors(blocks)
        both = np.concatenate([self._read(x, blocks.sizes, "f"), self._read(x, blocks.sizes, "b"), x], axis=1)
        return _sigmoid(both @ self.weights["out"] + self.weights["bias"])

    def gradient(self, blocks: Blocks, labels: np.ndarray, deaf: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss and its gradient; ``deaf`` blanks the word vectors of some blocks."""
        w, kept = self.weights, {"f": [], "b": []}
        x = self.vectors(blocks)
        word = slice(2 * PATH_SIZE, 2 * PATH_SIZE + WORD_SIZE)
        if deaf is not None:
            x[deaf, word] = 0
        both = np.concatenate([self._read(x, blocks.sizes, way, kept[way]) for way in "fb"] + [x], axis=1)
        p = _sigmoid(both @ w["out"] + w["bias"])
        loss = -float(np.mean(np.log(np.where(labels > 0, p, 1 - p) + 1e-9)))
        error = ((p - labels) / len(labels)).astype(np.float32)
        grads = {"out": both.T @ error, "bias": error.sum(keepdims=True)}
        spread = error[:, None] * w["out"]
        dx = spread[:, 2 * HIDDEN:].copy()
        for way, part in (("f", spread[:, :HIDDEN]), ("b", spread[:, HIDDEN:2 * HIDDEN])):
            dw_h, dz_all = np.zeros_like(w[f"h{way}"]), np.zeros((len(x), 4 * HIDDEN), np.float32)
            dh = dc = np.zeros((len(blocks.sizes), HIDDEN), np.float32)
            for at, on, i, f, o, g, squashed, h0, c0 in reversed(kept[way]):
                live = on[:, None]
                dh = dh + np.where(live, part[at], 0)
                dc = dc + dh * o * (1 - squashed ** 2)
                dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g ** 2)], axis=1) * live
                dw_h += h0.T @ dz
                dz_all[at[on]] = dz[on]
                dh = np.where(live, dz @ w[f"h{way}"].T, dh)
                dc = np.where(live, dc * f, dc)
            grads |= {f"x{way}": x.T @ dz_all, f"h{way}": dw_h, f"s{way}": dz_all.sum(0)}
            dx += dz_all @ w[f"x{way}"].T
        if deaf is not None:
            dx[deaf, word] = 0
        grads["path"] = _spread(dx[:, :PATH_SIZE], blocks.path, PATH_TERMS)
        grads["near"] = _spread(dx[:, PATH_SIZE:2 * PATH_SIZE], blocks.near, PATH_TERMS)
        grads["words"] = _spread(dx[:, word], blocks.words, WORD_TERMS)
        return loss, grads


def taught(path: list[list[str]]) -> bool:
    """Whether the elements around a block make it main text: the innermost that says anything decides.

    A heading in the header of an article is part of it.
    """
    heading = bool(path) and any(t in HEADINGS for t in path[-1])
    for own in reversed(path):
        if any(t in MAIN for t in own):
            return True
        if any(t in OTHER for t in own) and not (heading and own[0] == "t:header" and any(t in MAIN for e in path for t in e)):
            return False
    return False


def _elements(spelled: str) -> list[list[str]]:
    """``div.cookie banner`` is a div of two class words; a word without a stop after such an element's words is its class."""
    out: list[list[str]] = []
    for word in spelled.split():
        tag, _, kind = word.partition(".")
        if kind:
            out.append([f"t:{tag}", f"c:{kind}"])
        elif out and len(out[-1]) > 1 and word not in {"article", "nav", "fieldset", "label", "select", "p", "li", "a"}:
            out[-1].append(f"c:{word}")
        else:
            out.append([f"t:{word}"])
    return out


class Layouts:
    """Lays the main blocks of a page out anew between made surroundings, whose words come from other pages."""

    def __init__(self, texts: list[str], seed: int = 0):
        self.pick = np.random.default_rng(seed)
        self.texts = texts or ["A sentence of some words."]

    def words(self, least: int, most: int) -> str:
        words = self.texts[self.pick.integers(len(self.texts))].split()
        n = int(self.pick.integers(least, most + 1))
        at = int(self.pick.integers(max(1, len(words) - n)))
        return self.said(" ".join(words[at:at + n]) or "More")

    def said(self, text: str) -> str:
        """The text, or now and then one made word over and over, so that no word decides alone."""
        if self.pick.random() < 0.9:
            return text
        return " ".join([f"x{self.pick.integers(1 << 20)}"] * (1 + text.count(" "))) + "."[:int(self.pick.integers(2))]

    def one(self, options: list[str]) -> list[list[str]]:
        return _elements(options[self.pick.integers(len(options))])

    def wrap(self, path: list[list[str]]) -> list[list[str]]:
        """Now and then a class word nobody has seen, or boxes around the element."""
        out = [list(own) for own in path]
        if self.pick.random() < 0.3:
            out = [["t:div", f"c:x{self.pick.integers(1 << 20)}"]] * int(self.pick.integers(1, 3)) + out
        if self.pick.random() < 0.2:
            out[-1].append(f"c:x{self.pick.integers(1 << 20)}")
        return out

    def around(self, kind: str, base: list[list[str]]) -> list[tuple[list[list[str]], str, int]]:
        outer, out = base + self.wrap(self.one(OTHER_PATHS[kind])), []
        count = {"menu": (2, 8), "comment": (1, 6), "side": (1, 6), "form": (1, 5)}.get(kind, (1, 2))
        size = {"menu": (1, 3), "form": (1, 5), "head": (1, 6), "comment": (2, 60), "side": (1, 30), "notice": (3, 30), "advert": (2, 25), "foot": (2, 15)}[kind]
        leaf = self.one(LEAVES[kind])
        for _ in range(int(self.pick.integers(count[0], count[1] + 1))):
            if self.pick.random() < 0.3:
                leaf = self.one(LEAVES[kind])
            text = self.words(*size)
            out.append((outer + leaf, text, len(text) if any(e[0] == "t:a" for e in leaf) else 0))
        return out

    def page(self, main: list[tuple[list[str], str, int]]) -> tuple[list, list[int]]:
        """Blocks and labels of one layout of the main blocks, given as (innermost element, text, characters in links)."""
        chance = self.pick.random
        page, labels = [], []
        base = [["t:html"], ["t:body"]][int(2 * (chance() < 0.2)):]

        def put(blocks, label):
            page.extend(blocks)
            labels.extend([label] * len(blocks))

        if chance() < 0.8:
            put([([["t:html"], ["t:head"], ["t:title"]], main[0][1], 0)], 0)
        for kind in ("notice", "head", "menu", "advert", "side", "form"):
            if chance() < (0.7 if kind in ("menu", "advert") else 0.3):
                put(self.around(kind, base), 0)
        if chance() < 0.1:  # an element before the article is never closed
            base = base + self.one(OTHER_PATHS[("menu", "head", "side")[self.pick.integers(3)]])
        inner = base + self.wrap(self.one(MAIN_PATHS))
        for i, (own, text, links) in enumerate(main):
            if i and chance() < 0.04:
                put(self.around(("advert", "side", "form", "notice", "menu")[self.pick.integers(5)], inner), 0)
            around = [["t:header"]] if i == 0 and own and own[0] == "t:h1" and chance() < 0.1 else []
            kind = own
            if own and own[0] == "t:p" and chance() < 0.15:
                kind = [("t:h2", "t:h3", "t:li", "t:blockquote", "t:div", "t:pre", "t:td")[self.pick.integers(7)]]
                if kind[0] in ("t:h2", "t:h3"):
                    text = " ".join(text.split()[:8])
                around = {"t:li": [["t:ul"]], "t:td": [["t:table"], ["t:tr"]]}.get(kind[0], around)
            put([(inner + around + ([kind] if kind else []), self.said(text), links)], 1)
        if chance() < 0.3:
            put(self.around("comment", inner if chance() < 0.4 else base), 0)
        for kind in ("side", "comment", "form", "advert", "menu", "foot", "notice"):
            if chance() < (0.8 if kind == "foot" else 0.3):
                put(self.around(kind, base), 0)
        return page, labels


def fit_labeller(htmls: list[str], seed: int = 0, layouts: int = LAYOUTS, epochs: int = EPOCHS) -> Labeller:
    """Trains on pages with an article element as they are, and on their main blocks laid out anew."""
    sequences, given, others = [], [], []
    for html in htmls:
        page = read_page(html)
        blocks = [(page.path(e), text, links) for e, text, links in page.blocks]
        labels = [int(taught(path)) for path, _, _ in blocks]
        if any(labels):
            given.append((blocks, labels))
        others += [t for (_, t, _), label in zip(blocks, labels) if len(t) > 20]
    layout = Layouts(others[:20_000], seed)
    layouts = max(layouts, SAMPLE_PAGES * layouts // max(1, len(given)))  # few pages are laid out more often
    for blocks, labels in given:
        sequences += [(blocks, labels)] * 2
        main = [([path[-1][0]] if path[-1][0] not in MAIN else [], text, links) for (path, text, links), y in zip(blocks, labels) if y]
        for _ in range(layouts):
            sequences.append(layout.page(main))
    if not given:
        said = [(["t:h1"], "A heading", 0)] + [(["t:p"], "A sentence that says something about a matter.", 0)] * 6
        sequences = [layout.page(said) for _ in range(200)]
    pieces = [(blocks[i:i + WINDOW], labels[i:i + WINDOW]) for blocks, labels in sequences for i in range(0, len(blocks), WINDOW)]
    return train(pieces, seed, epochs)


def train(pieces: list[tuple[list, list[int]]], seed: int = 0, epochs: int = EPOCHS) -> Labeller:
    """Adam over batches of sequences of like length."""
    model, pick = Labeller(seed), np.random.default_rng(seed)
    ready = [(blocks_of([blocks]), np.array(labels, np.float32)) for blocks, labels in pieces]
    ready.sort(key=lambda r: len(r[1]))
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    starts, step = np.arange(0, len(ready), BATCH), 0
    total = epochs * len(starts)
    for _ in range(epochs):
        for start in pick.permutation(starts):
            some = ready[start:start + BATCH]
            blocks = Blocks([t for b, _ in some for t in b.path], [t for b, _ in some for t in b.near], [t for b, _ in some for t in b.words],
                            np.concatenate([b.measures for b, _ in some]), np.concatenate([b.sizes for b, _ in some]))
            labels = np.concatenate([y for _, y in some])
            _, grads = model.gradient(blocks, labels, pick.random(len(labels)) < DEAF)
            step += 1
            rate = RATE * (1 - step / (total + 1)) * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                model.weights[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return model


def sample_pages(pages: DataFrame, sample: int = SAMPLE_PAGES, most_bytes: int = SAMPLE_BYTES) -> list[str]:
    """At most ``sample`` pages of at most ``most_bytes``, those of least hash; longer ones are labelled, not learnt from."""
    short = pages.where(F.octet_length("html") <= most_bytes).select("html", F.xxhash64("html").alias("h"))
    hashes = [r["h"] for r in short.select("h").distinct().orderBy("h").limit(sample).collect()]  # copies count once
    rows = short.where(F.col("h").isin(hashes)).groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect()
    return [r["html"] for r in rows]


def _encoded(page: Page, table: np.ndarray) -> tuple[np.ndarray, list, list, np.ndarray]:
    """Path vectors, terms near by and words of every block, and measures.

    The sum of an element's path is that of its parent and its own terms, so deep pages cost no more than flat ones.
    """
    sums, counts = np.zeros((len(page.parents) + 1, table.shape[1]), np.float32), np.zeros(len(page.parents) + 1, np.float32)
    own = [path_terms([terms]) for terms in page.terms]
    for e, (parent, mine) in enumerate(zip(page.parents, own)):
        sums[e] = table[mine].sum(0)
        if parent >= 0:
            sums[e] += sums[parent]
        counts[e] = len(mine) + (counts[parent] if parent >= 0 else 0)
    none = np.zeros(0, np.int32)
    near, names = {}, {}
    for element, _, _ in page.blocks:
        if element not in near:
            chain, at = [], element
            while at >= 0 and len(chain) < NEAR:
                chain.append(at)
                at = page.parents[at]
            near[element] = np.concatenate([own[e] for e in chain]) if chain else none
            names[element] = [t for e in chain for t in page.terms[e]]
    at = np.fromiter((e for e, _, _ in page.blocks), np.int64, len(page.blocks))  # -1, outside of all elements, is the row of zeros
    return (sums[at] / np.maximum(counts[at], 1)[:, None], [near[e] for e in at], [_word_terms(t) for _, t, _ in page.blocks],
            _measures([t for _, t, _ in page.blocks], [n for _, _, n in page.blocks], [names[e] for e in at]))


def label_pages(model: Labeller, pages: list[Page]) -> list[np.ndarray]:
    """Scores of the blocks of each page; pages of like length are read side by side."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p.blocks), key=lambda i: len(pages[i].blocks))
    while order:
        group, held = [], 0
        while order and (not group or (held + len(pages[order[-1]].blocks) <= MOST_BLOCKS and 2 * len(pages[order[-1]].blocks) >= len(pages[group[0]].blocks))):
            group.append(order.pop())
            held += len(pages[group[-1]].blocks)
        path, near, words, measures = zip(*[_encoded(pages[i], model.weights["path"]) for i in group])
        flat = lambda parts: [t for p in parts for t in p]
        sizes = np.array([len(pages[i].blocks) for i in group], np.int64)
        scores = model.scores(Blocks(np.concatenate(path), flat(near), flat(words), np.concatenate(measures), sizes))
        for i, part in zip(group, np.split(scores, np.cumsum(sizes)[:-1])):
            out[i] = part
    return out


def page_texts(pages: DataFrame, model: Labeller) -> DataFrame:
    """(page_id, url, text, n_blocks, kept): the main blocks in page order, one line each.

    * A null or empty page, or one without main text, has the empty text; whole pages are read, however long.
    * Repeated rows come out each; null ids and urls stay; extra columns are not read; empty in, empty out.
    """
    shipped = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, 128, 4 << 20):
            read = [read_page(html) for html in batch.column(2).to_pylist()]
            texts, blocks, kept = [], [], []
            for page, scores in zip(read, label_pages(shipped.value, read)):
                main = [text for (_, text, _), s in zip(page.blocks, scores) if s >= 0.5]
                texts.append("\n".join(main))
                blocks.append(len(page.blocks))
                kept.append(len(main))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(blocks, pa.int32()),
                                              pa.array(kept, pa.int32())], ["page_id", "url", "text", "n_blocks", "kept"])

    return pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")) \
        .mapInArrow(run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_blocks int, kept int")


def main_text(pages: DataFrame, sample: int = SAMPLE_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every row, by a labeller trained on a sample of the same pages."""
    texts = page_texts(pages, fit_labeller(sample_pages(pages, sample)))
    return texts.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))

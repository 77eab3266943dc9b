"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks of text. Every block becomes a vector: hashed names of the tags, classes and ids on the path
above it, hashed words, and a few measures. A bidirectional LSTM (numpy) reads the vectors of a page in order and decides for
each block, with the whole page as context, whether it belongs to the article.

It is trained here, on at most ``FIT_PAGES`` rows of the table, chosen by a hash of page_id and html; long pages are learnt in
stretches of ``STRETCH`` blocks, to their end. Their blocks are labelled by what their containers mean in HTML (article and main
against nav, aside, footer and the like); since a table may know few layouts, each page is also laid out anew, several times, in
other common containers and in such with names that say nothing, with texts of the table.

Null html counts as empty; a page without text gives an empty string. White space inside a block becomes one space, blocks are
joined by one space in page order; nothing is capped. Unclosed tags, comments and truncated pages are read to their end.
Rows are treated one by one: repeated rows get equal texts, null ids and urls are carried, an empty table gives no rows, and
columns other than the three named are never read. An empty table leaves the model untrained, and no block is kept.
"""

from __future__ import annotations

import html as references
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tradeloom.llm.shared import bounded_sample

FIT_PAGES, LAYOUTS, EPOCHS, HIDDEN, RATE = 120, 3, 10, 16, 0.01
STRETCH = 200  # blocks that are learnt in one sequence
PATH_SLOTS, WORD_SLOTS, MEASURES = 256, 16, 4
WIDTH = PATH_SLOTS + WORD_SLOTS + MEASURES

# HTML elements by what they do to the text.
RAW = {"script", "style", "noscript", "template", "title", "textarea", "select", "svg", "iframe", "object", "button"}
VOID = {"br", "hr", "img", "meta", "link", "input", "area", "base", "col", "embed", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s",
          "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", re.S)
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)

# Containers that mean the article, and containers that mean something else.
ARTICLE = ["article", "main", "div.article", "div.article-body", "div.post", "div.post-content", "div.entry-content", "div.content",
           "section.story", "div.main-content", "div#content", "div.text", "section", "div", "div.body"]
OTHER = ["nav", "header", "footer", "aside", "form", "div.ad", "div.ads", "div.advert", "div.advertisement", "div.banner", "div.promo",
         "div.sponsored", "div.menu", "ul.menu", "div.nav", "div.navbar", "div.sidebar", "div#sidebar", "div.widget", "div.related",
         "div.header", "div.footer", "div#footer", "div.comments", "section.comments", "div#comments", "div.comment", "li.comment",
         "div.cookie", "div.cookie-notice", "div.notice", "div.banner-notice", "div.popup", "div.newsletter", "div.subscribe",
         "div.breadcrumbs", "div.share", "div.social", "div.login", "form.search", "div.disclaimer", "div.copyright", "aside.related"]

Block = tuple[list[str], str, float]


def _names(attributes: str) -> list[str]:
    return [name for groups in NAMED.findall(attributes) for name in re.findall(r"[a-z]+", "".join(groups).lower())]


def blocks_of(html: str) -> list[Block]:
    """(names on the path, text, share of the text inside links) of every leaf block with text, in page order."""
    stack: list[tuple[str, list[str]]] = []
    blocks: list[Block] = []
    parts: list[str] = []
    linked = total = at = 0

    def close() -> None:
        nonlocal linked, total
        text = " ".join(references.unescape("".join(parts)).split())
        if text:
            blocks.append(([name for _, names in stack for name in names], text, linked / max(total, 1)))
        parts.clear()
        linked = total = 0

    def write(text: str) -> None:
        nonlocal linked, total
        parts.append(text)
        total += len(text)
        linked += len(text) * any(tag == "a" for tag, _ in stack)

    while at < len(html):
        match = PIECE.search(html, at)
        if not match:
            write(html[at:])
            break
        write(html[at:match.start()])
        at = match.end()
        closing, tag, attributes = match[1], (match[2] or "").lower(), match[3] or ""
        if not tag:
            continue
        if tag not in INLINE:
            close()
        if closing:
            if any(tag == open_tag for open_tag, _ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>|\Z", re.I).search(html, at)
            at = end.end()
        elif tag not in VOID and not attributes.endswith("/"):
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):  # an open one ends here
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == tag:
                        del stack[depth:]
                        break
                    if stack[depth][0] not in INLINE:
                        break
            stack.append((tag, [] if tag in INLINE else [tag, *_names(attributes)]))
    close()
    return blocks


def _slot(name: str, slots: int) -> int:
    return zlib.crc32(name.encode()) % slots


def vector(block: Block) -> np.ndarray:
    names, text, linked = block
    v = np.zeros(WIDTH, np.float32)
    for name in names:
        if name not in ("html", "body"):
            v[_slot(name, PATH_SLOTS)] = 1
    words = text.split()
    slots = np.bincount([_slot(word, WORD_SLOTS) for word in text.lower().split()], minlength=WORD_SLOTS)
    v[PATH_SLOTS:PATH_SLOTS + WORD_SLOTS] = slots / max(len(words), 1)
    v[-MEASURES:] = np.log1p(len(words)) / 5, linked, float(text[-1] in ".!?"), 1.0
    return v


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Weights of two LSTMs, one per direction, and of the output."""

    def __init__(self, seed: int = 3) -> None:
        r = np.random.default_rng(seed)
        self.w = {f"{d}{k}": (r.standard_normal(shape) * 0.1).astype(np.float64) for d in "fb" for k, shape in
                  (("x", (WIDTH, 4 * HIDDEN)), ("h", (HIDDEN, 4 * HIDDEN)), ("c", (4 * HIDDEN,)))}
        self.w |= {"o": r.standard_normal(2 * HIDDEN) * 0.1, "p": np.zeros(1)}
        self.trained = False

    def _run(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """x: (steps, pages, WIDTH). States of all steps and what the way back needs."""
        h = c = np.zeros((x.shape[1], HIDDEN))
        fed, states, kept = x @ self.w[d + "x"] + self.w[d + "c"], [], []
        for t in range(len(x)):
            gates = fed[t] + h @ self.w[d + "h"]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g, before, h_before = np.tanh(gates[:, 3 * HIDDEN:]), c, h
            c = f * c + i * g
            h = o * np.tanh(c)
            states.append(h)
            kept.append((i, f, o, g, before, c, h_before))
        return np.stack(states), kept

    def _back(self, x: np.ndarray, d: str, kept: list, dh_all: np.ndarray, grads: dict) -> None:
        dh = dc = np.zeros((x.shape[1], HIDDEN))
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g, before, c, h_before = kept[t]
            dh, tc = dh + dh_all[t], np.tanh(c)
            dc = dc + dh * o * (1 - tc * tc)
            gates = np.hstack([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)])
            grads[d + "x"] += x[t].T @ gates
            grads[d + "h"] += h_before.T @ gates
            grads[d + "c"] += gates.sum(0)
            dh, dc = gates @ self.w[d + "h"].T, dc * f

    @staticmethod
    def _batch(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Padded vectors, forward and each page reversed, and which steps are real."""
        steps = max(map(len, pages))
        x, y, real = np.zeros((steps, len(pages), WIDTH)), np.zeros((steps, len(pages), WIDTH)), np.zeros((steps, len(pages)), bool)
        for n, page in enumerate(pages):
            x[:len(page), n], y[:len(page), n], real[:len(page), n] = page, page[::-1], True
        return x, y, real

    @staticmethod
    def _turned(values: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Each page's real steps in reverse."""
        out, lengths = np.zeros_like(values), real.sum(0)
        for n, length in enumerate(lengths):
            out[:length, n] = values[:length, n][::-1]
        return out

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        if not self.trained:
            return [np.zeros(len(p)) for p in pages]
        x, y, real = self._batch(pages)
        both = np.concatenate([self._run(x, "f")[0], self._turned(self._run(y, "b")[0], real)], axis=2)
        p = _sigmoid(both @ self.w["o"] + self.w["p"])
        return [p[:len(page), n] for n, page in enumerate(pages)]

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, batch: int = 32) -> None:
        """Adam on the log loss of all blocks, pages of similar length together; deterministic."""
        m, s = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        order, count, r = sorted(range(len(pages)), key=lambda n: len(pages[n])), 0, random.Random(5)
        groups = [order[at:at + batch] for at in range(0, len(order), batch)]
        for _ in range(epochs):
            r.shuffle(groups)
            for group in groups:
                x, y, real = self._batch([pages[n] for n in group])
                target = np.zeros(real.shape)
                for k, n in enumerate(group):
                    target[:len(labels[n]), k] = labels[n]
                (hf, kf), (hb, kb) = self._run(x, "f"), self._run(y, "b")
                both = np.concatenate([hf, self._turned(hb, real)], axis=2)
                slope = (_sigmoid(both @ self.w["o"] + self.w["p"]) - target) * real / real.sum()
                grads = {k: np.zeros_like(v) for k, v in self.w.items()}
                grads["o"], grads["p"] = np.einsum("tnh,tn->h", both, slope), np.array([slope.sum()])
                d_both = slope[:, :, None] * self.w["o"]
                self._back(x, "f", kf, d_both[:, :, :HIDDEN], grads)
                self._back(y, "b", kb, self._turned(d_both[:, :, HIDDEN:], real), grads)
                count += 1
                for k, g in grads.items():
                    g = np.clip(g, -1, 1)
                    m[k], s[k] = 0.9 * m[k] + 0.1 * g, 0.999 * s[k] + 0.001 * g * g
                    self.w[k] -= RATE * (m[k] / (1 - 0.9**count)) / (np.sqrt(s[k] / (1 - 0.999**count)) + 1e-8)
        self.trained = True


def weak_label(names: list[str]) -> int:
    """1 where the path says article and nothing on it says otherwise."""
    known = {n for c in OTHER for n in re.findall("[a-z]+", c)} - {"div", "li", "ul", "section", "banner", "form"} | {"form"}
    return int(any(n in ("article", "main") for n in names) and not known & set(names))


def _container(name: str) -> list[str]:
    return re.findall("[a-z]+", name)


def laid_out_anew(blocks: list[Block], labels: list[int], r: random.Random) -> tuple[list[Block], list[int]]:
    """The texts of a page in other containers: an article among other blocks."""
    texts = [b for b, label in zip(blocks, labels) if label] or blocks
    article, inner = r.choice(ARTICLE), r.choice([[], ["div"], ["section"], ["div", "content"]])
    if r.random() < 0.25:  # a name that says nothing
        article, inner = "div." + "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=8)), r.choice([[], ["div"]])
    elif article in ("section", "div"):  # such a container alone means nothing; the article then lies in a main element
        inner = [*inner, "main"]

    def other(where: list[str]) -> list[tuple[Block, int]]:
        path = [*where, *_container(r.choice(OTHER)), *r.choice([[], ["div"], ["ul", "li"], ["p"]])]
        several = r.randint(1, 6) if path[-1] == "li" else r.choice([1, 1, 2, 3])
        found = []
        for _ in range(several):
            words = r.choice(blocks)[1].split()
            cut = " ".join(words[:r.choice([1, 2, 4, 8, 16, 40])])
            found.append(((path, cut, 1.0 if path[-1] == "li" and r.random() < 0.8 else 0.0), 0))
        return found

    out: list[tuple[Block, int]] = []
    for _ in range(r.randint(1, 4)):
        out += other([])
    for _, text, _ in texts:
        if r.random() < 0.15:  # an article has short blocks as well
            text = " ".join(text.split()[:r.choice([1, 2, 4])])
        tag = r.choice(["p", "p", "p", "p", "h1", "h2", "h3", "li", "blockquote", "td", "pre"])
        out.append((([*_container(article), *inner, *{"li": ["ul", "li"], "td": ["table", "tr", "td"]}.get(tag, [tag])], text, 0.0), 1))
        if r.random() < 0.15:
            out += other([*_container(article), *inner])
    for _ in range(r.randint(1, 4)):
        out += other([])
    return [b for b, _ in out], [label for _, label in out]


def fit(pages: DataFrame, most: int = FIT_PAGES) -> Labeller:
    """Train on at most ``most`` rows."""
    found = bounded_sample(pages.select("page_id", "html").where("page_id is not null and html is not null"), most, "page_id", "html").toPandas()
    x, y, r = [], [], random.Random(11)
    for value in found.sort_values(["page_id", "html"]).html:
        blocks = blocks_of(value)
        if not blocks:
            continue
        labels = [weak_label(names) for names, _, _ in blocks]
        known = [(blocks, labels)] if any(labels) else []
        for b, labelled in known + [laid_out_anew(blocks, labels, r) for _ in range(LAYOUTS)]:
            for at in range(0, len(b), STRETCH):
                x.append(np.stack([vector(block) for block in b[at:at + STRETCH]]))
                y.append(np.array(labelled[at:at + STRETCH], float))
    model = Labeller()
    if x:
        model.train(x, y)
    return model


def extract(pages: DataFrame, model: Labeller | None = None, batch: int = 64) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` and ``n_blocks`` of every page."""
    model = model or fit(pages)
    key_type = dict(pages.dtypes)["page_id"]

    def main_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at:at + batch]
                found = [blocks_of(value or "") for value in part.html]
                order = sorted((n for n, b in enumerate(found) if b), key=lambda n: len(found[n]))
                texts = [""] * len(found)
                for low in range(0, len(order), 16):  # pages of similar length
                    group = order[low:low + 16]
                    for n, p in zip(group, model.probabilities([np.stack([vector(b) for b in found[n]]) for n in group])):
                        texts[n] = " ".join(text for (_, text, _), share in zip(found[n], p) if share > 0.5)
                yield pd.DataFrame({"page_id": part.page_id, "url": part.url, "text": texts, "n_chars": [len(t) for t in texts],
                                    "n_blocks": [len(b) for b in found]})

    # the key as text and back: a column of numbers with nulls would reach pandas as floating point
    return pages.select(F.col("page_id").cast("string"), "url", "html").mapInPandas(
        main_texts, "page_id string, url string, text string, n_chars bigint, n_blocks int").withColumn("page_id", F.col("page_id").cast(key_type))

"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks (``page_blocks``). Every block is described by the average of
learned vectors of its path's words (element names, classes, ids), the average of learned
vectors of its hashed words, and a few numbers (length, share of links, marks, place). A
bidirectional LSTM reads the blocks of a page in order, so a block is judged by all of the
page, and a logistic unit on both directions' states says whether it is main text. The
blocks so labelled, in page order and joined by line ends, are the page's text.

The labeller is trained in numpy on a bounded sample of pages: as they are, where an
``article`` or ``main`` element says what the main text is, and dealt anew into made layouts
(menus, notices, adverts, side columns, forms, reader comments, inside and outside the main
text, with and without telling names). Pages are then labelled in Arrow batches, those of
similar length together.

Cases: a null or empty page, or one without text, gives an empty text and no characters;
rows stay as they are, also repeated ones and those without an id or url. The labeller of
an empty table is trained on invented words. Extra columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import words as W
from riskframe.llm.frames import least_hashed, quoted
from riskframe.llm.page_blocks import Blocks, page_blocks

PATH_BUCKETS = 4096
WORD_BUCKETS = 4096
PATH_WIDTH = 24
WORD_WIDTH = 8
NUMBERS = 8
HIDDEN = 24
WIDTH = PATH_WIDTH + WORD_WIDTH + NUMBERS
MAX_PAGES = 300
MAX_LENGTH = 200_000  # characters; longer pages are labelled like any, but not learned from
MADE = 3  # made layouts per sampled page
EPOCHS = 10
AT_ONCE = 1 << 15  # blocks of the pages that are labelled together

# Element and class words by which the made layouts name their parts.
MAIN_NAMES = "content post entry article-body story main-content post-content entry-content text body article page-content".split()
PLAIN_NAMES = "wrapper container row col inner outer box group section block left right grid wrap layout site page".split()
MENU_NAMES = "nav navbar menu navigation main-menu top-nav links breadcrumb breadcrumbs pagination pager tabs toc".split()
HEAD_NAMES = "header site-header masthead topbar page-header branding top".split()
FOOT_NAMES = "footer site-footer page-footer colophon copyright bottom legal footer-links".split()
SIDE_NAMES = "sidebar side widget rail related related-posts recommended secondary aside popular trending more-stories tags".split()
NOTICE_NAMES = "cookie-notice cookie-banner consent gdpr notice alert banner-message announcement popup modal warning privacy-notice".split()
AD_NAMES = "ad ads advert advertisement ad-slot sponsored promo banner sponsor adbox ad-container dfp promotion".split()
COMMENT_NAMES = "comments comment-list comment-section responses replies discussion reader-comments disqus user-comments".split()
FORM_NAMES = "newsletter subscribe search-form login signup contact-form search comment-form subscription".split()
SHARE_NAMES = "share social share-buttons social-links share-bar follow".split()
SHORT = (
    "Home|About|Contact|Login|Sign in|Register|News|Sport|Blog|Archive|Help|Search|Menu|Next|Previous|Share|Tweet|Print|"
    "Email|Reply|Report|Like|Follow us|Read more|Top|Sitemap|Privacy|Terms|Inicio|Startseite|Accueil|Kontakt|Suche|Menú"
).split("|")


def bucket(word: str, most: int) -> int:
    data = np.frombuffer(word.encode() or b"\0", np.uint8)
    return int(W.hash_words(data, np.zeros(1, np.int64), np.array([len(data)]))[0] % np.uint64(most))


# ---- features


class Features:
    """Blocks of some pages as index lists and numbers; path words are looked up once."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def path(self, words: tuple[str, ...]) -> list[int]:
        for w in words:
            if w not in self.known:
                self.known[w] = bucket(w, PATH_BUCKETS)
        return [self.known[w] for w in words]

    def of(self, pages: list[Blocks]) -> tuple:
        """(path ids, path of each block, word ids, block of each word, numbers, blocks per page)."""
        unique: dict[tuple, int] = {}
        which = np.array([unique.setdefault(p, len(unique)) for page in pages for p in page.paths], np.int64)
        path_ids = [self.path(p) for p in unique]
        texts = pa.array([t for page in pages for t in page.texts], pa.large_string())
        n = len(texts)
        ids, rows, first = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        numbers = np.zeros((n, NUMBERS), np.float32)
        for block in W.blocks(texts):
            lowered = W.Block(block.first, W.LOWER[block.data], block.offsets)
            found = W.words(lowered, ~W.SPACE)
            ids.append((W.hash_words(lowered.data, found.start, found.end) % np.uint64(WORD_BUCKETS)).astype(np.int64))
            rows.append(found.row + block.first)
            kind = _KIND[block.data]
            share = np.stack([np.add.reduceat(kind == k, block.offsets[:-1]) for k in (1, 2, 3)], axis=1)
            own = slice(block.first, block.first + block.n)
            numbers[own, 1:4] = share / np.diff(block.offsets)[:, None]
            numbers[own, 4] = np.log1p(np.bincount(found.row, minlength=block.n)) / 5
        length = np.array([len(t) for page in pages for t in page.texts], np.float32)
        linked = np.array([x for page in pages for x in page.linked], np.float32)
        per_page = np.array([len(p.texts) for p in pages], np.int64)
        heads = np.repeat(np.cumsum(per_page) - per_page, per_page)
        numbers[:, 0] = np.log1p(length) / 8
        numbers[:, 5] = linked / np.maximum(length, 1)
        numbers[:, 6] = (np.arange(n) - heads) / np.maximum(np.repeat(per_page, per_page), 1)
        numbers[1:, 7] = (which[1:] == which[:-1]) & (heads[1:] == heads[:-1])
        return path_ids, which, np.concatenate(ids), np.concatenate(rows), numbers, per_page


_KIND = np.zeros(256, np.int8)
_KIND[0x21:0x30] = _KIND[0x3A:0x41] = _KIND[0x5B:0x61] = _KIND[0x7B:0x7F] = 1  # marks
_KIND[0x30:0x3A] = 2  # digits
_KIND[0x41:0x5B] = 3  # capitals


def _averages(table: np.ndarray, ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The average vector of each row's ids; zeros for a row without any. Rows do not fall."""
    out = np.zeros((n, table.shape[1]), table.dtype)
    if len(ids):
        heads = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        # summed in pieces, so that the looked up vectors stay small
        edges = [*range(0, len(heads), 4096), len(heads)]
        for a, b in zip(edges[:-1], edges[1:]):
            s, e = heads[a], heads[b] if b < len(heads) else len(ids)
            out[rows[heads[a:b]]] = np.add.reduceat(table[ids[s:e]], heads[a:b] - s)
        out /= np.maximum(np.bincount(rows, minlength=n), 1)[:, None].astype(table.dtype)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


# ---- the labeller


class Labeller:
    """Learned tables, two LSTMs and a logistic unit, as arrays by name."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls, seed: int) -> Labeller:
        rng = np.random.default_rng(seed)
        normal = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        w = {"path": normal(0.3, PATH_BUCKETS, PATH_WIDTH), "word": normal(0.1, WORD_BUCKETS, WORD_WIDTH)}
        for d in ("f", "b"):
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1.0  # forget gates begin open
            w |= {
                f"in_{d}": normal(WIDTH**-0.5, WIDTH, 4 * HIDDEN),
                f"rec_{d}": normal(HIDDEN**-0.5, HIDDEN, 4 * HIDDEN),
                f"bias_{d}": bias,
                f"out_{d}": normal(0.1, HIDDEN),
            }
        w["direct"], w["bias"] = normal(0.1, WIDTH), np.zeros(1, np.float32)
        return cls(w)

    def vectors(self, features: tuple, keep_words: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """A vector for each block, and the average path vector of each distinct path."""
        path_ids, which, word_ids, word_rows, numbers, _ = features
        flat = np.array([i for p in path_ids for i in p], np.int64)
        rows = np.repeat(np.arange(len(path_ids)), [len(p) for p in path_ids])
        paths = _averages(self.w["path"], flat, rows, len(path_ids))
        words = _averages(self.w["word"], word_ids, word_rows, len(which))
        if keep_words is not None:
            words *= keep_words[:, None]
        return np.concatenate((paths[which], words, numbers), axis=1), paths

    def _step(self, d: str, gates: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple:
        gates = gates + h @ self.w[f"rec_{d}"]
        held = _sigmoid(gates[:, : 3 * HIDDEN])
        new = np.tanh(gates[:, 3 * HIDDEN :])
        i, f, o = held[:, :HIDDEN], held[:, HIDDEN : 2 * HIDDEN], held[:, 2 * HIDDEN :]
        c = f * c + i * new
        top = np.tanh(c)
        return o * top, c, (i, f, o, new, top)

    def logits(self, x: np.ndarray, per_page: np.ndarray) -> np.ndarray:
        """A logit for each block of pages given one after another; memory follows one chunk of steps."""
        out = x @ self.w["direct"] + self.w["bias"][0]
        heads = np.cumsum(per_page) - per_page
        pages = np.flatnonzero(per_page)
        pages = pages[np.argsort(-per_page[pages], kind="stable")]
        n, head = per_page[pages], heads[pages]
        for d, sign in (("f", 1), ("b", -1)):
            h = np.zeros((len(pages), HIDDEN), np.float32)
            c = np.zeros_like(h)
            first = head if sign == 1 else head + n - 1
            for t in range(int(n.max(initial=0))):
                live = int(np.searchsorted(-n, -t, "left"))  # pages are in order of falling length
                rows = first[:live] + sign * t
                gates = x[rows] @ self.w[f"in_{d}"] + self.w[f"bias_{d}"]
                h, c, _ = self._step(d, gates, h[:live], c[:live])
                out[rows] += h @ self.w[f"out_{d}"]
        return out

    def main_blocks(self, pages: list[Blocks], features: Features) -> list[np.ndarray]:
        """For each page, which of its blocks are main text."""
        if not any(p.texts for p in pages):
            return [np.zeros(0, bool) for _ in pages]
        described = features.of(pages)
        x, _ = self.vectors(described)
        return np.split(self.logits(x, described[5]) > 0, np.cumsum(described[5])[:-1])

    # ---- training

    def gradients(self, features: tuple, labels: np.ndarray, keep_words: np.ndarray) -> tuple[float, dict]:
        """The mean loss of a batch of pages, and its slope by every weight."""
        path_ids, which, word_ids, word_rows, _, per_page = features
        x, _ = self.vectors(features, keep_words)
        n_pages, longest = len(per_page), int(per_page.max())
        heads = np.cumsum(per_page) - per_page
        step = np.arange(longest)
        live = step[:, None] < per_page  # (steps, pages)
        logits = x @ self.w["direct"] + self.w["bias"][0]
        runs = {}
        for d in ("f", "b"):
            place = np.where(live, heads + (step[:, None] if d == "f" else per_page - 1 - step[:, None]), 0)
            gates = x[place] @ self.w[f"in_{d}"] + self.w[f"bias_{d}"]
            h, c = np.zeros((n_pages, HIDDEN), np.float32), np.zeros((n_pages, HIDDEN), np.float32)
            kept = []
            for t in range(longest):
                new_h, new_c, inner = self._step(d, gates[t], h, c)
                kept.append((h, c, inner))
                on = live[t][:, None]
                h, c = np.where(on, new_h, h), np.where(on, new_c, c)
                logits[place[t][live[t]]] += new_h[live[t]] @ self.w[f"out_{d}"]
            runs[d] = (place, kept)
        p = _sigmoid(logits)
        loss = float(-np.mean(np.where(labels == 1, np.log(p + 1e-9), np.log(1 - p + 1e-9))))
        slope = ((p - labels) / len(labels)).astype(np.float32)

        out = {k: np.zeros_like(v) for k, v in self.w.items()}
        out["direct"], out["bias"][0] = x.T @ slope, slope.sum()
        by_x = slope[:, None] * self.w["direct"]
        for d, (place, kept) in runs.items():
            by_h = np.zeros((n_pages, HIDDEN), np.float32)
            by_c = np.zeros_like(by_h)
            for t in range(longest - 1, -1, -1):
                h, c, (i, f, o, new, top) = kept[t]
                on = live[t][:, None].astype(np.float32)
                own = slope[place[t]][:, None] * on
                out[f"out_{d}"] += ((o * top) * own).sum(axis=0)
                here = by_h * on + own * self.w[f"out_{d}"]
                inner = here * o * (1 - top * top) + by_c * on
                gate = np.concatenate(
                    (inner * new * i * (1 - i), inner * c * f * (1 - f), here * top * o * (1 - o), inner * i * (1 - new * new)), axis=1
                )
                out[f"rec_{d}"] += h.T @ gate
                out[f"bias_{d}"] += gate.sum(axis=0)
                rows = place[t][live[t]]
                out[f"in_{d}"] += x[rows].T @ gate[live[t]]
                by_x[rows] += gate[live[t]] @ self.w[f"in_{d}"].T
                by_h = by_h * (1 - on) + gate @ self.w[f"rec_{d}"].T
                by_c = by_c * (1 - on) + inner * f
        lengths = np.array([len(p) for p in path_ids])
        by_path = np.zeros((len(path_ids), PATH_WIDTH), np.float32)
        np.add.at(by_path, which, by_x[:, :PATH_WIDTH])
        flat = np.array([i for p in path_ids for i in p], np.int64)
        np.add.at(out["path"], flat, np.repeat(by_path / np.maximum(lengths, 1)[:, None], lengths, axis=0))
        n_words = np.maximum(np.bincount(word_rows, minlength=len(which)), 1)
        by_word = by_x[:, PATH_WIDTH : PATH_WIDTH + WORD_WIDTH] * (keep_words / n_words)[:, None]
        np.add.at(out["word"], word_ids, by_word[word_rows].astype(np.float32))
        return loss, out


def train(pages: list[tuple[Blocks, np.ndarray]], epochs: int = EPOCHS, seed: int = 1, rate: float = 0.01) -> Labeller:
    """Adam over batches of pages of similar length; words are left out of half the blocks."""
    labeller, features = Labeller.fresh(seed), Features()
    rng = np.random.default_rng(seed)
    pages = sorted((p for p in pages if len(p[0].texts)), key=lambda p: len(p[0].texts))
    batches = [pages[i : i + 16] for i in range(0, len(pages), 16)]
    made = [(features.of([p for p, _ in b]), np.concatenate([y for _, y in b]).astype(np.float32)) for b in batches]
    first = {k: np.zeros_like(v) for k, v in labeller.w.items()}
    second = {k: np.zeros_like(v) for k, v in labeller.w.items()}
    t = 0
    for epoch in range(epochs):
        for k in rng.permutation(len(made)):
            described, labels = made[k]
            keep = (rng.random(len(labels)) < 0.5).astype(np.float32)
            _, slopes = labeller.gradients(described, labels, keep)
            size = np.sqrt(sum(float((g * g).sum()) for g in slopes.values()))
            t += 1
            now = rate * min(1.0, 2.0 * (1 - epoch / epochs))
            for name, g in slopes.items():
                g = g * np.float32(min(1.0, 1.0 / (size + 1e-9)))
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                step = (first[name] / (1 - 0.9**t)) / (np.sqrt(second[name] / (1 - 0.99**t)) + 1e-6)
                labeller.w[name] -= (now * step).astype(np.float32)
    return labeller


# ---- pages to learn from

_AWAY = frozenset("nav aside header footer form menu button".split())


def marked_main(blocks: Blocks) -> np.ndarray | None:
    """Labels by a page's own ``article`` or ``main`` element; None if it has neither."""
    inside = [{"article", "main"} & set(p) and not (_AWAY | _TELLING) & set(p) for p in blocks.paths]
    return np.array(inside, bool) if any(inside) else None


_TELLING = frozenset(
    "." + part
    for name in [*MENU_NAMES, *FOOT_NAMES, *SIDE_NAMES, *NOTICE_NAMES, *AD_NAMES, *COMMENT_NAMES, *FORM_NAMES, *SHARE_NAMES]
    for part in name.split("-")
    if part not in ("main", "top", "more", "bottom", "message", "page", "text", "body", "container")
)


class Layout:
    """A made page: pieces of markup, and the label of every block in them, in order."""

    def __init__(self, rng: random.Random, long: list[str], short: list[str]):
        self.rng, self.long, self.short = rng, long, short
        self.html: list[str] = []
        self.labels: list[int] = []

    def block(self, tag: str, text: str, label: int, closed: bool = True, attributes: str = "") -> None:
        text = text.replace("&", "&amp;").replace("<", "&lt;")
        if not text.split():
            return
        if label and self.rng.random() < 0.15 and tag == "p":
            text = self.rng.choice(["<b>{}", "{}<br>", "<b>{}<br>", "<em>{}</em>", "<a href='/x'>{}</a>"]).format(text)
        self.html.append(f"<{tag}{attributes}>{text}" + (f"</{tag}>" if closed else ""))
        self.labels.append(label)

    def named(self, names: list[str], tags: list[str], telling: float = 0.9) -> tuple[str, str]:
        """An element's start and end, named after its part or after nothing."""
        rng = self.rng
        tag, key = rng.choice(tags), rng.choice(["class", "class", "id"])
        if tag in ("div", "section", "ul", "p") or rng.random() < 0.4:
            name = rng.choice(names) if rng.random() < telling else rng.choice(PLAIN_NAMES)
            if rng.random() < 0.3:
                name += " " + rng.choice(PLAIN_NAMES) + rng.choice(["", "-1", "_2", "12"])
            return f'<{tag} {key}="{name}">', f"</{tag}>"
        return f"<{tag}>", f"</{tag}>"

    def part(self, names: list[str], tags: list[str], fill, telling: float = 0.9) -> None:
        start, end = self.named(names, tags, telling)
        self.html.append(start)
        fill()
        self.html.append(end)

    def one(self, texts: list[str]) -> str:
        return self.rng.choice(texts)

    def links(self, low: int = 3, high: int = 8) -> None:
        rng, as_list = self.rng, self.rng.random() < 0.75
        self.html.append("<ul>" if as_list else "")
        for _ in range(rng.randint(low, high)):
            text = self.one(self.short).replace("&", "&amp;").replace("<", "&lt;")
            tag = "li" if as_list else rng.choice(["p", "div"])
            if not text.split():
                continue
            self.html.append(f"<{tag}><a href='/x'>{text}</a></{tag}>")
            self.labels.append(0)
        self.html.append("</ul>" if as_list else "")

    def menu(self) -> None:
        self.part(MENU_NAMES, ["nav", "nav", "div", "ul"], self.links)

    def head(self) -> None:
        def fill():
            self.block(self.rng.choice(["div", "h1", "p"]), self.one(self.short), 0)
            if self.rng.random() < 0.5:
                self.block("p", self.one(self.short), 0)
            if self.rng.random() < 0.4:
                self.menu()

        self.part(HEAD_NAMES, ["header", "div"], fill)

    def foot(self) -> None:
        def fill():
            if self.rng.random() < 0.4:
                self.links()
            bare = self.rng.random() < 0.5
            text = self.rng.choice(["©", "(c)", "Copyright"]) + " " + self.one(self.short + self.long)
            if bare:
                self.html.append("<hr>" + text.replace("&", "&amp;").replace("<", "&lt;") + "<hr>")
                self.labels.append(0)
            else:
                self.block("p", text, 0)

        self.part(FOOT_NAMES, ["footer", "footer", "div"], fill, 0.95)

    def passages(self, names: list[str], tags: list[str], low: int = 1, high: int = 3) -> None:
        def fill():
            bare = self.rng.random() < 0.5
            if bare:
                self.html.append("<!-- x -->" + self.one(self.long).replace("&", "&amp;").replace("<", "&lt;"))
                self.labels.append(0)
                return
            for _ in range(self.rng.randint(low, high)):
                self.block(self.rng.choice(["p", "div", "h3", "li"]), self.one(self.long + self.short), 0)

        self.part(names, tags, fill, 0.97)

    def advert(self) -> None:
        self.passages(AD_NAMES, ["div", "div", "div", "aside", "section"])

    def notice(self) -> None:
        self.passages(NOTICE_NAMES, ["div", "div", "section", "aside"])

    def side(self) -> None:
        def fill():
            for _ in range(self.rng.randint(1, 3)):
                self.block(self.rng.choice(["h2", "h3", "h4"]), self.one(self.short), 0)
                if self.rng.random() < 0.6:
                    self.links()
                else:
                    self.block("p", self.one(self.long), 0)

        self.part(SIDE_NAMES, ["aside", "aside", "div", "section"], fill, 0.95)

    def form(self) -> None:
        def fill():
            for _ in range(self.rng.randint(1, 3)):
                self.block(self.rng.choice(["label", "p", "legend", "h3", "button", "div"]), self.one(self.short + self.long[:3]), 0)
            self.html.append("<input type='text'>")

        self.part(FORM_NAMES, ["form"], fill, 0.6)

    def share(self) -> None:
        self.part(SHARE_NAMES, ["div", "ul", "section"], lambda: self.links(2, 4), 0.95)

    def comments(self) -> None:
        rng = self.rng

        def fill():
            if rng.random() < 0.7:
                self.block(rng.choice(["h2", "h3", "h4"]), rng.choice(["Comments", "3 comments", "Responses", "Discussion", "Kommentare"]), 0)
            for _ in range(rng.randint(1, 6)):
                start, end = self.named(["comment", "reply", "comment-body", "response"], ["div", "li", "article", "p", "div"])
                if start.startswith("<p"):
                    self.html.append(start)
                    self.html.append(self.one(self.long).replace("&", "&amp;").replace("<", "&lt;") + "</p>")
                    self.labels.append(0)
                    continue
                self.html.append(start)
                if rng.random() < 0.5:
                    self.block("div", self.one(self.short), 0, attributes=rng.choice(["", ' class="author"', ' class="meta"']))
                self.block(rng.choice(["p", "p", "div"]), self.one(self.long), 0)
                if rng.random() < 0.3:
                    self.html.append("<div><a href='/r'>Reply</a></div>")
                    self.labels.append(0)
                self.html.append(end)

        self.part(COMMENT_NAMES, ["section", "div", "ol", "ul"], fill, 0.97)

    def main(self, body: list[str]) -> None:
        rng = self.rng

        def fill():
            if rng.random() < 0.85:
                self.block("h1", self.one(self.short + body[:1])[:80], 1)
            for text in body:
                kind = rng.random()
                if kind < 0.8:
                    self.block("p", text, 1, closed=rng.random() < 0.85)
                elif kind < 0.85:
                    self.block(rng.choice(["h2", "h3"]), text[:60], 1)
                elif kind < 0.9:
                    self.html.append("<ul>")
                    for piece in [text[:80], text[80:160]]:
                        self.block("li", piece, 1)
                    self.html.append("</ul>")
                elif kind < 0.94:
                    self.part(["quote"], ["blockquote"], lambda text=text: self.block("p", text, 1))
                elif kind < 0.97:
                    self.block(rng.choice(["pre", "div", "figcaption", "dd"]), text, 1)
                else:
                    self.html.append("<table><tr>")
                    for piece in [text[:40], text[40:80]]:
                        self.block("td", piece, 1)
                    self.html.append("</tr></table>")
                if rng.random() < 0.06:
                    rng.choice([self.advert, self.share, self.side, self.form, self.notice])()
            if rng.random() < 0.35:
                rng.choice([self.comments, self.share, self.comments, self.advert, self.side])()

        kind = rng.random()
        if kind < 0.45:
            self.part(MAIN_NAMES, ["article"], fill)
        elif kind < 0.6:
            self.part(MAIN_NAMES, ["main"], fill)
        elif kind < 0.75:
            self.html.append("<main>")
            self.part(MAIN_NAMES, ["article", "section", "div"], fill)
            self.html.append("</main>")
        else:
            self.part(MAIN_NAMES, ["div", "section"], fill)

    def page(self, body: list[str]) -> tuple[Blocks, np.ndarray]:
        rng = self.rng
        wraps = [self.named(PLAIN_NAMES, ["div"]) for _ in range(rng.choice([0, 0, 0, 1, 2]))]
        self.html.append("<html><head><title>x</title></head><body>" + "".join(s for s, _ in wraps))
        before = [self.menu] * (rng.random() < 0.8) + [self.head] * (rng.random() < 0.5)
        before += [self.advert] * (rng.random() < 0.5) + [self.notice] * (rng.random() < 0.3) + [self.side] * (rng.random() < 0.2)
        after = [self.comments] * (rng.random() < 0.35) + [self.side] * (rng.random() < 0.35) + [self.advert] * (rng.random() < 0.3)
        after += [self.form] * (rng.random() < 0.2) + [self.share] * (rng.random() < 0.2) + [self.notice] * (rng.random() < 0.15)
        rng.shuffle(before)
        rng.shuffle(after)
        for part in before:
            part()
        self.main(body)
        for part in [*after, *[self.foot] * (rng.random() < 0.85)]:
            part()
        self.html.append("".join(e for _, e in reversed(wraps)) + "</body></html>")
        return page_blocks("".join(self.html)), np.array(self.labels, bool)


def training_pages(pages: list[str], seed: int = 1, made: int = MADE) -> list[tuple[Blocks, np.ndarray]]:
    """The pages that mark their main text, and made layouts filled with the pages' blocks."""
    rng = random.Random(seed)
    cut = [page_blocks(p) for p in pages]
    texts = sorted({t for b in cut for t in b.texts})
    rng.shuffle(texts)
    words = [" ".join(rng.choices("alo vent mira sul tas eno par kli dor um ria".split(), k=rng.randint(1, 40))) for _ in range(60)]
    long = [t[:600] for t in texts if len(t) > 60][:3000] + words
    short = [t for t in texts if len(t) <= 60][:1000] + SHORT + [w[:30] for w in words]
    out = [(b, y) for b in cut if (y := marked_main(b)) is not None]
    for _ in range(max(made * len(pages), 300)):
        body = rng.choices(long + short[:50], k=min(60, 1 + int(rng.expovariate(1 / 8))))
        blocks, labels = Layout(rng, long, short).page(body)
        if len(blocks.texts) == len(labels):
            out.append((blocks, labels))
    return out


# ---- on tables


def fit(
    pages: DataFrame, page_id: str = "page_id", html: str = "html", max_pages: int = MAX_PAGES, max_length: int = MAX_LENGTH
) -> Labeller:
    """A labeller trained on at most ``max_pages`` pages, those of least hash of id and markup."""
    read = pages.select(F.col(quoted(page_id)).alias("page_id"), F.col(quoted(html)).alias("html"))
    short = read.filter(F.length("html") <= max_length)
    chosen = least_hashed(short.select("html", F.xxhash64("page_id", "html").alias("digest")), ["digest"], max_pages)
    return train(training_pages(sorted(r.html for r in chosen.select("html").collect())))


def extract(
    pages: DataFrame, labeller: Labeller, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    weights = pages.sparkSession.sparkContext.broadcast(labeller.w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, features = Labeller(weights.value), Features()
        for batch in batches:
            for block in W.blocks(batch.column(2)):
                rows = batch.slice(block.first, block.n)
                texts: list[str] = []
                held: list[Blocks] = []
                for source in rows.column(2).to_pylist():
                    held.append(page_blocks((source or b"").decode()))
                    if sum(len(p.texts) for p in held) >= AT_ONCE:
                        texts += _joined(model, held, features)
                        held = []
                texts += _joined(model, held, features)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    read = pages.select(F.col(quoted(page_id)).cast("long").alias("page_id"), F.col(quoted(url)).cast("string").alias("url"), F.col(quoted(html)).cast("binary"))
    found = read.mapInArrow(run, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))


def _joined(model: Labeller, pages: list[Blocks], features: Features) -> list[str]:
    kept = model.main_blocks(pages, features) if pages else []
    return ["\n".join(t for t, main in zip(p.texts, k) if main) for p, k in zip(pages, kept)]

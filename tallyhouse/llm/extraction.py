"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks, the runs of text between block-level tags, each with the path of
tags, classes and ids above it. A bidirectional LSTM in numpy reads the blocks of a whole page in
order, each as the sum of learned vectors of its path's tokens, the mean of vectors of its hashed
words and a few measures, and labels every block as article or not from the context of the
whole document. The text of a page is the labelled blocks in page order.

Nobody labels the pages, so the training labels come from two places: a bounded sample of the
pages, where the markup itself says what a block is (inside ``article`` or ``main``, or inside
``nav``, ``footer``, an ``ad`` class and so on; blocks without such a sign have no say), and
pages composed at random from that sample's sentences with many kinds of menus, notices, adverts,
forms, sidebars and comments, whose labels are known. The model is small and broadcast.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.shared import column, runs, ship
from tallyhouse.llm.textarrays import hashed_words

SAMPLE = 300
COMPOSED = 1500
HIDDEN = 16
PATHS, WORDS = 2048, 512
PATH_SIZE, WORD_SIZE, MEASURES = 24, 6, 7
#: Blocks that the network reads at once, padding included, and characters of the longest page that trains it.
PADDED, LONGEST = 1 << 14, 200_000

# Elements of HTML by how they cut text.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li link main menu meta nav noscript "
    "ol optgroup option p pre section select summary table tbody td template textarea tfoot th thead title tr ul video audio".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
#: Drawings and markup that is not shown, passed over up to their end tag if there is one.
UNSEEN = frozenset("svg template".split())
#: Opening one of these ends an open element of the named kinds.
ENDS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
#: Elements inside which those ends apply.
FENCES = frozenset("ul ol dl table select article section div main aside nav body".split())
CLOSES_P = BLOCKS - frozenset("br button label option link meta title head".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?][^>]*+>?|</?[a-zA-Z][^>]*+\Z""", re.S)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)


@dataclass(slots=True)
class Block:
    path: tuple[str, ...]
    text: str
    linked: int  # characters inside links


def parse(page: str) -> list[Block]:
    """The leaf blocks with text of a whole page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []  # tag, its path token
    parts: list[str] = []
    linked, links, path, at, end = 0, 0, (), 0, len(page)

    def flush() -> None:
        nonlocal linked, path
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(path, text, linked))
            parts.clear()
        linked, path = 0, ()

    def say(a: int, b: int) -> None:
        nonlocal linked, path
        if b > a:
            if not parts:
                path = tuple(token for _, token in stack)
            parts.append(page[a:b])
            if links:
                linked += b - a

    def leave(position: int) -> None:
        nonlocal links
        for tag, _ in stack[position:]:
            links -= tag == "a"
        del stack[position:]

    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            say(at, end)
            break
        say(at, m.start())
        at, tag = m.end(), m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            flush()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    leave(k)
                    break
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag in VOID or (tag in ("svg", "math") and m[3].rstrip().endswith("/")):
            continue
        if tag in UNSEEN and (close := re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)):
            at = close.end()
            continue
        ended = ENDS.get(tag, ())
        if tag in CLOSES_P:
            ended = (*ended, "p")
        if ended:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ended:
                    leave(k)
                    break
                if stack[k][0] in FENCES:
                    break
        token, rest = tag, m[3]
        if "=" in rest:
            names = [f"{a.lower()}={v.strip(chr(34) + chr(39)).lower()}" for a, v in _NAMED.findall(rest)]
            if names:
                token = tag + " " + " ".join(names)
        links += tag == "a"
        stack.append((tag, token))
    flush()
    return out


# ---- signs in the markup ----------------------------------------------------------------

# What elements and the words of class names and ids usually hold.
ARTICLE = frozenset("article main".split())
ARTICLE_NAMES = frozenset("article post story entry articlebody".split())
OTHER = frozenset("nav footer aside form head title button select option textarea label menu noscript dialog".split())
OTHER_NAMES = frozenset(
    "ad ads advert advertisement adslot banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies copyright disqus "
    "footer gdpr header legal masthead menu modal nav navbar navigation newsletter notice notices paywall popup promo promoted recommended "
    "related replies reply search share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar trending widget".split()
)


@lru_cache(maxsize=20_000)
def token_words(token: str) -> tuple[str, tuple[str, ...]]:
    """An element's tag and the words of its class, id and role."""
    tag, _, names = token.partition(" ")
    return tag, tuple(w for w in re.split(r"[^a-z0-9]+", re.sub(r"\b(class|id|role|itemprop)=", "", names)) if w)


def sign(path: tuple[str, ...]) -> int | None:
    """1 inside an article, 0 inside something else, where "other" stays for all below it; None without a sign."""
    found = None
    for token in path:
        tag, names = token_words(token)
        inside = found == 1
        if tag in OTHER or any(n in OTHER_NAMES for n in names):
            found = 0
        elif tag == "header" and not inside:
            found = 0
        elif found is None and (tag in ARTICLE or any(n in ARTICLE_NAMES for n in names)):
            found = 1
    return found


@lru_cache(maxsize=50_000)
def path_features(path: tuple[str, ...]) -> tuple[int, ...]:
    """Hashed tokens of a path: every tag, every word of a name, and the last two tags together."""
    said: set[str] = set()
    tags = []
    for token in path:
        tag, names = token_words(token)
        tags.append(tag)
        said.add(tag)
        said.update("." + n for n in names)
    for token in path[-3:]:
        said.update("near " + n for n in token_words(token)[1])
    said.add("last " + " ".join(tags[-1:]))
    said.add("two " + " ".join(tags[-2:]))
    return tuple(sorted({zlib.crc32(s.encode()) % PATHS for s in said}))


# ---- pages composed at random -----------------------------------------------------------

_MARK = "\ue000"


def compose(rng: np.random.Generator, sentences: list[str]) -> str:
    """A page of random structure; article blocks begin with a private mark."""
    pick = lambda words: words[int(rng.integers(len(words)))]

    def words(low: int, high: int) -> str:
        said = " ".join(pick(sentences) for _ in range(1 + high // 20)).split()
        return html.escape(" ".join(said[: int(rng.integers(low, high + 1))]), quote=False) or "x"

    def wrap(tags: list[str], names: list[str], inside: str, bare: float = 0.0) -> str:
        tag, name = pick(tags), pick(names)
        if rng.random() < bare and tag not in ("div", "section", "ul", "ol", "p"):
            return f"<{tag}>{inside}</{tag}>"
        kind = pick(["class", "class", "id"])
        extra = pick(["", "", " box", " col", " wrap"]) if kind == "class" else ""
        return f'<{tag} {kind}="{name}{extra}">{inside}</{tag}>'

    def items(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{words(1, 4)}</a></li>' for _ in range(n)) + "</ul>"

    def para(mark: str = "", low: int = 3, high: int = 60) -> str:
        return f"<p>{mark}{words(low, high)}</p>"

    def menu() -> str:
        return wrap(["nav", "nav", "div", "ul"], ["menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topbar", "toolbar"], items(int(rng.integers(2, 8))), 0.7)

    def notice() -> str:
        return wrap(["div", "section", "dialog", "aside", "p"], ["notice", "cookie", "cookie-banner", "cookie-notice", "consent", "gdpr", "popup", "modal", "newsletter", "subscribe", "paywall", "site-notice"], pick([words(4, 40), para("", 4, 40), para("", 4, 30) + "<button>" + words(1, 2) + "</button>"]), 0.3)

    def advert() -> str:
        return wrap(["div", "div", "aside", "section", "p", "figure"], ["ad", "ads", "advert", "advertisement", "ad-slot", "banner", "promo", "promoted", "sponsored", "sponsor"], pick([words(2, 30), para("", 3, 40), "<a href='/x'>" + words(2, 15) + "</a>"]))

    def side() -> str:
        return wrap(["aside", "aside", "div", "section"], ["sidebar", "side-bar", "related", "widget", "recommended", "trending", "social", "share", "sharing"], f"<h3>{words(1, 4)}</h3>" + pick([items(int(rng.integers(2, 6))), para("", 3, 40), para() + para()]), 0.6)

    def form() -> str:
        inner = f"<label>{words(1, 3)}</label><input name='q'>" + pick(["", para("", 2, 20), f"<select><option>{words(1, 2)}</option><option>{words(1, 2)}</option></select>", "<textarea></textarea>"]) + f"<button>{words(1, 2)}</button>"
        return wrap(["form"], ["search", "signup", "contact", "login", "subscribe"], inner, 0.6)

    def comments() -> str:
        one = lambda: wrap(["div", "li", "article", "section", "p"], ["comment", "reply", "comment-body"], pick([para("", 2, 60), f"<b>{words(1, 2)}</b> {words(2, 50)}", para("", 1, 20) + para("", 2, 60)]))
        return wrap(["section", "div", "ol", "ul", "aside"], ["comments", "comment-list", "replies", "disqus", "comments-area", "user-comments"], pick(["", f"<h2>{words(1, 3)}</h2>", f"<h3>{words(1, 3)}</h3>"]) + "".join(one() for _ in range(int(rng.integers(1, 6)))))

    def footer() -> str:
        return wrap(["footer", "footer", "footer", "div"], ["footer", "site-footer", "copyright", "legal"], pick([f"&copy; {words(2, 25)}", para("", 2, 30), items(3) + para("", 2, 15)]), 0.8)

    def header() -> str:
        return wrap(["header", "header", "div"], ["header", "site-header", "masthead"], pick([words(1, 6), f"<h1>{words(1, 4)}</h1>", f"<a href='/'>{words(1, 3)}</a>" + menu(), f"<p>{words(2, 12)}</p>"]), 0.6)

    def body_text() -> str:
        made = []
        for _ in range(int(rng.integers(1, 9))):
            kind = rng.random()
            if kind < 0.62:
                made.append(para(_MARK, 1, pick([3, 15, 40, 90])))
            elif kind < 0.68:
                made.append(f"<p><b>{_MARK}{words(2, 40)}<br>")
            elif kind < 0.76:
                made.append(f"<h{(n := int(rng.integers(2, 5)))}>{_MARK}{words(1, 8)}</h{n}>")
            elif kind < 0.83:
                made.append("<ul>" + "".join(f"<li>{_MARK}{words(1, 20)}</li>" for _ in range(int(rng.integers(1, 5)))) + "</ul>")
            elif kind < 0.88:
                made.append(f"<blockquote>{pick([_MARK + words(3, 40), para(_MARK, 3, 40)])}</blockquote>")
            elif kind < 0.92:
                made.append("<table>" + "".join(f"<tr><td>{_MARK}{words(1, 6)}</td><td>{_MARK}{words(1, 6)}</td></tr>" for _ in range(2)) + "</table>")
            elif kind < 0.95:
                made.append(f"<figure><img src='x'><figcaption>{_MARK}{words(2, 15)}</figcaption></figure>")
            else:
                made.append(f"<pre>{_MARK}{words(2, 30)}</pre>")
            if rng.random() < 0.22:
                made.append(pick([advert, advert, side, notice, form])())
        return "".join(made)

    title = f"<h1>{_MARK}{words(2, 12)}</h1>"
    if rng.random() < 0.15:
        title = f"<header>{title}</header>"
    text = (title if rng.random() < 0.85 else "") + body_text()
    if rng.random() < 0.25:
        text += comments()
    kind = rng.random()
    if kind < 0.45:
        text = f"<article>{text}</article>"
    elif kind < 0.6:
        text = f"<main>{pick([text, f'<article>{text}</article>', f'<div>{text}</div>'])}</main>"
    elif kind < 0.92:
        text = wrap(["div", "section"], ["content", "article", "post", "post-body", "entry-content", "article-body", "story", "main-content", "text", "body", "page-content"], text)
    around = lambda kinds, p: "".join(k() for k in kinds if rng.random() < p)
    before = around([header, menu, notice, advert, form, side], 0.4)
    after = around([side, comments, advert, form, notice, footer], 0.45)
    page = before + text + after
    if rng.random() < 0.4:
        page = wrap(["div"], ["page", "wrapper", "container", "site", "root"], page)
    return f"<!DOCTYPE html><html><head><title>{words(2, 12)}</title><style>p{{}}</style><script>var a='<p>';</script></head><body>{page}</body></html>"


# ---- the network ------------------------------------------------------------------------


@dataclass
class Page:
    paths: list[tuple[int, ...]]
    words: np.ndarray  # hashed words of all blocks
    before: np.ndarray  # words before each block
    measures: np.ndarray
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    counted: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def __len__(self) -> int:
        return len(self.paths)


def featured(blocks_of: list[list[Block]]) -> list[Page]:
    """Pages as numbers; the words of all their blocks are hashed together."""
    texts = pa.array([b.text for blocks in blocks_of for b in blocks], pa.string())
    hashes, before = hashed_words(texts)
    hashes = (hashes % np.uint64(WORDS)).astype(np.int64)
    out, at = [], 0
    for blocks in blocks_of:
        n = len(blocks)
        span = before[at : at + n + 1]
        chars = np.array([len(b.text) for b in blocks], float)
        count = np.diff(span).astype(float) if n else np.zeros(0)
        measures = np.stack([
            np.log1p(chars) / 6, np.log1p(count) / 4, np.minimum(1, np.array([b.linked for b in blocks]) / np.maximum(chars, 1)) if n else chars,
            np.arange(n) / max(n, 1), (np.arange(n) + 1.0) / 20, np.array([b.text[-1] in ".!?…。" for b in blocks], float) if n else chars, np.ones(n),
        ], 1)
        out.append(Page([path_features(b.path) for b in blocks], hashes[span[0] : span[-1]] if n else hashes[:0], span - span[0], measures))
        at += n
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Bidirectional LSTM with embeddings below and a logistic output above."""

    def __init__(self, seed: int = 9):
        rng = np.random.Generator(np.random.Philox(seed))
        size, h = PATH_SIZE + WORD_SIZE + MEASURES, HIDDEN
        normal = lambda *shape, by=0.1: rng.normal(0, by, shape)
        self.p = {"paths": normal(PATHS, PATH_SIZE), "words": normal(WORDS, WORD_SIZE, by=0.02), "out": normal(2 * h + size), "bias": np.zeros(1)}
        for side in "fb":
            self.p |= {f"{side}_x": normal(size, 4 * h, by=0.2), f"{side}_h": normal(h, 4 * h, by=0.2), f"{side}_b": np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])}

    def inputs(self, pages: list[Page], longest: int) -> tuple[np.ndarray, tuple]:
        """(pages, longest, size) and what the gradient of the embeddings needs."""
        x = np.zeros((len(pages), longest, PATH_SIZE + WORD_SIZE + MEASURES))
        rows = [(i * longest + t, p) for i, page in enumerate(pages) for t, p in enumerate(page.paths)]
        path_row = np.repeat([r for r, _ in rows], [len(p) for _, p in rows]).astype(np.int64)
        path_at = np.array([a for _, p in rows for a in p], np.int64)
        flat = x.reshape(-1, x.shape[2])
        counts = [np.diff(page.before) for page in pages]
        word_row = np.concatenate([np.repeat(i * longest + np.arange(len(c)), c) for i, c in enumerate(counts)])
        word_at = np.concatenate([page.words for page in pages])
        share = np.concatenate([np.repeat(1 / np.maximum(c, 1), c) for c in counts])
        _add_rows(flat[:, :PATH_SIZE], path_row, self.p["paths"], path_at, None)
        # Words by their numbers per block, so that no row per word and dimension is made.
        slot = np.bincount(word_row * WORDS + word_at, share, len(flat) * WORDS) if len(flat) * WORDS <= 8_000_000 else None
        if slot is not None:
            flat[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] = slot.reshape(len(flat), WORDS) @ self.p["words"]
        else:
            _add_rows(flat[:, PATH_SIZE : PATH_SIZE + WORD_SIZE], word_row, self.p["words"], word_at, share)
        for i, page in enumerate(pages):
            x[i, : len(page), PATH_SIZE + WORD_SIZE :] = page.measures
        return x, (path_row, path_at, word_row, word_at, share)

    def _run(self, side: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        h, c = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
        pre = x @ self.p[f"{side}_x"] + self.p[f"{side}_b"]
        out, kept = np.zeros((*x.shape[:2], HIDDEN)), []
        steps = range(x.shape[1]) if side == "f" else range(x.shape[1] - 1, -1, -1)
        for t in steps:
            gates = pre[:, t] + h @ self.p[f"{side}_h"]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g, m = np.tanh(gates[:, 3 * HIDDEN :]), mask[:, t, None]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            if keep:
                kept.append((t, h, c, i, f, o, g, tanh_c))
            c = np.where(m, new_c, c)
            h = np.where(m, o * tanh_c, h)
            out[:, t] = h
        return out, kept

    def forward(self, pages: list[Page], keep: bool = True):
        """Probabilities, and with ``keep`` what the gradient needs of every step."""
        longest = max(map(len, pages))
        x, kept = self.inputs(pages, longest)
        mask = np.arange(longest) < np.array([len(p) for p in pages])[:, None]
        f, f_kept = self._run("f", x, mask, keep)
        b, b_kept = self._run("b", x, mask, keep)
        joined = np.concatenate([f, b, x], 2)
        return _sigmoid(joined @ self.p["out"] + self.p["bias"]), (x, kept, mask, joined, f_kept, b_kept)

    def gradients(self, pages: list[Page]) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss of the counted blocks and its gradient, back through time."""
        probability, (x, (path_row, path_at, word_row, word_at, share), mask, joined, f_kept, b_kept) = self.forward(pages)
        y, w = np.zeros(probability.shape), np.zeros(probability.shape)
        for i, page in enumerate(pages):
            y[i, : len(page)], w[i, : len(page)] = page.labels, page.counted
        total = max(w.sum(), 1)
        loss = -(w * (y * np.log(probability + 1e-9) + (1 - y) * np.log(1 - probability + 1e-9))).sum() / total
        d = w * (probability - y) / total
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"], g["bias"] = np.einsum("bt,btk->k", d, joined), np.array([d.sum()])
        d_joined = d[:, :, None] * self.p["out"]
        d_x = d_joined[:, :, 2 * HIDDEN :].copy()
        for side, kept, part in (("f", f_kept, d_joined[:, :, :HIDDEN]), ("b", b_kept, d_joined[:, :, HIDDEN : 2 * HIDDEN])):
            d_h, d_c = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
            for t, h, c, i, f, o, gg, tanh_c in reversed(kept):
                m = mask[:, t, None]
                d_h = d_h + part[:, t]
                out, cell = np.where(m, d_h, 0), np.where(m, d_c, 0)
                cell = cell + out * o * (1 - tanh_c**2)
                gates = np.concatenate([cell * gg * i * (1 - i), cell * c * f * (1 - f), out * tanh_c * o * (1 - o), cell * i * (1 - gg**2)], 1)
                g[f"{side}_x"] += x[:, t].T @ gates
                g[f"{side}_h"] += h.T @ gates
                g[f"{side}_b"] += gates.sum(0)
                d_x[:, t] += gates @ self.p[f"{side}_x"].T
                d_h = np.where(m, gates @ self.p[f"{side}_h"].T, d_h)
                d_c = np.where(m, cell * f, d_c)
        flat = d_x.reshape(-1, d_x.shape[2])
        np.add.at(g["paths"], path_at, flat[path_row, :PATH_SIZE])
        np.add.at(g["words"], word_at, flat[word_row, PATH_SIZE : PATH_SIZE + WORD_SIZE] * share[:, None])
        return loss, g

    def train(self, pages: list[Page], epochs: int = 8, batch: int = 32, rate: float = 0.01, seed: int = 10) -> float:
        """Adam over batches of pages of similar length; the last epoch's mean loss."""
        rng = np.random.Generator(np.random.Philox(seed))
        pages = sorted((p for p in pages if len(p) and p.counted.any()), key=len)
        groups = [pages[k : k + batch] for k in range(0, len(pages), batch)]
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step, mean = 0, 0.0
        for epoch in range(epochs):
            losses = []
            for k in rng.permutation(len(groups)):
                loss, gradient = self.gradients(groups[k])
                losses.append(loss)
                step += 1
                speed = rate * (0.5 ** max(0, epoch - epochs // 2)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for name, value in gradient.items():
                    value = np.clip(value, -1, 1)
                    first[name] = 0.9 * first[name] + 0.1 * value
                    second[name] = 0.999 * second[name] + 0.001 * value * value
                    self.p[name] -= speed * first[name] / (np.sqrt(second[name]) + 1e-8)
            mean = float(np.mean(losses)) if losses else 0.0
        return mean

    def label(self, pages: list[Page], batch: int = 64) -> list[np.ndarray]:
        """Whether each block of each page is article text; pages of similar length are read together,
        as many as fit in ``PADDED`` blocks at the length of the longest."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            number = batch
            while number > 1 and number * len(pages[order[:number][-1]]) > PADDED:
                number //= 2
            own, order = order[:number], order[number:]
            probability, _ = self.forward([pages[k] for k in own], keep=False)
            for i, k in enumerate(own):
                out[k] = probability[i, : len(pages[k])] >= 0.5
        return out


def _add_rows(target: np.ndarray, rows: np.ndarray, table: np.ndarray, at: np.ndarray, share: np.ndarray | None) -> None:
    """target[rows] += table[at] (times share), where ``rows`` does not decrease."""
    if not len(rows):
        return
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    value = table[at] if share is None else table[at] * share[:, None]
    target[rows[starts]] += np.add.reduceat(value, starts, axis=0)


def fit(pages: DataFrame, sample: int = SAMPLE, composed: int = COMPOSED, id_col: str = "page_id", html_col: str = "html", seed: int = 21) -> Network:
    """A network trained on a bounded sample of ``pages`` and pages composed from its sentences.

    The sample has the smallest hashes of id and text among pages of at most ``LONGEST`` characters.
    """
    ship(pages.sparkSession)
    page = column(pages, html_col, "string")
    rows = pages.select(F.xxhash64(column(pages, id_col, "string"), F.lit(seed)).alias("draw"), F.xxhash64(page).alias("print"), page.alias("html"))
    rows = rows.where(F.length("html") <= LONGEST)
    drawn = [(r["draw"], r["print"]) for r in rows.select("draw", "print").distinct().orderBy("draw", "print").limit(sample).collect()]
    last = drawn[-1] if drawn else (0, 0)
    picked = rows.where((F.col("draw") < last[0]) | ((F.col("draw") == last[0]) & (F.col("print") <= last[1]))) if drawn else rows.where(F.lit(False))
    got = picked.groupBy("draw", "print").agg(F.min("html").alias("html")).collect()  # ``sample`` pages of bounded length
    real = [parse(h) for _, _, h in sorted(map(tuple, got))]
    sentences = [b.text for blocks in real for b in blocks if len(b.text) > 20][:20_000] or ["one two three four five six seven eight nine ten eleven twelve"]
    rng = np.random.Generator(np.random.Philox(seed))
    invented = [parse(compose(rng, sentences)) for _ in range(composed)]
    marks = [[_MARK in b.text for b in blocks] for blocks in invented]
    for blocks in invented:
        for b in blocks:
            b.text = b.text.replace(_MARK, "").strip() or "x"
    train = featured(real) + featured(invented)
    for page, blocks in zip(train, real):
        signs = [sign(b.path) for b in blocks]
        page.labels = np.array([s == 1 for s in signs], float)
        page.counted = np.array([s is not None for s in signs], float)
    for page, own in zip(train[len(real) :], marks):
        page.labels, page.counted = np.array(own, float), np.ones(len(own))
    network = Network()
    network.train(train)
    return network


def extract(pages: DataFrame, sample: int = SAMPLE, composed: int = COMPOSED, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Network | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    The whole html is read. Null, empty and text-less pages give an empty text. Character
    references are decoded, white space inside a block becomes one blank, blocks are joined in page
    order by a line feed. Unclosed and stray tags, comments and quotes are accepted as they come.
    Formulas are text like any other; drawings and templates are none. A page of any length is
    read whole, in memory that grows with its blocks alone.
    Repeated rows give repeated results, an empty table gives no rows. Extra columns are ignored.
    """
    held = pages.sparkSession.sparkContext.broadcast(model or fit(pages, sample, composed, id_col, html_col))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = held.value
        for batch in batches:
            texts: list[str] = []
            for lo, hi in runs(batch.column(2)):
                blocks = [parse(h.as_py() or "") for h in batch.column(2)[lo:hi]]
                good = network.label(featured(blocks))
                texts += ["\n".join(b.text for b, keep in zip(own, kept) if keep) for own, kept in zip(blocks, good)]
            chars = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), chars], ["page_id", "url", "text", "n_chars"])

    ship(pages.sparkSession)
    rows = pages.select(column(pages, id_col, "long").alias("page_id"), column(pages, url_col, "string").alias("url"), column(pages, html_col, "string").alias("html"))
    return rows.mapInArrow(extracted, "page_id long, url string, text string, n_chars long")

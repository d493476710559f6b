"""HTML main text: a recurrent block labeller in numpy.

A page is cut into blocks, the leaf texts between block-level tags. Each block is read as two hashed vectors: the sum of
embeddings of its tag path (tags, class and id words, with and without the leaf) and the mean of embeddings of its
words, with a few squashed counts. A bidirectional LSTM over the page's whole block sequence then labels every block as
article or not, so a label can depend on everything before and after it.

Training takes at most ``max_pages`` pages of the table (a documented bound, by hash), labelled by their own structural
markup, and twice as many composed pages: known layouts of menus, headers, footers, sidebars, notices, adverts, forms, comments
and articles under many tag and class names, filled with words of the sampled pages. All pages are labelled by the model.

Defined results: null, empty and text-free html give an empty text; unclosed tags end with their parents, unclosed
comments, scripts and styles with the page; very long pages are one long sequence; repeated rows and null keys are rows
like any other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseledger.llm.common import worker_state

PATH_BUCKETS, WORD_BUCKETS, PATH_DIM, WORD_DIM, COUNTS, HIDDEN = 1 << 11, 1 << 12, 20, 8, 5, 20
MAX_PAGES = 400
#: Words, by hash, of which pages are composed; blocks of a training sequence.
MAX_WORDS, TRAIN_WINDOW = 20_000, 80
CACHE = 100_000
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CLOSED_BY_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
#: The rest of a tag: quoted values may hold any character, ">" included.
_REST = r"""(?>=\s*"[^"]*"|=\s*'[^']*'|[^>])*"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|math|iframe|object|canvas|audio|video|select|datalist)\b{_REST}>.*?(?:</\1\s*>|\Z)"
    rf"|<[!?][a-zA-Z][^>]*(?:>|\Z)|</?[a-zA-Z]{_REST}(?:>|\Z)|[^<]+|<",
    re.S | re.I,
)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)", re.S)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_WORDS = re.compile(r"[A-Za-z][a-z]*")


def blocks(page: str | None) -> list[tuple[tuple[str, ...], str, int]]:
    """(tag path, text, characters inside links) of each block in page order; white space is one space, trimmed."""
    out: list[tuple[tuple[str, ...], str, int]] = []
    stack: list[tuple[str, str]] = []  # tag, path step
    held: list[str] = []
    linked = 0
    path: tuple[str, ...] | None = None

    def close() -> None:
        nonlocal held, linked, path
        if held:
            text = "".join(held)
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                out.append((path or (), text, linked))
        held, linked, path = [], 0, None

    def pop_to(at: int) -> None:
        del stack[at:]

    for m in _TOKEN.finditer(page or ""):
        s = m[0]
        if s[0] != "<" or s == "<":
            if path is None and not s.isspace():
                path = tuple(step for tag, step in stack if tag not in INLINE or tag == "a")
            held.append(s)
            if stack and any(tag == "a" for tag, _ in stack[-3:]):
                linked += len(s)
            continue
        if m[1] or s.startswith(("<!", "<?")):
            continue
        t = _TAG.match(s)
        if not t:
            continue
        tag = t[2].lower()
        if tag not in INLINE:
            close()
        if t[1]:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == tag or tag in HEADINGS and stack[at][0] in HEADINGS:
                    pop_to(at)
                    break
                if tag in INLINE and stack[at][0] not in INLINE:
                    break
            continue
        if tag in VOID:
            continue
        if tag == "body" or (tag in CLOSES_P and tag not in ("html",)):
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == "head":
                    pop_to(at)
                    break
        if tag in CLOSES_P:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == "p":
                    pop_to(at)
                    break
                if stack[at][0] not in INLINE:
                    break
        elif tag in CLOSED_BY_SAME:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == tag:
                    pop_to(at)
                    break
                if stack[at][0] in CLOSED_BY_SAME[tag]:
                    break
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(s)) if len(s) > len(tag) + 2 else ""
        stack.append((tag, f"{tag} {names}" if names else tag))
    close()
    return out


def path_buckets(path: tuple[str, ...]) -> list[int]:
    """Every ancestor's tag and name words, the innermost tags by distance, and the whole tag path."""
    keys = {"#" + ">".join(step.split(" ", 1)[0] for step in path)}
    for step in path:
        tag, _, names = step.partition(" ")
        keys.add("t" + tag)
        keys.update("n" + w.lower() for w in _WORDS.findall(names))
    keys.update(f"{i}{step.split(' ', 1)[0]}" for i, step in enumerate(path[::-1][:3]))
    return [zlib.crc32(k.encode("utf-8", "surrogatepass")) % PATH_BUCKETS for k in sorted(keys)]


def word_bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_BUCKETS


def counts(text: str, n_words: int, linked: int, place: float) -> list[float]:
    return [min(1.0, np.log1p(n_words) / 7), min(1.0, linked / max(1, len(text))), float(text[-1:] in ".!?;:"), place, 1.0]


@dataclass
class Labeller:
    paths: np.ndarray  # PATH_BUCKETS x PATH_DIM
    words: np.ndarray  # WORD_BUCKETS x WORD_DIM
    wx: np.ndarray  # 2 x inputs x 4 HIDDEN
    wh: np.ndarray  # 2 x HIDDEN x 4 HIDDEN
    bias: np.ndarray  # 2 x 4 HIDDEN
    out: np.ndarray  # inputs + 2 HIDDEN
    out_bias: np.ndarray  # 1


def _sig(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lstm(x: np.ndarray, mask: np.ndarray, wx, wh, b, keep: list | None = None) -> np.ndarray:
    """pages x blocks x HIDDEN, left to right; past its last block a page's state stands still."""
    n, t, _ = x.shape
    h, c = np.zeros((n, HIDDEN), x.dtype), np.zeros((n, HIDDEN), x.dtype)
    out = np.zeros((n, t, HIDDEN), x.dtype)
    pre = x @ wx + b
    for k in range(t):
        z = pre[:, k] + h @ wh
        i, f, o, g = _sig(z[:, :HIDDEN]), _sig(z[:, HIDDEN : 2 * HIDDEN] + 1), _sig(z[:, 2 * HIDDEN : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
        c2 = f * c + i * g
        tc = np.tanh(c2)
        h2 = o * tc
        m = mask[:, k, None]
        if keep is not None:
            keep.append((h, c, i, f, o, g, tc, m))
        h, c = np.where(m, h2, h), np.where(m, c2, c)
        out[:, k] = h
    return out


def lstm_back(dout: np.ndarray, x: np.ndarray, wx, wh, keep: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    dh, dc = np.zeros_like(dout[:, 0]), np.zeros_like(dout[:, 0])
    dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), x.dtype)
    gh = np.zeros_like(wh)
    for k in range(x.shape[1] - 1, -1, -1):
        h, c, i, f, o, g, tc, m = keep[k]
        dh = dh + dout[:, k]
        dn, cn = np.where(m, dh, 0), np.where(m, dc, 0)
        cn = cn + dn * o * (1 - tc * tc)
        dz = np.concatenate([cn * g * i * (1 - i), cn * c * f * (1 - f), dn * tc * o * (1 - o), cn * i * (1 - g * g)], axis=1)
        dz_all[:, k] = dz
        gh += h.T @ dz
        dh = np.where(m, dz @ wh.T, dh)
        dc = np.where(m, cn * f, dc)
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    return dz_all @ wx.T, x.reshape(-1, x.shape[2]).T @ flat, gh, flat.sum(axis=0)


class Reader:
    """Features and labels of pages; one per worker, with bounded caches of paths and words."""

    def __init__(self, model: Labeller):
        self.m = model
        self.path_of: dict[tuple[str, ...], np.ndarray] = {}
        self.word_of: dict[str, int] = {}

    def inputs(self, page: list[tuple[tuple[str, ...], str, int]]) -> np.ndarray:
        m = self.m
        x = np.zeros((len(page), PATH_DIM + WORD_DIM + COUNTS), dtype=np.float32)
        if len(self.path_of) > CACHE // 10:
            self.path_of = {}
        if len(self.word_of) > CACHE:
            self.word_of = {}
        get = self.word_of
        for k, (path, text, linked) in enumerate(page):
            if path not in self.path_of:
                self.path_of[path] = m.paths[path_buckets(path)].sum(axis=0)
            x[k, :PATH_DIM] = self.path_of[path]
            words = text.lower().split(" ")
            for w in set(words).difference(get):
                get[w] = word_bucket(w)
            at = np.fromiter(map(get.__getitem__, words), dtype=np.int64, count=len(words))
            x[k, PATH_DIM : PATH_DIM + WORD_DIM] = m.words[at].mean(axis=0)
            x[k, PATH_DIM + WORD_DIM :] = counts(text, len(words), linked, k / len(page))
        return x

    def labels(self, pages: list[list]) -> list[np.ndarray]:
        """Whether each block belongs to the article; pages of like length share a pass."""
        m, out = self.m, [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            part = order[at : at + max(1, min(256, 20_000 // len(pages[order[min(at + 255, len(order) - 1)]])))]
            at += len(part)
            lengths = np.array([len(pages[i]) for i in part])
            x = np.zeros((len(part), lengths.max(), PATH_DIM + WORD_DIM + COUNTS), dtype=np.float32)
            for r, i in enumerate(part):
                x[r, : lengths[r]] = self.inputs(pages[i])
            logit = forward(m, x, lengths)[0]
            for r, i in enumerate(part):
                out[i] = logit[r, : lengths[r]] > 0
        return out


def reverse(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each page's own blocks backwards, its padding in place."""
    k = np.arange(x.shape[1])[None, :]
    at = np.where(k < lengths[:, None], lengths[:, None] - 1 - k, k)
    return np.take_along_axis(x, at[:, :, None], axis=1)


def forward(m: Labeller, x: np.ndarray, lengths: np.ndarray, keep: tuple[list, list] | None = None):
    mask = np.arange(x.shape[1])[None, :] < lengths[:, None]
    back_x = reverse(x, lengths)
    a = lstm(x, mask, m.wx[0], m.wh[0], m.bias[0], keep[0] if keep else None)
    b = reverse(lstm(back_x, mask, m.wx[1], m.wh[1], m.bias[1], keep[1] if keep else None), lengths)
    full = np.concatenate([x, a, b], axis=2)
    return full @ m.out + m.out_bias[0], full, mask, back_x


BAD_TAGS = frozenset("nav header footer aside form head title button dialog menu".split())
BAD_NAMES = frozenset("nav navigation navbar menu header masthead footer sidebar aside widget ad ads advert advertisement adslot banner promo sponsor sponsored notice cookie consent gdpr alert newsletter subscribe signup form comment comments reply replies discussion responses share social related breadcrumb breadcrumbs pagination pager toolbar search login copyright legal popup modal".split())
GOOD_NAMES = ("content", "post", "entry-content", "article-body", "story", "main-content", "post-body", "text", "page-content", "article", "body-text", "story-body")


def markup_labels(page: list[tuple[tuple[str, ...], str, int]]) -> list[bool] | None:
    """Labels from the page's own structure, or None where it names no article."""
    if not any(step.split(" ", 1)[0] in ("article", "main") for path, *_ in page for step in path):
        return None
    out = []
    for path, *_ in page:
        tags = [step.partition(" ") for step in path]
        good = any(t in ("article", "main") for t, *_ in tags)
        bad = any(t in BAD_TAGS or any(w.lower() in BAD_NAMES for w in _WORDS.findall(names)) for t, _, names in tags)
        out.append(good and not bad)
    return out


def composed_page(rng: np.random.Generator, words: list[str]) -> tuple[list, list[bool]]:
    """A page of a known layout and its labels."""
    say = lambda low, high: " ".join([words[i] for i in rng.integers(0, len(words), int(rng.integers(low, high)))])
    one = lambda *x: x[int(rng.integers(len(x)))]
    end = lambda: one(".", ".", "!", "", "?")
    parts: list[tuple[str, bool]] = []

    def links(n: int) -> str:
        return "".join(f'<li><a href="/x">{say(1, 3)}</a></li>' for _ in range(n))

    def boiler() -> str:
        kind = int(rng.integers(12))
        if kind == 0:
            return f"<nav><ul>{links(int(rng.integers(2, 8)))}</ul></nav>"
        if kind == 1:
            return f'<div class="{one("menu", "navbar", "main-menu", "site-nav", "breadcrumbs", "toolbar")}">{one("<ul>" + links(4) + "</ul>", say(2, 6), "<a href=/>" + say(1, 3) + "</a>")}</div>'
        if kind == 2:
            kind = one("h1", "h2", "div", "p")
            return f"<header><{kind}>{say(1, 6)}</{kind}></header>"
        if kind == 3:
            return f"<footer>{one('', '<p>')}&copy; {say(1, 14)}{end()}</footer>"
        if kind == 4:
            return f"<aside>{one('', '<h3>' + say(1, 4) + '</h3>')}<p>{say(3, 40)}{end()}</p></aside>"
        if kind == 5:
            return f'<div {one("class", "id")}="{one("sidebar", "side-bar", "widget", "right-sidebar", "related", "related-posts", "share", "social-share", "popular")}"><p>{say(2, 40)}{end()}</p><ul>{links(3)}</ul></div>'
        if kind == 6:
            return f'<{one("div", "div", "section", "p")} class="{one("ad", "ads", "advert", "ad-slot", "sponsored", "promo", "banner")}">{say(2, 30)}{end()}</div>'
        if kind == 7:
            return f'<div {one("class", "id")}="{one("cookie-notice", "notice", "consent", "gdpr-banner", "alert", "cookie-banner")}"{one("", " role=alert")}><p>{say(4, 40)}{end()}</p><button>{say(1, 3)}</button></div>'
        if kind == 8:
            return f'<form action="/s"><label>{say(1, 4)}</label><input name="q"><p>{say(1, 12)}</p><button>{say(1, 2)}</button></form>'
        if kind in (9, 10):
            each, whole = one("div", "li", "article"), one("section", "div", "ol")
            item = lambda: f'<{each} class="{one("comment", "comment-body", "reply", "comment")}">{one("", "<b>" + say(1, 2) + "</b>")}<p>{say(3, 90)}{end()}{one("</p>", "")}</{each}>'
            return f'<{whole} {one("class", "id")}="{one("comments", "comment-list", "comments-area", "discussion", "responses")}">{one("", "<h3>" + say(1, 3) + "</h3>")}{"".join(item() for _ in range(int(rng.integers(1, 6))))}</{whole}>'
        return f'<div {one("class", "id")}="{one("newsletter", "subscribe", "site-header", "site-footer", "page-footer", "copyright", "pagination", "search", "login")}">{say(2, 24)}{end()}</div>'

    def body() -> str:
        kind = int(rng.integers(14))
        if kind < 9:
            return f"<p>{one('', '', '<b>', '<a href=/y>' + say(1, 3) + '</a> ')}{say(1, 120)}{end()}{one('</p>', '')}"
        if kind == 9:
            return "<h{0}>{1}</h{0}>".format(int(rng.integers(2, 4)), say(1, 8))
        if kind == 10:
            return f"<ul>{''.join(f'<li>{say(1, 20)}{end()}</li>' for _ in range(int(rng.integers(1, 5))))}</ul>"
        if kind == 11:
            return f"<blockquote>{one('', '<p>')}{say(2, 40)}{end()}</blockquote>"
        if kind == 12:
            return f"<table><tr><td>{say(1, 8)}</td><td>{say(1, 8)}</td></tr></table>"
        return f"<pre>{say(1, 20)}</pre>"

    wrap = int(rng.integers(5))
    name = one(*GOOD_NAMES)
    opened, closed = [("<article>", "</article>"), ("<main>", "</main>"), (f'<div class="{name}">', "</div>"), (f'<div id="{name}">', "</div>"), (f'<main><article class="{name}">', "</article></main>")][wrap]
    lead = [boiler() for _ in range(int(rng.integers(0, 5)))]
    tail = [boiler() for _ in range(int(rng.integers(0, 5)))]
    parts = [(f"<html><head><title>{say(1, 8)}</title></head><body>", False)] + [(x, False) for x in lead] + [(opened + f"<h1>{say(1, 9)}</h1>", True)]
    for _ in range(int(rng.integers(1, 14))):
        parts.append((boiler(), False) if rng.random() < 0.08 else (body(), True))
    parts += [(closed, True)] + [(x, False) for x in tail]
    # A mark in each part tells its blocks apart after the page has been cut as any other.
    page = blocks("".join(f"{x}" for x, _ in parts))
    labels, texts = [], [[t for _, t, _ in blocks(x)] for x, _ in parts]
    flat = [(t, flag) for ts, (_, flag) in zip(texts, parts, strict=True) for t in ts]
    if [t for t, _ in flat] != [t for _, t, _ in page]:
        return [], []
    labels = [flag for _, flag in flat]
    return page, labels


def train(sample: list[str], seed: int = 11, epochs: int = 10, rate: float = 0.01, max_words: int = MAX_WORDS) -> Labeller:
    rng = np.random.default_rng(seed)
    pages = [(b, l) for b in (blocks(p) for p in sample) if b and (l := markup_labels(b))]
    words = sorted({w for b, _ in pages for _, t, _ in b for w in t.split(" ")}, key=lambda w: (zlib.crc32(w.encode("utf-8", "surrogatepass")), w))[:max_words] or ["the", "of", "and", "a", "to", "in"]
    for _ in range(2 * MAX_PAGES):
        b, l = composed_page(rng, words)
        if b:
            pages.append((b, l))
    # A long page is learnt from in windows of its blocks, from its first to its last.
    pages = [(b[k : k + TRAIN_WINDOW], l[k : k + TRAIN_WINDOW]) for b, l in pages for k in range(0, len(b), TRAIN_WINDOW)]
    width = PATH_DIM + WORD_DIM + COUNTS
    init = lambda *s: rng.normal(0, 0.2, s).astype(np.float32)
    m = Labeller(init(PATH_BUCKETS, PATH_DIM), init(WORD_BUCKETS, WORD_DIM) * 0.5, init(2, width, 4 * HIDDEN), init(2, HIDDEN, 4 * HIDDEN), np.zeros((2, 4 * HIDDEN), np.float32), init(width + 2 * HIDDEN), np.zeros(1, np.float32))
    names = ("paths", "words", "wx", "wh", "bias", "out", "out_bias")
    first, second = ({n: np.zeros_like(getattr(m, n)) for n in names} for _ in range(2))
    made = []
    for b, l in pages:
        pb = [path_buckets(p) for p, *_ in b]
        wb = [[word_bucket(w) for w in t.lower().split(" ")] for _, t, _ in b]
        ct = np.array([counts(t, len(w), k, i / len(b)) for i, ((_, t, k), w) in enumerate(zip(b, wb, strict=True))], np.float32)
        made.append((np.concatenate(pb), np.array([len(x) for x in pb]), np.concatenate(wb), np.array([len(x) for x in wb]), ct, np.array(l, np.float32)))
    step = 0
    for _ in range(epochs):
        order = sorted(range(len(made)), key=lambda i: (len(made[i][5]), rng.random()))
        groups = [order[i : i + 64] for i in range(0, len(order), 64)]
        for gi in rng.permutation(len(groups)):
            part = groups[gi]
            lengths = np.array([len(made[i][5]) for i in part])
            x, y = np.zeros((len(part), lengths.max(), width), np.float32), np.zeros((len(part), lengths.max()), np.float32)
            inside = np.arange(lengths.max())[None, :] < lengths[:, None]
            pb, pn, wb, wn, ct, lab = (np.concatenate([made[i][j] for i in part]) for j in range(6))
            p_start, w_start = np.cumsum(pn) - pn, np.cumsum(wn) - wn
            x[inside] = np.concatenate([np.add.reduceat(m.paths[pb], p_start), np.add.reduceat(m.words[wb], w_start) / wn[:, None], ct], axis=1)
            y[inside] = lab
            keep: tuple[list, list] = ([], [])
            logit, full, mask, back_x = forward(m, x, lengths, keep)
            d = np.where(mask, _sig(logit) - y, 0) / mask.sum()
            g = {"out": np.einsum("ntk,nt->k", full, d), "out_bias": np.array([d.sum()])}
            dfull = d[:, :, None] * m.out
            dx = dfull[:, :, :width].copy()
            da, ga, gha, gba = lstm_back(dfull[:, :, width : width + HIDDEN], x, m.wx[0], m.wh[0], keep[0])
            db, gb, ghb, gbb = lstm_back(reverse(dfull[:, :, width + HIDDEN :], lengths), back_x, m.wx[1], m.wh[1], keep[1])
            dx += da + reverse(db, lengths)
            g |= {"wx": np.stack([ga, gb]), "wh": np.stack([gha, ghb]), "bias": np.stack([gba, gbb]), "paths": np.zeros_like(m.paths), "words": np.zeros_like(m.words)}
            d_in = dx[inside]
            np.add.at(g["paths"], pb, np.repeat(d_in[:, :PATH_DIM], pn, axis=0))
            np.add.at(g["words"], wb, np.repeat(d_in[:, PATH_DIM : PATH_DIM + WORD_DIM] / wn[:, None], wn, axis=0))
            step += 1
            for n in names:
                first[n] = 0.9 * first[n] + 0.1 * g[n]
                second[n] = 0.999 * second[n] + 0.001 * g[n] ** 2
                setattr(m, n, (getattr(m, n) - rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)).astype(np.float32))
    return m


def main_text(page: list[tuple[tuple[str, ...], str, int]], label: np.ndarray) -> str:
    return " ".join(t for (_, t, _), keep in zip(page, label, strict=True) if keep)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", max_pages: int = MAX_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks) of every row, from its whole html."""
    hashed = pages.select(F.col(html_col).alias("h"), F.xxhash64(F.col(html_col)).alias("k")).filter("h is not null")
    # Hashes choose the pages, so tasks send the driver numbers first and then no page that is not trained on.
    chosen = [r["k"] for r in hashed.select("k").distinct().orderBy("k").limit(max_pages).collect()]
    sample = hashed.filter(F.col("k") <= max(chosen)).groupBy("k").agg(F.min("h").alias("h")).orderBy("k").collect() if chosen else []
    shared = pages.sparkSession.sparkContext.broadcast(train([r["h"] for r in sample]))  # under 1 MB whatever the table

    def run(batches):
        reader = worker_state(shared, lambda: Reader(shared.value))
        for b in batches:
            texts, n = [], []
            for at in range(0, len(b), 512):
                cut = [blocks(h) for h in b.column(2).slice(at, 512).to_pylist()]
                for page, label in zip(cut, reader.labels(cut), strict=True):
                    texts.append(main_text(page, label))
                    n.append(len(page))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64()), pa.array(n, pa.int32())], names=["page_id", "url", "text", "n_chars", "n_blocks"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("h")).mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks int")

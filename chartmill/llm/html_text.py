"""Main text of web pages by a recurrent block labeller.

A bidirectional LSTM (numpy) reads the blocks of a page as a sequence: the path of tags, classes and ids around each, its
hashed words, and figures about the text.  So a block is judged with the whole page as context.  Blocks judged to be main
text are joined in page order by one line feed.

It is trained on the driver with two bounded sets: about `sample` pages of the table (never over four times as many), drawn by the hash of
page_id among those of at most `sample_chars` characters, labelled by what the page's own marks say (`teacher`); and three times as many practice pages,
made of the sample's sentences in other layouts (`practice`), labelled by construction, half of them without telling names (`unnamed`).  All pages are read and labelled
whole.

Null and empty pages give an empty text; so do pages without main text.  Repeated rows are read alike; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.llm.html_blocks import N_FEATURES, Block, blocks_of, disputed, features, teacher
from chartmill.llm.shared import in_arrow

HIDDEN = 28
MARK = ""
AT_ONCE = 1 << 14


# ---- the network

class Labeller:
    def __init__(self, seed: int = 5, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.w: dict[str, np.ndarray] = {}
        for way in "fb":
            self.w[f"x{way}"], self.w[f"h{way}"], self.w[f"b{way}"] = draw(N_FEATURES, 4 * hidden), draw(hidden, 4 * hidden), np.zeros(4 * hidden, np.float32)
            self.w[f"b{way}"][hidden : 2 * hidden] = 1  # remember at first
        self.w["o"], self.w["d"], self.w["c"] = draw(2 * hidden, 1), draw(N_FEATURES, 1) * 0.1, np.zeros(1, np.float32)

    def walk(self, x: np.ndarray, mask: np.ndarray, way: str) -> tuple[np.ndarray, list]:
        """Hidden states of one direction; x is time, page, feature, and steps beyond a page's end change nothing."""
        n, k = x.shape[1], self.hidden
        into = x @ self.w[f"x{way}"] + self.w[f"b{way}"]
        h, c = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
        states, steps = np.zeros((len(x), n, k), np.float32), []
        for t in range(len(x)) if way == "f" else range(len(x) - 1, -1, -1):
            z = into[t] + h @ self.w[f"h{way}"]
            gates = sigmoid(z[:, : 3 * k])
            g = np.tanh(z[:, 3 * k :])
            new = gates[:, k : 2 * k] * c + gates[:, :k] * g
            tanh = np.tanh(new)
            m = mask[t][:, None]
            steps.append((t, h, c, gates, g, tanh))
            h, c = np.where(m, gates[:, 2 * k :] * tanh, h), np.where(m, new, c)
            states[t] = h
        return states, steps

    def read(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
        walked = [self.walk(x, mask, way) for way in "fb"]
        states = np.concatenate([s for s, _ in walked], axis=2)
        return (states @ self.w["o"] + x @ self.w["d"])[..., 0] + self.w["c"], states, [s for _, s in walked]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        logits, states, steps = self.read(x, mask)
        # Blocks whose label is not known (nan) are read but teach nothing.
        told = mask & ~np.isnan(y)
        error = (np.where(told, sigmoid(logits) - y, 0) / max(told.sum(), 1)).astype(np.float32)[..., None]
        k = self.hidden
        grads = {"o": np.einsum("tnk,tnz->kz", states, error), "d": np.einsum("tnk,tnz->kz", x, error), "c": error.sum(axis=(0, 1))}
        down = error @ self.w["o"].T
        for way, walked, part in zip("fb", steps, (slice(0, k), slice(k, 2 * k)), strict=True):
            dz_all = np.zeros((*x.shape[:2], 4 * k), np.float32)
            wh, gh = self.w[f"h{way}"], np.zeros_like(self.w[f"h{way}"])
            dh, dc = np.zeros_like(walked[0][1]), np.zeros_like(walked[0][1])
            for t, h, c, gates, g, tanh in reversed(walked):
                m = mask[t][:, None]
                dh = dh + down[t][:, part]
                i, f, o = gates[:, :k], gates[:, k : 2 * k], gates[:, 2 * k :]
                dnew = np.where(m, dh * o * (1 - tanh * tanh) + dc, 0)
                dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), np.where(m, dh * tanh * o * (1 - o), 0), dnew * i * (1 - g * g)], axis=1)
                dz_all[t] = dz
                gh += h.T @ dz
                dh, dc = np.where(m, dz @ wh.T, dh), np.where(m, dnew * f, dc)
            grads[f"x{way}"], grads[f"h{way}"], grads[f"b{way}"] = np.einsum("tnk,tnz->kz", x, dz_all, optimize=True), gh, dz_all.sum(axis=(0, 1))
        return grads

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], rounds: int, seed: int = 3, batch: int = 16, rate: float = 0.01) -> None:
        """Adam over batches of pages of similar length."""
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        step = 0
        order = np.argsort([len(p) for p in pages], kind="stable")
        groups = [order[i : i + batch] for i in range(0, len(order), batch)]
        for turn in range(rounds):
            for g in rng.permutation(len(groups)):
                x, mask = padded([pages[i] for i in groups[g]])
                y = padded([labels[i][:, None] for i in groups[g]])[0][..., 0]
                step += 1
                now = rate * (1 - turn / rounds)
                for k, grad in self.gradients(x, mask, y).items():
                    grad = np.clip(grad, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.99 * second[k] + 0.01 * grad * grad
                    self.w[k] -= (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block is main text; pages of similar length are read together, a bounded number of steps at once."""
        out: list = [np.zeros(0, bool)] * len(pages)
        order = [i for i in np.argsort([len(p) for p in pages], kind="stable") if len(pages[i])]
        while order:
            size = max(1, min(64, AT_ONCE // len(pages[order[-1]])))
            some, order = order[-size:], order[:-size]
            logits = self.read(*padded([pages[i] for i in some]))[0]
            for at, i in enumerate(some):
                out[i] = logits[: len(pages[i]), at] > 0
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(len(p) for p in pages)
    x, mask = np.zeros((longest, len(pages), pages[0].shape[1]), np.float32), np.zeros((longest, len(pages)), bool)
    for i, p in enumerate(pages):
        x[: len(p), i], mask[: len(p), i] = p, True
    return x, mask


# ---- training

NAV = ('<nav{}>', '<div class="menu">', '<div class="navbar">', '<ul class="nav">', '<div id="navigation">', '<div class="breadcrumbs">', '<div role="navigation">', '<ul class="main-menu">', '<div class="top-menu">')
HEADER = ('<header>', '<div class="header">', '<div id="masthead">', '<div class="site-header">', '<div class="page-header">', '<div class="topbar">', '<div id="top" class="banner">')
FOOTER = ('<footer>', '<div class="footer">', '<div id="footer">', '<div class="site-footer">', '<div class="copyright">', '<div class="legal">')
ASIDE = ('<aside>', '<div class="sidebar">', '<div id="sidebar">', '<div class="widget">', '<div class="related">', '<section class="related-posts">', '<div class="right-rail">', '<div class="side">', '<div class="recommended">', '<div class="popular">')
AD = ('<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="advertisement">', '<div id="ad-top">', '<div class="sponsored">', '<div class="promo">', '<aside class="ad">', '<p class="ad">', '<div class="ad-banner">')
NOTICE = ('<div class="cookie">', '<div class="cookie-banner">', '<div id="cookie-notice">', '<div class="consent">', '<div class="notice">', '<div class="newsletter">', '<div class="popup">', '<div class="alert">', '<div class="gdpr">', '<section class="notice">', '<p class="notice">', '<div role="dialog">')
FORM = ('<form>', '<form class="search">', '<form action="/login">', '<form class="subscribe">', '<div class="login"><form>', '<form id="contact">')
COMMENT = ('<section class="comments">', '<div id="comments">', '<div class="comments">', '<ol class="commentlist">', '<div class="comment">', '<ul class="replies">', '<section id="comments">', '<div class="discussion">')
SHARE = ('<div class="share">', '<ul class="social">', '<div class="social-links">')
MAIN = ('<article>', '<main>', '<main><article>', '<div class="content">', '<div id="content">', '<div class="post">', '<div class="entry-content">', '<div class="article-body">', '<div class="story">', '<section class="article">', '<div class="main-content">', '<div><article class="post">', '<div id="main"><div class="text">', '<table><tr><td class="content">', '<div role="main">', '<article class="entry"><div>', '<div id="main">', '<section><article>')


#: What may stand around a paragraph of an article, though its name says otherwise.
ODD = ('<div class="more">{}</div>', '<div class="side-note">{}</div>', '<div class="top">{}</div>', '<div class="banner-text">{}</div>', '<div class="story-more">{}</div>')
ODD_P = ("notice-text", "more", "alert-text", "header-text")
SAID = {
    "comment": ("Comments", "2 Comments", "Kommentare", "3 Kommentare", "Commentaires", "Comentarios", "Leave a reply", "Replies"),
    "footer": ("(c) 2024 Example Ltd", "\xA9 2023 The Site", "Copyright 2022 Media Group. All rights reserved.", "All rights reserved.", "Impressum", "Alle Rechte vorbehalten"),
    "offer": ("Subscribe to our newsletter!", "Advertisement", "We use cookies to make this site better.", "Sponsored by our partners.", "Sign up and never miss a story.", "Anzeige", "Publicité"),
    "further": ("Related", "Related stories", "Read more", "See also", "Most read", "Weiterlesen", "Lire aussi"),
}
NAMED = re.compile(r"""\b(class|id|role)="([^"]*)"|<(/?)(nav|header|footer|aside|article|main|section)\b""")


def unnamed(page: str, rng: np.random.Generator) -> str:
    """The page with names of classes and ids that say nothing, and plain elements."""
    names: dict[str, str] = {}

    def other(m: re.Match) -> str:
        if m[1]:
            return f'class="{names.setdefault(m[2], "x" + format(rng.integers(1 << 30), "x"))}"'
        return f"<{m[3]}div"

    return NAMED.sub(other, page)


def closed(opening: str) -> str:
    tags = [t.split()[0].split(">")[0] for t in opening.split("<")[1:]]
    return "".join(f"</{t}>" for t in reversed(tags))


def practice(sentences: list[str], rng: np.random.Generator) -> str:
    """A page in some layout; the blocks of its article carry MARK."""
    pick = lambda options: options[rng.integers(len(options))]
    words = lambda lo, hi: " ".join(pick(sentences).split()[: rng.integers(lo, hi)]) or "x"
    sentence = lambda: " ".join(pick(sentences) for _ in range(rng.integers(1, 4)))
    likely = lambda p: rng.random() < p

    def links(opening: str) -> str:
        item = "li" if "<ul" in opening or "<ol" in opening or likely(0.6) else "span" if likely(0.5) else "div"
        inner = "".join(f'<{item}><a href="/{i}">{words(1, 4)}</a></{item}>' for i in range(rng.integers(2, 8)))
        return opening.format("") + (f"<ul>{inner}</ul>" if item == "li" and "<ul" not in opening else inner) + closed(opening.format(""))

    def boxed(opening: str, paragraphs: int) -> str:
        inner = "".join(f"<p>{sentence()}</p>" if likely(0.7) else f"<div>{words(2, 12)}</div>" for _ in range(paragraphs))
        kind = "footer" if opening in FOOTER else "further" if opening in ASIDE else "offer" if opening in NOTICE + AD else None
        if kind and likely(0.5):
            said = pick(SAID[kind])
            return opening + (f"<h4>{said}</h4>{inner}" if kind == "further" else said if opening.startswith("<p") or likely(0.5) else f"<p>{said}</p>") + closed(opening)
        if opening.startswith("<p") or likely(0.3):
            inner = sentence() if likely(0.5) else words(2, 10)
        elif likely(0.3):
            inner = f"<h3>{words(1, 4)}</h3>" + inner
        return opening + inner + closed(opening)

    def form() -> str:
        opening = pick(FORM)
        return opening + f"<label>{words(1, 4)}</label><input name=q>" + (f"<p>{words(3, 12)}</p>" if likely(0.4) else "") + (f"<select><option>{words(1, 2)}<option>{words(1, 3)}</select>" if likely(0.3) else "") + f"<button>{words(1, 3)}</button>" + closed(opening)

    def comments() -> str:
        opening = pick(COMMENT)
        item = "li" if "<ol" in opening or "<ul" in opening else pick(('div class="comment"', "div", "article", 'article class="comment"', "p"))
        heading = pick(SAID["comment"]) if likely(0.6) else words(1, 3)
        inner = "".join(f"<{item}>" + (f"<b>{words(1, 3)}</b> " if likely(0.5) else "") + (sentence() if item == "p" or likely(0.4) else f"<p>{sentence()}</p>") + f"</{item.split()[0]}>" for _ in range(rng.integers(1, 6)))
        return opening + (f"<h3>{heading}</h3>" if likely(0.4) else f"<div>{heading}</div>" if likely(0.5) else "") + inner + closed(opening)

    def article() -> str:
        opening = pick(MAIN)
        parts = [f"<h1>{MARK}{words(3, 10)}</h1>"] if likely(0.85) else []
        if parts and likely(0.2):
            parts = [f"<header>{parts[0]}</header>"]
        bare = likely(0.1)
        for _ in range(rng.integers(1, 14)):
            roll = rng.random()
            if roll < 0.7:
                paragraph = f"<div>{MARK}{sentence()}</div>" if bare else f"<p>{MARK}{sentence()}" + ("</p>" if likely(0.9) else "")
                if likely(0.05):
                    paragraph = pick(ODD).format(f"<p>{MARK}{sentence()}</p>")
                elif likely(0.05):
                    paragraph = f'<p class="{pick(ODD_P)}">{MARK}{sentence()}</p>'
                parts.append(paragraph)
            elif roll < 0.78:
                parts.append(f"<h{rng.integers(2, 4)}>{MARK}{words(1, 8)}</h2>")
            elif roll < 0.85:
                parts.append("<ul>" + "".join(f"<li>{MARK}{words(2, 14)}</li>" for _ in range(rng.integers(1, 5))) + "</ul>")
            elif roll < 0.9:
                parts.append(f"<blockquote>{MARK}{sentence()}</blockquote>")
            elif roll < 0.93:
                parts.append(f"<p><b>{MARK}{words(2, 10)}<br><p>{MARK}{sentence()}</p>")
            elif roll < 0.96:
                parts.append(f"<p>{MARK}{words(1, 3)}</p>")
            else:
                parts.append(f"<table><tr><td>{MARK}{words(1, 5)}</td><td>{MARK}{words(1, 5)}</td></tr></table>")
            if likely(0.05):
                parts.append(pick((boxed(pick(AD), 1), boxed(pick(NOTICE), 1), links(pick(SHARE)), form(), boxed(pick(ASIDE), 1))))
        if likely(0.08):
            parts.append(comments())
        if likely(0.08):
            parts.append(boxed("<footer>", 1))
        return opening + "".join(parts) + closed(opening)

    before = [lambda: links(pick(NAV)), lambda: boxed(pick(AD), 1), lambda: boxed(pick(HEADER), 1), lambda: pick(HEADER[:6]) + links(pick(NAV)) + "</div>", lambda: boxed(pick(NOTICE), 1), form, lambda: boxed(pick(ASIDE), 2)]
    after = [comments, lambda: boxed(pick(ASIDE), 3), lambda: links(pick(ASIDE)), lambda: boxed(pick(AD), 1), form, lambda: links(pick(SHARE)), lambda: boxed(pick(NOTICE), 2), lambda: links(pick(NAV)), lambda: boxed(pick(FOOTER), 1)]
    top = "".join(before[i]() for i in rng.permutation(len(before))[: rng.integers(1, 6)])
    end = "".join(after[i]() for i in rng.permutation(len(after))[: rng.integers(1, 7)]) + (boxed(pick(FOOTER), 1) if likely(0.8) else "")
    page = f"<html><head><title>{words(2, 8)}</title></head><body>"
    return page + (f'<div class="{pick(("wrapper", "container", "page", "site", "layout"))}">' if likely(0.4) else "") + top + article() + end + "</body></html>"


def trained(pages: list[str], rounds: int = 20, seed: int = 5) -> Labeller:
    rng = np.random.default_rng(seed)
    read = [blocks_of(p) for p in pages]
    labelled: list = [(b, [np.nan if disputed(x) else teacher(x) for x in b]) for b in read]
    labelled = [(b, y) for b, y in labelled if True in y]
    sentences = [x.text[:300] for b, y in labelled for x, main in zip(b, y, strict=True) if main is True] or ["The quick brown fox jumps over the lazy dog.", "It was late."]
    for nr in range(3 * max(300, len(pages))):
        # Half of the practice pages have names that say nothing, so that the text and its place must tell.
        page = practice(sentences, rng)
        made = blocks_of(unnamed(page, rng) if nr % 2 else page)
        labelled.append(([Block(b.path, b.text.replace(MARK, "") or "x", b.linked) for b in made], [MARK in b.text for b in made]))
    labeller = Labeller(seed)
    labeller.fit(features([b for b, _ in labelled]), [np.array(y, np.float32) for _, y in labelled], rounds)
    return labeller


# ---- extraction

def texts_of(pages: list[str], labeller: Labeller) -> list[str]:
    read = [blocks_of(p) for p in pages]
    return ["\n".join(b.text for b, main in zip(blocks, kept, strict=True) if main) for blocks, kept in zip(read, labeller.label(features(read)), strict=True)]


def extract(pages: DataFrame, sample: int = 300, sample_chars: int = 100_000) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    # Pages whose hash is below a share of all hashes: about `sample` of them, however many partitions there are.
    shortened = pages.where(F.length(html) <= sample_chars)
    share = min(1.0, sample / max(1, shortened.count()))
    drawn = F.pmod(F.xxhash64("page_id", F.lit("sample")), F.lit(1 << 30)) < share * (1 << 30)
    few = shortened.where(drawn).select(html.alias("html")).orderBy(F.xxhash64("html")).limit(4 * sample)
    labeller = trained([r["html"] for r in few.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                texts = texts_of(part.column(2).to_pylist(), labeller)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return in_arrow(pages.select("page_id", F.col("url").cast("string"), html.alias("html")), run, f"page_id {kind}, url string, text string, n_chars long")

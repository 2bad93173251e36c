"""HTML pages as sequences of text blocks, and what the block labeller sees of them.

A block is the text between two tags of block elements; line breaks and inline elements do not end it.  Its path is the
chain of elements around it.  Scripts, styles, templates and comments hold no text.  Markup that is not well formed is read
leniently: paragraphs, list items and cells end where the next begins, end tags without a start are ignored, and a `<` that
starts no tag is text.
"""

from __future__ import annotations

import html
import re
import zlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np

from chartmill.llm.tokens import word_hashes

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)\]\]>|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*)>"
    r"|<(?P<end2>/?)(?P<tag2>[A-Za-z][A-Za-z0-9:-]*)(?P<rest2>[^<>]*)>|<[!?][^>]*>|(?P<text>[^<]+|<)", re.S)
NAMES = re.compile(r"""(?i)\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe noembed xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html"
    " label legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An element of the first kind ends an open one of the second, up to the nearest of the third.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "body": ({"head"}, {"html"})}
#: Names of elements, classes, ids and roles that tell what a part of a page is; a fixed list.
KINDS = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs crumbs pagination pager toc topbar toolbar tabs tabbar dropdown submenu navlinks skip",
    "header": "header masthead logo branding siteheader pageheader topheader heading top banner hero",
    "footer": "footer foot copyright legal colophon bottom imprint siteinfo",
    "aside": "aside sidebar side rail widget widgets related recommended recommendations popular trending more teaser teasers complementary",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted adsense adslot outbrain taboola banner",
    "notice": "cookie cookies consent gdpr notice notices alert alerts popup modal overlay toast dialog newsletter subscribe subscription privacy disclaimer warning announcement paywall",
    "form": "form fieldset button select option textarea label legend search login signup register input contact",
    "comment": "comment comments commentlist reply replies respond discussion disqus thread responses feedback reviews kommentar kommentare commentaire commentaires comentario comentarios",
    "social": "share sharing social follow like tweet",
    "main": "article main content post entry story articlebody maincontent text body-text postbody",
    "title": "h1 h2 h3 h4 h5 h6",
    "outside": "head title noscript",
}
KIND_OF = {name: [k for k, names in KINDS.items() if name in names.split()] for names in KINDS.values() for name in names.split()}
BOILERPLATE = ("nav", "header", "footer", "aside", "ad", "notice", "form", "comment", "social", "outside")
#: What texts of a few words beside an article say, in four languages; a fixed list.
CUES = {
    "rights": r"\xA9|\(c\)|copyright|all rights reserved|alle rechte|tous droits|todos los derechos|impressum",
    "comment": r"\bcomments?\b|kommentare?\b|commentaires?\b|comentarios?\b|\brepl(?:y|ies)\b|antworten|répondre|responder",
    "offer": r"subscribe|newsletter|cookies?\b|sign (?:in|up)|log ?in|advertisement|sponsored|anzeige|publicité|publicidad",
    "further": r"\brelated\b|read more|see also|most read|share this|follow us|weiterlesen|lire aussi|leer más",
}
SAYS = [re.compile(cue, re.I) for cue in CUES.values()]
ANY = re.compile("|".join(CUES.values()), re.I)
SHORT = 80
PATH_DIMS, WORD_DIMS, PLACE_DIMS = 32, 24, 8
N_FEATURES = 3 * len(KINDS) + PATH_DIMS + WORD_DIMS + 10 + len(CUES) + PLACE_DIMS


class Block(NamedTuple):
    path: tuple[str, ...]  # elements as `tag name name`, outermost first
    text: str
    linked: int  # characters inside links


@lru_cache(maxsize=100_000)
def element(tag: str, attributes: str) -> str:
    names = [a or b or c for a, b, c in NAMES.findall(attributes)]
    words = []
    for name in names:
        for whole in name.split():
            words += [whole.lower(), *SPLIT.split(CAMEL.sub("-", whole).lower())]
    return " ".join([tag, *dict.fromkeys(w for w in words if w)])


def blocks_of(page: str) -> list[Block]:
    stack: list[tuple[str, str]] = []
    out: list[Block] = []
    pieces: list[str] = []
    linked = links = 0
    at = 0

    def close() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append(Block(tuple(e for t, e in stack if t in BLOCK or t in ("a",)), text, linked))
            pieces, linked = [], 0

    while at < len(page):
        m = TOKEN.match(page, at)
        if m is None:
            at += 1
            continue
        at = m.end()
        text = m["text"] if m["text"] is not None else m["data"]
        if text is not None:
            pieces.append(text if m["data"] is None else html.escape(text, quote=False))
            if links:
                linked += len(text)
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        ends, rest = m["end"] or m["end2"], m["rest"] or m["rest2"] or ""
        if tag in RAW and not ends:
            found = re.compile(rf"(?i)</{tag}\b").search(page, at)
            at = found.start() if found else len(page)
            continue
        if tag == "br" or (tag in VOID and tag != "hr"):
            pieces.append(" ")
            continue
        if tag in BLOCK:
            close()
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                # Any heading's end tag ends the open heading.
                if stack[i][0] == tag or (tag in HEADINGS and stack[i][0] in HEADINGS):
                    links -= sum(t == "a" for t, _ in stack[i:])
                    del stack[i:]
                    break
            continue
        if tag in VOID:
            continue
        shut: tuple = IMPLIED.get(tag, ((), ()))
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in shut[1] or (stack[i][0] in BLOCK and stack[i][0] not in shut[0] and stack[i][0] != "p" and not shut[0]):
                break
            if stack[i][0] in shut[0] or (tag in BLOCK and stack[i][0] == "p"):
                links -= sum(t == "a" for t, _ in stack[i:])
                del stack[i:]
                if not shut[0]:
                    break
        if not rest.rstrip().endswith("/") or tag in BLOCK:
            stack.append((tag, element(tag, rest)))
            links += tag == "a"
    close()
    return out


@lru_cache(maxsize=100_000)
def kinds_of(one: str) -> frozenset[str]:
    return frozenset(k for name in one.split() for k in KIND_OF.get(name, ()))


def teacher(block: Block) -> bool:
    """Whether the page's own marks place a block in the article: the innermost part that has a name decides.  An
    article's own header holds its headline."""
    inside = False
    title = any(e.split()[0] in HEADINGS for e in block.path)
    for one in block.path:
        kinds = kinds_of(one)
        if "main" in kinds and not kinds & (set(BOILERPLATE) - {"header"}):
            inside = True
        elif any(k in BOILERPLATE for k in kinds):
            if kinds & set(BOILERPLATE) == {"header"} and inside and title:
                continue
            return False
    return inside


def disputed(block: Block) -> bool:
    """Whether a name inside the article speaks against a block that reads like the article's text: there names mislead,
    and the teacher does not know."""
    if teacher(block) or block.linked or block.text[-1] not in ".!?" or any(e.split()[0] in ("form", "nav", "footer", "aside", "button", "label") for e in block.path):
        return False
    inside = next((i for i, e in enumerate(block.path) if "main" in kinds_of(e)), None)
    return inside is not None and not any(k in BOILERPLATE for e in block.path[: inside + 1] for k in kinds_of(e)) and not any("comment" in kinds_of(e) for e in block.path)


@lru_cache(maxsize=50_000)
def path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Kinds that occur on the path, that are the last of their path, and that stand inside a main part; hashed names."""
    out = np.zeros(3 * len(KINDS) + PATH_DIMS, np.float32)
    names = list(KINDS)
    inside = False
    for depth, one in enumerate(path):
        kinds = kinds_of(one)
        for k in kinds:
            out[names.index(k)] = 1
            if depth == len(path) - 1:
                out[len(KINDS) + names.index(k)] = 1
            if inside:
                out[2 * len(KINDS) + names.index(k)] = 1
        inside |= "main" in kinds
        for name in one.split():
            h = zlib.crc32(name.encode("utf-8", "surrogatepass"))
            out[3 * len(KINDS) + h % PATH_DIMS] += (1 if h & 1024 else -1) * 0.5
    # A very deep path stays within what others have.
    return np.clip(out, -2, 2)


def places(page: list[Block]) -> np.ndarray:
    """How each block lies among the others, whatever the elements around it are called: how far its path agrees with that of the
    block before and after it, and how much of the page's plain text and of its links stands beside it, under the same parent
    and under the one above that."""
    n = len(page)
    out = np.zeros((n, PLACE_DIMS), np.float32)
    shared = np.zeros(n + 1, np.float32)
    for i in range(1, n):
        a, b = page[i - 1].path, page[i].path
        if a is b or a == b:
            shared[i] = 1
            continue
        same = 0
        for x, y in zip(a, b, strict=False):
            if x != y:
                break
            same += 1
        shared[i] = same / max(len(a), len(b), 1)
    linked = np.fromiter((b.linked for b in page), np.float64, n)
    plain = np.maximum(np.fromiter((len(b.text) for b in page), np.float64, n) - linked, 0)
    out[:, 0], out[:, 1] = shared[:n], shared[1:]
    for column, up in ((2, 1), (5, 2)):
        numbers: dict[tuple[str, ...], int] = {}
        at = np.fromiter((numbers.setdefault(b.path[:-up], len(numbers)) for b in page), np.int64, n)
        out[:, column] = (np.bincount(at, plain) / max(plain.sum(), 1))[at]
        out[:, column + 1] = (np.bincount(at, linked) / max(linked.sum(), 1))[at]
        out[:, column + 2] = np.minimum(np.log1p(np.bincount(at)) / 3, 2)[at]
    return out


def features(pages: list[list[Block]]) -> list[np.ndarray]:
    """For each page a row for each block: path, hashed words and figures about the text and its place."""
    texts = [b.text.encode("utf-8", "surrogatepass") for page in pages for b in page]
    hashes, counts = word_hashes(texts)
    rows = np.repeat(np.arange(len(texts)), counts)
    words = np.zeros((len(texts), WORD_DIMS), np.float32)
    slot = (hashes % np.uint64(WORD_DIMS)).astype(np.int64)
    np.add.at(words, (rows, slot), np.where(hashes >> np.uint64(60) & np.uint64(1), 1, -1).astype(np.float32))
    # Of length one, so that a text that repeats a word very often looks no different in size.
    words /= np.maximum(np.linalg.norm(words, axis=1), 1)[:, None]
    out, at = [], 0
    for page in pages:
        own = np.zeros((len(page), N_FEATURES), np.float32)
        n = counts[at : at + len(page)]
        for i, b in enumerate(page):
            path, size = path_vector(b.path), len(b.text)
            own[i, : len(path)] = path
            if size <= SHORT and ANY.search(b.text):
                own[i, len(path) : len(path) + len(CUES)] = [bool(cue.search(b.text)) for cue in SAYS]
            own[i, -10:-2] = (
                min(np.log1p(n[i]) / 4, 2), min(size / max(n[i], 1) / 8, 2), min(b.linked / size, 1), b.text[-1] in ".!?:;\"”»", (b.text.count(",") + b.text.count(".")) / size * 10,
                min(len(b.path) / 10, 2), b.text[:1].isupper(), n[i] < 4,
            )
            own[i, -2:] = i / len(page), (len(page) - i) / len(page)
        own[:, -(10 + WORD_DIMS) : -10] = words[at : at + len(page)]
        if page:
            own[:, -(10 + WORD_DIMS + PLACE_DIMS) : -(10 + WORD_DIMS)] = places(page)
        out.append(own)
        at += len(page)
    return out

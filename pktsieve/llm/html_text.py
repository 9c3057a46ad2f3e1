"""Main text of web pages by two passes of block rules.

A page is cut into blocks at its block-level elements. The first pass decides
blocks by stop-word density, length and link density, and by what the markup
says outright: blocks in navigation, page headers, footers, asides, forms,
adverts, notices or reader comments are boilerplate, and where a page marks its
article, blocks outside it are too. Short blocks with few links stay open. Where
no listed language fits a page, stop words tell nothing, and length and link
density decide. In the second pass an open block inherits the label of its
nearest decided neighbours (of two different ones as near, the article's).

An inline element that is boilerplate (an advert or a hidden mark in a
paragraph) takes its own text out of its block and leaves the block whole.

Defined results: null or empty HTML gives the empty text; a page cut off
anywhere is read as far as it goes (a tag that doesn't end is dropped); tags
may be unclosed or nested wrongly; nothing is capped; rows are judged one by
one, so repeats and order don't matter; columns named ``text`` and ``n_chars`` are
replaced, other extra columns are never looked at.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# --- fixed values: element names of HTML, by their role
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "noembed", "noframes", "xmp", "svg", "math", "object")
DROPPED = frozenset("nav footer aside form head button select option dialog menu canvas audio video map".split())
# --- fixed values: words of class, id and role attributes that name boilerplate
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices "
    "overlay pager pagination popup promo promoted promotion related recommended replies reply respond search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget complementary contentinfo alert".split()
)
# --- fixed values: words that name one reader comment, and a comment section
COMMENT = frozenset("comment reply response".split())
COMMENTS = frozenset("responses discussion feedback reactions commentlist".split())
HEADERS = frozenset(("header", "site header", "page header", "top header", "global header"))
# --- fixed values: frequent function words of the languages that are told apart by them
STOP_WORDS = frozenset(
    "the of and to in a is that it was for on are as with his they at be this from have or by one had not but what all were "
    "when we there can an your which their said if do will each about how up out them then she many some so these would "
    "der die das und ist von zu mit sich des dem nicht ein eine auf für als auch es an werden aus er hat dass sie nach wird "
    "bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde "
    "le la les de des du et est un une que qui dans pour pas sur au plus par ce il ne se sont avec son elle nous vous mais "
    "ou où leur cette ont été aux même ses comme tout sans être deux aussi "
    "el los las del en y por con para una su al lo como más pero sus ya o este sí porque esta entre cuando muy sin sobre "
    "también me hasta hay donde quien desde todo nos durante todos uno les ni contra otros ese eso ante ellos e esto".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?P<rawattrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for n in RAW}
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PART = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[^\W\d_]+")
_DENSE = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")  # scripts that say more in a character


def _is_boilerplate(name: str, attrs: str, in_article: bool) -> bool:
    if name in DROPPED:
        return True
    if name == "header" and not in_article:
        return True
    if not attrs or name in ("html", "body"):
        return False
    if name in ("article", "main"):  # names of an article tell about its page, unless it is a comment itself
        return any(
            parts and (parts[0] in COMMENT or parts[-1] in COMMENT)
            for value in _named(attrs) for parts in ([p for p in _PART.split(v) if p] for v in value.split())
        )
    if _HIDDEN.search(attrs):
        return True
    for value in _named(attrs):
        parts = [p for p in _PART.split(value) if p]
        if any(p in NAMES or p in COMMENTS for p in parts):
            return True
        if not in_article and " ".join(parts) in HEADERS:
            return True
    return False


def _named(attrs: str) -> list[str]:
    """The values of class, id and role."""
    return [(m[2] or m[3] or m[4] or "").lower() for m in _NAMED.finditer(attrs)]


class Block:
    __slots__ = ("pieces", "linked", "dropped", "article", "muted")

    def __init__(self, dropped: bool, article: bool, muted: bool):
        self.pieces: list[str] = []
        self.linked = 0  # characters in links
        self.dropped, self.article, self.muted = dropped, article, muted


def blocks_of(page: str) -> list[tuple[str, float, bool, bool]]:
    """Text, share of link characters, in boilerplate markup, in an article: of each non-empty block in page order."""
    found: list[Block] = []
    stack: list[tuple[str, bool, bool]] = []  # name, boilerplate from here, article from here
    state = {"dropped": 0, "article": 0, "links": 0, "muted": 0}  # muted: dropped by inline elements
    block = Block(False, False, False)

    def cut() -> None:
        nonlocal block
        if block.pieces and not block.muted:
            found.append(block)
        block = Block(state["dropped"] > 0, state["article"] > 0, state["muted"] > 0)

    def pop(name: str) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                while len(stack) > i:
                    gone, dropped, article = stack.pop()
                    state["dropped"] -= dropped
                    state["muted"] -= dropped and gone not in BLOCK
                    state["article"] -= article
                    state["links"] -= gone == "a"
                return

    def close_inline(name: str) -> None:
        """An inline element ends wherever it began; what began in it goes on."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                _, dropped, article = stack.pop(i)
                state["dropped"] -= dropped
                state["muted"] -= dropped
                state["article"] -= article
                state["links"] -= name == "a"
                if block.dropped and not state["dropped"]:
                    cut()
                return

    def text(piece: str) -> None:
        if piece and (block.dropped or not state["dropped"]):
            piece = html.unescape(piece)
            block.pieces.append(piece)
            if state["links"]:
                block.linked += len(_SPACE.sub("", piece))

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m["raw"]:
            name = m["raw"].lower()
            if name in BLOCK:
                cut()
            if m["rawattrs"].endswith("/") and name in ("svg", "math", "object", "iframe"):
                continue
            close = _RAW_END[name].search(page, at)
            at = close.end() if close else end
        elif m["name"]:
            name = m["name"].lower()
            if m["close"]:
                if name in BLOCK:
                    pop(name)
                    cut()
                else:
                    close_inline(name)
            elif name == "br":
                text(" ")
            else:
                if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
                    pop(name)  # these end where the next begins
                if name not in VOID and not m["attrs"].endswith("/"):
                    dropped = _is_boilerplate(name, m["attrs"], state["article"] > 0)
                    article = name in ("article", "main")
                    stack.append((name, dropped, article))
                    state["dropped"] += dropped
                    state["muted"] += dropped and name not in BLOCK
                    state["article"] += article
                    state["links"] += name == "a"
                    if name in BLOCK:
                        cut()
                elif name in BLOCK:
                    cut()
    cut()
    out = []
    for b in found:
        body = _SPACE.sub(" ", "".join(b.pieces)).strip()
        if body:
            chars = len(body.replace(" ", ""))
            out.append((body, min(1.0, b.linked / max(1, chars)), b.dropped, b.article))
    return out


def classify(blocks, short: int = 80, long: int = 200, most_links: float = 0.33, low: float = 0.1, high: float = 0.2) -> list[bool]:
    """Which blocks are the article's: the two passes."""
    marked = any(article and not dropped for _, _, dropped, article in blocks)
    words = [_WORD.findall(body.lower()) for body, *_ in blocks]
    stops = [sum(w in STOP_WORDS for w in ws) for ws in words]
    told = [i for i, (_, links, dropped, _) in enumerate(blocks) if not dropped and links <= most_links]
    # without a listed language, density is unknown
    known = sum(stops[i] for i in told) >= low * sum(len(words[i]) for i in told)
    labels: list[bool | None] = []
    for i, (body, links, dropped, article) in enumerate(blocks):
        size = len(body) + 2 * len(_DENSE.findall(body))
        if dropped or (marked and not article):
            labels.append(False)
        elif links > most_links:
            labels.append(False)
        elif size < short:
            labels.append(None)
        elif not known:
            labels.append(True if links <= low else None)
        else:
            density = stops[i] / max(1, len(words[i]))
            if density >= high or (size >= long and density >= low):
                labels.append(True)
            elif marked or density >= low or size >= long:
                labels.append(None)
            else:
                labels.append(False)
    # inside a marked article only its own blocks are neighbours
    decides = [x is not None and not (marked and (b[2] or not b[3])) for x, b in zip(labels, blocks)]
    n = len(blocks)
    before, after = [-1] * n, [n] * n  # the nearest decided block on either side
    for i in range(1, n):
        before[i] = i - 1 if decides[i - 1] else before[i - 1]
    for i in range(n - 2, -1, -1):
        after[i] = i + 1 if decides[i + 1] else after[i + 1]
    out = []
    for i, x in enumerate(labels):
        if x is None:
            b, a = before[i], after[i]
            if b < 0 and a == n:
                x = True  # nothing speaks against it
            elif b < 0 or (a < n and a - i < i - b):
                x = labels[a]
            elif a == n or i - b < a - i:
                x = labels[b]
            else:
                x = labels[b] or labels[a]
        out.append(bool(x))
    return out


def main_text(page: str) -> str:
    blocks = blocks_of(page)
    return "\n\n".join(b[0] for b, keep in zip(blocks, classify(blocks)) if keep)


def extract(pages: DataFrame, source: str = "html") -> DataFrame:
    """The given columns with ``text`` (main text) and ``n_chars``, which replace columns of these names."""

    @F.pandas_udf("string")
    def body(column: pd.Series) -> pd.Series:
        return column.map(main_text)

    out = pages.withColumn("text", body(text_or_empty(source)))
    return out.withColumn("n_chars", F.length("text").cast("long"))

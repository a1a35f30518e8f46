"""Main text of web pages by tag-path ratios.

A page's text is a list of blocks, each with its root-to-leaf path of block tags (with class and id).
Per path the features are summed over all its blocks: characters outside links, punctuation marks, and
blocks.  The two ratios (characters per block, punctuation per block) are smoothed over neighbouring
paths in page order, fused, and thresholded; how much of the page is on a path doesn't matter, so a short
section scores like a long one.  Containers of the paths that pass hold the content: the article or main
element around them, else the container named for content, else the container itself.  Every block in
such a container belongs to it, so headings, short sections and lists of links stay.

Tags that can't hold main text (menus, scripts, ...) never count.  Names only weigh: a container whose name ends in a
word for boilerplate (adverts, notices, comments, ...), or begins with one and ends in a word of layout, is left
out as long as other sentences stand beside it; one whose name merely begins so (side-effects, legal-history) has its path's
score halved, and the ratios decide.  A form that holds most of the text around it is a container like any other.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: HTML's own vocabulary
RAW = {"script", "style", "noscript", "template", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"html", "body", "head", "main", "article", "section", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li",
         "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote", "pre", "figure",
         "figcaption", "address", "hgroup", "details", "summary", "center", "nav", "header", "footer", "aside", "form",
         "fieldset", "menu", "dialog", "button", "select", "svg", "canvas", "object", "audio", "video", "math"}
FORMS = {"form", "fieldset"}
NEVER = {"nav", "footer", "aside", "menu", "dialog", "button", "select", "svg", "canvas", "object", "audio",
         "video", "head"}
CLOSES_P = BLOCK - {"html", "body", "head", "button", "select", "svg", "canvas", "object", "audio", "video", "math"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

# names of containers, as authors write them
WORDS = set("""ad ads advert adverts advertisement advertisements adsense adslot banner sponsor sponsored promo promos promotion promotions
cookie cookies consent gdpr notice notices alert alerts popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs sidebar
side aside rail widget widgets footer foot masthead header head topbar toolbar comment comments commentlist disqus replies reply respond share
sharing social related recommended recommendations subscribe subscription newsletter signup login search pagination pager skip hidden legal
copyright form""".split())
INSIDE = ("sidebar", "advert", "cookie", "newsletter", "breadcrumb", "comment", "navbar", "popup", "subscri", "disqus", "promo")
HEADS = {"header", "head", "masthead", "topbar"}
CONTENT = set("""content article post entry story main text body maincontent articlebody post-content entry-content article-content article-body
story-body main-content page-content post-body entry-body""".split())
LAYOUT = set("""area banner bar block body bottom box button buttons card cards center col column container content feed group holder icon icons
inner item items left link links list message module outer pane panel post posts region right row section slot strip text title top unit wrap
wrapper zone""".split())
NOT = {"has", "with", "no", "without", "is", "not", "non"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>?", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACES = re.compile(r"\s+")
_PUNCT = re.compile(r"[.,;:!?¡¿…、。，！？]")
SMOOTH = 1                     # neighbouring paths on each side
THRESHOLD = 0.25               # share of the best fused score that a path must reach
HINT = 0.5                     # weight of a path whose container's name begins like boilerplate
FAIR = 0.25                    # share of the text let through that articles and mains must hold to be all that counts
LEAST = 25                     # characters of a sentence


def _told_by_name(names: list[str], inside: bool) -> int:
    """What class and id say: 2 boilerplate, 1 perhaps, 0 nothing.  ``inside`` an article, a heading belongs to it."""
    if any(n in CONTENT for n in names):
        return 0

    def boilerplate(part: str) -> bool:
        return (part in WORDS and not (inside and part in HEADS)) or any(w in part for w in INSIDE)

    told = 0
    for n in names:
        parts = [p.rstrip("0123456789") for p in re.split(r"[-_:]+", n)]
        parts = [p for p in parts if p]
        if not parts or parts[0] in NOT or parts[-1] == "free":
            continue
        if boilerplate(parts[-1]) or (boilerplate(parts[0]) and parts[-1] in LAYOUT):
            return 2
        told = max(told, int(boilerplate(parts[0])))
    return told


class _Node:
    __slots__ = ("tag", "label", "bad", "soft", "hint", "up", "path", "content", "body")

    def __init__(self, tag, label, bad, up, content=False, soft="", hint=False):
        self.tag, self.label, self.bad, self.up, self.content = tag, label, bad, up, content
        self.path = (up.path + "/" if up else "") + label
        # (kind, path) of the body this is in: the outermost article, else the innermost main, else the outermost content
        own, around = {"article": 3, "main": 2}.get(tag, 1) if content else 0, up.body if up else (0, "")
        self.body = (own, self.path) if own > around[0] or own == 2 == around[0] else around
        # containers around this one, itself included, that are boilerplate by name or as forms: (path, kind, body around it)
        self.soft = (up.soft if up else ()) + (((self.path, soft, around[1]),) if soft else ())
        self.hint = hint or bool(up and up.hint)


class Block(NamedTuple):
    path: str
    holder: str                # its container
    bad: bool                  # in a tag that never holds main text
    linked: int                # characters inside links
    text: str
    body: str                  # the article, main or content container around it, or ""
    soft: tuple[tuple[str, str, str], ...]
    hint: bool


def blocks(page: str) -> list[Block]:
    """Every block of text, in page order."""
    root = _Node("#", "#", False, None)
    stack = [root]
    out: list[Block] = []
    text: list[str] = []
    in_link = [0, 0]                                      # open links, characters in them

    def flush():
        if text:
            clean = _SPACES.sub(" ", html.unescape("".join(text))).strip()
            if clean:
                top = stack[-1]
                holder = top.up if top.up and top.tag not in ("div", "section", "article", "main", "body", "td") else top
                out.append(Block(top.path, holder.path, top.bad, min(in_link[1], len(clean)), clean, top.body[1], top.soft, top.hint))
            text.clear()
        in_link[1] = 0

    def words(piece: str):
        if piece:
            text.append(piece)
            if in_link[0]:
                in_link[1] += len(piece.strip())

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            rest = page[at:]
            cut = re.search(r"<[a-zA-Z/!?][^<]*\Z", rest)  # a tag that the page's end cuts off
            words(rest[: cut.start()] if cut else rest)
            break
        words(page[at: m.start()])
        at = m.end()
        closing, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])    # the second: a quote that is not closed
        if not name:
            continue
        tag = name.lower()
        if closing:
            if tag == "a":
                in_link[0] = max(0, in_link[0] - 1)
            if tag in BLOCK:
                flush()
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        del stack[i:]
                        break
                in_link[0] = 0
            continue
        if tag in RAW:
            if not rest.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if tag == "br":
            text.append(" ")
        if tag == "hr":
            flush()
        if tag == "a":
            in_link[0] += 1
        if tag in VOID or tag not in BLOCK:
            continue
        flush()
        if tag in CLOSES_P and stack[-1].tag == "p":
            stack.pop()
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in SIBLINGS.get(tag, ()):
                del stack[i:]
                break
            if stack[i].tag in SCOPE.get(tag, BLOCK):
                break
        got = {k.lower(): a or b or c or "" for k, a, b, c in _ATTR.findall(rest)} if rest.strip(" /") else {}
        named = " ".join(x for x in (got.get("class", ""), got.get("id", "")) if x)
        top = stack[-1]
        names = named.lower().split()
        inside = any(n.content for n in stack)
        bad = (top.bad or tag in NEVER or (tag == "header" and not inside) or "hidden" in got
               or got.get("role", "").lower() in ROLES or got.get("aria-hidden", "").lower() == "true"
               or bool(re.search(r"display\s*:\s*none", got.get("style", ""), re.I)))
        told = _told_by_name(names, inside) if names and tag not in ("html", "body", "main") else 0
        soft = "form" if tag in FORMS else "name" if told == 2 else ""
        content = tag in ("article", "main") or (tag not in ("html", "body") and any(n in CONTENT for n in names))
        if not (rest.endswith("/") and tag in ("svg", "canvas", "object")):
            stack.append(_Node(tag, tag + ("." + _SPACES.sub(".", named.strip()) if named else ""), bad, top, content, soft, told == 1))
            in_link[0] = 0
    flush()
    return out


def _candidates(found: list[Block]) -> list[Block]:
    """The blocks that may be main text: none in a container that is boilerplate, unless it holds what there is."""
    rest = [b for b in found if not b.bad]
    let: set[str] = set()
    # forms first: one that holds most of the text around it is a plain container
    for path, kind, scope in sorted({s for b in rest for s in b.soft}, key=lambda s: len(s[0])):
        if kind == "form":
            around = sum(len(b.text) - b.linked for b in rest if not scope or b.body == scope or b.body.startswith(scope + "/"))
            inner = sum(len(b.text) - b.linked for b in rest if any(s[0] == path for s in b.soft))
            if 2 * inner > around:
                let.add(path)

    def plain(b: Block) -> bool:
        return all(s[0] in let for s in b.soft)

    def sentence(b: Block) -> bool:
        return len(b.text) - b.linked >= LEAST and bool(_PUNCT.search(b.text))

    # named containers: where nothing else around has a sentence, the one with the most text
    for scope in sorted({s[2] for b in rest for s in b.soft if s[1] == "name"}, key=len):
        near = [b for b in rest if not scope or b.body == scope or b.body.startswith(scope + "/")]
        if not any(plain(b) and sentence(b) for b in near):
            inner: dict[str, int] = {}
            for b in near:
                shut = [s for s in b.soft if s[0] not in let]
                if len(shut) == 1 and shut[0][1] == "name":
                    inner[shut[0][0]] = inner.get(shut[0][0], 0) + len(b.text) - b.linked
            if inner:
                let.add(max(inner, key=inner.__getitem__))
    return [b for b in rest if plain(b)]


def main_text(page: str | None) -> str:
    found = _candidates(blocks(page or ""))
    if not found:
        return ""
    paths: dict[str, list] = {}
    for b in found:
        p = paths.setdefault(b.path, [0, 0, 0, 0, 1.0])
        p[0] += len(b.text) - b.linked
        p[1] += len(_PUNCT.findall(b.text))
        p[2] += 1
        p[3] += b.linked
        p[4] = HINT if b.hint else 1.0
    f = np.array(list(paths.values()), dtype=float)
    length, marks = f[:, 0] / f[:, 2], f[:, 1] / f[:, 2]
    linked = f[:, 3] / np.maximum(1, f[:, 0] + f[:, 3])

    def smooth(x: np.ndarray) -> np.ndarray:
        wide = np.pad(x, SMOOTH, mode="edge")
        return 0.5 * x + 0.5 * np.convolve(wide, np.ones(2 * SMOOTH + 1) / (2 * SMOOTH + 1), "valid")

    # fused: characters and punctuation per block, less what is linked, weighed by what names say
    fused = np.sqrt(smooth(length) * (1 + smooth(marks))) * (1 - linked) * f[:, 4]
    score = dict(zip(paths, fused))
    bar = THRESHOLD * max(score.values())
    reached: dict[str, int] = {}
    for b in found:
        if score[b.path] >= bar and score[b.path] > 0:
            reached[b.body or b.holder] = reached.get(b.body or b.holder, 0) + len(b.text) - b.linked
    # articles and mains, if they hold a fair part of what the ratios let through
    inside = {h for h in reached if re.search(r"/(?:article|main)(?:[./]|$)", h)}
    holders = inside if sum(reached[h] for h in inside) >= FAIR * sum(reached.values()) and inside else set(reached)
    if not holders:
        return ""

    def kept(path: str, holder: str) -> bool:
        """In a content container, or in a list, quote or table within one."""
        return any(holder == h or holder.startswith(h + "/") for h in holders)

    return "\n".join(b.text for b in found if kept(b.path, b.holder) and (
        b.body or not (b.linked >= 0.8 * len(b.text) and not b.path.rsplit("/", 1)[-1].startswith(("h", "p")))))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per page.

    Character references are decoded, white space inside a block becomes one space, blocks are joined
    in page order by line ends.  A null or empty page, or one without main text, has an empty text.
    Whole pages are read, however long; nothing else of the text is dropped.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [main_text(h) for h in b["h"]]
            yield pd.DataFrame({"i": b["i"], "url": b["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    src = pages.select(F.col(id_col).cast("long").cast("string").alias("i"), F.col(url_col).alias("url"), F.col(html_col).alias("h"))
    return src.mapInPandas(run, "i string, url string, text string, n_chars long").select(
        F.col("i").cast("long").alias("page_id"), "url", "text", "n_chars")

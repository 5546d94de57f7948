"""Main text of web pages by tree scoring.

Text blocks pass points for length and commas to their ancestors, discounted by link density; the
container with the best score and its worthwhile siblings are kept, without boilerplate elements.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestay.llm.store import map_arrow, strings

# HTML vocabulary and the words by which page furniture is known.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "svg", "math", "template", "noscript", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"html", "body", "head", "main", "article", "section", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt",
          "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote", "pre", "address", "figure", "figcaption",
          "details", "summary", "nav", "header", "footer", "aside", "form", "fieldset", "legend", "menu", "dialog", "center", "select",
          "option", "button", "label", "search", "hgroup"}
FURNITURE = {"head", "nav", "footer", "aside", "form", "fieldset", "menu", "dialog", "select", "option", "button", "label", "search"}
TEXT_BLOCKS = {"p", "pre", "blockquote", "td", "th", "li", "dd", "dt", "h1", "h2", "h3", "h4", "h5", "h6", "figcaption", "caption"}
HEADINGS = {"h1", "h2", "h3"}
#: An element of the first kind closes an open element of the second kind that it cannot stand in.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "body": {"head"}}
NEGATIVE = {"ad", "ads", "adv", "advert", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored", "promo", "promotion",
            "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter",
            "subscribe", "subscription", "signup", "login", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond",
            "sidebar", "aside", "widget", "widgets", "related", "recommended", "recommendations", "share", "sharing", "social",
            "breadcrumb", "breadcrumbs", "pagination", "pager", "menu", "nav", "navbar", "navigation", "header", "masthead", "footer", "skip",
            "toolbar", "search", "form", "hidden", "tracking", "paywall", "disclaimer"}
POSITIVE = {"article", "content", "main", "post", "entry", "body", "story", "text", "page", "column", "blog"}
#: Content names of containers that hold one article.
WHOLE = {"article", "content", "main", "post", "entry", "story"}
#: A class that begins so tells what a page has, not what the element is.
STATES = {"no", "without", "has", "with"}
ROLES = {"navigation", "banner", "complementary", "contentinfo", "search", "alert", "alertdialog", "dialog", "form", "menu", "menubar"}
TAG_SCORE = {"article": 25.0, "main": 15.0, "div": 5.0, "section": 5.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0, "address": -3.0,
             "ol": -3.0, "ul": -3.0, "dl": -3.0, "li": -3.0}

_START = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)|<[!?/]", re.S)
#: Attributes up to the tag's end; a quote opens a value after = only, and one that nothing closes is a character like others.
_REST = re.compile(r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)*+)>""")
_PLAIN_REST = re.compile(r"([^>]*+)>")
#: An attribute of interest, or another one's quoted value, so that nothing is looked for within it.
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|aria-hidden|hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?|=\s*(?:"[^"]*"|'[^']*')""", re.I)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _attributes(raw: str) -> tuple[bool, bool, bool, bool, bool]:
    """From the attributes of a start tag: whether it is hidden or of a furniture role, has a furniture name, has a content
    name, has one apart from furniture names, and has such a one of WHOLE.
    """
    gone = negative = positive = apart = whole = False
    for m in _ATTRIBUTE.finditer(raw):
        if not m[1]:
            continue
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            for one in value.split():
                parts = [x.lower() for x in _NAME_PART.findall(one)]
                bad = not NEGATIVE.isdisjoint(parts) and parts[0] not in STATES
                negative |= bad
                if not POSITIVE.isdisjoint(parts):
                    positive = True
                    apart |= not bad
                    whole |= not bad and not WHOLE.isdisjoint(parts)
        elif name == "role":
            gone |= value.lower() in ROLES
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            gone = True
        elif name == "style":
            gone |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
    return gone, negative, positive, apart, whole


def _tokens(source: str):
    """(start, end, slash, tag name, attributes) of each tag, comment and declaration; the last three are empty for the latter two."""
    at, rest = 0, _REST
    while m := _START.search(source, at):
        at = m.end()
        if not m[0].startswith("<!--"):
            tail = (rest if m[2] else _PLAIN_REST).match(source, at)
            if tail is None and m[2]:
                # after quoted values the page ends within the tag: from here on tags end at the first >
                rest = _PLAIN_REST
                tail = rest.match(source, at)
            if tail is None:
                # no > is left, so only a comment that nothing closes may follow
                at = source.find("<!--", at)
                if at >= 0:
                    yield at, len(source), "", "", ""
                return
            at = tail.end()
        at = (yield m.start(), at, m[1] or "", m[2] or "", tail[1] if m[2] else "") or at


class Page:
    """The block tree of a page: parallel lists for elements (parents first) and text blocks in page order."""

    def __init__(self, source: str, names: bool = True):
        self.names = names  # whether a furniture name removes an element
        self.parent, self.tag, self.gone, self.weight, self.whole = [-1], ["#page"], [False], [0.0], [False]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters within links
        self._read(source)

    def _open(self, tag: str, raw: str, top: int) -> int:
        hidden, negative, positive, apart, whole = _attributes(raw) if raw else (False,) * 5
        inside = self.gone[top]
        if tag in ("html", "body"):
            hidden = negative = False
        # beside a content name, or on an article, a furniture name only lowers the score
        named = self.names and negative and not apart and tag not in ("main", "article", *TEXT_BLOCKS - {"li", "td", "blockquote", "p"})
        furniture = tag in FURNITURE or hidden or named
        if tag == "header":
            # the header of an article holds its title; the page's header is furniture
            furniture = hidden or not any(self.tag[a] in ("article", "main") for a in self._up(top))
        self.parent.append(top)
        self.tag.append(tag)
        self.gone.append(inside or furniture)
        self.weight.append(TAG_SCORE.get(tag, 0.0) + (25.0 if positive else 0.0) - (25.0 if negative else 0.0))
        self.whole.append(tag in ("article", "main") or whole and tag not in ("html", "body"))
        return len(self.tag) - 1

    def _up(self, node: int):
        while node >= 0:
            yield node
            node = self.parent[node]

    def _read(self, source: str) -> None:
        top, at, link, linked = 0, 0, 0, 0
        run: list[str] = []

        def flush():
            nonlocal linked
            if run:
                text = " ".join("".join(run).split())
                run.clear()
                if text and not self.gone[top]:
                    self.blocks.append((top, text, min(linked, len(text))))
            linked = 0

        def say(text):
            nonlocal linked
            text = html.unescape(text) if "&" in text else text
            run.append(text)
            if link:
                linked += len("".join(text.split()))

        end, tokens, skip = len(source), _tokens(source), None
        while at < end:
            try:
                start, stop, slash, tag, attributes = tokens.send(skip)
            except StopIteration:
                say(source[at:])
                break
            skip = None
            if start > at:
                say(source[at:start])
            at, tag = stop, tag.lower()
            if not tag:
                continue
            if slash:
                if tag == "a":
                    link = max(0, link - 1)
                elif tag in BLOCKS:
                    opened = next((a for a in self._up(top) if self.tag[a] == tag), None)
                    if opened:
                        flush()
                        top, link = self.parent[opened], 0
                    elif tag == "p":
                        flush()
            elif tag in RAW:
                if not attributes.endswith("/"):
                    close = re.compile(rf"</{tag}[\s/>]", re.I).search(source, at)
                    stop = source.find(">", close.end() - 1) if close else -1
                    at = skip = end if stop < 0 else stop + 1
            elif tag in ("br", "hr"):
                run.append(" ")
            elif tag == "a":
                link = 1
            elif tag in BLOCKS:
                flush()
                link = 0
                if self.tag[top] == "p" or self.tag[top] in HEADINGS and tag in HEADINGS:
                    top = self.parent[top]
                shut = CLOSES.get(tag)
                if shut:
                    for a in self._up(top):
                        if self.tag[a] in shut:
                            top = self.parent[a]
                            if tag != "tr" or self.tag[a] == "tr":
                                break
                        elif self.tag[a] in ("ul", "ol", "dl", "table", "select", "div", "section", "article"):
                            break
                if tag != "html" and (tag != "body" or "body" not in [self.tag[a] for a in self._up(top)]):
                    top = self._open(tag, attributes, top)
        flush()

    def main_blocks(self) -> list[str]:
        """The texts of the best container and its siblings, in page order; within an article all that is not mainly links."""
        n = len(self.tag)
        points, length, linked, held = [0.0] * n, [0] * n, [0] * n, [False] * n
        for node, text, links in self.blocks:
            worth = (1.0 + text.count(",") + text.count("，") + text.count("、") + min(len(text) / 100.0, 3.0)) * (1.0 - links / len(text))
            length[node] += len(text)
            linked[node] += links
            a = self.parent[node] if self.tag[node] in TEXT_BLOCKS else node
            level = 0
            while a >= 0 and level < 5:
                points[a] += worth / (1 if level == 0 else 2 if level == 1 else 3 * level)
                held[a] = True
                a, level = self.parent[a], level + 1
        for node in range(n - 1, 0, -1):  # parents come before their children
            length[self.parent[node]] += length[node]
            linked[self.parent[node]] += linked[node]
        density = [k / c if c else 0.0 for k, c in zip(linked, length)]
        score = [(points[a] + self.weight[a] if held[a] else 0.0) * (1.0 - density[a]) for a in range(n)]
        candidates = [a for a in range(n) if held[a] and not self.gone[a] and self.tag[a] not in TEXT_BLOCKS - {"td", "blockquote"}]
        if not candidates:
            return []
        best = max(candidates, key=lambda a: (score[a], -a))
        keep = [False] * n
        keep[best] = True
        home = self.parent[best]
        article = -1 if self.tag[best] in ("article", "main") else next((a for a in self._up(home) if self.whole[a]), -1)
        spine = set()
        if article >= 0:
            keep[article] = True
            for a in self._up(best):
                spine.add(a)
                if a == article:
                    break
            home = -1
        for a in range(1, n):
            if a in spine:
                keep[a] = True
            elif keep[self.parent[a]] and a != best:
                keep[a] = self.parent[a] == best or self.parent[a] not in spine or density[a] <= 0.5
            elif self.parent[a] == home and home >= 0 and a != best and not self.gone[a] and length[a]:
                if self.tag[a] in TEXT_BLOCKS:
                    keep[a] = density[a] < 0.25 and (length[a] > 80 or self.tag[a] in HEADINGS)
                else:
                    keep[a] = score[a] >= max(10.0, 0.2 * score[best])
            if keep[a] and self.tag[a] in ("ul", "ol", "div", "section", "table") and a != best and a not in spine and density[a] > 0.5:
                keep[a] = False
        return [text for node, text, links in self.blocks if keep[node]]


def main_text(source: str) -> str:
    """Main text of one page: blocks in page order, joined by one space; empty if there is none.

    Where furniture names leave nothing, the page is read again without that rule.
    """
    return " ".join(Page(source).main_blocks() or Page(source, names=False).main_blocks())


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row's whole html. Null and empty html give the empty text.

    Repeated rows give repeated rows; page_id and url pass as they are, null or not; other columns are ignored.
    """

    def run(batch: pa.RecordBatch):
        texts = [main_text(x) for x in strings(batch.column(2))]
        return batch.column(0), batch.column(1), texts, [len(x) for x in texts]

    return map_arrow(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html")), run,
                     "page_id long, url string, text string, n_chars long")

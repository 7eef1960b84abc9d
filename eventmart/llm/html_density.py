"""Main text of HTML pages by composite text density.

A page becomes a tree of its elements (tolerant: unclosed and stray tags, cut pages).
Every node gets its characters, tags, link characters and link tags, and from them
its composite density: characters per tag, adjusted by how much of them is link text
(the logarithm's base is kept at e or more, so that pages without links have one).
A container's density sum adds up its children's densities; the container with the
largest sum is the core of the page. The least density on the way from the core up to
the body is the page's threshold: the largest-sum containers elsewhere that reach it
belong to the text too. If the core lies in an ``article``, in ``main`` or in an
element that is named as the content, that element is the text, so that short
blocks (headings, captions, one-line paragraphs) beside dense ones stay.

Elements that are never main text are left out before anything is counted: scripts,
styles, forms and their controls, menus, footers, sidebars, headers outside the
article, and elements whose id, class or role names an advert, notice, sidebar, menu or
reader comments (unless the main element, the first h1 or an article lies in them).
The text is returned in blocks, in page order: character references decoded, white
space inside a block made one space, blocks joined by an empty line.

Defined cases: a null or empty page, or one without text, gives the empty text;
a page without any tag is one block; repeated rows and null ids give a row each; an
empty table gives an empty result; of other columns, those named like the new ones
are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from eventmart.llm.common import free_name

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math q ruby rb rp rt s samp small "
                   "span strike strong sub sup time tt u var wbr br".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption caption td th tr summary address".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: elements that are never main text
DROPPED = frozenset("head script style noscript template iframe object embed applet svg canvas audio video map nav footer aside form "
                    "menu dialog button select option textarea input datalist fieldset title".split())
#: a start tag that ends an open paragraph
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                   "h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: a start tag that ends an open element of these, up to one of the others
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
        "option": (("option",), ("select",))}
#: words of an id, class or role that name an element as something else than main text
NAMED_AWAY = frozenset("ad ads advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors promo "
                       "promos promotion banner sidebar sidebars sidenav aside menu menus submenu nav navbar navigation topnav breadcrumb "
                       "breadcrumbs footer masthead cookie cookies consent gdpr notice notices notification notifications alert popup popover "
                       "modal overlay newsletter subscribe subscription signup login paywall share sharing sharebar social related recommended "
                       "recommendations comment comments commentlist commentary disqus responses replies respond discussion widget widgets toolbar "
                       "pagination pager skip complementary contentinfo search searchbox".split())
#: those of them that hold even where an article lies below
NAMED_COMMENTS = frozenset("comment comments commentlist commentary disqus responses replies respond discussion".split())
#: words that name a header (left out unless it lies in the article)
NAMED_HEADER = frozenset("header siteheader topbar".split())
#: words that name an article, whose own header stays
NAMED_ARTICLE = frozenset("article post entry story".split())
#: words that name the content
NAMED_CONTENT = frozenset("article articlebody post postbody story storybody entry content contents maincontent main body text".split())
#: words that turn the one after them into a mere remark, as in ``no-sidebar``
REMARKS = frozenset("no has with without is hide show".split())

_CUT_TAG = re.compile("<[A-Za-z/!?]")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _names(attrs: list[tuple[str, str | None]]) -> set[str]:
    """The words of an element's id, class and role."""
    out: set[str] = set()
    for key, value in attrs:
        if key in ("id", "class", "role", "itemprop") and value:
            for name in value.split():
                words = [w.lower() for w in _WORDS.findall(name)]
                out.update(w for before, w in zip(["", *words], words, strict=False) if before not in REMARKS)
                if not REMARKS.intersection(words):
                    out.add("".join(words))
    return out


def _hidden(attrs: list[tuple[str, str | None]]) -> bool:
    return any(key == "hidden" or (key == "style" and value and "display:none" in value.replace(" ", "").lower()) for key, value in attrs)


class _Tree(HTMLParser):
    """Elements in page order (parents before children) and the text segments among them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.names, self.hidden = ["#root"], [-1], [set()], [False]
        self.open, self.is_open = [0], {"#root": 1}
        #: for each open block, how many inline elements of a kind are open in it
        self.inline: list[dict[str, int]] = [{}]
        #: (node, text) in page order; text "" is where a block starts or ends
        self.segments: list[tuple[int, str]] = []

    def _close(self, to: int) -> None:
        """Close the open elements down to the stack's first `to`."""
        while len(self.open) > to:
            tag = self.tag[self.open.pop()]
            self.is_open[tag] -= 1
            if tag in INLINE:
                self.inline[-1][tag] -= 1
            else:
                self.inline.pop()
                self.segments.append((self.open[-1], ""))

    # what is left open at the end of the page swallows the rest, as in browsers
    def parse_comment(self, i: int, report: int = 1) -> int:
        end = self.rawdata.find("-->", i + 4)
        return len(self.rawdata) if end < 0 else end + 3

    def parse_html_declaration(self, i: int) -> int:
        return self.parse_comment(i) if self.rawdata.startswith("<!--", i) else self.parse_pi(i)

    def parse_pi(self, i: int) -> int:
        end = self.rawdata.find(">", i + 2)
        return len(self.rawdata) if end < 0 else end + 1

    def parse_bogus_comment(self, i: int, report: int = 1) -> int:
        return self.parse_pi(i)

    def _close_open(self, tags: tuple[str, ...], within: tuple[str, ...] = ()) -> None:
        """Close the innermost open element of tags, unless one of within lies inside of it."""
        if not any(self.is_open.get(t) for t in tags):
            return
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[at]]
            if tag in within:
                return
            if tag in tags:
                if tag == "tr" or tags[0] != "tr":
                    return self._close(at)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_P and self.is_open.get("p"):
            self._close_open(("p",))
        if tag in ENDS:
            self._close_open(*ENDS[tag])
        if tag in HEADINGS and self.tag[self.open[-1]] in HEADINGS:
            self._close(len(self.open) - 1)
        if tag == "body" and self.is_open.get("head"):
            self._close_open(("head",))
        if tag == "main":  # never inside these: one of them was left open
            for outer in ("nav", "header", "footer", "aside"):
                self._close_open((outer,))
        if tag == "br":
            self.segments.append((self.open[-1], " "))
            return
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.names.append(_names(attrs) if attrs else set())
        self.hidden.append(bool(attrs) and _hidden(attrs))
        if tag not in INLINE:
            self.segments.append((self.open[-1], ""))
        if tag not in VOID:
            self.open.append(len(self.tag) - 1)
            self.is_open[tag] = self.is_open.get(tag, 0) + 1
            if tag in INLINE:
                self.inline[-1][tag] = self.inline[-1].get(tag, 0) + 1
            else:
                self.inline.append({})

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash closes nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.segments.append((self.open[-1], " "))
        elif self.inline[-1].get(tag) if tag in INLINE else self.is_open.get(tag):  # inline ends close no block
            self._close_open((tag,))

    def handle_data(self, data: str) -> None:
        self.segments.append((self.open[-1], data))


def _parse(html: str) -> _Tree:
    tree = _Tree()
    end = html.rfind(">") + 1  # what looks like a tag behind it is a cut one
    cut = _CUT_TAG.search(html, end)
    tree.feed(html[:cut.start()] if cut else html)
    tree.close()
    return tree


def _left_out(tree: _Tree) -> list[bool]:
    """Whether a node, by itself or by an ancestor, is never main text."""
    n = len(tree.tag)
    # what lies below a node: 2 the main element or the page's first h1, 1 an article
    holds = [0] * n
    title = next((i for i in range(n) if tree.tag[i] == "h1"), -1)
    for i in range(n - 1, 0, -1):
        own = 2 if i == title or tree.tag[i] == "main" else int(tree.tag[i] == "article" and not tree.names[i] & NAMED_AWAY)
        up = tree.parent[i]
        holds[up] = max(holds[up], holds[i], own)
    away, in_article = [False] * n, [False] * n
    for i in range(1, n):
        up, tag, names = tree.parent[i], tree.tag[i], tree.names[i]
        in_article[i] = in_article[up] or tag in ("article", "main") or bool(names & NAMED_ARTICLE)
        if away[up] or tree.hidden[i]:
            away[i] = True
        elif tag in ("html", "body", "main"):
            continue
        elif tag in DROPPED:
            away[i] = not (tag in ("form", "fieldset") and holds[i])
        elif tag == "header":
            away[i] = not in_article[up]
        elif names & NAMED_AWAY:
            away[i] = holds[i] < (2 if names & NAMED_COMMENTS else 1)
        elif names & NAMED_HEADER:
            away[i] = not in_article[up]
    return away


def composite_density(chars: int, tags: int, link_chars: int, link_tags: int, body_chars: int, body_link_chars: int) -> float:
    """Characters per tag, times a logarithm that falls with the share of link text."""
    if not chars:
        return 0.0
    tags, plain = tags or 1, chars - link_chars
    base = math.e - 1 + math.log(chars / (plain or 1) * link_chars + body_link_chars / (body_chars or 1) * chars + math.e)
    ratio = chars / (link_chars or 1) * tags / (link_tags or 1)
    return chars / tags * max(0.0, math.log(ratio) / math.log(base))


def _chosen(tree: _Tree, away: list[bool]) -> list[bool]:
    """Whether a node lies in the subtrees that the densities select."""
    n = len(tree.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    own = [0] * n
    for node, text in tree.segments:
        if text and not away[node]:
            own[node] += sum(map(len, text.split()))
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[tree.parent[i]] or tree.tag[i] == "a"
    for i in range(n - 1, -1, -1):
        chars[i] += own[i]
        if in_link[i]:
            link_chars[i] += own[i]
        if i and not away[i]:
            up = tree.parent[i]
            chars[up] += chars[i]
            tags[up] += tags[i] + 1
            link_chars[up] += link_chars[i]
            link_tags[up] += link_tags[i] + (tree.tag[i] == "a")
    body = next((i for i in range(n) if tree.tag[i] == "body"), 0)
    density = [composite_density(chars[i], tags[i], link_chars[i], link_tags[i], chars[body], link_chars[body]) for i in range(n)]
    sums = [float(own[i]) for i in range(n)]
    for i in range(1, n):
        if not away[i]:
            sums[tree.parent[i]] += density[i]
    candidate = [not away[i] and chars[i] > 0 and tree.tag[i] not in INLINE and tree.tag[i] not in PARAGRAPHS and not in_link[i] for i in range(n)]
    candidate[0] = chars[0] > 0
    inside = [False] * n
    core = max((i for i in range(n) if candidate[i]), key=lambda i: (sums[i], -i), default=None)
    if core is None:
        return inside

    path = [core]
    while path[-1] > 0:
        path.append(tree.parent[path[-1]])
    articles = [i for i in path if tree.tag[i] == "article"] or [i for i in path if tree.tag[i] == "main"]
    named = [i for i in path if tree.names[i] & NAMED_CONTENT and tree.tag[i] not in ("body", "html")]
    if articles or named:
        inside[(articles or named)[-1]] = True
    else:
        threshold = min((density[i] for i in path if i >= body), default=density[core])
        inside[core] = True
        # the largest sum below each other node that reaches the threshold
        best = list(range(n))
        for i in range(n - 1, 0, -1):
            up = tree.parent[i]
            if candidate[best[i]] and (not candidate[best[up]] or sums[best[i]] > sums[best[up]]):
                best[up] = best[i]
        on_path = set(path)
        for i in range(1, n):
            if tree.parent[i] in on_path and i not in on_path and not away[i] and density[i] >= threshold:
                inside[best[i] if candidate[best[i]] else i] = True
        # headings right beside or above the core belong to it
        for i in range(1, core):
            if tree.tag[i] in HEADINGS and tree.parent[i] in on_path and not away[i]:
                inside[i] = True
    for i in range(1, n):
        inside[i] = inside[i] or inside[tree.parent[i]]
    return inside


def main_text(html: str | None) -> str:
    """The main text of a page, its blocks joined by an empty line."""
    if not html:
        return ""
    tree = _parse(html)
    away = _left_out(tree)
    inside = _chosen(tree, away)
    blocks: list[list[str]] = [[]]
    for node, text in tree.segments:
        if not text:
            blocks.append([])
        elif inside[node] and not away[node]:
            blocks[-1].append(text)
    return "\n\n".join(t for t in (" ".join("".join(b).split()) for b in blocks) if t)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """pages with two columns more: the main text and its code points (``n_chars``).

    Pages are independent of each other: one pass, no exchange, one page's tree in memory at a time.
    """
    @pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield pd.Series([main_text(h) for h in htmls], dtype=object)

    made = free_name(pages, "main_text")
    with_text = pages.withColumn(made, F.coalesce(text(F.col(html_col)), F.lit("")))
    return with_text.withColumns({text_col: F.col(made), "n_chars": F.length(made).cast("long")}).drop(made)

"""HTML extraction by composite text density (Sun, Song & Liao 2011).

A page becomes a tree. Every node has its characters, tags, link characters and link tags; its composite density is
characters per tag, damped by its links relative to those of the body. The density sum of a node adds up its
children's densities: it is largest where many dense blocks stand side by side. The node with the largest sum is the
content; the smallest density on its path to the body is the threshold that other parts must reach. A part that lies in
a main or article is widened to it, as the page marks what belongs together; on a page whose densest node lies in one,
text outside of such marks is not the article. A marked article reaches the threshold also by its characters per tag
alone, so that links inside of an article do not cost it its place. Elements whose name, role or whole class token says what they are (menus,
forms, comments ...) are taken out first.
"""
from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanspark.session import ship_package

from .base import c

#: Element names of the HTML standard, by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset("head script style textarea title xmp iframe noembed noframes noscript template svg math object "
                   "audio video canvas select button datalist map".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p "
                  "pre section summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - frozenset("body html li dd dt tr td th thead tbody tfoot caption option optgroup legend summary".split())
#: An element of the first kind ends an open one of the second kind, up to the nearest element of the third.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
           "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
           "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select", "datalist"})}
#: What is not the article: by element, by role, and by the tokens of class.
NOT_ARTICLE = frozenset("nav footer aside form menu dialog".split())
NOT_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
NOT_ARTICLE_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead topbar footer sidebar aside ad ads advert adverts advertisement "
    "advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay newsletter "
    "subscribe subscription signup login social share sharing related recommended recommendations comment comments commentlist respond "
    "replies disqus discussion widget toolbar pagination pager search skip".split())
HEADER_WORDS = frozenset(("header",))  # an article's own header belongs to it
COMMENT_WORDS = frozenset("comment comments reply replies".split())
#: Only a whole class token counts: one of the words above, alone or with such words and these.
PART_WORDS = frozenset(
    "area bar block body bottom box button buttons container content form global icons inner item items left links list main page post posts "
    "primary right secondary section site top unit wrap wrapper".split())
#: Ids that say as much by themselves, outside of the article and not of headings; no part of an id ever does.
NOT_ARTICLE_IDS = frozenset("nav navbar navigation menu breadcrumbs masthead topbar footer sidebar comments commentlist respond disqus_thread".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that can lead into the text beside them.
LEADS = HEADINGS | frozenset("p blockquote hgroup figure".split())
#: Names that are never judged by class, and those that hold a page's article (an article may be a comment).
SAFE, WHOLE = frozenset(("html", "body", "main")), frozenset(("article", "main"))

#: Elements nested deeper become siblings, as in browsers.
DEPTH = 512

_TAG = re.compile(r"<!--.*?(?:-->|--!>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
                  r"|<([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)", re.S)
_NAMED = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[a-z]+")


class Page:
    """The tree of one page in document order. Node 0 stands above everything."""

    def __init__(self, source: str):
        self.tag, self.parent, self.out, self.id_out, self.header = [""], [-1], [False], [False], [False]
        self.events: list[tuple[int, int, str]] = []  # (node, kind, text): 0 start, 1 end, 2 text
        self._read(source)

    def _read(self, source: str) -> None:
        tag, parent, events = self.tag, self.parent, self.events
        stack, at, n = [0], 0, len(source)

        def text(end: int) -> None:
            if end > at:
                part = source[at:end]
                events.append((stack[-1], 2, html.unescape(part) if "&" in part else part))

        def close(to: int) -> None:  # ends all elements above place ``to`` of the stack
            while len(stack) > to:
                events.append((stack.pop(), 1, ""))

        while at < n:
            m = _TAG.search(source, at)
            if m is None:
                text(n)
                break
            text(m.start())
            at = m.end()
            name = (m[1] or m[2] or "").lower()
            if m[1]:
                place = next((i for i in range(len(stack) - 1, 0, -1) if tag[stack[i]] == name), 0) 
                if place:
                    close(place)
                continue
            if not name:
                continue
            if name in ENDS_P:
                self._end(stack, close, {"p"}, {"table", "td", "th", "button", "object", "caption"})
            if name in IMPLIED:
                self._end(stack, close, *IMPLIED[name])
            close(min(len(stack), DEPTH))
            node = len(tag)
            tag.append(name)
            parent.append(stack[-1])
            out, id_out, header = self._named(name, m[3]) if m[3] else (False, False, False)
            self.out.append(name in HIDDEN or out)
            self.id_out.append(id_out)
            self.header.append(name == "header" or header)
            events.append((node, 0, ""))
            stack.append(node)
            if name in VOID or m[3].endswith("/") and name not in BLOCK and name not in RAW and name != "a":
                close(len(stack) - 1)
            elif name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                close(len(stack) - 1)
                at = end.end() if end else n
        close(1)

    def _end(self, stack, close, names, limits) -> None:
        for i in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[i]]
            if name in names:
                close(i)
                return
            if name in limits:
                return

    @staticmethod
    def _named(name: str, attributes: str) -> tuple[bool, bool, bool]:
        """Whether hidden, role or a whole class token says that an element is not the article, whether its id does,
        and whether its class calls it a header."""
        out = id_out = header = False
        words = COMMENT_WORDS if name == "article" else NOT_ARTICLE_WORDS
        for m in _NAMED.finditer(attributes):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name in SAFE:
                break
            if key == "hidden":
                out = out or m.group(0).lower() == "hidden"
            elif key == "role":
                out = out or value.strip() in NOT_ARTICLE_ROLES
            elif name in HEADINGS:
                continue
            elif key == "id":
                id_out = value.strip() in NOT_ARTICLE_IDS
            else:
                for token in value.split():
                    parts = set(token.replace("_", "-").split("-"))
                    out = out or not parts.isdisjoint(words) and parts <= words | PART_WORDS
                    header = header or not parts.isdisjoint(HEADER_WORDS) and parts <= HEADER_WORDS | PART_WORDS | {"entry", "article"}
        return out, id_out, header

    def _gone(self, believe: bool) -> tuple[list[bool], list[bool]]:
        """Which nodes are taken out, with all that is in them, and which lie in an article or main. Without
        ``believe`` forms, classes and ids are not judged."""
        tag, parent, n = self.tag, self.parent, len(self.tag)
        hidden, inside, within = [False] * n, [False] * n, [False] * n
        for i in range(1, n):
            hidden[i] = tag[i] in HIDDEN or hidden[parent[i]]
        whole = "article" if any(tag[i] == "article" and not self.out[i] and not hidden[i] for i in range(n)) else "main"
        out = self.out[:]
        for i in range(1, n):
            within[i] = tag[parent[i]] == whole and not out[parent[i]] or within[parent[i]]
            out[i] = out[i] or self.id_out[i] and not within[i]
            inside[i] = tag[i] in WHOLE and not out[i] or inside[parent[i]]
        holds = [False] * n  # an article or main, or the page's title, itself or below
        for i in range(n - 1, 0, -1):
            holds[i] = holds[i] or tag[i] in WHOLE and not out[i] and not hidden[i]
            holds[parent[i]] = holds[parent[i]] or holds[i]
        titled = [False] * n
        for i in range(n - 1, 0, -1):
            titled[i] = titled[i] or tag[i] == "h1" and not hidden[i]
            titled[parent[i]] = titled[parent[i]] or titled[i] and not self.header[i]
        gone = hidden
        for i in range(1, n):
            sure = tag[i] in NOT_ARTICLE and tag[i] != "form" or self.header[i] and not inside[i]
            named = believe and (out[i] or tag[i] == "form") and (within[i] or not titled[i])
            gone[i] = gone[i] or gone[parent[i]] or (sure or named) and not holds[i]
        return gone, inside

    def measure(self, gone: list[bool]) -> tuple[list[int], list[int], list[float], list[float], list[int], list[int]]:
        """Characters (without white space), tags, composite density and density sum of every node that stays; its links
        and their characters."""
        tag, parent, n = self.tag, self.parent, len(self.tag)
        size, tags, link_size, links, linked = [0] * n, [0] * n, [0] * n, [0] * n, [False] * n
        for i in range(1, n):
            linked[i] = tag[i] == "a" or linked[parent[i]]
        for node, kind, text in self.events:
            if kind == 2 and not gone[node]:
                chars = len("".join(text.split()))
                size[node] += chars
                link_size[node] += chars if linked[node] else 0
        for i in range(n - 1, 0, -1):
            if not gone[i]:
                up = parent[i]
                size[up] += size[i]
                link_size[up] += link_size[i]
                tags[up] += tags[i] + 1
                links[up] += links[i] + (tag[i] == "a")
        body = self.body()
        of_body = link_size[body] / max(1, size[body])

        def density(i: int) -> float:
            if not size[i]:
                return 0.0
            base = math.log(size[i] * link_size[i] / max(1, size[i] - link_size[i]) + of_body * size[i] + math.e)
            share = size[i] / max(1, link_size[i]) * (max(1, tags[i]) / max(1, links[i]))
            return size[i] / max(1, tags[i]) * max(0.0, math.log(max(share, 1e-9)) / math.log(base) if base > 1 else math.log(max(share, 1.0)))

        dense = [0.0 if gone[i] else density(i) for i in range(n)]
        sums = [0.0] * n
        for i in range(1, n):
            sums[parent[i]] += dense[i]
        return size, tags, dense, sums, links, link_size

    def body(self) -> int:
        return next((i for i in range(1, len(self.tag)) if self.tag[i] == "body"), 0)

    def main_text(self) -> str:
        tag, parent, n, body = self.tag, self.parent, len(self.tag), self.body()
        for believe in (True, False):  # where what names say leaves nothing, they are not believed
            gone, inside = self._gone(believe)
            size, tags, dense, sums, links, link_size = self.measure(gone)
            if size[body]:
                break
        else:
            return ""
        # the largest sum of each subtree, and where it is (of equal ones the outermost)
        best = list(range(n))
        for i in range(n - 1, 0, -1):
            if not gone[i] and sums[best[i]] > sums[best[parent[i]]]:
                best[parent[i]] = best[i]
        top = best[body] if sums[best[body]] > 0 else body
        path, i = [body], top
        while i > 0 and i != body:
            path.append(i)
            i = parent[i]
        threshold = min(dense[i] for i in path)
        plain = min(size[i] / max(1, tags[i]) for i in path)
        around = [0] * n  # the outermost main or article around each node
        for i in range(1, n):
            around[i] = around[parent[i]] or (i if tag[i] in WHOLE and not gone[i] else 0)
        chosen = [False] * n
        chosen[around[top] or top] = True
        for i in range(1, n):  # other parts as dense as the path to the body; an article also by its characters a tag alone
            reached = dense[i] >= threshold and dense[i] > 0 or tag[i] in WHOLE and size[i] >= plain * max(1, tags[i])
            if not gone[i] and size[i] and reached and tag[i] in BLOCK and tag[i] not in ("html", "body"):
                if inside[i]:
                    chosen[around[i]] = True
                elif not inside[top]:
                    chosen[best[i] if sums[best[i]] > 0 else i] = True
        if not inside[top]:
            self._lead_in(chosen, gone, body)
        after = self._after_heading()
        kept = [False] * n
        for i in range(n):  # bullets that are nothing but links are a menu, but not under a heading of theirs
            menu = tag[i] == "ul" and links[i] > 2 and link_size[i] == size[i] and not after[i]
            kept[i] = (i and kept[parent[i]] or chosen[i]) and not gone[i] and not (menu and not chosen[i])
        return "\n".join(self._blocks(kept))

    def _lead_in(self, chosen: list[bool], gone: list[bool], body: int) -> None:
        """Headings and paragraphs that stand right before a chosen part, if a heading is among them, belong to it."""
        last: dict[int, list[int]] = {}  # parent -> its children so far that lead into the next
        for i in range(1, len(self.tag)):
            run = last.setdefault(self.parent[i], [])
            if chosen[i] and any(self.tag[x] in HEADINGS for x in run):
                for x in run:
                    chosen[x] = True
            if self.tag[i] in LEADS and not gone[i]:
                run.append(i)
            elif self.tag[i] in BLOCK and self.tag[i] != "hr":
                run.clear()

    def _after_heading(self) -> list[bool]:
        """Which nodes come right after a heading, or after the element that only holds it."""
        out, heading = [False] * len(self.tag), False
        for node, kind, text in self.events:
            if kind == 0:
                out[node] = heading
            elif kind == 1:
                heading = self.tag[node] in HEADINGS or heading and self.tag[node] in ("header", "hgroup", "div")
            elif text.strip():
                heading = False
        return out

    def _blocks(self, kept: list[bool]):
        parts: list[str] = []
        for node, kind, text in self.events:
            if kind == 2:
                if kept[node]:
                    parts.append(text)
            elif self.tag[node] in BLOCK:
                block = " ".join("".join(parts).split())
                parts.clear()
                if block:
                    yield block
            elif self.tag[node] == "br" and kind == 0:
                parts.append(" ")
        block = " ".join("".join(parts).split())
        if block:
            yield block


def extract(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def extract_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id, url, text``, the main text of the whole page.

    Character references are decoded, white space inside a block is one space, blocks are joined by one line feed in
    page order; a ``br`` is white space, inline elements leave no trace. Pages that are null, empty or hold no text
    outside of what is taken out give an empty text; broken markup is read as browsers read it (open elements end with
    their parent). Repeated rows are each extracted; an empty table gives an empty result."""
    ship_package(df.sparkSession)
    rows = df.select(c(id_col).alias("page_id"), c(url_col).alias("url"), c(html_col).cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([extract(x.as_py()) for x in part.column(2)], pa.string())],
                    names=["page_id", "url", "text"])

    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")

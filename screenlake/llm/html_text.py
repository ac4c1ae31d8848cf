"""Main text of HTML pages by composite text density.

The page becomes a tree (unclosed and misnested tags are mended as browsers do); parts that are never main text (scripts, menus,
asides, hidden parts) are cut.  Forms and boxes named as adverts, notices, comments ... are cut where an article or main element
stands beside them; else one that holds such an element, or ``SHARE`` of the text outside links, stays and its own boxes are
judged alike within it.  Every node then gets the
composite density of Sun, Song and Liao (SIGIR 2011): characters per tag, lowered where many of them are link text relative to
the page.  A node's density sum adds those of its children.  The node with the largest sum is the content; the
smallest density on its path to the body is the threshold by which its siblings, and those of its ancestors, count as content too.
A content node inside an article or main element stands for that whole element.

Blocks come in page order, white space inside a block becomes one blank.  All of the page is read, nothing is capped.

Defined cases: null or empty html, or a page without main text, gives the empty string; every row is extracted on its own, so
repeated rows and null ids stay; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CUT = frozenset("""head script style noscript template iframe object svg canvas video audio nav footer aside form button
select textarea input dialog menu""".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol option p pre section summary table tbody tfoot thead
tr ul""".split())
CELL = frozenset("td th br".split())
CLOSES_P = BLOCK - {"html", "body", "option", "caption", "legend"}
# opening one of these closes an open one of the named kinds, up to the named limits
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select", "datalist"})}
P_LIMIT = frozenset("article aside blockquote body div footer form header html li main nav section table td th button".split())
# words of a class, id or role that name parts beside the main text
BESIDE = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
contentinfo complementary consent cookie cookies copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter
notice notices pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing
sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets alert announcement toc""".split())
ADVERTS = frozenset("ad ads advert adverts advertisement advertising".split())  # the page's own text in one only with an article
READERS = frozenset("comment comments disqus replies reply respond".split())
KEEP = frozenset(("html", "body", "article", "main"))
SHARE, READERS_SHARE = 0.5, 0.9  # of the text in a box's surroundings; the second one for boxes named after READERS


class _Tree(HTMLParser):
    """Nodes in page order: tag, parent, and the node's pieces (a text, or the number of a child)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.parts, self.cut = ["html"], [-1], [[]], [False]
        self.named: dict[int, float] = {}  # boxes that the page's text decides on, and the share they need to stay
        self.open = [0]
        self.at: dict[str, list[int]] = {}  # places of open tags, by name

    def _inside(self, tags) -> bool:
        return any(self.at.get(t) for t in tags)

    def _last(self, tags) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def _close(self, names, limits) -> None:
        k = self._last(names)
        if k and k >= self._last(limits):
            for node in self.open[k:]:
                self.at[self.tag[node]].pop()
            del self.open[k:]

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "html":
            return
        if tag == "body" and self._inside(("head",)):
            self._close(("head",), ())
        if tag in CLOSES_P:
            self._close(("p",), P_LIMIT)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
            if tag == "tr":
                self._close(("tr",), ("table",))
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.parts.append([])
        self.cut.append(self._beside(tag, attrs))
        if not self.cut[-1] and (share := self._share(tag, attrs)) is not None:
            self.named[node] = share
        self.parts[self.open[-1]].append(node)
        if tag not in VOID:
            self.at.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)  # a slash closes void elements only

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        self._close((tag,), KEEP if tag not in KEEP else ("body",))

    def handle_data(self, data: str) -> None:
        self.parts[self.open[-1]].append(data)

    def unknown_decl(self, data: str) -> None:
        if data.startswith("CDATA["):
            self.parts[self.open[-1]].append(data[6:])

    def _beside(self, tag: str, attrs) -> bool:
        if tag in CUT and tag != "form":
            return True
        if tag == "header":
            return not self._inside(("article", "main"))
        if tag in KEEP:
            return False
        return any(name == "hidden" or name == "aria-hidden" and value == "true"
                   or name == "style" and value and "display:none" in value.replace(" ", "").lower() for name, value in attrs)

    def _share(self, tag: str, attrs) -> float | None:
        """The share of the text around it that a form or a box named as one beside the main text needs to stay."""
        if tag in KEEP:
            return None
        words = {w for name, value in attrs if name in ("class", "id", "role") and value
                 for w in value.lower().replace("-", " ").replace("_", " ").split()}
        if not ADVERTS.isdisjoint(words):
            return float("inf")
        if not READERS.isdisjoint(words):
            return READERS_SHARE
        return SHARE if tag == "form" or not BESIDE.isdisjoint(words) else None


def _judge_boxes(t: _Tree) -> None:
    """Cuts the named boxes that aren't the main text's own."""
    if not t.named:
        return
    n = len(t.tag)
    gone, box, in_link = [False] * n, [0] * n, [False] * n  # box: the innermost named one around a node, itself included
    for i in range(n):
        p = max(t.parent[i], 0)
        gone[i] = t.cut[i] or gone[p]
        box[i] = i if i in t.named else box[p]
        in_link[i] = in_link[p] or t.tag[i] == "a"
    chars, main, own = [0] * n, [False] * n, set()  # own: boxes with an article that lies in no box within them
    for i in range(n - 1, -1, -1):
        if gone[i]:
            continue
        if not in_link[i]:
            chars[i] += sum(len(" ".join(x.split())) for x in t.parts[i] if isinstance(x, str))
        if t.tag[i] in ("article", "main"):
            main[i] = True
            own.add(box[i])
        if i:
            chars[t.parent[i]] += chars[i]
            main[t.parent[i]] = main[t.parent[i]] or main[i]
    for i in sorted(t.named):  # outer boxes first
        around = box[t.parent[i]]
        if around and t.cut[around]:
            t.cut[i] = True
        else:
            t.cut[i] = around in own or not (main[i] or chars[i] > 0 and chars[i] >= t.named[i] * chars[around])


def _densities(t: _Tree) -> list[float]:
    n = len(t.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(n):
        p = t.parent[i]
        if p >= 0:
            t.cut[i] = t.cut[i] or t.cut[p]
            in_link[i] = in_link[p] or t.tag[i] == "a"
    for i in range(n - 1, -1, -1):  # children come after their parents
        if t.cut[i]:
            continue
        own = sum(len(" ".join(x.split())) for x in t.parts[i] if isinstance(x, str))
        chars[i] += own
        if in_link[i]:
            link_chars[i] += own
        p = t.parent[i]
        if p >= 0:
            chars[p] += chars[i]
            tags[p] += tags[i] + 1
            link_chars[p] += link_chars[i]
            link_tags[p] += link_tags[i] + (t.tag[i] == "a")
    body_chars, body_links = max(1, chars[0]), link_chars[0]
    out = [0.0] * n
    for i in range(n):
        c = chars[i]
        if t.cut[i] or not c:
            continue
        k, lc, lt = max(1, tags[i]), max(1, link_chars[i]), max(1, link_tags[i])
        base = math.log(c / max(1, c - link_chars[i]) * link_chars[i] + body_links / body_chars * c + math.e)
        out[i] = c / k * math.log(max(c / lc * k / lt, 1.0)) / base
    return out


def _content(t: _Tree) -> list[int]:
    """The roots of the content, in page order."""
    density = _densities(t)
    n = len(t.tag)
    total = [0.0] * n
    for i in range(1, n):
        total[t.parent[i]] += density[i]
    for i in range(n):
        if not any(not isinstance(x, str) for x in t.parts[i]):
            total[i] = density[i]  # a leaf stands for its text
    alive = [i for i in range(n) if density[i] > 0]
    if not alive:
        return [i for i in range(n) if not t.cut[i] and t.parent[i] < 0]
    best = max(alive, key=lambda i: (total[i], -i))
    path = [best]
    while t.parent[path[-1]] >= 0:
        path.append(t.parent[path[-1]])
    for up in reversed(path):
        if t.tag[up] in ("article", "main"):
            best = up
    path = path[path.index(best):]
    least = min([density[i] for i in path if t.tag[i] not in ("html",)] or [density[best]])
    chosen = {best}
    if t.tag[best] not in ("article", "main"):
        for below, up in zip(path, path[1:]):  # siblings as dense as the thinnest node on the way
            chosen |= {x for x in t.parts[up] if not isinstance(x, str) and x != below and density[x] >= least}
    else:
        chosen |= {i for i in alive if t.tag[i] == t.tag[best] and t.parent[i] == t.parent[best]}
    return sorted(chosen)


def main_text(html: str | None) -> str:
    if not html:
        return ""
    t = _Tree()
    t.feed(html + "-->" if html.rfind("<!--") > html.rfind("-->") else html)  # an open comment runs to the end
    t.close()
    _judge_boxes(t)
    blocks, words = [], []

    def flush() -> None:
        if line := " ".join("".join(words).split()):
            blocks.append(line)
        words.clear()

    roots = _content(t)
    for root in roots:
        flush()
        stack: list = [root]
        while stack:
            x = stack.pop()
            if x is flush:
                flush()
            elif isinstance(x, str):
                words.append(x)
            elif not t.cut[x]:
                tag = t.tag[x]
                if tag in BLOCK:
                    flush()
                    stack.append(flush)
                elif tag in CELL:
                    words.append(" ")
                stack.extend(reversed(t.parts[x]))
    flush()
    return "\n\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 ["page_id", "url", "text"])

    read = pages.select(F.col("page_id").cast("long"), "url", "html")
    return read.mapInArrow(run, "page_id long, url string, text string")

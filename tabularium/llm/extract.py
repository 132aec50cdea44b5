"""Main text of web pages by composite text density.

Each page becomes a list of nodes in page order (parents before children), so all subtree sums are one
backward pass and depth is no concern. Elements that are boilerplate by their kind, role or class go first.
Every node then gets its link-adjusted characters per tag, and every parent the sum over its children. The
node with the largest sum sets the threshold: the smallest density on its path to the body. Nodes that
reach the threshold contribute their maximum-sum subtree, with the headings around them; an ``article`` or ``main`` around (or, if
it holds most of the text, inside) the best subtree is taken as a whole.

Text: character references decoded, ``br`` and white space inside a block one space, blocks trimmed and
joined in page order by an empty line. Nothing is cut.

Defined results: null or empty html, and pages without text, give an empty text. Broken markup is read
leniently: missing and stray end tags, unclosed comments, scripts and quotes. Repeated pages give repeated rows.
Extra columns of the table are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import table

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("td th tr tbody thead tfoot caption head body html option optgroup legend".split())
#: start tag: (open elements that it ends, where the search for them stops)
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
}
P_STOPS = frozenset("table td th button object caption html".split())

# Kinds, roles and names of boilerplate.
DROP_KINDS = frozenset(
    "head nav header footer aside form script style noscript template iframe svg canvas select textarea menu "
    "object audio video title input xmp noembed noframes".split()
)
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Names that mean boilerplate whatever stands beside them.
DROP_NAMES = frozenset(
    "adbox adslot adunit adsbygoogle advert adverts advertisement advertisements sponsored promos sidebar sidebars nav "
    "navbar breadcrumb breadcrumbs footer masthead cookie cookies gdpr newsletter disqus pagination pager".split()
)
#: Names that articles use too (related-work, share-prices): all parts of the name must be names or furniture.
DROP_ALONE = frozenset(
    "ad ads adv advertising sponsor sponsors promo promotion banner menu menus navigation header consent notice notices "
    "alert alerts popup modal overlay subscribe signup login social share sharing related recommended recommendations "
    "comment comments reply replies respond widget widgets toolbar copyright skip".split()
)
FURNITURE = frozenset(
    "area articles bar block blocks body bottom box button buttons col column container content count feed fixed form "
    "global group header heading icon icons inline inner item items left link links list main media mobile "
    "module panel page post posts primary right row secondary section site small sticky stories text this thread title "
    "to top unit user users wrap wrapper".split()
)
WITHOUT = frozenset("has no not with without".split())  # has-sidebar names what surrounds a sidebar
OWN_HEADER = frozenset("article post entry content story main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

TOKEN = re.compile(
    r"<(?:(?P<comment>!--)|(?P<other>[!?])|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?P<close>>?))"
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
OPEN = re.compile(r"(?:^|\s)open(?=[\s=/]|$)", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def _boilerplate_name(parts: list[str]) -> bool:
    """Whether the parts of a class or id name boilerplate."""
    known = DROP_NAMES | DROP_ALONE
    pairs = {i: a + b for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in known}  # sideBar, sign-up
    bad = {p for i, p in enumerate(parts) if p in known and (not i or parts[i - 1] not in WITHOUT)} | set(pairs.values())
    if not bad or bad <= {"header"} and OWN_HEADER.intersection(parts):
        return False
    if bad & DROP_NAMES:
        return True
    paired = {j for i in pairs for j in (i, i + 1)}
    return all(i in paired or p in known or p in FURNITURE or p.isdigit() for i, p in enumerate(parts))


class Page:
    """Nodes of one page in page order, and its texts with the node and the block they stand in."""

    def __init__(self, source: str):
        self.kind, self.parent, self.attrs = ["html"], [-1], [""]
        self.texts: list[tuple[int, int, str]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack, block, at, size = [0], 0, 0, len(source)
        kind, parent, attrs, texts = self.kind, self.parent, self.attrs, self.texts
        places: dict[str, list[int]] = {}  # where each kind stands in the stack
        blocks: list[int] = []  # where blocks stand in it
        bodies: set[str] = set()

        def add(text: str) -> None:
            if text:
                texts.append((stack[-1], block, text))

        def last(names) -> int:
            return max((places[n][-1] for n in names if places.get(n)), default=0)

        def cut(place: int) -> None:
            while len(stack) > place:  # every element leaves once
                name = kind[stack.pop()]
                places[name].pop()
                if name in BLOCK:
                    blocks.pop()

        def close_to(names, stops) -> None:
            place = last(names)
            if place > last(stops):
                cut(place)

        while at < size:
            lt = source.find("<", at)
            if lt < 0:
                add(html.unescape(source[at:]))
                break
            m = TOKEN.match(source, lt)
            if m is None:
                add(html.unescape(source[at : lt + 1]))
                at = lt + 1
                continue
            if lt > at:
                add(html.unescape(source[at:lt]))
            if m["comment"]:
                end = source.find("-->", lt + 4)
                at = size if end < 0 else end + 3
                continue
            if m["other"]:
                end = source.find(">", lt)
                at = size if end < 0 else end + 1
                continue
            at = m.end()
            if not m["close"]:  # an unclosed quote or the end of the page
                end = source.find(">", m.end("name"))
                if end < 0:
                    break
                at = end + 1
            name = m["name"].lower()
            if name == "br":
                add(" ")
                continue
            if name in BLOCK:
                block += 1
            if m["end"]:
                place = last((name,))
                if place and (name in BLOCK or not blocks or place > blocks[-1]):  # an inline end tag ends no block
                    cut(place)
                continue
            if name in ("html", "body"):
                if name == "html" or name in bodies:
                    continue
                bodies.add(name)
            if name in CLOSES_P:
                close_to(("p",), P_STOPS)
            if name in ENDS:
                close_to(*ENDS[name])
            kind.append(name)
            parent.append(stack[-1])
            attrs.append(m["attrs"])
            if name in RAW:
                end = re.compile(f"</{name}", re.I).search(source, at)
                if end is None:
                    at = size
                else:
                    gt = source.find(">", end.end())
                    at = size if gt < 0 else gt + 1
                continue
            if name not in VOID and not m["attrs"].endswith("/") or name in BLOCK - VOID:
                places.setdefault(name, []).append(len(stack))
                if name in BLOCK:
                    blocks.append(len(stack))
                stack.append(len(kind) - 1)

    def boilerplate(self) -> list[bool]:
        """Whether each node is boilerplate, itself or by one of its ancestors."""
        n = len(self.kind)
        around_main = [False] * n  # holds an article or main of its own
        for i in range(n - 1, 0, -1):
            if self.kind[i] in ("article", "main") and not self._named(i) or around_main[i]:
                around_main[self.parent[i]] = True
        dropped, in_main, in_p = [False] * n, [False] * n, [False] * n
        own_header = [False] * n
        for i in range(1, n):
            up = self.parent[i]
            name = self.kind[i]
            in_main[i] = in_main[up] or name in ("article", "main")
            in_p[i] = in_p[up] or name == "p"
            if own_header[up]:  # of an article's own header only the headings are text
                own_header[i] = True
                dropped[i] = dropped[up] or name in DROP_KINDS
                continue
            if name == "header" and in_main[up] and not dropped[up]:
                own_header[i] = True
                continue
            if name in ("html", "body"):
                continue
            control = name in DROP_KINDS or name == "button" and not in_p[i]  # a button in a sentence is text
            dropped[i] = dropped[up] or control or (not around_main[i] and self._named(i))
        headed = [False] * n
        for i in range(1, n):
            headed[i] = headed[self.parent[i]] or (own_header[i] and self.kind[i] in HEADINGS)
        return [d or (o and not h) for d, o, h in zip(dropped, own_header, headed)]

    def _named(self, i: int) -> bool:
        """Boilerplate by role, class, id or being hidden; a dialog without ``open`` is hidden."""
        if self.kind[i] == "dialog" and not OPEN.search(self.attrs[i]):
            return True
        if not self.attrs[i]:
            return False
        for m in ATTRIBUTE.finditer(self.attrs[i]):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" and not value.strip():
                return True
            if key == "role" and value.lower() in DROP_ROLES:
                return True
            if key == "style" and re.search(r"display\s*:\s*none", value, re.I):
                return True
            if key in ("class", "id"):
                for word in value.split():
                    parts = [p.lower() for p in NAME_PART.findall(word)]
                    if _boilerplate_name(parts):
                        return True
        return False


def densities(page: Page, dropped: list[bool]) -> tuple[list[float], list[float], list[int]]:
    """Composite density of each node, the sum over its children, and its characters."""
    n = len(page.kind)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = page.kind[i] == "a" or in_link[page.parent[i]]
    for node, _, text in page.texts:
        if not dropped[node]:
            k = len("".join(text.split()))
            chars[node] += k
            if in_link[node]:
                link_chars[node] += k
    for i in range(n - 1, 0, -1):
        if dropped[i]:
            continue
        up = page.parent[i]
        chars[up] += chars[i]
        link_chars[up] += link_chars[i]
        tags[up] += tags[i] + 1
        link_tags[up] += link_tags[i] + (page.kind[i] == "a")
    link_share = link_chars[0] / max(chars[0], 1)
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        c, t, lc, lt = chars[i], max(tags[i], 1), link_chars[i], max(link_tags[i], 1)
        if c and not dropped[i]:
            base = math.log(c / max(c - lc, 1) * lc + link_share * c + math.e)
            # a page without links would have base 1, whose logarithm is 0
            scale = math.log(max(c / max(lc, 1) * t / lt, 1.0)) / max(math.log(base), 0.5)
            density[i] = c / t * scale
        if i:
            sums[page.parent[i]] += density[i]
    return density, sums, chars


def main_nodes(page: Page, dropped: list[bool]) -> list[bool]:
    """Whether each node belongs to the main text."""
    n = len(page.kind)
    density, sums, chars = densities(page, dropped)
    best = max(range(n), key=lambda i: (sums[i], -i))
    if not sums[best]:
        best = 0
    path = [best]
    while page.parent[path[-1]] >= 0:
        path.append(page.parent[path[-1]])
    chosen = [False] * n
    whole = None
    for kind in ("article", "main"):
        around = [i for i in reversed(path) if page.kind[i] == kind]
        inner = [i for i in range(n) if page.kind[i] == kind and not dropped[i]]
        top = max(inner, key=lambda i: (chars[i], -i), default=None)
        if around or (top is not None and 2 * chars[top] >= chars[best] > 0):
            whole = around[0] if around else top
            break
    if whole is not None:
        chosen[whole] = True
    else:
        threshold = min(density[i] for i in path)
        top_of = list(range(n))  # best node of each subtree
        for i in range(n - 1, 0, -1):
            up = page.parent[i]
            if not dropped[i] and sums[top_of[i]] > sums[top_of[up]]:
                top_of[up] = top_of[i]
        for i in range(n):
            if density[i] >= threshold and chars[i] and not dropped[i]:
                chosen[top_of[i] if sums[top_of[i]] else i] = True
        _add_headings(page, chosen)
    for i in range(1, n):
        chosen[i] = chosen[i] or chosen[page.parent[i]]
    return chosen


def _add_headings(page: Page, chosen: list[bool]) -> None:
    """Headings are short, so they miss the threshold: those below the common ancestor join."""
    n, total = len(chosen), sum(chosen)
    if total < 1:
        return
    below = [int(c) for c in chosen]
    for i in range(n - 1, 0, -1):
        below[page.parent[i]] += below[i]
    common = max(i for i in range(n) if below[i] == total)
    if chosen[common]:
        common = max(page.parent[common], 0)
    inside = [False] * n
    inside[common] = True
    for i in range(common + 1, n):
        inside[i] = inside[page.parent[i]]
        if inside[i] and page.kind[i] in HEADINGS and (page.kind[common] not in ("body", "html") or below[page.parent[i]]):
            chosen[i] = True


def main_text(source: str | None) -> str:
    """The main text of one page."""
    if not source:
        return ""
    page = Page(source)
    dropped = page.boilerplate()
    chosen = main_nodes(page, dropped)
    blocks: list[list[str]] = []
    last = None
    for node, block, text in page.texts:
        if chosen[node] and not dropped[node]:
            if block != last:
                blocks.append([])
                last = block
            blocks[-1].append(text)
    joined = (" ".join("".join(parts).split()) for parts in blocks)
    return "\n\n".join(b for b in joined if b)


def extract(pages: DataFrame, column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns with ``text`` and ``n_chars``; one row per page."""
    picked = pages.select(*keep, F.col(column).alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), sizes],
                [*batch.schema.names[:-1], "text", "n_chars"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(run, f"{schema}, text string, n_chars long")


def op1_main_text(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))

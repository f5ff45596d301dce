"""Main text of web pages by tag-path ratios.

A page's text nodes carry their root-to-leaf tag path. Text length and punctuation are
aggregated per path (average per node); along the page both series are smoothed
with a Gaussian, fused, and thresholded by their own spread, which selects content nodes:
prose shares few paths with long, punctuated nodes, boilerplate many with
short ones. The region is the deepest element that holds most of the selected text; its
blocks are the article, but for elements that say what they are (navigation, forms, ...)
and for blocks of nothing but links. What a class, id or role says, or a form, doesn't count for an element around the
article: one that holds a main element or ``HOLDS`` of the text that the ratios select on the page.

Pages are independent: one pass, no shuffle; memory is bounded by ``CHUNK`` bytes of
markup or one page. Markup need not be well formed: unclosed or stray tags, comments and
quotes are taken as browsers do, roughly.

Edge cases: null or empty html gives the empty text; html without tags is one block; rows are independent, so
repeated rows and null page_ids give a row each; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

CHUNK = 8 << 20

#: Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody tfoot thead
tr ul""".split())
APART = frozenset("td th br hr option".split())  # a space lies between these and their neighbours
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the key ends an open element of the value.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "body": {"head"}} | {t: {"p"} for t in BLOCK - {"li", "dt", "dd", "tr", "body", "html", "tbody", "thead", "tfoot"}}
#: Where the search for an element to end stops.
SCOPE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}

#: Elements, roles and words of class or id that mark what is not the article.
NOT_ARTICLE = frozenset("""aside button canvas datalist dialog fieldset footer form head iframe input label menu nav noscript object
script search select style svg template textarea title""".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
HINTS = frozenset("""ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs captcha comment comments commentlist
consent cookie cookies disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay
pager pagination paywall popup promo promoted promotion related replies reply respond share sharing sidebar signup skip social sponsor
sponsored subscribe subscription teaser toc toolbar widget widgets""".split())
#: Words before a hint that make it a property of the whole page.
PROPERTY = frozenset("has is js no not with without".split())
WHOLE = frozenset("html body main article".split())

TOKEN = re.compile(r"""<!--(?:(?!-->).)*+(?:-->|\Z)|<!\[CDATA\[|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
ATTR = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？،؛؟।]")
SPACES = re.compile(r"\s+")

#: Half width and spread of the smoothing, in text nodes; the threshold in standard deviations.
RADIUS, SIGMA, SPREAD = 2, 1.0, 0.4
KERNEL = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-RADIUS, RADIUS + 1)]
REGION_SHARE = 0.7
HOLDS = 0.9

#: What an element says of itself: nothing, not the article unless it holds it, not the article.
PLAIN, MARKED, OUT = 0, 1, 2


def _excluded(tag: str, attrs: str, in_article: bool) -> int:
    if tag == "form":
        return MARKED
    if tag in NOT_ARTICLE or (tag == "header" and not in_article):
        return OUT
    if not attrs or tag in WHOLE:
        return PLAIN
    says = PLAIN
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return OUT
        if name == "role" and value in ROLES:
            says = MARKED
        if name in ("class", "id"):
            for word in value.split():
                parts = re.split(r"[^a-z0-9]+", word)
                if parts[0] not in PROPERTY and not HINTS.isdisjoint(parts):
                    says = MARKED
    return says


class _Page:
    """Text nodes of a page. Elements are numbered; ``parent``, ``tag`` and ``path`` by number."""

    def __init__(self, source: str):
        self.parent, self.tag, self.path, self.says = [-1], ["#"], [0], [PLAIN]
        self.paths: dict[tuple[int, str], int] = {}
        self.nodes: list[tuple[int, int, str, bool]] = []  # element, block, text, in a link
        self.block = 0
        self.links = 0
        self.articles = 0
        self.open = [0]
        self._read(source)

    def _push(self, tag: str, attrs: str) -> None:
        top = self.open[-1]
        self.parent.append(top)
        self.tag.append(tag)
        self.path.append(self.paths.setdefault((self.path[top], tag), len(self.paths) + 1))
        self.says.append(OUT if self.says[top] == OUT else _excluded(tag, attrs, self.articles > 0))
        self.open.append(len(self.tag) - 1)
        self.links += tag == "a"
        self.articles += tag in ("article", "main")

    def _pop_to(self, depth: int) -> None:
        while len(self.open) > depth:
            tag = self.tag[self.open.pop()]
            self.links -= tag == "a"
            self.articles -= tag in ("article", "main")

    def _find(self, tags, stop=frozenset()) -> int:
        for k in range(len(self.open) - 1, 0, -1):
            t = self.tag[self.open[k]]
            if t in tags:
                return k
            if t in stop:
                return 0
        return 0

    def _text(self, text: str) -> None:
        if text:
            self.nodes.append((self.open[-1], self.block, text, self.links > 0))

    def _read(self, s: str) -> None:
        at, search = 0, TOKEN.search
        while m := search(s, at):
            self._text(entities.unescape(s[at:m.start()]))
            at = m.end()
            name = m[2] or m[5]
            if not name:
                if m[0].startswith("<![CDATA["):
                    end = s.find("]]>", at)
                    self._text(s[at:end if end >= 0 else len(s)])
                    at = end + 3 if end >= 0 else len(s)
                continue
            tag, attrs = name.lower(), m[3] or m[6] or ""
            if tag in BLOCK:
                self.block += 1
            elif tag in APART:
                self._text(" ")
            if m[1] or m[4]:
                if k := self._find({tag}, () if tag in BLOCK else BLOCK):
                    self._pop_to(k)
                continue
            if tag in ENDS and (k := self._find(ENDS[tag], SCOPE.get(tag, {"table", "button", "td", "th"} if tag not in SCOPE else ()))):
                self._pop_to(k)
            if tag in VOID:
                continue
            if tag == "html" or tag == "body":
                if self._find({tag}):
                    continue
            self._push(tag, attrs)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(s, at)
                self._pop_to(len(self.open) - 1)
                at = end.end() if end else len(s)
            elif attrs.endswith("/") and tag in ("svg", "path"):
                self._pop_to(len(self.open) - 1)
        self._text(entities.unescape(s[at:]))


def _smooth(x: list[float]) -> list[float]:
    n, out = len(x), []
    for i in range(n):
        lo, hi = max(0, i - RADIUS), min(n, i + RADIUS + 1)
        k = KERNEL[lo - i + RADIUS:hi - i + RADIUS]
        out.append(sum(a * b for a, b in zip(k, x[lo:hi], strict=True)) / sum(k))
    return out


def _content(page: _Page, nodes: list[tuple[int, int, str, bool]]) -> list[bool]:
    """Which text nodes the fused path ratios select."""
    total: dict[int, list[float]] = {}
    for el, _, text, _ in nodes:
        t = total.setdefault(page.path[el], [0, 0, 0])
        t[0] += 1
        t[1] += len(text)
        t[2] += len(PUNCTUATION.findall(text))
    ratios = [total[page.path[el]] for el, _, _, _ in nodes]
    length = _smooth([t[1] / t[0] for t in ratios])
    marks = _smooth([t[2] / t[0] for t in ratios])
    fused = [a * (1 + b) for a, b in zip(length, marks, strict=True)]
    mean = sum(fused) / len(fused)
    spread = math.sqrt(sum((x - mean) ** 2 for x in fused) / len(fused))
    return [x >= SPREAD * spread for x in fused]


def _below(page: _Page, own: list[int]) -> list[int]:
    """Sums of ``own`` over each element and all below it: children have larger numbers than their parents."""
    for el in range(len(own) - 1, 0, -1):
        own[page.parent[el]] += own[el]
    return own


def _outside(page: _Page) -> list[bool]:
    """Which elements are not of the article by what they or those around them say."""
    says, parent = page.says, page.parent
    marked = [el for el, s in enumerate(says) if s == MARKED]
    holds: set[int] = set()
    if marked:
        nodes = [n for n in page.nodes if says[n[0]] != OUT and not n[2].isspace()]
        size, mains = [0] * len(says), [0] * len(says)
        for el, _, text, _ in nodes:
            size[el] += len(text)
        size = _below(page, size)
        for el, tag in enumerate(page.tag):
            mains[el] = tag == "main" and size[el] > 0
        mains = _below(page, mains)
        holds = {el for el in marked if mains[el]}
        if any(2 * size[el] >= size[0] for el in marked):  # else none can hold the text
            selected = [0] * len(says)
            for (el, _, text, _), yes in zip(nodes, _content(page, nodes), strict=True):
                selected[el] += len(text) * yes
            selected = _below(page, selected)
            holds |= {el for el in marked if selected[el] >= HOLDS * selected[0] > 0}
    out = [False] * len(says)
    for el in range(1, len(says)):
        out[el] = out[parent[el]] or says[el] == OUT or says[el] == MARKED and el not in holds
    return out


def main_text(source: str | None) -> str:
    """The article's blocks, joined by an empty line."""
    if not source:
        return ""
    page = _Page(source)
    outside = _outside(page)
    nodes = [n for n in page.nodes if not outside[n[0]]]
    full = [n for n in nodes if not n[2].isspace()]
    if not full:
        return ""
    chosen = _content(page, full)

    weight = [0] * len(page.tag)
    for (el, _, text, _), yes in zip(full, chosen, strict=True):
        weight[el] += len(text) * yes
    weight = _below(page, weight)
    region = max((el for el in range(len(weight)) if weight[el] >= REGION_SHARE * weight[0]), default=0)
    # a paragraph is no region: its article, or what surrounds it, is
    up = region
    while up and page.tag[up] not in ("article", "main"):
        up = page.parent[up]
    if up:
        region = up
    else:
        while region and (page.tag[region] not in BLOCK or page.tag[region] in HEADING or page.tag[region] in ("p", "li", "pre", "blockquote", "dd", "dt", "tr")):
            region = page.parent[region]
    inside = [False] * len(page.tag)
    inside[region] = True
    for el in range(region + 1, len(inside)):
        inside[el] = inside[page.parent[el]]

    picked = {id(n) for n, yes in zip(full, chosen, strict=True) if yes}
    blocks: dict[int, list] = {}
    for n in nodes:
        if inside[n[0]]:
            blocks.setdefault(n[1], []).append(n)
    out = []
    for parts in blocks.values():
        text = SPACES.sub(" ", "".join(p[2] for p in parts)).strip()
        linked = sum(len(p[2]) for p in parts if p[3] and not p[2].isspace())
        alone = text and linked >= 0.9 * len(text) and not any(id(p) in picked for p in parts)
        if text and (not alone or page.tag[parts[0][0]] in HEADING):
            out.append(text)
    return "\n\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """One row per input row: page_id, url, text."""
    def run(batches):
        for b in slices(batches, "html", CHUNK):
            text = [main_text(x) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string())], ["page_id", "url", "text"])

    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string")


def digest(text: DataFrame) -> DataFrame:
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

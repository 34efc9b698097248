"""Main text of web pages from streaming parser events.

The standard library's event parser is fed the page; no tree is built. Events make *lines*: the text of
one block, the tags met in it and the container it lies in. Boilerplate elements (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, reader comments: by element, role or word of their class or id) are left out
as they stream by; an article or main inside one goes with it, unless the element is never closed, which a first pass over
the tags tells. Inside article and main such words only *hint* at furniture, and count less, for ids and classes there are
often made of the text: on elements that hold text, and in the ids of plain containers, only those that name nothing
else (``ALWAYS``). An article of its own goes if a class name begins with such a word.

Each line's text-to-tag ratio is smoothed with a Gaussian; lines at or above the threshold
(``SPREAD`` standard deviations, at most the largest ratio) form the content cluster. A hinted element goes, unless it holds
``SHARE`` of the cluster's characters; so does a header beside the article of a main. The content region is the outermost
article or main with at least ``SHARE`` of the cluster's characters, where no other holds any; else the deepest container with
the whole cluster, which may be the page. Every other line of the region is kept, short ones too.

Null and empty pages give an empty text, as do pages without content. Truncated or badly nested markup is
read as far as it goes; cells, rows and list items end where the next one begins. Time and memory follow the page's length. One
row out per row in; repeated rows, null ids and further columns pass.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read

SPREAD, SIGMA, SHARE = 1.0, 1.0, 0.75

# Element names of HTML and words that sites use for page furniture.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article body div main section td".split())
MAIN = frozenset(("article", "main"))
#: An element that ends when one of these begins, and the elements that it does not look beyond.
ENDS = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd")}
SCOPES = frozenset("table ul ol dl menu article main body".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("aside audio button canvas dialog footer form head iframe menu nav noscript object script select style svg template textarea title video".split())
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion recommended related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget".split()
)
#: Words that name furniture inside an article, too.
ALWAYS = frozenset(
    "ad ads adsense advert adverts advertisement advertising comment comments consent cookie cookies disqus gdpr newsletter paywall promo promoted related replies respond sidebar signup sponsor sponsored subscribe teaser widget".split()
)
#: Elements that hold text or table rows: in an article other class words say nothing of them.
TEXTS = frozenset("blockquote caption dd dt figcaption figure h1 h2 h3 h4 h5 h6 li p pre table tbody td tfoot th thead tr".split())
#: In an article the ids of these count; those of others are made of their text.
PLAIN = frozenset("div ol table ul".split())
_WORDS = re.compile(r"[a-z0-9]+")
_ODD_DECLARATION = re.compile(r"<!(?!--|doctype)[^>]*>", re.I)


class Tags(HTMLParser):
    """The numbers of the start tags whose element is never closed."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: dict[str, list[int]] = {}
        self.made = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.made += 1
        if tag not in VOID:
            self.open.setdefault(tag, []).append(self.made)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.open.get(tag):
            self.open[tag].pop()

    def unclosed(self) -> frozenset[int]:
        return frozenset(n for numbers in self.open.values() for n in numbers)


class Lines(HTMLParser):
    """Collects ``(text, tags, container, hint)`` for each block outside boilerplate.

    Containers are numbered as they open, so that a container's descendants have the numbers up to its ``last``; the
    page is 0. ``top`` is a container's outermost article or main, 0 without one; ``article``: it is in an article. A hint is the number of the hinted
    element or header around the block, 0 without one.
    """

    def __init__(self, unclosed: frozenset[int]) -> None:
        super().__init__(convert_charrefs=True)
        self.unclosed = unclosed
        self.lines: list[tuple[str, int, int, int]] = []
        self.text: list[str] = []
        self.tags = 0
        self.open: list[tuple[str, int, int]] = []  # open block elements: name, container or 0, hint or 0
        self.count: Counter[str] = Counter()  # of their names
        self.parent, self.last, self.top, self.article = [0], [0], [0], [False]
        self.inner = [0]  # open containers
        self.hints: list[int] = [0]  # open hints
        self.headers: dict[int, int] = {}  # hint to the main around a header
        self.dropped: str | None = None  # the boilerplate element that we are inside of
        self.endless = False  # it is never closed
        self.inside = 0  # elements of the same name open inside it
        self.made = 0  # start tags

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags, self.inner[-1], self.hints[-1]))
        self.text.clear()
        self.tags = 0

    def finish(self) -> None:
        self.flush()
        self.close_to(0)
        self.last[0] = len(self.last) - 1

    def unwanted(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        """"drop", "hint" or "" (wanted)."""
        if tag in DROPPED:
            return "drop"
        if tag in ("main", "body", "html"):
            return ""
        in_article = self.count["article"] > 0
        if tag == "header" and not in_article:
            return "hint" if self.count["main"] else "drop"
        verdict = ""
        for name, value in attrs:
            value = (value or "").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in DROPPED_ROLES:
                return "" if tag == "article" else "drop"
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return "drop"
            if name not in ("class", "id"):
                continue
            if tag == "article":
                if name == "class" and any((w := _WORDS.findall(token)) and w[0] in ALWAYS for token in value.split()):
                    return "drop"
            elif not in_article and not self.count["main"]:
                if not DROPPED_WORDS.isdisjoint(_WORDS.findall(value)):
                    return "drop"
            elif name == "class" and tag not in TEXTS:
                if not DROPPED_WORDS.isdisjoint(_WORDS.findall(value)):
                    verdict = "hint"
            elif name == "class" or tag in PLAIN:
                words = [w for token in value.split() for w in _WORDS.findall(token)[:1]]
                if not ALWAYS.isdisjoint(words):
                    verdict = "hint"
        return verdict

    def close_to(self, depth: int) -> None:
        for name, container, hint in reversed(self.open[depth:]):
            self.count[name] -= 1
            if container:
                self.last[container] = len(self.last) - 1
                self.inner.pop()
            if hint:
                self.hints.pop()
        del self.open[depth:]

    def end(self, names: tuple[str, ...], scope: frozenset[str] = frozenset()) -> None:
        """Close the innermost open element of these names, if one is open (inside the innermost scope)."""
        if any(self.count[name] for name in names):
            for depth in range(len(self.open) - 1, -1, -1):
                if self.open[depth][0] in names:
                    self.close_to(depth)
                    return
                if self.open[depth][0] in scope:
                    return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.made += 1
        if self.dropped:
            if self.endless and tag in ("article", "main", "body") and self.dropped not in ("script", "style"):
                self.dropped = None
            else:
                self.inside += tag == self.dropped
                return
        verdict = "" if tag in VOID else self.unwanted(tag, attrs)
        if verdict == "drop":
            if tag in BLOCKS:
                self.flush()
            self.dropped, self.inside, self.endless = tag, 0, self.made in self.unclosed
            return
        if tag in BLOCKS:
            self.flush()
            if self.open and self.open[-1][0] == "p":
                self.close_to(len(self.open) - 1)
            if tag in ENDS:
                self.end(ENDS[tag], SCOPES)
            if tag not in VOID:
                container = hint = 0
                if tag in CONTAINERS:
                    container = len(self.last)
                    above = self.inner[-1]
                    self.parent.append(above), self.last.append(container)
                    self.article.append(self.article[above] or tag == "article")
                    self.top.append(self.top[above] or (container if tag in MAIN else 0))
                    self.inner.append(container)
                if verdict:
                    hint = self.made
                    if tag == "header":
                        self.headers[hint] = self.top[self.inner[-1]]
                    self.hints.append(self.hints[-1] or hint)
                self.open.append((tag, container, hint))
                self.count[tag] += 1
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID or tag not in BLOCKS | DROPPED:
            if self.dropped:
                self.made += 1
            else:
                self.handle_starttag(tag, attrs)
        else:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.dropped:
            if tag == self.dropped:
                if self.inside:
                    self.inside -= 1
                else:
                    self.dropped = None
                return
            if not self.endless or tag not in ("body", "html", "article", "main") or not self.count[tag]:
                return
            self.dropped = None
        if tag in BLOCKS:
            self.flush()
            self.end((tag,))

    def handle_data(self, data: str) -> None:
        if not self.dropped:
            self.text.append(data)


def _fed(make, html: str):
    """A parser that has read the page; without declarations that it does not know, if there are such."""
    for source in (html, _ODD_DECLARATION.sub("", html)):
        parser = make()
        try:
            parser.feed(source)
            parser.close()
        except AssertionError:
            continue
        break
    return parser


def page_lines(html: str) -> Lines:
    unclosed = _fed(Tags, html).unclosed()
    parser = _fed(lambda: Lines(unclosed), html)
    parser.finish()
    return parser


def smoothed(ratios: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing over a radius of two sigmas, weights normalised at the ends."""
    radius = max(1, round(2 * sigma))
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(radius + 1)]
    out = []
    for i in range(len(ratios)):
        near = range(max(0, i - radius), min(len(ratios), i + radius + 1))
        out.append(sum(kernel[abs(j - i)] * ratios[j] for j in near) / sum(kernel[abs(j - i)] for j in near))
    return out


def content_region(page: Lines, cluster: list[tuple[int, int]]) -> int:
    """The container of the region, from the (characters, container) of the cluster's lines."""
    held: Counter[int] = Counter()
    for n, container in cluster:
        if page.top[container]:
            held[page.top[container]] += n
    if len(held) == 1:
        ((region, n),) = held.items()
        if n >= SHARE * sum(n for n, _ in cluster):
            return region
    first, last = min(c for _, c in cluster), max(c for _, c in cluster)
    region = first
    while page.last[region] < last:
        region = page.parent[region]
    return region


def main_text(html: str | None) -> str:
    page = page_lines(html or "")
    lines = page.lines
    if not lines:
        return ""
    ratio = smoothed([len(text) / max(1, tags) for text, tags, _, _ in lines])
    mean = sum(ratio) / len(ratio)
    spread = math.sqrt(sum((r - mean) ** 2 for r in ratio) / len(ratio))
    threshold = min(max(ratio), SPREAD * spread)
    content = [line for line, r in zip(lines, ratio, strict=True) if r >= threshold]
    whole, hinted, articles = 0, Counter(), set()
    for text, _, container, hint in content:
        whole += len(text)
        hinted[hint] += len(text)
        if page.article[container]:
            articles.add(page.top[container])
    # Furniture by its word, unless it is the content; and headers of a main that has an article.
    gone = {h for *_, h in lines if h and (page.headers[h] in articles if h in page.headers else hinted[h] < SHARE * whole)}
    region = content_region(page, [(len(t), c) for t, _, c, h in content if h not in gone] or [(len(t), c) for t, _, c, _ in content])
    return "\n\n".join(t for t, _, c, h in lines if h not in gone and region <= c <= page.last[region])


def extract(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text, n_chars) for each row of ``pages``. Narrow: no shuffle."""
    return _with_text(pages.select(F.col(id_col), F.col(html_col)), [id_col], html_col)


def _with_text(rows: DataFrame, keep: list[str], html_col: str) -> DataFrame:
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py()) for value in batch.column(n)]
            columns = [*(batch.column(i) for i in range(n)), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(n + 2)])

    kinds = [rows.schema[c].dataType.simpleString() for c in keep]
    schema = ", ".join(f"c{i} {kind}" for i, kind in enumerate([*kinds, "string", "long"]))
    return rows.select(*keep, html_col).mapInArrow(run, schema).toDF(*keep, "text", "n_chars")


def op9_html_text(spark, sf_dir: str) -> DataFrame:
    return _with_text(read(spark, sf_dir, "pages"), ["page_id", "url"], "html")

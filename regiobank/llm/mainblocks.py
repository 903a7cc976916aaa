"""Main text of web pages by consensus of their hosts.

Pages are read into text blocks within containers. Every page scores its containers and votes for the one that holds its
article, by the container's path: tags, classes and ids from the outside in, generalised (lower case, numbers as one sign),
so that pages of one template vote for the same path. Spark sums the votes up per host, and each page is read again with
the paths that won on its host. A page that has none of them keeps its own choice.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiobank.llm.common import map_arrow, slices
from regiobank.sources.scratch import stage

#: A path wins with this share of the votes of its host, so 1 / SHARE paths of a host do at most.
SHARE = 0.05
#: A step inwards must keep this share of the text, or this one if the container is named as an article.
INWARD = 0.6
NAMED_INWARD = 0.3
SALTS = 64

#: Tags by their role in HTML; fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp template noscript svg math object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
CONTAINERS = frozenset("body article main section div td table center".split())
OUTSIDE = frozenset("head nav header footer aside form button select option menu dialog fieldset audio video canvas map".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an opening tag closes by itself, and where that ends.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
#: Words in classes and ids of what is not the article, and words that pages use for the article.
ROLES_OUTSIDE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES_OUTSIDE = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adsense banner banners breadcrumb breadcrumbs "
    "comment comments commentlist disqus discussion replies reply respond cookie cookies consent gdpr notice notices alert "
    "footer foot header masthead menu menus nav navbar navigation navi topbar toolbar sidebar sidebars aside rail widget "
    "widgets related recommended recommendations share sharing social newsletter subscribe subscription signup login popup "
    "modal overlay promo promotion promoted sponsor sponsored sponsors pagination pager paging skip search form hidden".split()
)
NAMES_INSIDE = frozenset("article articlebody content contents entry main maincontent post postbody postcontent story text body".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|itemprop|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Numbers of pages and items; single digits tell columns and kinds of boxes apart.
_DIGITS = re.compile(r"\d\d+")


class Node(NamedTuple):
    """A container of a page."""

    parent: int
    path: int
    kind: str
    inside: bool  # its name says that it holds an article


class Block(NamedTuple):
    node: int  # the innermost container
    text: str
    linked: int  # characters of it within links
    heading: int  # 1 to 6, or 0
    kept: bool  # not within anything that is no part of an article


class Page(NamedTuple):
    nodes: list[Node]
    blocks: list[Block]
    paths: list[tuple[int, str, int]]  # (the path outside, the last step, number of steps)

    def path(self, number: int) -> str:
        steps = []
        while number:
            number, step, _ = self.paths[number]
            steps.append(step)
        return ">".join(reversed(steps))


def _names(attributes: str) -> dict[str, str]:
    if "=" not in attributes and "hidden" not in attributes:
        return {}
    return {name.lower(): html.unescape(a or b or c or "") for name, a, b, c in _NAMED.findall(attributes)}


def _words(names: dict[str, str]) -> set[str]:
    """The words in classes and id. Classes that say what an element has or lacks say nothing about itself."""
    found = set()
    for name in (*names.get("class", "").split(), *names.get("id", "").split()):
        if not re.match(r"(?i)(no|has|with|without|is|not)[-_]", name):
            found.update(part.lower() for part in _PARTS.findall(name))
            found.add(name.lower())
    return found


def _is_outside(tag: str, names: dict[str, str], words: set[str]) -> bool:
    if tag in OUTSIDE:
        return True
    if tag in ("html", "body", "main", "article") and "comment" not in words and "comments" not in words:
        return False
    if names.get("role", "").lower() in ROLES_OUTSIDE or "hidden" in names or names.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"(?i)display\s*:\s*none", names.get("style", "")):
        return True
    return bool(words & NAMES_OUTSIDE) and not (words & {"article", "articlebody"})


def _step(tag: str, names: dict[str, str]) -> str:
    classes = sorted({_DIGITS.sub("#", name.lower()) for name in names.get("class", "").split()})
    ids = [_DIGITS.sub("#", name.lower()) for name in names.get("id", "").split()]
    return ".".join([tag, *classes]) + "".join(f"#{name}" for name in ids)


class _Reader:
    """Reads a page from its start to its end, with the elements that are open."""

    def __init__(self) -> None:
        self.page = Page([Node(-1, 0, "", False)], [], [(0, "", 0)])
        self.known: dict[tuple[int, str], int] = {}
        #: tag, and as they were before it: container, outside, heading, muted
        self.open: list[tuple[str, int, int, int, bool]] = []
        self.count: dict[str, int] = {}
        self.node = self.outside = self.heading = self.links = self.linked = 0
        self.muted = False
        self.parts: list[str] = []

    def text(self, piece: str) -> None:
        if piece and not self.muted:
            self.parts.append(piece)
            if self.links:
                self.linked += len(piece)

    def end_block(self) -> None:
        if self.parts:
            whole = "".join(self.parts)
            text = " ".join((html.unescape(whole) if "&" in whole else whole).split())
            if text:
                share = self.linked / len(whole)
                self.page.blocks.append(Block(self.node, text, round(share * len(text)), self.heading, not self.outside))
            self.parts.clear()
            self.linked = 0

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag == "hr":
            self.text(" ")
            if tag == "hr":
                self.end_block()
            return
        if tag in VOID:
            return
        if tag == "a":
            self.links = 1
            return
        names = _names(attributes)
        if tag in INLINE and not names and not self.count.get(tag):
            return
        words = _words(names)
        outside = _is_outside(tag, names, words)
        if words & NAMES_OUTSIDE == {"header"} and (self._within_article() or words & NAMES_INSIDE):
            outside = False
        if tag in INLINE:
            # of inline elements only those that are no part of an article are followed, and those within them
            if outside or self.count.get(tag):
                self._push(tag)
                self.muted = self.muted or outside
            return
        self.end_block()
        if tag in CLOSES:
            self._close_until(*CLOSES[tag])
        elif self.count.get("p"):
            self.end("p")
        if tag == "body" or tag == "html":
            return
        self._push(tag)
        # an article's own header has its headline
        if outside and not (tag == "header" and self._within_article()):
            self.outside += 1
        if tag in HEADINGS:
            self.heading = int(tag[1])
        if tag in CONTAINERS:
            step = _step(tag, names)
            around = self.page.nodes[self.node].path
            path = self.known.setdefault((around, step), len(self.page.paths))
            if path == len(self.page.paths):
                self.page.paths.append((around, step, self.page.paths[around][2] + 1))
            inside = tag in ("article", "main") or names.get("itemprop", "").lower() == "articlebody" or bool(words & NAMES_INSIDE)
            self.page.nodes.append(Node(self.node, path, tag, inside))
            self.node = len(self.page.nodes) - 1

    def _within_article(self) -> bool:
        return bool(self.count.get("article") or self.count.get("main")) and not self.outside

    def _push(self, tag: str) -> None:
        self.open.append((tag, self.node, self.outside, self.heading, self.muted))
        self.count[tag] = self.count.get(tag, 0) + 1

    def _close_until(self, closed: set[str], stop: set[str]) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] in closed:
                self._pop(at)
            elif self.open[at][0] in stop or self.open[at][0] in CONTAINERS:
                return

    def _pop(self, at: int) -> None:
        for tag, *_ in self.open[at:]:
            self.count[tag] -= 1
        _, self.node, self.outside, self.heading, self.muted = self.open[at]
        del self.open[at:]

    def end(self, tag: str) -> None:
        if tag == "a":
            self.links = 0
            return
        if tag not in INLINE:
            self.end_block()
            self.links = 0
        if self.count.get(tag):
            at = len(self.open) - 1
            while self.open[at][0] != tag:
                at -= 1
            # what stands open within a block does not hold back the end of the block
            self._pop(at)


def read_page(source: str) -> Page:
    """Blocks and containers of a page. Anything is a page; what a browser would not show is left out."""
    reader, at, size = _Reader(), 0, len(source)
    while at < size:
        sign = source.find("<", at)
        if sign < 0:
            reader.text(source[at:])
            break
        reader.text(source[at:sign])
        follows = source[sign + 1 : sign + 2]
        if follows == "!" or follows == "?" or (follows == "/" and not source[sign + 2 : sign + 3].isalpha()):
            sign, mark = (sign + 2, "-->") if source.startswith("<!--", sign) else (sign, ">")
            end = source.find(mark, sign)
            at = size if end < 0 else end + len(mark)
            continue
        if not (follows.isascii() and follows.isalpha()) and follows != "/":
            reader.text("<")
            at = sign + 1
            continue
        found = _TAG.match(source, sign) or _LOOSE_TAG.match(source, sign)
        if not found:
            break  # a tag that never ends
        tag, at = found[2].lower(), found.end()
        if found[1]:
            reader.end(tag)
            continue
        if tag in RAW:
            if not found[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
                at = size if not end else max(source.find(">", end.end()) + 1, end.end())
            continue
        reader.start(tag, found[3])
        if tag == "plaintext":
            reader.text(html.escape(source[at:], quote=False))
            break
    reader.end_block()
    return reader.page


def _weight(block: Block) -> int:
    """How much a block speaks for its container: its text that is no link."""
    return (len(block.text) - block.linked) if block.kept else 0


def _sums(page: Page) -> tuple[list[int], list[bool]]:
    """Weight of the blocks within each container, and whether a headline is among them."""
    weight, headline = [0] * len(page.nodes), [False] * len(page.nodes)
    for block in page.blocks:
        weight[block.node] += _weight(block)
        headline[block.node] |= block.heading == 1 and block.kept and block.linked * 2 < len(block.text)
    for number in range(len(page.nodes) - 1, 0, -1):
        parent = page.nodes[number].parent
        weight[parent] += weight[number]
        headline[parent] |= headline[number]
    return weight, headline


def best_container(page: Page) -> tuple[int, float]:
    """The container that holds the article, as far as the page itself tells, and the share of the page's text in it.

    From the page inwards: into the container with the most text as long as it has most of it, but not away from a
    headline, nor out of what is called an article.
    """
    weight, headline = _sums(page)
    if not weight[0]:
        return 0, 0.0
    inner: dict[int, list[int]] = {}
    for number, node in enumerate(page.nodes):
        if number and weight[number]:
            inner.setdefault(node.parent, []).append(number)
    at = 0
    while at in inner:
        best = max(inner[at], key=lambda number: (weight[number], -number))
        if weight[best] < INWARD * weight[at]:
            # parts of one article, or the largest of several things
            named = [number for number in inner[at] if page.nodes[number].inside and weight[number] >= NAMED_INWARD * weight[at]]
            best = max(named, key=lambda number: (weight[number], -number), default=None)
            if best is None or page.nodes[at].kind == "article" or (headline[at] and not headline[best]):
                break
        elif page.nodes[at].kind == "article" or (headline[at] and not headline[best]):
            break
        at = best
    return at, weight[at] / weight[0]


def text_of(page: Page, chosen: list[int]) -> str:
    """Blocks within some containers, in the order of the page."""
    held = [number in set(chosen) for number in range(len(page.nodes))]
    for number in range(1, len(page.nodes)):
        held[number] = held[number] or held[page.nodes[number].parent]
    return "\n\n".join(block.text for block in page.blocks if block.kept and held[block.node])


def extract(page: Page, winners: list[str]) -> str:
    """The text of the first of some paths that has any on this page; of the page's own choice, if none has."""
    weight, _ = _sums(page)
    if winners:
        wanted = {path: rank for rank, path in enumerate(winners)}
        sizes = {path.count(">") + 1 if path else 0 for path in winners}
        rank_of = [wanted.get(page.path(number)) if steps in sizes else None for number, (_, _, steps) in enumerate(page.paths)]
        places: dict[int, list[int]] = {}
        for number, node in enumerate(page.nodes):
            rank = rank_of[node.path]
            if rank is not None and weight[number]:
                places.setdefault(rank, []).append(number)
        if places:
            return text_of(page, places[min(places)])
    return text_of(page, [best_container(page)[0]])


def host_of(url: Column) -> Column:
    """The host of an address in lower case, without user and port; null if it has none."""
    host = F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*:/*(?:[^/?#@\s]*@)?([^/?#:\s]+)", 1))
    return F.when(host != "", host)


def host_paths(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """host, winners: the paths with at least `share` of the votes of a host's pages, by falling votes."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            hosts, paths, votes = [], [], []
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                page = read_page(source)
                at, held = best_container(page)
                if held:
                    hosts.append(host)
                    paths.append(page.path(page.nodes[at].path))
                    votes.append(round(1000 * held))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(votes, pa.int64())], ["host", "path", "votes"])

    asked = pages.select(host_of(F.col("url")).alias("host"), "html").where("host IS NOT NULL AND html IS NOT NULL")
    votes = map_arrow(asked, vote, "host string, path string, votes bigint").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    votes = stage(votes, "votes")
    cast = votes.groupBy("host").agg(F.sum("votes").alias("cast"))
    strong = votes.join(cast, "host").where(F.col("votes") >= share * F.col("cast"))
    ranked = strong.groupBy("host").agg(F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("votes"), "path"))).alias("ranked"))
    return ranked.select("host", F.col("ranked.path").alias("winners"))


def main_texts(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """One row per row of `pages` (page_id, url, html): page_id, url, text, n_chars.

    text has the blocks of the article, joined by an empty line: character references decoded, white space within a block
    as one space. Left out are menus, headers (but for the headline within an article), footers, sidebars, notices,
    adverts, forms, scripts, styles, comments and what is hidden, known by tag, role, class or id, and all that stands
    outside the container that won. Null and empty pages and pages without text give an empty text. Pages whose url is
    null or has no host go by their own choice. Rows that repeat each get a row (and vote); page_id and url stay as they
    are; other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    # rows without a host spread over all tasks
    host = F.coalesce(host_of(F.col("url")), F.concat(F.lit(" "), F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("string")))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    winners = stage(host_paths(pages, share), "host-paths")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [extract(read_page(source), paths or []) for source, paths in zip(batch.column("html").to_pylist(), batch.column("winners").to_pylist())]
            size = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), size], ["page_id", "url", "text", "n_chars"])

    kinds = {field.name: field.dataType.simpleString() for field in pages.schema if field.name in ("page_id", "url")}
    joined = rows.join(winners, "host", "left").select("page_id", "url", "html", "winners")
    return map_arrow(joined, read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")

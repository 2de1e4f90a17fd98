"""HTML extraction: containers are scored per page, hosts vote on paths, winners extract.

A container's path is the tags and classes from the root down, without digits and
ids, so that pages of one template share it; what is kept of it is a running hash, so
deep pages cost no more than long ones.  A page's best container is widened to the
article or other container around it as long as what that adds is mostly unlinked text.
Each page votes for the path so found with the best container's score; votes are summed per host and path in
Spark.  Each page's own paths are joined with all votes of its host, however many,
and the best voted one is its winner.  Then every page is read again, and the text is
taken from the containers on the winning path.  Only winners that are not the path the
page voted for itself are sent along, by the page's locator.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.rows import AT, FILE, in_files, located
from logweave.llm.words import small_batches
from logweave.plans.sizing import settled, small_side

# What a container passes of a block's score to the containers around it.
PASSED_ON = 0.4

CONTAINERS = frozenset("article main section div td body center dl".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dd dt pre blockquote table tbody thead tfoot tr th caption hr br figure figcaption "
    "address details summary header footer nav aside form fieldset html head title".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg object".split())
LEFT_OUT = RAW | frozenset("nav header footer aside button select menu dialog head canvas audio video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements, and words that a class or id begins or ends with, that mark what is no part of the article.
MARKED = frozenset({"form"})
MARKS = frozenset(
    "ad ads adv advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "pager pagination popup promo promoted related replies reply search share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar widget".split()
)
# Words that say a mark is of something else.
OTHERWISE = frozenset("has is no not with without".split())
# With less unlinked text than this outside headings a page has lost its article to a mark.
LEAST_TEXT = 60
# An open element of the key's tag ends when one of these starts.
ENDED_BY = {
    "p": BLOCKS - {"br", "title", "html", "head"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr"}),
    "td": frozenset({"td", "th", "tr"}),
    "th": frozenset({"td", "th", "tr"}),
    "option": frozenset({"option"}),
}
# An article is not widened beyond these.
WHOLE = frozenset({"article", "main"})
_KEPT = frozenset({"html", "body", "article", "main"})
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|([^<]+|<)", re.DOTALL
)
_NAMED = re.compile(r"""\b(class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Container:
    path: str
    first: int
    last: int = -1
    score: float = 0.0
    depth: int = 0
    tag: str = ""
    around: Container | None = None


@dataclass
class Page:
    """Blocks of text in page order, and the containers with the blocks they span."""

    blocks: list[str] = field(default_factory=list)
    # Of each block, how many characters are links, and whether it is a heading.
    linked: list[int] = field(default_factory=list)
    heading: list[bool] = field(default_factory=list)
    containers: list[Container] = field(default_factory=list)
    # Marked elements in page order: the marked one around each (-1: none), and its unlinked text not in another.
    marked: list[list[int]] = field(default_factory=list)


@dataclass(slots=True)
class Open:
    """An element not yet ended: where it is, and what keeps its text out of the page."""

    tag: str
    path: str = ""
    out: bool = False
    # The marked element it is in, -1 if none; in a header of an article, where headings alone count.
    mark: int = -1
    quiet: bool = False
    article: bool = False
    container: Container | None = None


def _names(attributes: str) -> tuple[list[str], bool]:
    """Generalised class names, and whether a class or id marks the element as left out."""
    classes, marked = [], False
    for key, *values in _NAMED.findall(attributes):
        value = next((v for v in values if v), "").lower()
        marked = marked or any(map(_is_mark, value.split()))
        if key.lower() == "class":
            classes += [w for w in re.sub(r"\d+", "", value).split() if w.strip("-_")]
    return sorted(set(classes)), marked


def _is_mark(name: str) -> bool:
    """Does a class or id begin or end with a mark, and not say that it is about something else?"""
    words = _WORDS.findall(name)
    return bool(words) and not MARKS.isdisjoint((words[0], words[-1])) and OTHERWISE.isdisjoint(words)


def _path(around: str, name: str) -> str:
    return blake2b(f"{around}>{name}".encode(), digest_size=12).hexdigest()


def spared(page: Page) -> frozenset[int]:
    """Marked elements that are read all the same, as without them hardly any text is left.

    From the outside in: the largest one, and the largest in it, until there is text.
    """
    each = zip(page.blocks, page.linked, page.heading, strict=True)
    left = sum(len(block) - linked for block, linked, heading in each if not heading)
    sizes = [size for _, size in page.marked]
    for k in range(len(sizes) - 1, -1, -1):
        if page.marked[k][0] >= 0:
            sizes[page.marked[k][0]] += sizes[k]
    found, inside = [], {}
    for k, (around, _) in enumerate(page.marked):
        if sizes[k] > sizes[inside.get(around, k)] or around not in inside:
            inside[around] = k
    k = inside.get(-1)
    while k is not None and left < LEAST_TEXT and sizes[k] > left:
        found.append(k)
        left += page.marked[k][1]
        k = inside.get(k)
    return frozenset(found)


def parse(html: str) -> Page:
    """A tolerant reading: elements left open end with their parent or the page."""
    page = _parsed(html, frozenset())
    all_the_same = spared(page) if page.marked else None
    return _parsed(html, all_the_same) if all_the_same else page


def _parsed(html: str, unmarked: frozenset[int]) -> Page:
    page = Page()
    stack: list[Open] = []
    opened: Counter[str] = Counter()
    text: list[str] = []
    linked = 0
    heading = False

    def flush() -> None:
        nonlocal linked
        if text:
            block = " ".join("".join(text).split())
            if block:
                page.blocks.append(block)
                page.linked.append(linked)
                page.heading.append(heading)
                worth = max(0.0, len(block) - 2.0 * linked) * (1.0 if len(block) >= 25 else 0.3)
                around = next((e.container for e in reversed(stack) if e.container is not None), None)
                while around is not None and worth > 1e-9:
                    around.score += worth
                    worth *= PASSED_ON
                    around = around.around
            text.clear()
        linked = 0

    def pop() -> None:
        ended = stack.pop()
        opened[ended.tag] -= 1
        if ended.container is not None:
            ended.container.last = len(page.blocks)

    at, n = 0, len(html)
    while at < n:
        token = _TOKEN.match(html, at)
        at = token.end()
        closing, tag, attributes, plain = token.groups()
        if plain is not None:
            inner = stack[-1] if stack else None
            headed = any(opened[h] > 0 for h in HEADINGS)
            if inner is not None and (inner.out or (inner.quiet and not headed)):
                continue
            found = unescape(plain)
            links = opened["a"] > 0
            if inner is not None and inner.mark >= 0:
                page.marked[inner.mark][1] += 0 if links else len(found.strip())
                continue
            heading = headed if not text else heading and headed
            text.append(found)
            if links:
                linked += len(found.strip())
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if opened[tag] > 0:
                if tag in BLOCKS:
                    flush()
                while stack[-1].tag != tag:
                    if stack[-1].tag in BLOCKS:
                        flush()
                    pop()
                pop()
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(html, at)
                at = n if end is None else html.find(">", end.start()) + 1 or n
            continue
        if tag in BLOCKS:
            flush()
        if tag in VOID or attributes.endswith("/"):
            continue
        while stack and tag in ENDED_BY.get(stack[-1].tag, ()):
            pop()
        if tag in BLOCKS and tag not in ("br", "title"):
            # A block inside a paragraph ends the paragraph, whatever inline elements are open in it.
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag in ENDED_BY and tag in ENDED_BY[stack[k].tag]:
                    while len(stack) > k:
                        pop()
                    break
                if stack[k].tag in BLOCKS:
                    break
        parent = stack[-1] if stack else Open("")
        names, marked = _names(attributes) if attributes else ([], False)
        now = Open(tag, parent.path, parent.out, parent.mark, parent.quiet, parent.article or tag == "article")
        if tag == "header" and parent.article:
            now.quiet = True
        elif tag in LEFT_OUT:
            now.out = True
        if (marked or tag in MARKED) and tag not in _KEPT and not now.out:
            page.marked.append([parent.mark, 0])
            if len(page.marked) - 1 not in unmarked:
                now.mark = len(page.marked) - 1
        if tag in BLOCKS:
            now.path = _path(parent.path, ".".join([tag, *names]))
        if tag in CONTAINERS and not now.out and now.mark < 0:
            around = next((e.container for e in reversed(stack) if e.container is not None), None)
            now.container = Container(now.path, len(page.blocks), depth=len(stack), tag=tag, around=around)
            page.containers.append(now.container)
        opened[tag] += 1
        stack.append(now)
    flush()
    while stack:
        pop()
    return page


def best(page: Page) -> Container | None:
    return max(page.containers, key=lambda c: (c.score, -c.depth, -c.first), default=None)


def widened(page: Page, found: Container) -> Container:
    """``found``, or what is around it while the blocks that this adds are mostly unlinked text.

    An article is whole, and the body is no article.  An article or main element that
    adds nothing counts as well, so that pages of a template vote for the same path.
    """
    around = found.around
    while around is not None and around.tag != "body" and found.tag not in WHOLE:
        added = [*range(around.first, found.first), *range(found.last, around.last)]
        size, linked = sum(len(page.blocks[k]) for k in added), sum(page.linked[k] for k in added)
        if 2 * linked > size:
            break
        if added or around.tag in WHOLE:
            found = around
        around = around.around
    return found


def text_of(page: Page, paths: list[str]) -> str:
    """The blocks under the first of ``paths`` that has text here, else under the page's best container."""
    for path in paths:
        spans = [(c.first, c.last) for c in page.containers if c.path == path and c.last > c.first]
        if spans:
            chosen = sorted({k for first, last in spans for k in range(first, last)})
            return " ".join(page.blocks[k] for k in chosen)
    own = best(page)
    own = own and widened(page, own)
    return " ".join(page.blocks if own is None else page.blocks[own.first : own.last])


def own_path(page: Page) -> tuple[str | None, float]:
    """The path a page votes for, with its vote; no path where nothing scores."""
    found = best(page)
    return (widened(page, found).path, found.score) if found is not None and found.score > 0 else (None, 0.0)


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own, scores, paths = [], [], []
        for html in batch.column("html").to_pylist():
            page = parse(html)
            path, score = own_path(page)
            own.append(path)
            scores.append(score)
            paths.append(sorted({c.path for c in page.containers if c.last > c.first}))
        kept = [batch.column(name) for name in (FILE, AT, "host")]
        columns = [*kept, pa.array(own, pa.string()), pa.array(scores, pa.float64()), pa.array(paths, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, [FILE, AT, "host", "own", "score", "paths"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, winner in zip(batch.column("html").to_pylist(), batch.column("winner").to_pylist(), strict=True):
            page = parse(html)
            path = own_path(page)[0] if winner is None else winner
            texts.append(text_of(page, [] if path is None else [path]))
        columns = [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "url", "text"])


def _hosted(pages: DataFrame, url_col: str, html_col: str):
    host = F.lower(F.coalesce(F.try_parse_url(F.col(url_col).cast("string"), F.lit("HOST")), F.lit("")))
    return host.alias("host"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html")


def winners(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The best voted path of each page (of a table from :func:`rows.in_files`) that is not its own vote.

    Columns: the page's locator and ``winner``.  Sums per host and path are combined
    before the shuffle, so a host with a third of all pages sends one row per path and
    task.  Pages without a host vote together.
    """
    rows = located(pages, *_hosted(pages, url_col, html_col))
    schema = f"{FILE} string, {AT} long, host string, own string, score double, paths array<string>"
    read = settled(rows.mapInArrow(_vote, schema), "page-paths")
    votes = read.filter("own IS NOT NULL").groupBy("host", F.col("own").alias("path")).agg(F.sum("score").alias("votes"))
    votes = small_side(settled(votes, "page-votes"))
    had = read.select(FILE, AT, "own", "host", F.explode("paths").alias("path")).join(votes, ["host", "path"])
    first = F.min_by("path", F.struct(-F.col("votes"), F.col("path"))).alias("winner")
    chosen = had.groupBy(FILE, AT).agg(first, F.any_value("own").alias("own"))
    return chosen.filter("NOT winner <=> own").select(FILE, AT, "winner")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id``, ``url``, ``text`` and ``n_chars`` of every page's article.

    What a class or id marks as no part of the article is left out, but not where
    hardly any text would be left: then the marked part is a container like others, and
    the vote decides.  In a header inside the article headings count, nothing else.

    Null and empty html give an empty text; a page without containers gives all its
    blocks; an unreadable url counts as no host.  Rows that repeat are read each for
    itself.  Of paths with equal votes the one with the least hash wins.  Pages may be
    long and deep: reading one takes time in proportion to its length.  Other columns,
    whatever their names, are not read.
    """
    small_batches(pages.sparkSession, 500)
    pages = in_files(pages, "pages")
    other = small_side(settled(winners(pages, url_col, html_col), "page-winners"))
    _, html = _hosted(pages, url_col, html_col)
    rows = located(pages, F.col(id_col).alias("id"), F.col(url_col).alias("url"), html)
    kinds = dict(rows.dtypes)
    read = rows.join(other, [FILE, AT], "left").select("id", "url", "html", "winner")
    found = read.mapInArrow(_extract, f"id {kinds['id']}, url {kinds['url']}, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))

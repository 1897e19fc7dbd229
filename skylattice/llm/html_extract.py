"""Main text of web pages by consensus paths per host.

Every page's containers are scored by the running text they hold. Their paths,
tags with generalised classes, are votes; a Spark aggregation adds them per host
and keeps the paths that win a fair share of its pages. Each page is then read
again and its text taken from the winning path it has, so that a page with a long
comment or a short article still follows its host. A page whose host has no
usable path falls back to its own best container.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from skylattice.session import broadcast_if_small, materialize

#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg".split())
#: Elements that end a block of text where they start and end.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that can hold an article.
CONTAINER = frozenset("article body center dialog div html main section td".split())
#: Elements that are no part of an article.
OUTSIDE = frozenset(
    "aside button datalist dialog footer form head input label legend menu nav object select".split()
)
#: Elements that stress a word of a sentence; their class says nothing about the page.
STRESS = frozenset("abbr b cite code del dfn em font i ins kbd mark math q s samp small strong sub sup time u var".split())
#: Words in a class, id or role that mark what is no part of an article.
MARKS = frozenset(
    "ad ads adv advert advertisement advertising adslot adsbygoogle alert banner breadcrumb breadcrumbs "
    "byline captcha comment commentlist comments complementary consent contentinfo cookie cookies copyright "
    "dialog disclaimer discussion disqus footer gdpr header hidden legal login masthead menu menubar modal "
    "nav navbar navigation newsletter notice notification overlay pager pagination paywall popup promo "
    "promoted promotion reactions recommended related replies reply respond responses search share sharing "
    "sidebar signin signup skip social sponsor sponsored subscribe subscription tags teaser toolbar topbar "
    "widget".split()
)
#: Marks that are fine inside an article, where they hold its title.
TITLES = frozenset(["header", "banner", "masthead"])
#: Marks that may as well name a section of an article, whose own text then decides.
TOPICS = frozenset("legal overlay related search share sharing skip social tags widget".split())
#: Characters of a paragraph that may be one of the article's, and the most of an element's that links may hold.
PARAGRAPH, LINKED = 80, 0.2

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
NAME = re.compile(r"[a-z]+")
#: First parts of class names that speak about the page or the post, not about the element.
ABOUT = re.compile(r"(?:has|no|with|without|category|tag)[-_].*")
#: What differs between pages of one template: numbers and long hashes.
VARIABLE = re.compile(r"[0-9a-f]*\d[0-9a-f]*")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Page:
    """Blocks of text with their container, and the containers' labels, parents and keys.

    A block is (container, text, characters in links, whether in a list of
    links). A container's key is a 64-bit hash of the labels on its path, so that
    a page needs no path in full but for the one it is read by.
    """

    blocks: list[tuple[int, str, int, bool]] = field(default_factory=list)
    labels: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [-1])
    keys: list[int] = field(default_factory=lambda: [0])

    def add(self, parent: int, label: str) -> int:
        """A container inside another one; its number."""
        key = xxhash.xxh64_intdigest(label.encode("utf-8", "replace"), self.keys[parent] & (1 << 64) - 1)
        self.labels.append(label)
        self.parents.append(parent)
        self.keys.append(key - (1 << 64) if key >> 63 else key)
        return len(self.keys) - 1

    def path(self, container: int) -> str:
        """The labels from the page to a container."""
        names = []
        while container >= 0:
            names.append(self.labels[container])
            container = self.parents[container]
        return "/".join(reversed(names))


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


def _label(tag: str, attributes: dict[str, str]) -> str:
    """The tag with its classes (or id) generalised."""
    names = sorted({VARIABLE.sub("#", x) for x in attributes.get("class", "").lower().split()})
    if not names and attributes.get("id"):
        return f"{tag}#{VARIABLE.sub('#', attributes['id'].lower())}"
    return ".".join([tag, *names])


def _is_outside(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in OUTSIDE or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    return bool("hidden" in attributes or attributes.get("aria-hidden") == "true" or HIDDEN.search(attributes.get("style", "")))


def _mark(tag: str, attributes: dict[str, str], in_article: bool) -> tuple[float, bool] | None:
    """None without a mark, else the share of the page's running text that overrides it and whether it may be a topic.

    A mark that is a whole name or its last part says more than one in front.
    Inside an article, marks that are all ``TOPICS`` may name one of its sections.
    """
    if not attributes or tag in ("html", "body") or tag in STRESS:
        return None
    said = [attributes.get(x, "") for x in (("role",) if tag in ("article", "main") else ("class", "id", "role"))]
    names = [x for x in " ".join(said).lower().split() if not ABOUT.fullmatch(x)]
    marks = MARKS - TITLES if in_article else MARKS
    parts = [NAME.findall(x) for x in names]
    found = {y for x in parts for y in x if y in marks}
    if not found:
        return None
    return 1.0 if any(x and x[-1] in marks for x in parts) else 0.9, in_article and found <= TOPICS


def _without_marked(
    page: Page,
    under: list[int],
    parents: list[int],
    marks: list[tuple[float, bool]],
    mains: list[int],
    articles: list[int],
) -> None:
    """Drop the blocks of marked elements, but for elements that hold the page's article or a section of it.

    ``under`` is the innermost marked element of each block (-1: none), ``parents``
    that around each marked element; ``mains`` and ``articles`` are those around
    each main and article. An element holds the page's article if a main is in it
    or, while no main or article is outside marked elements, an article or its
    share of the running text. It holds a section if its mark may be a topic and
    its own text, without marked elements inside, has few links and a paragraph
    that ends as a sentence does.
    """
    if not parents:
        return
    around = set(mains)
    stated = -1 in mains or -1 in articles
    if not stated:
        around.update(articles)
    worth = [max(0, len(text) - 2 * linked) for _, text, linked, _ in page.blocks]
    held, size, links, prose = ([0] * len(parents) for _ in range(4))
    for x, w, (_, text, linked, _) in zip(under, worth, page.blocks):
        if x >= 0:
            held[x] += w
            size[x] += len(text)
            links[x] += linked
            prose[x] += len(text) >= PARAGRAPH and text.rstrip("\"')]»”’").endswith((".", "!", "?", "…", "。"))
    for x in range(len(parents) - 1, -1, -1):  # elements inside come after those around them
        if parents[x] >= 0:
            held[parents[x]] += held[x]
    total = sum(worth)
    fine = [not stated and 0 < share * total <= h for h, (share, _) in zip(held, marks)]
    for x, (_, topic) in enumerate(marks):
        fine[x] = fine[x] or (topic and prose[x] > 0 and links[x] <= LINKED * size[x])
    for x in around:
        while x >= 0:
            fine[x] = True
            x = parents[x]
    gone = []
    for x, parent in enumerate(parents):
        gone.append(not fine[x] or (parent >= 0 and gone[parent]))
    page.blocks = [b for b, x in zip(page.blocks, under) if x < 0 or not gone[x]]


def parse(source: str) -> Page:
    """The text blocks of a page outside menus, notices, forms and the like.

    End tags may be missing: a block element ends an open paragraph, a list item
    or cell ends its predecessor, and an end tag closes all that is open inside.
    """
    page = Page()
    # open elements: tag, container, outside, in an article, blocks and links at its start, marked element
    stack: list[tuple[str, int, bool, bool, int, int, int]] = [("", 0, False, False, 0, 0, -1)]
    under: list[int] = []
    marked_in: list[int] = []
    marks: list[tuple[float, bool]] = []
    mains: list[int] = []
    articles: list[int] = []
    text: list[str] = []
    link_chars = links = depth_a = 0

    def flush() -> None:
        nonlocal link_chars
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                page.blocks.append((stack[-1][1], joined, link_chars, False))
                under.append(stack[-1][6])
            text.clear()
        link_chars = 0

    def close(to: int) -> None:
        nonlocal depth_a
        while len(stack) > to:
            tag, _, _, in_article, first, before, _ = stack[-1]
            if tag in BLOCK:
                flush()
            if tag in ("ul", "ol") and links - before >= 2 and not in_article:
                chars = sum(len(b[1]) for b in page.blocks[first:])
                if sum(b[2] for b in page.blocks[first:]) >= 0.8 * chars:
                    page.blocks[first:] = [(*b[:3], True) for b in page.blocks[first:]]
            depth_a -= tag == "a"
            stack.pop()

    def open_at(tags: tuple[str, ...], until: frozenset | tuple) -> int | None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in until:
                return None
        return None

    def add(part: str) -> None:
        nonlocal link_chars
        if part and not stack[-1][2]:
            if "&" in part:
                part = entities.unescape(part)
            text.append(part)
            if depth_a:
                link_chars += len(part.strip())

    at, end = 0, len(source)
    search = TOKEN.search
    while at < end:
        m = search(source, at)
        if m is None:
            add(source[at:])
            break
        if m.start() > at:
            add(source[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in BLOCK:
                i = open_at((tag,), ())
                if i is None or tag in ("body", "html"):
                    flush()
                else:
                    close(i)
            elif tag == "br":
                add(" ")
            else:
                i = open_at((tag,), BLOCK)
                if i is not None:
                    close(i)
            continue
        if tag in VOID:
            if tag in BLOCK:
                flush()
            elif tag == "br":
                add(" ")
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = stop.end() if stop else end
            continue
        if tag in BLOCK:
            i = open_at(("p",), CONTAINER)
            if i is not None:
                close(i)
            if tag == "li":
                i = open_at(("li",), ("ul", "ol", "menu"))
            elif tag in ("dt", "dd"):
                i = open_at(("dt", "dd"), ("dl",))
            elif tag in ("td", "th"):
                i = open_at(("td", "th"), ("tr", "table"))
            elif tag == "tr":
                i = open_at(("tr",), ("table",))
            else:
                i = None
            if i is not None:
                close(i)
            flush()
        _, container, outside, in_article, _, _, marked = stack[-1]
        attributes = _attributes(m[3]) if m[3] else {}
        if tag in CONTAINER:
            container = page.add(container, _label(tag, attributes))
        outside = outside or _is_outside(tag, attributes, in_article)
        mark = None if outside else _mark(tag, attributes, in_article)
        if mark is not None:
            if tag in BLOCK:
                marked_in.append(marked)
                marks.append(mark)
                marked = len(marked_in) - 1
            elif not (in_article and any(x.strip() for x in text)):  # inside a sentence it is a part of it
                outside = True
        if not outside and tag == "main":
            mains.append(marked)
        elif not outside and tag == "article" and not in_article:
            articles.append(marked)
        if tag == "a":
            depth_a += 1
            links += 1
        stack.append((tag, container, outside, in_article or tag == "article", len(page.blocks), links, marked))
    close(1)
    flush()
    _without_marked(page, under, marked_in, marks, mains, articles)
    return page


def container_scores(page: Page) -> dict[int, float]:
    """For each key the text of its containers; a parent gets half of what its child holds."""
    found: dict[int, float] = {}
    for container, text, linked, _ in page.blocks:
        worth = float(max(0, len(text) - 2 * linked))
        while container >= 0 and worth >= 1:
            key = page.keys[container]
            found[key] = found.get(key, 0.0) + worth
            worth /= 2
            container = page.parents[container]
    return found


def best_key(scores: dict[int, float], page: Page) -> int | None:
    """The key of the largest score; of equal ones the deepest container's, then the first in the page."""
    if not scores:
        return None
    best = max(scores.values())
    depth: list[int] = []
    for parent in page.parents:
        depth.append(depth[parent] + 1 if parent >= 0 else 0)
    return page.keys[max((i for i, k in enumerate(page.keys) if scores.get(k) == best), key=lambda i: (depth[i], -i))]


def text_at(page: Page, key: int) -> str:
    """The blocks inside containers of ``key``, in page order, joined by two line feeds.

    A list of links is part of the text behind its first running block; in a page
    without a container of its own only up to the last one.
    """
    inside = [False] * len(page.keys)
    for i, (own, parent) in enumerate(zip(page.keys, page.parents)):
        inside[i] = own == key or (parent >= 0 and inside[parent])
    blocks = [b for b in page.blocks if inside[b[0]]]
    running = [i for i, (_, text, linked, listed) in enumerate(blocks) if not listed and len(text) > 2 * linked]
    first = running[0] if running else len(blocks)
    tag = re.split("[.#]", page.labels[page.keys.index(key)], maxsplit=1)[0] if key in page.keys else ""
    last = running[-1] if running and tag in ("", "html", "body") else len(blocks)
    return "\n\n".join(b[1] for i, b in enumerate(blocks) if not b[3] or first < i < last)


def host_paths(pages: DataFrame, host_col: str, html_col: str, least_share: float = 0.1) -> DataFrame:
    """(host, paths): per host the keys of paths that are best on ``least_share`` of its pages, most votes first.

    Pages are parsed once: the votes of each path are stored before they are
    added per host and compared.
    """
    source = pages.select(host_col, html_col)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                hosts, paths, shares, best = [], [], [], []
                part = batch.slice(at, 256)
                for host, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    page = parse(source or "")
                    scores = container_scores(page)
                    first, total = best_key(scores, page), sum(scores.values())
                    for key, score in scores.items():
                        hosts.append(host)
                        paths.append(key)
                        shares.append(score / total)
                        best.append(int(key == first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hosts, pa.string()), pa.array(paths, pa.int64()), pa.array(shares, pa.float64()), pa.array(best, pa.int64())],
                    ["host", "path", "share", "best"],
                )

    votes = source.mapInArrow(vote, "host string, path long, share double, best long")
    counted = votes.groupBy("host", "path").agg(
        F.round(F.sum("share"), 6).alias("share"), F.sum("best").alias("best")
    )
    per_path = materialize(counted.where("best > 0"), "votes")
    totals = per_path.groupBy("host").agg(F.sum("best").alias("pages"))
    # at most 1 / least_share paths of a host pass
    winners = per_path.join(totals, "host").where(F.col("best") >= F.lit(least_share) * F.col("pages"))
    ranked = F.sort_array(F.collect_list(F.struct("best", "share", "path")), asc=False)
    return winners.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("paths"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_share: float = 0.1) -> DataFrame:
    """(id, url, text, n_chars, path) for every row of ``pages``: its main text and the path it came from.

    Null or empty html gives an empty text and a null path; a null url is a host
    of its own. Character references are decoded, white space in a block becomes
    one space, blocks are joined by two line feeds. Repeated rows are extracted
    alike, each on its own; an empty table gives none, and columns but the three
    named are not read, so no name clashes. Very long and deeply nested pages are
    read whole in memory that grows with their length. The host's paths are broadcast if their measured
    size allows it, else joined with a shuffle whose hot hosts are split.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    source = pages.select(F.col(id_col), F.col(url_col), F.col(html_col), host.alias("__host"))
    winners = materialize(host_paths(source, "__host", html_col, least_share), "paths")
    joined = source.join(broadcast_if_small(winners), source["__host"] == winners["host"], "left").select(
        id_col, url_col, html_col, "paths"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts, used = [], []
                for source, paths in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    page = parse(source or "")
                    own = set(page.keys)
                    text, key = "", None
                    for key in (p for p in paths or [] if p in own):
                        text = text_at(page, key)
                        if text:
                            break
                    if not text:
                        key = best_key(container_scores(page), page)
                        text = text_at(page, key) if key is not None else ""
                    texts.append(text)
                    used.append(None if key is None else page.path(page.keys.index(key)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(texts, pa.string()),
                        pa.array([len(x) for x in texts], pa.int64()),
                        pa.array(used, pa.string()),
                    ],
                    [id_col, url_col, "text", "n_chars", "path"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    return joined.mapInArrow(
        read, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long, path string"
    )

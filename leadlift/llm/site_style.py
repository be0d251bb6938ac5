"""Main text of web pages, by a site style tree.

Pages of one host are merged into one tree of elements. An element is known by its path: tags, class and id names, and
for a container without a name its place in its parent's layout. The importance of a merged node says how much it
differs from page to page (for content, one less the entropy of where each distinct block of text occurs; for
presentation, the entropy of the ways its children are laid out), how much text outside of links it holds beside the
sibling that holds most of its parent's, and, as a prior, what the element's tag and names say of itself. The prior of
an element that holds the ``article`` or ``main`` part is one: names of an ancestor are not held against it. Branches
below ``LEAST`` are removed from each page of the host. See ``weighed`` for how the three are put together.

Paths seen on few pages of a host are judged by all hosts together as to their differences, and count as differing if
those are few as well. Pages with the same text are copies and count once, per host and over all hosts.

The statistics are counts of distinct pages per (host, path, hash) that Spark adds up; a host with a third of all pages
spreads over its hashes. Pages are parsed where they lie; only the removed paths of their host are joined to them.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.sources.shipping import ship
from leadlift.sources.staging import stage

LEAST = 0.4
FEW_PAGES = 5
LEADING = 0.6  # of the text of all children: then one child leads
NEAR_LEADING = 0.15  # of the leading child's text: what has less is no main text
MAIN_PRIOR, NOISE_PRIOR = 20.0, 0.1
LAID_OUT = 8  # containers at most, for their places to tell them apart
CONTENT_SHARE = 0.9  # of a path's importance; the rest is presentation

# Elements by their meaning in HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q ruby rt rp s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
NOISE_TAGS = frozenset("nav footer aside form button select menu dialog svg head object canvas".split())
MAIN_TAGS = frozenset(("article", "main"))
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form".split())
TEXT_LEVEL = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote table caption thead tbody tfoot tr td th figure figcaption hr "
    "address details summary".split()
)
NAMELESS = frozenset("div section center fieldset hgroup".split())
# whole names, with endings that only say what kind of box it is
NOISE_NAME = re.compile(
    r"(?:[a-z]+[_-])?(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notice|popup|modal|overlay|sidebar|"
    r"side-bar|menu|nav|navbar|navigation|breadcrumbs?|share|sharing|social|comments?|disqus|replies|related|"
    r"recommended|recommendations|newsletter|subscribe|login|signup|search|footer|pagination|toolbar|widget)"
    r"(?:[_-]?(?:box|list|section|area|block|wrapper|container|links?|posts?|form|bar|panel|#|\d+))*",
    re.I,
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_NAME = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")


class Page:
    """Elements and text blocks of one page.

    Elements are numbered in page order, 0 being the page; lists hold one entry per element, so a page costs time and
    memory in proportion to its length, however deep it is. Blocks are (element, text).
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[int, str]] = []
        self.tags, self.kinds, self.parents, self.priors = [""], [""], [0], [1.0]
        self.children: list[list[int]] = [[]]
        self.own_text, self.own_links = [0], [0]
        self.stack = [0]
        self.depths: dict[str, list[int]] = {}  # open elements of a tag, as places in the stack
        self.text: list[str] = []
        self.linked, self.in_link = 0, False
        self._read(source)
        self._place()

    def _read(self, source: str) -> None:
        at = 0
        while at < len(source):
            token = _TOKEN.search(source, at)
            if token is None:
                self._say(source[at:])
                break
            if token.start() > at:
                self._say(source[at : token.start()])
            at = token.end()
            if token[2] is None:
                continue
            tag = token[2].lower()
            if token[1]:
                self._close(tag)
            else:
                self._open(tag, token[3])
                if tag in RAW and not token[3].rstrip().endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}[^>]*(?:>|\Z)", re.I).search(source, at)
                    at = end.end() if end else len(source)
        self._flush()

    def _say(self, text: str) -> None:
        self.text.append(text)
        if self.in_link:
            self.linked += len(text.strip())

    def _open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text.append(" ")
            return
        if tag in RAW or tag in ("html", "body"):
            return
        if tag not in INLINE:
            self._flush()
            if tag in CLOSES_P:
                self._close("p", quiet=True)
            for other in SAME.get(tag, ()):
                self._close(other, quiet=True, within=("ul", "ol", "dl", "table", "select"))
        if tag == "a":
            self.in_link = True
        if tag in VOID or tag in INLINE:
            return
        found = _NAME.findall(attributes)
        names = " ".join([a or b or c for kind, a, b, c in found if kind.lower() != "role"])
        role = " ".join([a or b or c for kind, a, b, c in found if kind.lower() == "role"]).lower()
        main = tag in MAIN_TAGS or role == "main"
        told = tag in NOISE_TAGS or role in NOISE_ROLES or (not main and any(map(NOISE_NAME.fullmatch, names.split())))
        if tag == "header" and not any(self.depths.get(t) for t in MAIN_TAGS):
            told = True
        number = len(self.tags)
        self.children[self.stack[-1]].append(number)
        self.parents.append(self.stack[-1])
        self.tags.append("main" if main else tag)
        kind = re.sub(r"\d+", "#", ".".join(sorted(set(names.lower().split()))))
        self.kinds.append(f"{tag}.{kind}" if kind else tag)
        self.priors.append(MAIN_PRIOR if main else NOISE_PRIOR if told else 1.0)
        self.children.append([])
        self.own_text.append(0)
        self.own_links.append(0)
        self.depths.setdefault(tag, []).append(len(self.stack))
        self.stack.append(number)

    def _close(self, tag: str, quiet: bool = False, within: tuple[str, ...] = ()) -> None:
        """Close the innermost open ``tag`` and what is open inside it; ``quiet`` stops at an enclosing ``within``."""
        if tag in INLINE:
            if tag == "a":
                self.in_link = False
            return
        innermost = self.depths.get(tag)
        stops = [self.depths[t][-1] for t in (*within, *MAIN_TAGS) if self.depths.get(t)] if quiet else []
        if innermost and innermost[-1] >= max(stops, default=0):
            self._flush()
            depth = innermost[-1]
            for place in range(len(self.stack) - 1, depth - 1, -1):
                self.depths[self.kinds[self.stack[place]].split(".", 1)[0]].pop()
            del self.stack[depth:]
        elif not quiet:
            self._flush()

    def _flush(self) -> None:
        if self.text:
            text = _SPACE.sub(" ", html.unescape("".join(self.text))).strip()
            if text:
                self.blocks.append((self.stack[-1], text))
                self.own_text[self.stack[-1]] += len(text)
                self.own_links[self.stack[-1]] += min(self.linked, len(text))
        self.text, self.linked, self.in_link = [], 0, False

    def _place(self) -> None:
        """Paths as hashes, sums over branches, and whether an element holds or lies in the main part."""
        count = len(self.tags)
        self.branch_text, self.branch_links = list(self.own_text), list(self.own_links)
        self.holds_main, self.in_main = [False] * count, [False] * count
        for i in range(count - 1, 0, -1):
            up = self.parents[i]
            self.branch_text[up] += self.branch_text[i]
            self.branch_links[up] += self.branch_links[i]
            self.holds_main[up] |= self.holds_main[i] or self.tags[i] == "main"
        self.paths = [0] * count
        for i in range(count):
            if not self.children[i]:
                continue
            containers = [self.kinds[c] for c in self.children[i] if self.tags[c] not in TEXT_LEVEL]
            layout = " ".join(containers) if len(containers) <= LAID_OUT else ""
            place, inside = 0, self.in_main[i] or self.tags[i] == "main"
            hashes: dict[str, int] = {}
            for c in self.children[i]:
                step = self.kinds[c]
                if self.tags[c] not in TEXT_LEVEL:
                    # containers without a name are told apart by their place in their parent's layout
                    if layout and step in NAMELESS:
                        step = f"{step}@{place} {layout}"
                    place += 1
                    if self.holds_main[c] and self.priors[c] < 1:
                        self.priors[c] = 1.0  # what it says of itself is not said of the article
                if step not in hashes:
                    hashes[step] = _hash(f"{self.paths[i]}/{step}")
                self.paths[c] = hashes[step]
                self.in_main[c] = inside

    def place_of(self, element: int) -> str:
        """The last steps of an element's path, to read."""
        up = self.parents[element]
        return "/".join([self.kinds[e] for e in (self.parents[up], up, element) if e])

    def kept(self, removed: set[int]) -> list[str]:
        """Texts of the blocks outside of removed branches."""
        gone = [False] * len(self.tags)
        for i in range(1, len(gone)):
            gone[i] = gone[self.parents[i]] or self.paths[i] in removed
        return [text for element, text in self.blocks if not gone[element]]

    def told(self) -> set[int]:
        """Paths of what elements say of themselves is no main text."""
        return {path for path, prior in zip(self.paths, self.priors, strict=True) if prior < 1}


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) >> 1


NODE = "parent bigint, place string, container boolean, in_main boolean, prior double, text bigint, links bigint"


def statistics(page: Page) -> list[tuple]:
    """What a page adds to its host's tree: (path, kind, hash, parent, place, ..), each path, kind and hash once."""
    nodes: dict[int, list] = {}
    rows: set[tuple[int, str, int]] = set()
    for i, path in enumerate(page.paths):
        node = nodes.get(path)
        if node is None:
            up = page.paths[page.parents[i]] if i else None
            nodes[path] = [up, page.place_of(i), page.tags[i] not in TEXT_LEVEL, page.in_main[i], page.priors[i], 0, 0]
            node = nodes[path]
        node[4] = max(node[4], page.priors[i])
        node[5] += page.branch_text[i]
        node[6] += page.branch_links[i]
        if page.children[i]:
            # runs of one tag count as one: a page with more paragraphs is laid out alike
            tags = [page.tags[c] for c in page.children[i]]
            rows.add((path, "style", _hash(" ".join([t for n, t in enumerate(tags) if not n or tags[n - 1] != t]))))
    for element, text in page.blocks:
        rows.add((page.paths[element], "content", _hash(text)))
    return [(path, "page", 0, *node) for path, node in nodes.items()] + [(*row, *[None] * 7) for row in rows]


def vote(page: Page) -> int:
    """Hash of the texts outside of what says it is no main text: copies of a page have the same."""
    return _hash("\n".join(page.kept(page.told())))


def main_text(page: Page, removed: set[int]) -> str:
    """Blocks that stay, one per line; removed paths take their branches with them.

    A page of another make than its host's, without a declared main part, may lose all of them: then only what says
    itself that it is no main text goes.
    """
    kept = page.kept(removed)
    if not kept and "main" not in page.tags:
        kept = page.kept(page.told())
    return "\n".join(kept)


def hosted(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    return pages.select(F.col("page_id").cast("bigint"), "url", "html", host.alias("host"))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, place, pages, importance) of the merged trees of ``pages(page_id, url, html, ..)``, one per host.

    ``path`` is a hash, ``place`` its last steps to read. ``pages`` counts copies, importance does not.
    """
    ship(pages.sparkSession)

    def count(batches):
        names = ["host", "vote", "path", "kind", "hash", "parent", "place", "container", "in_main", "prior", "text", "links"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        kinds += [pa.bool_(), pa.bool_(), pa.float64(), pa.int64(), pa.int64()]
        for batch in batches:
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page = Page(source or "")
                same = vote(page)
                columns = list(zip(*[(host, same, *row) for row in statistics(page)], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    seen = hosted(pages).select("host", "html").mapInArrow(
        count, f"host string, vote bigint, path bigint, kind string, hash bigint, {NODE}"
    )
    # a path fixes its facts, so they may as well be keys; the rest is equal in all copies
    facts = ["parent", "place", "container", "in_main"]
    per_vote = [F.max(c).alias(c) for c in ("prior", "text", "links")]
    votes = seen.groupBy("host", "path", "kind", "hash", "vote", *facts).agg(F.count(F.lit(1)).alias("copies"), *per_vote)
    votes = stage(votes, "style_votes")
    votes_per_hash = F.count(F.lit(1)).alias("count")
    own = importance(
        votes.groupBy("host", "path", "kind", "hash").agg(votes_per_hash, F.sum("copies").alias("copies")), ["host", "path"]
    )
    # a page that several hosts have counts once here
    pooled = votes.groupBy("path", "kind", "hash", "vote").agg(F.sum("copies").alias("copies"))
    pooled = importance(
        pooled.groupBy("path", "kind", "hash").agg(votes_per_hash, F.sum("copies").alias("copies")), ["path"]
    ).select("path", F.col("distinct").alias("_distinct"), F.col("importance").alias("_pooled"))
    differing = (
        F.when(F.col("distinct") >= FEW_PAGES, F.col("importance"))
        .when(F.col("_distinct") >= FEW_PAGES, F.col("_pooled"))
        .otherwise(F.lit(1.0))
    )
    differing = own.join(pooled, "path").select("host", "path", "pages", differing.alias("differing"))
    sums = [F.max("prior").alias("prior"), F.sum("text").alias("text"), F.sum("links").alias("links")]
    nodes = votes.where("kind = 'page'").groupBy("host", "path", *facts).agg(*sums)
    return weighed(stage(nodes.join(differing, ["host", "path"]), "style_nodes"))


def weighed(nodes: DataFrame) -> DataFrame:
    """(host, path, place, pages, importance) from the merged nodes' texts, priors and differences.

    The importance is the product of three parts. The prior is what the element says of itself. Its difference from
    page to page counts where its parent's text differs; where pages share the parent's text, only for containers that
    hold less than half of it. And where one child holds most of a parent's text outside of links, weighed by priors,
    outside of a declared main part, a sibling counts by its text as a share of that child's.
    """
    own = (F.col("text") - F.least("links", "text")) * F.col("prior")
    children = nodes.where("parent is not null").withColumn("own", own.cast("double"))
    parents = children.groupBy("host", "parent").agg(
        F.max("own").alias("_top"),
        F.sum("own").alias("_all"),
        F.sum("text").alias("_text"),
        F.sum(F.col("text") * F.col("differing")).alias("_differing"),
    )
    both = children.join(parents, ["host", "parent"])
    varied = F.col("_differing") >= F.lit(LEAST) * F.col("_text")
    judged = varied | (F.col("container") & (F.col("text") < 0.5 * F.col("_text")))
    led = ~F.col("in_main") & (F.col("_top") > 0) & (F.col("_top") >= F.lit(LEADING) * F.col("_all"))
    share = F.least(F.lit(1.0), F.col("own") / (F.lit(NEAR_LEADING / LEAST) * F.col("_top")))
    weight = F.least(F.lit(1.0), "prior") * F.when(judged & (F.col("prior") <= 1), F.col("differing")).otherwise(1.0)
    found = (weight * F.when(led, share).otherwise(1.0)).alias("importance")
    return both.select("host", "path", "place", "pages", found)


def importance(counts: DataFrame, by: list[str]) -> DataFrame:
    """Pages, distinct pages and importance per ``by``: entropies to the base of the number of distinct pages.

    ``count`` has the distinct pages of a hash, ``copies`` all of them. The importance is one for a single page.
    """
    n = F.col("count").cast("double")
    content, style = F.col("kind") == "content", F.col("kind") == "style"
    summed = counts.groupBy(*by).agg(
        F.max(F.when(F.col("kind") == "page", F.col("copies"))).alias("pages"),
        F.max(F.when(F.col("kind") == "page", F.col("count"))).alias("distinct"),
        F.count(F.when(content, 1)).alias("blocks"),
        F.sum(F.when(content, F.ln(n))).alias("spread"),
        F.sum(F.when(style, n)).alias("laid"),
        F.sum(F.when(style, n * F.ln(n))).alias("laid_log"),
    )
    base = F.ln(F.col("distinct").cast("double"))
    # a block that occurs once on each of n pages has entropy ln n; the average over distinct blocks
    differing = 1 - F.col("spread") / F.col("blocks") / base
    layouts = (F.ln("laid") - F.col("laid_log") / F.col("laid")) / base
    return summed.select(
        *by,
        "pages",
        "distinct",
        F.when(F.col("distinct") <= 1, F.lit(1.0))
        .when(F.col("blocks") == 0, F.lit(1.0))
        .otherwise(F.lit(CONTENT_SHARE) * differing + F.lit(1 - CONTENT_SHARE) * F.coalesce(layouts, F.lit(0.0)))
        .alias("importance"),
    )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of ``pages(page_id, url, html, ..)``; other columns are left out.

    Blocks are joined by line breaks; a page without any, a null or an empty page gives an empty text. Pages without a
    url, or with one that names no host, form one site. Repeated rows repeat their text.
    """
    tree = style_tree(pages)
    low = tree.where(F.col("importance") < LEAST).groupBy("host").agg(F.collect_set("path").alias("removed"))
    # written first: its size is known when Spark chooses the join
    low = stage(low.select(F.col("host").alias("_host"), "removed"), "removed_paths")
    joined = hosted(pages)
    joined = joined.join(low, joined["host"] == low["_host"], "left").select("page_id", "url", "html", "removed")

    def extract(batches):
        for batch in batches:
            rows = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            texts = [main_text(Page(source or ""), set(removed or ())) for source, removed in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    return joined.mapInArrow(extract, "page_id bigint, url string, text string")

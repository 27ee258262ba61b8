"""HTML extraction with site style trees.

Each page is parsed to a DOM whose nodes carry a presentation key (a hash of tag, class, id and role and of the key of the
parent, so of the whole branch). The DOMs of one host are merged: for every key the tree counts pages,
visible text, and how pages differ in what stands there. The importance of a node is the
entropy of its contents over the pages of the host, relative to the largest possible (log of the pages): a menu that
is the same everywhere has 0, an article has 1. Keys whose content repeats that way, with ``MIN_PAGES`` pages to judge
by, are removed with all below them. A host with fewer pages lends the verdict of the tree of all hosts
together, which is merged the same way under an empty host name.

Nodes whose meaning is told by their tag or by a name in their class, id or role (menus, headers outside an article,
footers, sidebars, notices, adverts, forms, comments, scripts, styles) are removed before that and are not counted.
If a page has an article or main element with text, only what is inside counts as content, and inside it the trees
remove only elements with a class, id or role: a heading or paragraph that many pages share is still text. If removal
would leave nothing (a host of copies of one page), the page keeps its branches. What is left is cut
into blocks at block elements; white space inside a block becomes one space, and blocks are joined by two line ends.

Trees are sums over (host, key, content hash), so a hot host is added up inside tasks first and then dealt by content.
The keys of each page are saved once as rows (host, page, key), where a page is named by the digest of its html, and joined to the keys to
remove of its host and to those of the merged tree, dealt over ``SALTS`` parts, as one key can stand on most pages. A page then gets its own found
keys as a list, which is never longer than the page's DOM; no list goes over a host or over all hosts, and none to the driver.

Defined results: null and empty html give an empty text of length 0; a null or odd URL belongs to the empty
host; unclosed, stray and cut-off tags are read as browsers do in simple cases, and a tag with an unbalanced quotation mark
ends at its next ``>``; repeated rows get equal results and count as pages of their own; an empty table gives no rows; extra columns
pass through whatever their name, but for text, which is replaced. Time is linear in the page, however deep its elements are nested.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import hub_join, save, table

MIN_PAGES = 8
MIN_IMPORTANCE = 0.3
SALTS = 8
BASE, PRIME = 0x2545F4914F6CDD1D, (1 << 61) - 1
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "select", "object", "canvas", "audio", "video"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
NOISE_TAG = frozenset("nav aside footer form head button script style noscript template iframe svg math select textarea title object canvas audio video menu dialog".split())
NOISE_ROLE = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar form".split())
NOISE_NAME = re.compile(r"(?:^|[-_\s])(?:ad|ads|adv|advert\w*|adsense|banner|breadcrumbs?|comments?|commentlist|cookies?|consent|copyright|disqus|footer|header|masthead|menu|nav|navbar|navigation|newsletter|notice|notices|notification|alert|popup|modal|promo\w*|related|replies|respond|share|sharing|sidebar|side-bar|social|sponsor\w*|subscribe|toolbar|widget\w*)(?:$|[-_\s\d])")
#: First words that say what an element has or lacks.
NEGATED = frozenset("no not non has have with without".split())
#: Elements that a slash closes, besides the void ones.
FOREIGN = frozenset(("svg", "math"))
P_CLOSERS = BLOCK - {"html", "body", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "optgroup", "legend", "summary"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = frozenset(("ul", "ol", "dl", "table", "select", "menu"))
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"(?=[\s/>])|'[^']*'(?=[\s/>])|[\"'])*+)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
SPACE = re.compile(r"\s+")
HEADER_OK = frozenset(("article", "main"))
HOST = r"(?s)^.*?://([^/?#]*)"


class Node:
    __slots__ = ("children", "key", "names", "noise", "parent", "tag")

    def __init__(self, tag: str, parent: Node | None, names: str = "", noise: bool = False):
        self.tag, self.parent, self.names, self.noise = tag, parent, names, noise
        self.children: list[Node | str] = []
        self.key = 0


def noise_name(names: str) -> bool:
    """A class or id word that names a menu, advert and so on; one that says what an element has or lacks (``has-sidebar``, ``no-comments``) names nothing."""
    for word in names.lower().split():
        m = NOISE_NAME.search(word)
        if m and not NEGATED.intersection(re.split("[-_]", word[: m.start() + 1])):
            return True
    return False


def is_noise(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    if tag in NOISE_TAG or (tag == "header" and not inside) or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if tag in ("html", "body") or (tag in HEADER_OK):
        return False
    if attributes.get("role") in NOISE_ROLE:
        return True
    return any(noise_name(attributes[a]) for a in ("class", "id") if attributes.get(a))


class Open:
    """The open elements, with the depths of each tag, of blocks and of scopes, so that no end tag has to look for its element."""

    def __init__(self):
        self.nodes = [Node("#", None)]
        self.depths: dict[str, list[int]] = {}
        self.blocks, self.scopes, self.articles = [0], [0], [0]

    def kinds(self, tag: str) -> list[list[int]]:
        return [self.depths.setdefault(tag, [0]), *[held for held, tags in ((self.blocks, BLOCK), (self.scopes, SCOPE), (self.articles, HEADER_OK)) if tag in tags]]

    def push(self, node: Node) -> None:
        for held in self.kinds(node.tag):
            held.append(len(self.nodes))
        self.nodes.append(node)

    def close(self, depth: int) -> None:
        """Close the elements from this depth on."""
        while len(self.nodes) > depth:
            for held in self.kinds(self.nodes.pop().tag):
                held.pop()

    def last(self, tag: str) -> int:
        """Depth of the innermost open element of a tag, 0 if there is none."""
        return self.depths.get(tag, (0,))[-1]

    def end(self, tag: str) -> None:
        depth = self.last(tag)
        if depth and (tag in ("body", "html", *HEADER_OK) or depth > self.articles[-1]):
            self.close(depth)

    def shut_for(self, tag: str) -> None:
        """Close what the start of this tag closes: a paragraph, or a sibling item of the same list or table."""
        if tag in CLOSES:
            depth = max(map(self.last, CLOSES[tag]))
            if depth > self.scopes[-1]:
                self.close(depth)
        elif tag in P_CLOSERS and self.nodes[self.blocks[-1]].tag == "p":
            self.close(self.blocks[-1])


def parse(html: str) -> Node:
    """The DOM; texts are decoded strings among the children."""
    open_, at, size = Open(), 0, len(html)
    while at < size:
        m = TOKEN.search(html, at)
        if m is None:
            open_.nodes[-1].children.append(unescape(html[at:]))
            break
        if m.start() > at:
            open_.nodes[-1].children.append(unescape(html[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            open_.end(tag)
            continue
        open_.shut_for(tag)
        node = open_.nodes[-1]
        attributes = {a[1].lower(): a[2] or a[3] or a[4] or "" for a in ATTRIBUTE.finditer(m[3])} if m[3] else {}
        child = Node(tag, node, f"{attributes.get('class', '')}|{attributes.get('id', '')}|{attributes.get('role', '')}" if attributes else "", is_noise(tag, attributes, len(open_.articles) > 1))
        node.children.append(child)
        if tag in VOID or (tag in FOREIGN and m[3].endswith("/")):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else size
            continue
        open_.push(child)
    return open_.nodes[0]


def walk(root: Node) -> Iterator[Node]:
    """Nodes outside noise, parents first, with their presentation keys set."""
    todo = [root]
    while todo:
        node = todo.pop()
        if node.noise:
            continue
        if node.parent is not None:
            node.key = xxhash.xxh64_intdigest(f"{node.parent.key}/{node.tag}.{node.names}") - (1 << 63)
        yield node
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]


def has_text(node: Node) -> bool:
    todo: list[Node | str] = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            if not x.isspace():
                return True
        elif not x.noise:
            todo += x.children
    return False


def style_rows(html: str) -> dict[int, int]:
    """Key to content hash for the page's block nodes with text; equal keys of a page are hashed together.

    A content is the sequence of texts below a node. Its hash is a polynomial one, so a node's is made of those of its children and each
    text is hashed once.
    """
    nodes = list(walk(parse(html)))
    found: dict[int, tuple[int, int]] = {}
    sums: dict[int, tuple[int, int]] = {}  # hash and length of the sequence below a node
    for node in reversed(nodes):  # children before parents
        h, n = 0, 0
        for child in node.children:
            if isinstance(child, str):
                said = SPACE.sub(" ", child).strip()
                if said:
                    h, n = (h * BASE + xxhash.xxh64_intdigest(said)) % PRIME, n + 1
            elif not child.noise:
                below, length = sums.pop(id(child))
                if length:
                    h, n = (h * pow(BASE, length, PRIME) + below) % PRIME, n + length
        sums[id(node)] = h, n
        if n and node.tag in BLOCK and node.tag not in ("html", "body"):
            before, length = found.get(node.key, (0, 0))
            found[node.key] = ((before * BASE + h + 1) % PRIME, length + 1)
    return {key: h for key, (h, _) in found.items()}


def main_text(html: str | None, removed: frozenset[int] = frozenset()) -> str:
    """The blocks of the page without noise and without the given keys."""
    if not html:
        return ""
    return (_main_text(html, removed) or _main_text(html, frozenset())) if removed else _main_text(html, removed)


def _main_text(html: str, removed: frozenset[int]) -> str:
    root = parse(html)
    tops, within = [], {}
    for node in walk(root):  # parents first
        around = within.get(id(node.parent))  # the innermost article or main element around it
        if node.key in removed and (node.names or (around is None and node.tag not in HEADER_OK)):
            node.noise = True
        elif node.tag in HEADER_OK:
            tops.append((node, around))
        within[id(node)] = node if node.tag in HEADER_OK else around
    chosen, seen = [], set()
    for top, around in tops:
        # what stands in an element that was looked at is part of it
        if id(around) not in seen and not top.noise and has_text(top):
            chosen.append(top)
        seen.add(id(top))
    chosen = chosen or [root]
    blocks: list[list[str]] = [[]]
    for top in chosen:
        blocks.append([])
        todo: list[Node | str | None] = [top]
        while todo:
            x = todo.pop()
            if x is None:
                blocks.append([])
            elif isinstance(x, str):
                blocks[-1].append(x)
            elif x.tag == "br":
                blocks[-1].append(" ")
            elif not x.noise:
                if x.tag in BLOCK:
                    blocks.append([])
                    todo.append(None)
                todo += reversed(x.children)
            elif x.tag in BLOCK:
                blocks.append([])
    joined = (SPACE.sub(" ", "".join(b)).strip() for b in blocks)
    return "\n\n".join(b for b in joined if b)


KEYED = "host string, page string, key long, content long"


def page_keys(pages: DataFrame) -> DataFrame:
    """(host, page, html) to a row (host, page, key, content) for every distinct key of every page."""

    def keys(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            rows = [(host, page, key, content) for host, page, html in zip(*(c.to_pylist() for c in batch.columns), strict=True) for key, content in style_rows(html or "").items()]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "page", "key", "content"])

    return pages.select("host", "page", "html").mapInArrow(keys, KEYED)


def style_trees(keys: DataFrame) -> DataFrame:
    """Rows of ``page_keys`` to (host, key): pages and importance, for every host and, under host '', for all of them."""
    own = keys.groupBy("host", "key", "content").agg(F.count(F.lit(1)).alias("n"))
    every = own.groupBy(F.lit("").alias("host"), "key", "content").agg(F.sum("n").alias("n"))
    rows = own.filter("host != ''").unionByName(every)
    sums = rows.groupBy("host", "key").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log2("n")).alias("s"))
    entropy = F.log2("pages") - F.col("s") / F.col("pages")
    return sums.select("host", "key", "pages", F.when(F.col("pages") > 1, entropy / F.log2("pages")).otherwise(F.lit(1.0)).alias("importance"))


def keys_to_remove(trees: DataFrame, min_pages: int = MIN_PAGES, min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """(host, key) of low importance."""
    return trees.filter((F.col("pages") >= min_pages) & (F.col("importance") < min_importance)).select("host", "key")


def found_keys(keys: DataFrame, low: DataFrame, sizes: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(tree_host, tree_page, tree_keys): the keys of a page that its host's tree removes, or the merged tree if the host (sizes: host, pages, keys) has too few pages for its own."""
    salted = keys.select("host", "page", "key", F.pmod(F.xxhash64("page"), F.lit(SALTS)).alias("salt"))
    low = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    own = salted.join(low.filter("host != ''"), ["host", "key", "salt"], "left_semi").select("host", "page", "key")
    small = hub_join(salted, sizes.filter((F.col("pages") < min_pages) | (F.col("host") == "")), "host", "keys", keys.count()).select("host", "page", "key", "salt")
    every = small.join(low.filter("host = ''").drop("host"), ["key", "salt"], "left_semi").select("host", "page", "key")
    return own.unionByName(every).groupBy(F.col("host").alias("tree_host"), F.col("page").alias("tree_page")).agg(F.collect_set("key").alias("tree_keys"))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """Add text to every page."""
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), HOST, 1), F.lit("")))
    digest = F.md5(F.col(html_col).cast("binary"))
    keys = save(page_keys(pages.select(host.alias("host"), digest.alias("page"), F.col(html_col).alias("html"))), "page_keys")
    low = save(keys_to_remove(style_trees(keys), min_pages), "low_keys")
    pages_of = pages.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("pages"))
    sizes = save(pages_of.join(keys.groupBy("host").agg(F.count(F.lit(1)).alias("keys")), "host"), "host_sizes")
    # null pages stay apart
    hosted = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns if c not in (html_col, "text")]).alias("other_columns"), F.col(html_col).alias("page_html"), host.alias("page_host"), F.coalesce(digest, F.md5(F.col(url_col).cast("binary"))).alias("page_digest"))
    joined = hosted.join(found_keys(keys, low, sizes, min_pages), (F.col("page_host") == F.col("tree_host")) & (F.col("page_digest") == F.col("tree_page")), "left")

    def text(html: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, frozenset(k) if k is not None else frozenset()) for h, k in zip(html, found, strict=True)], dtype=object)

    kept = [F.col("page_html").alias(c) if c == html_col else F.col("other_columns")[c].alias(c) for c in pages.columns if c != "text"]
    return joined.select(*kept, F.pandas_udf(text, "string")(F.col("page_html"), F.col("tree_keys")).alias("text"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))

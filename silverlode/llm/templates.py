"""Main text of web pages: element subtrees that recur over a host's pages are template, and go."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.common import stored

# A subtree is template when it stands on so many pages of a host, those with equal main parts counted once.
LEAST_PAGES = 5

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[\"'=])*+)>", re.S
)
_ATTRIBUTE = re.compile(r"([A-Za-z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "svg", "template")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# An open element of the second kind ends where one of the first begins, unless one of the third lies between.
_ENDS_P = _BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
_ENDED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# What is never part of an article's text, by element, by role, and by words of its class and id.
_DROPPED = frozenset("head nav footer aside form button select dialog menu object canvas audio video input label".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead topbar comment comments disqus respond reply replies share sharing social related "
    "recommended recommendations widget widgets toolbar login search pagination pager".split()
)
# Words that do not make another thing of a name: site-footer, ad-box.
_PLAIN = frozenset("site page main top bottom global bar box block wrapper container area inner list links item items".split())
# Reader comments go by a class or an id that says so, also beside the article's own words (post-comments), and wherever they
# stand; words of other things (comments-on-x) make it a name of something else.
_COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
_WITH_COMMENTS = frozenset("section thread threads body form user users reader readers children holder view text meta".split())
_ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion".split())
_NAMED = frozenset("div section article main header ul ol dl table figure details fieldset center".split())
_MAIN_NAMES = frozenset("article content post entry story main".split())
_OF_COMMENTS = _COMMENTS | _WITH_COMMENTS | _PLAIN | _MAIN_NAMES
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr tbody thead tfoot table figcaption caption".split())


class _Node:
    __slots__ = ("tag", "dropped", "main", "inside", "parent", "children", "digest", "hash", "holds_main", "size", "comments")

    def __init__(self, tag: str, parent: _Node | None, attributes: str) -> None:
        self.tag, self.parent = tag, parent
        self.children: list[_Node | str] = []
        self.digest = xxhash.xxh3_64(tag)
        self.hash = 0
        self.inside = parent is not None and (parent.inside or parent.main or parent.tag == "article")
        self.holds_main = tag in ("article", "main")
        self.size = 0
        self.dropped = tag in _DROPPED
        self.comments = False
        self.main = tag == "main"
        if attributes and not attributes.isspace():
            self._read(attributes)
        self.holds_main |= self.main

    def _read(self, attributes: str) -> None:
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
            if key in ("class", "id"):
                for token in re.sub(r"([a-z])([A-Z])", r"\1 \2" if self.inside else r"\1-\2", value).lower().split():
                    self._named(key, token)
            elif key == "role":
                self.dropped |= value.lower() in _ROLES
                self.main |= value.lower() == "main"
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                self.dropped = True

    def _named(self, key: str, token: str) -> None:
        """What one word of a class or an id says.

        In an article, only a whole word of a class tells, as ids name its parts; comments and adverts go by their names
        there too. A name that says what is dropped is never that of a main part, whatever else it says.
        """
        parts = frozenset(re.split(r"[^a-z0-9]+", token)) - {""}
        if self.tag in _NAMED or self.tag in ("li", "dd"):
            words = parts & _COMMENTS
            sure = key == "class" or not self.inside or words & {"comment", "comments", "disqus"}
            if words and sure and all(part in _OF_COMMENTS or part.isdigit() for part in parts):
                self.comments = self.dropped = True
        if key == "class" and token in _ADVERTS:
            self.dropped = True
        if self.tag in _NAMED:
            if self.inside:
                self.dropped |= key == "class" and token in _NAMES
            else:
                self.dropped |= bool(parts & _NAMES) and parts <= _NAMES | _PLAIN | _MAIN_NAMES
        self.main |= self.tag in ("div", "section") and bool(parts & _MAIN_NAMES) and not parts & _NAMES


def _close(node: _Node) -> _Node:
    """Hash the finished subtree and hand its facts to its parent, which is returned."""
    node.hash = node.digest.intdigest() - (1 << 63)
    parent = node.parent
    parent.digest.update(node.hash.to_bytes(8, "little", signed=True))
    parent.holds_main |= node.holds_main and not node.dropped and not node.comments
    parent.size += node.size
    return parent


def parse(page: str) -> _Node:
    """A tree of elements from any text: unclosed elements end where HTML has them end, stray end tags are skipped."""
    root = at_node = _Node("", None, "")
    at = 0
    while True:
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            if not text.isspace():
                at_node.digest.update(" ".join(text.split()))
            at_node.children.append(text)
            at_node.size += len(text)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            node = at_node
            while node.parent and node.tag != tag:
                node = node.parent
            if node.parent:
                while at_node is not node:
                    at_node = _close(at_node)
                at_node = _close(at_node)
            elif tag == "br":
                at_node.children.append(" ")
            continue
        if tag in _RAW:
            if not m[3].rstrip().endswith("/"):
                end = _RAW[tag].search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in _VOID:
            at_node.children.append(" " if tag != "hr" else _Node("hr", at_node, ""))
            continue
        ended, bounds = _ENDED.get(tag, ((), ()))
        node = at_node
        stop = None
        while node.parent and node.tag not in bounds:
            if node.tag in ended or (node.tag == "p" and tag in _ENDS_P):
                stop = node
            if node.tag in ("table", "td", "th") and tag not in _ENDED:
                break
            node = node.parent
        if stop:
            while at_node is not stop:
                at_node = _close(at_node)
            at_node = _close(at_node)
        node = _Node(tag, at_node, m[3])
        at_node.children.append(node)
        if not m[3].endswith("/"):
            at_node = node
        else:
            _close(node)
    while at_node.parent:
        at_node = _close(at_node)
    root.hash = root.digest.intdigest() - (1 << 63)
    return root


def _contents(root: _Node) -> list[_Node]:
    """In page order, the outermost articles that are not dropped, else the outermost main parts, else the whole page."""
    articles: list[_Node] = []
    mains: list[_Node] = []
    todo = [(root, False)]
    while todo:
        node, in_main = todo.pop()
        if node.tag == "article" and not node.dropped:
            articles.append(node)
            continue
        if node.main and not node.dropped and not in_main:
            mains.append(node)
        below = in_main or (node.main and not node.dropped)
        todo.extend(
            (child, below)
            for child in reversed(node.children)
            if isinstance(child, _Node) and not child.comments and (not child.dropped or child.holds_main)
        )
    return articles or mains or [root]


def read(page: str | None) -> tuple[list[tuple[str, list[int]]], set[int], int]:
    """The blocks of a page's main parts in page order (text, and the hashes of the subtrees around it that may be
    template), the hashes of all such subtrees of the whole page, and the hash of its largest main part.

    Any block element may be template, but for the largest main part and what is around it. In a main part, neither may
    an element of prose (p, h1, li, ...) nor one that holds half of the part, however often they recur: texts that are
    copied within a host stay. What is dropped by name is hashed like all else, and has no text.
    """
    if not page:
        return [], set(), 0
    root = parse(page)
    contents = _contents(root)
    largest = max(contents, key=lambda n: n.size)
    guarded = largest is not root
    starts = {id(c) for c in contents}
    around: set[int] = set()
    node: _Node | None = largest
    while node:
        around.add(id(node))
        node = node.parent
    found: list[tuple[str, list[int]]] = []
    hashes: set[int] = set()
    open_: list[str] = []
    under: list[int] = []
    block_under: list[int] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(open_)).split())
        if text:
            found.append((text, block_under))
        open_.clear()

    def may_recur(node: _Node, part: _Node | None) -> bool:
        if node.tag not in _BLOCK or node.tag in ("html", "body") or id(node) in around:
            return False
        return not guarded or part is None or part is node or (node.tag not in _PROSE and 2 * node.size < part.size)

    # Deep pages: each node comes up once to open it and, with ``closing``, once to close it. ``part`` is the main part
    # that it lies in; ``live`` tells whether text counts here.
    todo: list[tuple[_Node | str, bool, _Node | None, bool]] = [(root, False, None, False)]
    while todo:
        node, closing, part, live = todo.pop()
        if isinstance(node, str):
            if live:
                open_.append(node)
            continue
        if node.tag in _BLOCK:
            flush()
        if closing:
            if may_recur(node, part):
                under.pop()
        else:
            if id(node) in starts:
                part, live = node, True
            elif node.dropped and (guarded or node.comments or not node.holds_main):
                live = False
            if may_recur(node, part):
                under.append(node.hash)
                hashes.add(node.hash)
            todo.append((node, True, part, live))
            todo.extend((child, False, part, live) for child in reversed(node.children))
        block_under = list(under) if node.tag in _BLOCK else block_under
    flush()
    return found, hashes, largest.hash


def blocks(page: str | None) -> list[tuple[str, list[int]]]:
    """The blocks of a page's main parts in page order: text, and the hashes of the subtrees that may be template."""
    return read(page)[0]


def extract(pages: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """``pages`` (url, html) with a column ``main_text``: the blocks of the main part, joined by a blank line.

    Each page is parsed twice, once to hash and once to cut, so that no copy of the texts is kept between. Every block subtree
    of the whole page, menus and footers too, is hashed, tag by tag with its text, and counted over the pages of its host by Spark.
    Those on five pages with different main parts are the host's template: their blocks go. Counts are combined before they
    move, so a hot host costs no more than others. Of what the count leaves, as on hosts of few pages, what lies outside of articles
    or main parts goes, and menus, footers, forms, scripts and the like go by element, role and class. White space within
    a block becomes one space; character references are decoded.

    A null or empty page has an empty text; a very long one is parsed in the memory of its task; a null or odd url counts as a host of its own name; repeated rows are pages
    like others; an empty table gives no rows. Only columns named in ``carried`` (all, by default) come back; one named
    main_text is replaced.
    """
    columns = [c for c in carried or pages.columns if c != "main_text"]
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    # Equal pages have equal subtrees, so their content may serve as the key.
    key = F.xxhash64("url", "html").alias("key")
    hashes = T.ArrayType(T.LongType())

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read(p.as_py())[1:] for p in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("host"),
                    pa.array([sorted(hashes) for hashes, _ in found], pa.list_(pa.int64())),
                    pa.array([content for _, content in found], pa.int64()),
                ],
                ["key", "host", "subtrees", "content"],
            )

    given = pages.select(key, host.alias("host"), "html")
    schema = given.select("key", "host").schema.add("subtrees", hashes).add("content", T.LongType())
    parsed = stored(given.mapInArrow(hashed, schema), "subtrees")
    seen = parsed.select("key", "host", "content", F.explode("subtrees").alias("subtree"))
    template = (
        seen.groupBy("host", "subtree")
        .agg(F.count_distinct("content").alias("n"))
        .where(F.col("n") >= LEAST_PAGES)
        .select("host", "subtree")
    )
    hit = seen.join(template, ["host", "subtree"]).groupBy("key").agg(F.collect_set("subtree").alias("template"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, template in zip(batch.column("html"), batch.column("template").to_pylist(), strict=True):
                gone = frozenset(template or ())
                texts.append("\n\n".join(t for t, under in blocks(page.as_py()) if gone.isdisjoint(under)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "main_text"])

    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), key, "html")
    kept = rows.join(hit.hint("merge"), "key", "left").select("row", "html", "template")
    return kept.mapInArrow(
        cut, T.StructType([rows.schema["row"], T.StructField("main_text", T.StringType())])
    ).select("row.*", "main_text")

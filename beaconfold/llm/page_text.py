"""Main text of web pages, with site templates removed.

Every page is parsed to a tree of elements. Each element's subtree (tags, attributes, text) has a hash; Spark counts in
how many pages of a host a subtree occurs, and one that recurs in ``MIN_PAGES`` pages and ``MIN_SHARE`` of its host's pages
is template. A page's text is its article (or main) element; without one, its body less the template. In both,
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments go by element, role and
class. Inside an article a recurring subtree stays if it is a plain paragraph, heading, list, quotation or table, because
copies of one article, or a common sentence, recur as well; recurring boxes and sections go.

Counts are added up in each task before the shuffle, so a host with a third of all pages is one row a subtree and task. What is joined
back to a page are the template hashes of its host, a bounded list.

Defined results: null html is empty; a page without text gives an empty text; null or odd URLs share a host of their own;
unclosed and stray tags are accepted as browsers do; other columns stay out.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconfold.llm.common import staged, table
from beaconfold.llm.url_filter import host_and_path

MIN_PAGES, MIN_SHARE = 5, 0.3
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "xmp"))
GONE = frozenset(
    "head script style noscript template nav header footer aside form button select option textarea input iframe object embed svg canvas audio video dialog menu title".split()
)
BLOCK = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tr td th figure figcaption".split())
#: Class or id words that mark what isn't main text.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|newsletter|subscribe|sidebar|side-bar|menu|nav|navbar|"
    r"navigation|breadcrumbs?|pagination|footer|header|masthead|comments?|comment-\w+|disqus|respond|replies|share|sharing|social|related|recommended|widget)(?=$|[\s_-])",
    re.I,
)
ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu"))
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: What an opening tag closes, if it stands open inside the nearest of the second group.
_CLOSES = {"li": ("li", ("ul", "ol")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr",)), "th": ("td th", ("tr",)), "option": ("option", ("select",))}
_INLINE_STAYS = frozenset("article aside body center dd details div fieldset figure footer form header html li main nav section table td th".split())


class Node:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []


def parse(html: str) -> Node:
    """A forgiving tree of elements and texts; character references stay as they are."""
    root = Node("")
    stack = [root]
    at = 0
    while True:
        found = _TOKEN.search(html, at)
        if found is None:
            rest = html[at:]
            cut = re.search(r"<[a-zA-Z/!][^>]*\Z", rest)  # a tag cut off at the end
            stack[-1].children.append(rest[: cut.start()] if cut else rest)
            return root
        if found.start() > at:
            stack[-1].children.append(html[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                # A stray closing tag of an inline element or paragraph doesn't close what stands around it.
                if stack[k].tag in _INLINE_STAYS and tag not in _INLINE_STAYS:
                    break
            continue
        if tag in BLOCK:
            _close_paragraph(stack)
        if tag in _CLOSES:
            ends, stop = _CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in stop:
                    break
                if stack[k].tag in ends.split():
                    del stack[k:]
        node = Node(tag, found[3])
        stack[-1].children.append(node)
        if tag in VOID or found[3].endswith("/") and tag in ("svg", "path", "use"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            node.children.append(html[at : end.start() if end else len(html)])
            at = end.end() if end else len(html)
            continue
        stack.append(node)


def _close_paragraph(stack: list[Node]) -> None:
    """A block inside an open paragraph ends it, with the inline elements open in it."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == "p":
            del stack[k:]
            return
        if stack[k].tag in _INLINE_STAYS:
            return


def subtrees(root: Node) -> dict[int, int]:
    """The hash of every element's subtree, by the element's identity; bottom up, whatever the depth."""
    found: dict[int, int] = {}
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo.extend(c for c in n.children if isinstance(c, Node))
    digests: dict[int, bytes] = {}
    for n in reversed(order):
        h = blake2b(f"{n.tag}\0{n.attributes.strip()}".encode(errors="surrogatepass"), digest_size=8)
        for c in n.children:
            if isinstance(c, Node):
                h.update(b"\1" + digests.pop(id(c)))
            elif c and not c.isspace():
                h.update(b"\2" + " ".join(c.split()).encode(errors="surrogatepass"))
        digests[id(n)] = d = h.digest()
        found[id(n)] = int.from_bytes(d, "little", signed=True)
    return found


def _unwanted(node: Node) -> bool:
    if node.tag in GONE:
        return True
    if not node.attributes or node.tag in ("body", "html", "article", "main"):
        return False
    for m in _ATTRIBUTE.finditer(node.attributes):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name in ("class", "id") and MARKED.search(value):
            return True
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value.lower() in ROLES):
            return True
    return False


def _mains(root: Node) -> list[Node]:
    """The outermost article or main elements outside unwanted ones, in page order."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        if n.tag in ("article", "main") or 'role="main"' in n.attributes:
            out.append(n)
        elif not _unwanted(n) or n.tag == "":
            todo.extend(c for c in reversed(n.children) if isinstance(c, Node))
    return out


def main_text(root: Node, template: set[int], hashes: dict[int, int]) -> str:
    mains = _mains(root)
    blocks: list[str] = []
    current: list[str] = []

    def end() -> None:
        text = " ".join(entities.unescape("".join(current)).split())
        if text:
            blocks.append(text)
        current.clear()

    todo: list = list(reversed(mains or [root]))
    while todo:
        n = todo.pop()
        if n is None:
            end()
        elif isinstance(n, str):
            current.append(n)
        elif n.tag == "br":
            current.append(" ")
        elif not _unwanted(n) and not (hashes and hashes[id(n)] in template and not (mains and (n.tag in PROSE or n.tag not in BLOCK or n in mains))):
            if n.tag in BLOCK:
                end()
                todo.append(None)
            todo.extend(reversed(n.children))
    end()
    return "\n".join(blocks)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, subtree, pages): subtrees once for each page, summed over the batch."""
    for batch in batches:
        counts: Counter = Counter()
        for host, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            counts.update((host, h) for h in set(subtrees(parse(text or "")).values()))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array(list(counts.values()), pa.int64())], ["host", "subtree", "pages"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, template in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist(), strict=True):
            root = parse(html or "")
            texts.append(main_text(root, set(template or ()), subtrees(root) if template else {}))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) of ``pages`` (page_id, url, html)."""
    host, _ = host_and_path(F.col("url"))
    read = pages.select("page_id", "url", "html", host.alias("host"))
    counted = read.select("host", "html").mapInArrow(_count, "host string, subtree bigint, pages bigint").groupBy("host", "subtree").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= min_pages)
    sizes = read.groupBy("host").agg(F.count("*").alias("size"))
    template, _ = staged(counted.join(sizes, "host").where(F.col("pages") >= min_share * F.col("size")).select("host", "subtree"), "template")
    # A host's template holds at most (elements a page) / min_share subtrees: the sum over its pages of their subtrees
    # is at least min_share * pages for each.
    by_host = template.groupBy("host").agg(F.collect_set("subtree").alias("template")).withColumnRenamed("host", "_host")
    joined = read.join(by_host, read["host"] == F.col("_host"), "left")
    return joined.select("page_id", "url", "html", "template").mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")


def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))

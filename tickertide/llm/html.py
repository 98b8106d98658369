"""Main text of web pages without the templates of their sites.

1. Each page is read into a tree of elements, and each element subtree is hashed. Spark
   counts on how many different pages of a host a subtree stands; copies of a page, whose
   main text is the same, count once. Subtrees on many pages belong to the template.
2. The keys of template subtrees lie in shared files as sorted arrays. Each page is read
   again, without its template subtrees and without the elements that are known by name or
   class not to be main text, and its text blocks are taken out.

Within an article only containers are matched with templates: a paragraph that many articles
have is still a part of them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.llm.hostrank import host_of
from tickertide.llm.shared import U64, find, shard_bits, shared_path, write_sorted
from tickertide.llm.words import plain
from tickertide.session import cut_lineage

LEAST_PAGES = 4  # different pages of a host that a template subtree stands on, at least; as many more for each power of ten above 100
SHORT = 5  # words; single blocks of fewer recur by chance, so they must also stand on
LEAST_SHARE = 0.1  # this share of the host's pages

# -- fixed values: elements of HTML by their part in a page --
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes iframe".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# An opening tag closes an open element of these kinds, unless it stands in a newer scope.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
TABLE = {"table"}
PARAGRAPH_SCOPES = {"article", "section", "div", "td", "th", "li", "blockquote", "table"}
# -- fixed values: what is not main text, by element, and by names in role, class and id --
ASIDE = set("nav aside form script style noscript template iframe button select input textarea title head menu dialog svg object canvas".split())
EDGE = {"header", "footer"}
ASIDE_ROLES = set("navigation banner complementary contentinfo search form dialog alert menu".split())
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer gdpr "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification pagination popup promo promotion "
    "related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
# Words that say where a part named by one of the words above is, or of what form.
PLACES = set(
    "site page post entry article global main primary secondary top bottom left right upper lower sub inner outer mobile desktop "
    "sticky fixed list listing item items block box bar area section container wrapper wrap panel column row group body links link "
    "button buttons icons form title heading thread tree count text slot unit zone posts articles".split()
)
COMMENTS = set("comment comments disqus replies reply respond".split())
MAIN = {"article", "main"}
# Parts of a paragraph, which are no template by themselves.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption".split())

TOKEN = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][^\s/>]*))")
QUOTE_OR_END = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class Element:
    __slots__ = ("tag", "attributes", "children", "aside", "named", "key")

    def __init__(self, tag: str, attributes: str):
        self.tag, self.attributes = tag, attributes
        self.children: list[Element | str] = []
        self.key = 0
        self.aside = tag in ASIDE
        # Names that make it an aside, if the page's main text is not in it.
        self.named = {"form"} if tag == "form" else set()
        if not self.aside and "=" in attributes:
            for name, *values in ATTRIBUTE.findall(attributes):
                name = name.lower()
                if name not in ("class", "id", "role") or tag in ("html", "body", "main"):
                    continue
                words = "".join(values).lower().split()
                if name == "role":
                    found = ASIDE_ROLES.intersection(words)
                else:
                    found = {w for word in words for w in aside_words(word)}
                if found:
                    self.aside = True
                    self.named |= found


def aside_words(name: str) -> set[str]:
    """The words that make a class or id an aside: ``comment-list`` and ``site_footer`` say what
    they are and where, but ``has-sidebar`` and ``comments-open`` speak of something else."""
    parts = name.replace("_", "-").split("-")
    found = ASIDE_WORDS.intersection(parts)
    return found if all(w in found or w in PLACES or not w or w.isdigit() for w in parts) else set()


class Stack:
    """The open elements, and where those of each tag are among them."""

    def __init__(self, root: Element):
        self.open = [root]
        self.places: dict[str, list[int]] = {}

    def push(self, element: Element) -> None:
        self.places.setdefault(element.tag, []).append(len(self.open))
        self.open.append(element)

    def last(self, tags) -> int:
        """The place of the innermost element of these tags, 0 without one."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, place: int) -> None:
        """End the element at a place and all in it."""
        while len(self.open) > place:
            self.places[self.open.pop().tag].pop()

    def close_open(self, tags, scopes) -> None:
        place = self.last(tags)
        if place > self.last(scopes):
            self.close(place)


def tag_end(page: str, at: int) -> int:
    """Where the > of a tag is; -1 if there is none outside of quotes."""
    while (stop := QUOTE_OR_END.search(page, at)) is not None:
        if stop[0] == ">":
            return stop.start()
        at = page.find(stop[0], stop.end()) + 1
        if not at:
            break
    return -1


def parse(page: str) -> Element:
    """The tree of a page. Unclosed elements end where HTML ends them or with their parent.

    From a tag on whose quotes would swallow the rest of the page, quotes mean nothing and tags
    end at the next >. What begins like a tag behind the last > is text. Time grows with the
    page, whatever is broken in it.
    """
    root = Element("", "")
    stack = Stack(root)
    at, begin = 0, 0  # text from begin on is not in the tree yet
    quotes, final = True, page.rfind(">")
    while (token := TOKEN.search(page, at)) is not None:
        close, tag = token.group(2), token.group(3)
        start, at = token.span()
        if tag is None:
            comment = token.group(1) is not None
            end = page.find("-->" if comment else ">", at)
            end = len(page) if end < 0 else end + (3 if comment else 1)
        else:
            if start > final:
                break
            end = tag_end(page, at) if quotes else page.find(">", at)
            if end < 0:
                quotes, end = False, page.find(">", at)
            end += 1
        if start > begin:
            stack.open[-1].children.append(page[begin:start])
        attributes = page[at : end - 1]
        at = begin = end
        if tag is None:
            continue
        tag = tag.lower()
        if close:
            place = stack.last((tag,))
            # A stray tag does not end the article.
            if place and (tag in ("body", "html", "main", "article") or place > stack.last(MAIN)):
                stack.close(place)
            continue
        if tag in BLOCKS:
            stack.close_open(("p",), PARAGRAPH_SCOPES)
        if tag in CLOSES:
            stack.close_open(CLOSES[tag], SCOPES.get(tag, TABLE))
        element = Element(tag, attributes)
        stack.open[-1].children.append(element)
        if tag in RAW:
            close_tag = re.compile(f"</{tag}\\s*>", re.I).search(page, at)
            at = begin = len(page) if close_tag is None else close_tag.end()
        elif tag not in VOID and not attributes.endswith("/"):
            stack.push(element)
    if begin < len(page):
        stack.open[-1].children.append(page[begin:])
    return root


def hash_subtrees(element: Element, host: str) -> int:
    """Give each element a hash of its tag, attributes, text and children, and the host."""
    for e in reversed(in_order(element)):  # children are ready before their parent
        h = xxhash.xxh3_64(f"{host}\0{e.tag}\0{e.attributes}")
        for c in e.children:
            h.update(c.key.to_bytes(8, "little") if isinstance(c, Element) else " ".join(c.split()).encode("utf-8", "replace"))
            h.update(b"\1")
        e.key = h.intdigest()
    return element.key


def in_order(root: Element) -> list[Element]:
    """The elements of a tree; children come after their parent."""
    order, waiting = [], [root]
    while waiting:
        e = waiting.pop()
        order.append(e)
        waiting.extend(c for c in e.children if isinstance(c, Element))
    return order


def free_main(root: Element) -> None:
    """No element that is or holds the article of the page, or most of its text, is an aside
    by its class, id or role, or as a form.

    The article is the longest one, if all articles stand in asides and it has more text than
    is left outside of them. Text in other asides by element counts for forms only.
    """
    order = in_order(root)
    if not any(e.named for e in order):
        return
    whole: dict[int, int] = {}
    size: dict[int, int] = {}
    seen: dict[int, int] = {}  # text of an element outside of the asides in it, but for those with most of the page's
    for e in reversed(order):
        own = sum(len("".join(c.split())) for c in e.children if isinstance(c, str))
        below = [c for c in e.children if isinstance(c, Element)]
        whole[id(e)] = own + sum(whole[id(c)] for c in below)
        size[id(e)] = own + sum(size[id(c)] for c in below if c.named or not c.aside)
    most = {id(e) for e in order if e.named and 2 * (of := whole if e.tag == "form" else size)[id(e)] > of[id(root)]}
    for e in reversed(order):
        below = [c for c in e.children if isinstance(c, Element)]
        own = size[id(e)] - sum(size[id(c)] for c in below if c.named or not c.aside)
        seen[id(e)] = own + sum(seen[id(c)] for c in below if not c.aside or id(c) in most and c.named.isdisjoint(COMMENTS))
    if main_roots(root) == [root]:
        parent = {id(c): e for e in order for c in e.children if isinstance(c, Element)}
        articles = [e for e in order if e.tag in MAIN]
        best = max(articles, key=lambda e: size[id(e)], default=None)
        if best is not None and size[id(best)] > seen[id(root)]:
            while best is not root:
                best.aside = best.aside and not best.named
                best = parent[id(best)]
    for e in order:
        if id(e) in most:
            e.aside = False


def read_page(page: str) -> Element:
    root = parse(page)
    free_main(root)
    return root


def main_roots(root: Element) -> list[Element]:
    """Articles outside of asides, outermost ones; else the main element; else the page."""
    for tag in ("article", "main"):
        found, waiting = [], [root]
        while waiting:
            e = waiting.pop()
            if e.tag == tag and not e.aside:
                found.append(e)
            elif not e.aside and e.tag not in EDGE:
                waiting.extend(c for c in reversed(e.children) if isinstance(c, Element))
        if found:
            return found
    return [root]


def text_blocks(roots: list[Element], template: set[int]) -> list[str]:
    """Blocks of text in page order, without asides and template subtrees."""
    blocks: list[str] = []
    parts: list[str] = []

    def end_block() -> None:
        words = html.unescape("".join(parts)).split()
        parts.clear()
        if words:
            blocks.append(" ".join(words))

    for root in roots:
        in_article = root.tag in MAIN
        waiting: list[Element | str | None] = [root]
        while waiting:
            e = waiting.pop()
            if e is None:
                end_block()
            elif isinstance(e, str):
                parts.append(e)
            elif e.aside or e.tag == "footer" or e.tag == "header" and not in_article:
                end_block()
            elif e is not root and e.key in template and not (in_article and e.tag in PARAGRAPHS):
                end_block()
            elif e.tag == "br":
                parts.append("\n")
            elif e.tag in BLOCKS or e is root:
                end_block()
                waiting.append(None)
                waiting.extend(reversed(e.children))
            else:
                waiting.extend(reversed(e.children))
    end_block()
    return blocks


def candidates(roots: list[Element]) -> list[Element]:
    """Elements that could be template: below the main roots, where they are not asides."""
    found = []
    for root in roots:
        waiting = [c for c in root.children if isinstance(c, Element)]
        while waiting:
            e = waiting.pop()
            if e.aside:
                continue
            part = e.tag in VOID or e.tag in INLINE or e.tag in ("html", "body", "main", "article")
            if not part and not (root.tag in MAIN and e.tag in PARAGRAPHS):
                found.append(e)
            waiting.extend(c for c in e.children if isinstance(c, Element))
    return found


def page_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, subtree, short, content) of each distinct candidate of each page (host, html);
    the first row of a page has no subtree."""
    for batch in batches:
        hosts, subtrees, shorts, contents = [], [], [], []
        for host, page in zip(batch.column(0).to_pylist(), plain(batch.column(1)).to_pylist()):
            root = read_page(page)
            hash_subtrees(root, host)
            roots = main_roots(root)
            content = signed(xxhash.xxh3_64_intdigest("\n".join(text_blocks(roots, set())).encode("utf-8", "replace")))
            keys = {None: False} | {signed(e.key): is_short(e) for e in candidates(roots)}
            hosts.extend([host] * len(keys))
            subtrees.extend(keys)
            shorts.extend(keys.values())
            contents.extend([content] * len(keys))
        yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(subtrees, pa.int64()), pa.array(shorts, pa.bool_()), pa.array(contents, pa.int64())], names=["host", "subtree", "short", "content"])


def is_short(element: Element) -> bool:
    """Whether an element is a single block of a few words."""
    texts, waiting = [], [element]
    while waiting:
        e = waiting.pop()
        if isinstance(e, str):
            texts.append(e)
        elif e is element or e.tag in INLINE:
            waiting.extend(e.children)
        else:
            return False
    return sum(len(t.split()) for t in texts) < SHORT


def signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


def template_subtrees(pages: DataFrame, least_pages: int, least_share: float) -> DataFrame:
    """Keys of the subtrees that stand on many different pages of their host."""
    rows = pages.mapInArrow(page_subtrees, "host string, subtree bigint, short boolean, content bigint").distinct()
    counts = rows.groupBy("host", "subtree", "short").agg(F.count("*").alias("n"))
    # Written once, as it is read for hosts and for subtrees: pages are parsed once to count.
    counts = cut_lineage(counts.where(F.col("subtree").isNull() | (F.col("n") >= least_pages)))
    hosts = counts.where("subtree is null").select("host", F.col("n").alias("pages"))
    often = counts.where("subtree is not null")
    least = F.when(F.col("short"), least_share * F.col("pages")).otherwise(least_pages * F.log10(F.col("pages") / 10))
    return often.join(hosts, "host").where(F.col("n") >= least).select(F.col("subtree").alias("key")).distinct()


def extract_text(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each page, in whole.

    Null html is empty, a page without main text has the empty text, and pages without a host
    are pages of one nameless host. Repeated rows count as one page. Other columns are ignored.
    """
    spark = pages.sparkSession
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    folder, bits = shared_path(spark, "templates"), shard_bits(spark)
    write_sorted(template_subtrees(rows.select("host", "html"), least_pages, least_share), folder, bits)

    @F.arrow_udf("string")
    def main_text(hosts: pa.Array, documents: pa.Array) -> pa.Array:
        out = []
        for host, page in zip(hosts.to_pylist(), plain(documents).to_pylist()):
            root = read_page(page)
            roots = main_roots(root)
            hash_subtrees(root, host)
            keys = np.array([e.key for e in candidates(roots)], U64)
            template = set(keys[find(folder, bits, keys, [])["found"]].tolist()) if len(keys) else set()
            out.append("\n".join(text_blocks(roots, template)))
        return pa.array(out, pa.string())

    found = rows.select("page_id", "url", main_text(F.col("host"), F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))

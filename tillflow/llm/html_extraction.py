"""Main text of web pages by site template removal.

A page is read into its element tree; every element's subtree has a hash of its tags
and texts. The article are the article (or main) elements, else the body, without elements
that by tag, role or class are no part of it. Spark counts, per host, the otherwise
different articles that hold each subtree, and subtrees that recur in many of them
are the host's template. The main text is the article without its template.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.text import list_column, small_side, staged

#: A subtree is template if more than this many distinct articles of the host, and more
#: than this share of them, hold it; within article or main elements the second share holds.
MIN_PAGES = 5
SHARE = 0.3
ARTICLE_SHARE = 0.6
#: Articles of whose text less than this share is left are taken for copies of each other.
MIN_LEFT = 0.3

#: HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag ends these open elements, up to (not into) the elements named with them.
ENDS_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "legend"}
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
#: Elements whose text is never part of the article.
NO_TEXT = frozenset(
    "head script style template noscript nav aside footer form button select option textarea input iframe object embed svg canvas "
    "audio video map menu dialog title xmp noembed noframes datalist".split()
)
#: Words of an element's class or id that say the same; those of the second set only outside the article.
NO_TEXT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments reply replies disqus respond share sharing social related "
    "recommended newsletter subscribe subscription signup login popup modal overlay toolbar pagination pager footer widget widgets skip".split()
)
OUTSIDE_NAMES = frozenset("header masthead topbar branding logo search tags meta copyright legal".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())

_TAG = re.compile(r"""<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<other>[!?][^>]*)>?|(?P<slash>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z))""", re.S)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
_NAME_WORDS = re.compile(r"[a-z0-9]+")


@dataclass
class Element:
    tag: str
    parent: int
    attrs: dict[str, str]
    inside_main: bool
    parts: list[bytes] = field(default_factory=list)
    hash: int = 0


@dataclass
class Page:
    """Elements in the order they open, and the page as a sequence of (element that
    opens: i, closes: ~i, or text with its element)."""

    elements: list[Element] = field(default_factory=list)
    events: list = field(default_factory=list)


def parse(source: str) -> Page:
    page = Page()
    stack: list[int] = []
    opened: Counter[str] = Counter()  # open elements by tag: most searches of the stack need not start

    def close() -> None:
        i = stack.pop()
        e = page.elements[i]
        opened[e.tag] -= 1
        e.hash = xxhash.xxh3_64_intdigest(b"\1".join([e.tag.encode(), *e.parts]))
        page.events.append(~i)
        if stack:
            page.elements[stack[-1]].parts.append(b"\2" + e.hash.to_bytes(8, "little"))

    def close_to(names: set[str], stop: set[str]) -> None:
        if not any(opened[n] for n in names):
            return
        for depth in range(len(stack) - 1, -1, -1):
            tag = page.elements[stack[depth]].tag
            if tag in names:
                while len(stack) > depth:
                    close()
                return
            if tag in stop:
                return

    def add_text(raw: str) -> None:
        if raw:
            page.events.append(raw)
            words = " ".join(raw.split())
            if words and stack:
                page.elements[stack[-1]].parts.append(words.encode(errors="surrogatepass"))

    at = 0
    while at < len(source):
        m = _TAG.search(source, at)
        if not m:
            add_text(source[at:])
            break
        add_text(source[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["slash"]:
            if name not in VOID:
                close_to({name}, set())
            continue
        if name in ENDS_P:
            close_to({"p"}, {"button", "table", "td", "th", "caption", "object", "template", "html"})
        if name in IMPLIED:
            close_to(*IMPLIED[name])
        attrs = {a[0].lower(): (a[1] or a[2] or a[3]).lower() for a in _ATTR.findall(m["attrs"])}
        parent = stack[-1] if stack else -1
        inside = parent >= 0 and (page.elements[parent].inside_main or page.elements[parent].tag in ("article", "main"))
        page.elements.append(Element(name, parent, attrs, inside))
        i = len(page.elements) - 1
        stack.append(i)
        opened[name] += 1
        page.events.append(i)
        if name in VOID or m["attrs"].endswith("/") and name not in BLOCKS:
            close()
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            add_text(source[at : end.start() if end else len(source)])
            at = end.end() if end else len(source)
            close()
    while stack:
        close()
    return page


def outside_article(e: Element) -> bool:
    """Whether tag, role, class or id say that the element is no part of an article."""
    if e.tag in NO_TEXT or "hidden" in e.attrs and e.attrs["hidden"] != "until-found" or e.attrs.get("aria-hidden") == "true":
        return True
    if e.tag in ("html", "body", "main", "article"):
        return False
    if e.tag == "header" and not e.inside_main or e.attrs.get("role") in NO_TEXT_ROLES:
        return True
    words = set(_NAME_WORDS.findall(e.attrs.get("class", "") + " " + e.attrs.get("id", "")))
    return not words.isdisjoint(NO_TEXT_NAMES) or not e.inside_main and not words.isdisjoint(OUTSIDE_NAMES)


def content(page: Page) -> tuple[list[bool], list[bool], list[bool]]:
    """For each element: whether it is no part of an article, whether it is in the
    page's article, and whether it may be template there, as the article itself can't."""
    gone: list[bool] = []
    inside: list[bool] = []
    part: list[bool] = []
    for e in page.elements:
        gone.append(e.parent >= 0 and gone[e.parent] or outside_article(e))
    roots = {e.tag for e, out in zip(page.elements, gone) if not out}
    wanted = "article" if "article" in roots else "main" if "main" in roots else None
    for e, out in zip(page.elements, gone):
        inner = e.parent >= 0 and inside[e.parent]
        inside.append(inner or wanted is None or e.tag == wanted)
        part.append(not out and (e.tag not in ("html", "body") if wanted is None else inner))
    return gone, inside, part


def main_text(page: Page, template: set[int]) -> str:
    """The page's article without ``template`` subtrees, its blocks joined by two line
    feeds. An article that would be left empty keeps them."""
    gone, kept_root, part = content(page)
    wanted = not all(kept_root)
    dropped: list[bool] = []
    for e, out, can in zip(page.elements, gone, part):
        dropped.append(out or e.parent >= 0 and dropped[e.parent] or can and e.hash in template)
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    stack: list[int] = []
    for event in page.events:
        if isinstance(event, str):
            if (not stack and not wanted) or stack and kept_root[stack[-1]] and not dropped[stack[-1]]:
                line.append(references.unescape(event))
            continue
        i = event if event >= 0 else ~event
        if page.elements[i].tag in BLOCKS:
            flush()
        elif page.elements[i].tag == "br" or dropped[i]:
            line.append(" ")
        if event >= 0:
            stack.append(event)
        else:
            stack.pop()
    flush()
    return "\n\n".join(blocks) if blocks or not template else main_text(page, set())


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))


def article_trees(page: Page) -> tuple[int, int, list[tuple[int, bool, int, int, int]]]:
    """The article's digest and size, and its subtrees that may be template: (hash,
    within article or main elements, digest of the article without them, size, place
    of the enclosing one or -1). A subtree that is the whole article is none of them.
    A digest is the sum of its texts' hashes."""
    gone, inside, part = content(page)
    n = len(page.elements)
    digests, sizes = [0] * n, [0] * n
    total = size = 0
    for i in range(n - 1, -1, -1):
        e = page.elements[i]
        if inside[i] and not gone[i]:
            for text in e.parts:
                if text[:1] != b"\2":
                    digests[i] += xxhash.xxh3_64_intdigest(text)
                    sizes[i] += len(text)
            if e.parent >= 0 and inside[e.parent]:
                digests[e.parent] += digests[i]
                sizes[e.parent] += sizes[i]
            else:
                total, size = total + digests[i], size + sizes[i]
    same: Counter[int] = Counter()
    for i, e in enumerate(page.elements):
        if part[i]:
            same[e.hash] += digests[i]
    place: dict[int, int] = {}
    trees = []
    for i, e in enumerate(page.elements):
        if part[i] and 0 < sizes[i] < size:
            place[i] = len(trees)
            trees.append((e.hash, e.inside_main or e.tag in ("article", "main"), total - same[e.hash] & (1 << 64) - 1, sizes[i], place.get(e.parent, -1)))
    return total & (1 << 64) - 1, size, trees


def signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _article_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, article, size, trees) of (host, html): see ``article_trees``."""
    for batch in batches:
        pages = [article_trees(parse(source.as_py())) for source in batch.column(1)]
        hashes, inside, rests, sizes, places = zip(*[t for _, _, trees in pages for t in trees]) if any(t for _, _, t in pages) else ([],) * 5
        trees = pa.StructArray.from_arrays([signed(hashes), pa.array(inside, pa.bool_()), signed(rests), pa.array(sizes, pa.int32()), pa.array(places, pa.int32())], ["h", "inside", "rest", "size", "place"])
        article, size = signed([a for a, _, _ in pages]), pa.array([n for _, n, _ in pages], pa.int64())
        yield pa.record_batch([batch.column(0), article, size, list_column(trees, np.array([len(t) for _, _, t in pages], np.int64))], ["host", "article", "size", "trees"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, h, inside, rest) of (host, size, trees, template): for the article's subtrees in
    ``template``, the digest of the rest, or if little is left their smallest hash."""
    for batch in batches:
        out = []
        for host, size, trees, template in zip(*(c.to_pylist() for c in batch.columns)):
            template = set(template)
            covered: list[bool] = []
            lost = 0
            for t in trees:
                above = t["place"] >= 0 and covered[t["place"]]
                lost += t["size"] if t["h"] in template and not above else 0
                covered.append(above or t["h"] in template)
            found = [t for t in trees if t["h"] in template]
            alone = min((t["h"] for t in found), default=0) if size - lost < MIN_LEFT * size else None
            out.extend((host, t["h"], t["inside"], t["rest"] if alone is None else alone) for t in found)
        columns = zip(*out) if out else ([],) * 4
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "h", "inside", "rest"])


def site_templates(pages: DataFrame, min_pages: int, share: float, article_share: float) -> DataFrame:
    """(host, template: hashes) of a table (host, html). A host has at most as many as
    its articles have subtrees on average, divided by the share.

    A subtree is counted once for each different rest of the articles that hold it, so
    pages with the same article count once, whatever surrounds it. Articles that the
    subtrees so found would leave with less than MIN_LEFT of their text may be near
    copies: they are counted again as one for each smallest hash of those subtrees.
    Counting is by partial sums, so a host with a third of all pages is combined first."""
    articles = pages.filter("length(html) > 0").mapInArrow(_article_rows, "host string, article long, size long, trees array<struct<h:long,inside:boolean,rest:long,size:int,place:int>>")
    articles = staged(articles, "site_articles")
    hosts = articles.groupBy("host").agg(F.countDistinct("article").alias("pages"))
    least = F.when(F.col("inside"), article_share).otherwise(share)

    def above(seen: DataFrame) -> DataFrame:
        counted = seen.groupBy("host", "h").agg(F.countDistinct("rest").alias("n"), F.max("inside").alias("inside"))
        common = counted.filter(F.col("n") > min_pages).join(hosts, "host").filter(F.col("n") > F.col("pages") * least)
        return common.groupBy("host").agg(F.collect_set("h").alias("template"))

    first = small_side(staged(above(articles.select("host", F.inline("trees"))), "site_subtrees"), 4096)
    held = articles.join(first, "host").select("host", "size", "trees", "template")
    return above(held.mapInArrow(_contexts, "host string, h long, inside boolean, rest long"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES, share: float = SHARE, article_share: float = ARTICLE_SHARE) -> DataFrame:
    """One row per row of ``pages``: ``id_col``, ``url_col``, text and n_chars (code points).

    Character references are decoded, white space inside a block is one space, blocks
    are joined in page order by two line feeds; nothing is shortened. A null or empty
    page, or one without an article's text, has the text "". A null or relative url
    has the host "". Repeated pages are extracted each and counted once as templates,
    as are pages with the same article; an empty table gives an empty result, other columns are ignored.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    templates = staged(site_templates(rows.select("host", "html"), min_pages, share, article_share), "site_templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source, template in zip(batch.column(2), batch.column(3)):
                source = source.as_py()
                texts.append(main_text(parse(source), {h & (1 << 64) - 1 for h in template.as_py() or ()}) if source else "")
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "url")}
    joined = rows.join(small_side(templates, 4096), "host", "left").select("id", "url", "html", "template")
    return joined.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})

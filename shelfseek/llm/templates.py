"""Main text of web pages: page structure, and removal of subtrees that recur across the pages of a host.

Pages are parsed once, in Arrow batches, into blocks of text. Elements that are never article text (menus, footers,
sidebars, adverts, forms, scripts, hidden parts and so on, by tag, role or class) are left out while parsing. Each block
carries the hashes of the subtrees it lies in. Spark counts each subtree per host, once per distinct page and combined
before the shuffle; one found on ``MIN_PAGES`` pages and on a share of ``MIN_SHARE`` of the host's or on ``MANY_PAGES`` of
them is template, and blocks in it are dropped. If a page has ``article`` elements its text is what they hold, else what ``main`` holds, else the body.

Prose inside an article (paragraphs, headings, quotations, list entries, cells) is no template however often it recurs, as
articles repeat passages; containers inside an article can be.

Defined results: null or empty pages give an empty text; pages without a url form one host; copies of a page count once
towards templates; ids are passed through, null and repeated ones too; unclosed elements end with the one around them,
a tag, comment or reference cut off at the page's end is read as browsers do.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfseek.llm.text_arrays import batch_map
from shelfseek.scratch import stored

MIN_PAGES = 3
MIN_SHARE = 0.3
#: So many pages are enough however many the host has.
MANY_PAGES = 20
#: Templates are broadcast up to so many bytes, else the commonest of them; the others are joined with the pages' marks.
BROADCAST_BYTES = 8 << 20

# Element names, roles and class words of HTML pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
PROSE = frozenset("blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TABLE = frozenset("table thead tbody tfoot".split())
NEVER = frozenset(
    "head nav footer aside form button select input textarea iframe svg canvas object audio video dialog menu datalist "
    "script style noscript template map math".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
CLASS_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promotion banner cookie "
    "cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus replies share sharing social related "
    "recommended recommendations widget widgets toolbar pagination pager login signup search skip".split()
)
#: What a starting element closes if it is still open.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LIST_EDGES = frozenset("ul ol dl table body article main section div menu select".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)
    |<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*)(?P<end>>|\Z)
    |(?P<text>[^<]+|<)""",
    re.DOTALL | re.VERBOSE,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s>]+))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def attributes(source: str) -> dict[str, str]:
    found = {}
    for name, value in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")) if value else "")
    return found


def names_never(names: str) -> bool:
    """Whether one of the names consists of CLASS_WORDS only: ``ad-banner`` does, ``related-work`` does not."""
    words = [[w.lower() for w in WORD.findall(name)] for name in names.split()]
    return any(own and CLASS_WORDS.issuperset(own) for own in words)


def is_never(tag: str, source: str, inside: bool, within: str) -> bool:
    """An element that holds no article text, by its name, role, class or state; ``inside`` an article or main part, and
    ``within`` the element around it. What is doubtful is left to the counts of the host."""
    if tag in NEVER:
        return True
    if not source.strip(" /"):
        return False
    own = attributes(source)
    if "hidden" in own or own.get("aria-hidden") == "true" or HIDDEN.search(own.get("style", "")):
        return True
    if own.get("role", "").lower() in ROLES:
        return True
    # The page itself and its main parts may be called anything.
    if tag in ("html", "body", "article", "main", "p") or tag in HEADINGS:
        return tag in ("article", "p") and any(names_never(x) and "comment" in x.lower() for x in own.get("class", "").split())
    # Prose, and words in a sentence, are text whatever they are called, and ids in an article are made from headings.
    if inside and (tag in PROSE or tag in TABLE) or tag not in BLOCK and (inside or within in PROSE):
        return False
    return names_never(own.get("class", "")) or not inside and names_never(own.get("id", ""))


class Element:
    __slots__ = ("article", "first", "header", "main", "never", "tag")

    def __init__(self, tag: str, first: int, never: bool, article: bool, main: bool, header: bool):
        self.tag, self.first, self.never = tag, first, never
        self.article, self.main, self.header = article, main, header


def blocks(page: str) -> list[tuple[str, list[int]]]:
    """The page's blocks of main text in order, each with the hashes of the subtrees it lies in."""
    found: list[tuple[str, bool, bool]] = []
    marks: list[list[int]] = []
    hashes: list[bytes] = []
    stack = [Element("", 0, False, False, False, False)]
    buffer: list[str] = []
    any_article = any_main = False

    def flush() -> None:
        if buffer:
            top = stack[-1]
            text = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if text and not top.never:
                found.append((text, top.article, top.main))
                marks.append([])
                hashes.append(xxhash.xxh64_digest(text.encode("utf-8", "surrogatepass")))

    def close() -> None:
        element = stack[-1]
        if element.tag in BLOCK:
            flush()
        stack.pop()
        if element.header and not element.never and element.first < len(found):
            # A header without the article's own heading is the site's.
            del found[element.first :], marks[element.first :], hashes[element.first :]
        if element.tag in BLOCK and not element.never and element.first < len(found):
            inside = element.article or element.main
            if not (inside and element.tag in PROSE) and element.tag not in ("html", "body", "article", "main"):
                mark = xxhash.xxh64_intdigest(element.tag.encode() + b"".join(hashes[element.first :])) - (1 << 63)
                for own in marks[element.first :]:
                    own.append(mark)

    at, n = 0, len(page)
    while at < n:
        token = TOKEN.match(page, at)
        at = token.end()
        text = token["text"]
        if text is not None:
            if not stack[-1].never:
                buffer.append(text)
            continue
        tag = token["tag"]
        if tag is None or not token["end"]:
            continue
        tag = tag.lower()
        if token["close"]:
            depth = len(stack) - 1
            while depth and stack[depth].tag != tag:
                if tag == "p" and stack[depth].tag in LIST_EDGES:
                    depth = 0
                    break
                depth -= 1
            if depth:
                while len(stack) > depth:
                    close()
            elif tag in BLOCK:
                flush()
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if tag in BLOCK:
            flush()
            # A block ends an open paragraph, an entry the one before it.
            for wanted in (("p",) if tag not in CLOSES else CLOSES[tag]):
                depth = len(stack) - 1
                while depth and stack[depth].tag != wanted and stack[depth].tag not in LIST_EDGES:
                    depth -= 1
                if depth and stack[depth].tag == wanted:
                    while len(stack) > depth:
                        close()
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            at = end.start() if end else n
            if end:
                shut = page.find(">", at)
                at = shut + 1 if shut >= 0 else n
            continue
        top = stack[-1]
        never = top.never or is_never(tag, token["attributes"], top.article or top.main, top.tag)
        article = not never and (top.article or tag == "article")
        main = not never and (top.main or tag == "main" or 'role="main"' in token["attributes"])
        any_article |= article
        any_main |= main
        if tag == "h1":
            for element in stack:
                element.header = False
        stack.append(Element(tag, len(found), never, article, main, tag == "header"))
    while len(stack) > 1:
        close()
    flush()
    wanted = [(text, own) for (text, article, main), own in zip(found, marks, strict=True) if (article if any_article else main if any_main else True)]
    return wanted


def host(url: Column) -> Column:
    """Lower-case authority of a url without user and port; empty where there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""))


def parse(batch: pa.RecordBatch) -> pa.Table:
    pages = [blocks(page or "") for page in batch["html"].to_pylist()]
    struct = pa.struct([("text", pa.string()), ("marks", pa.list_(pa.int64()))])
    columns = {name: batch[name] for name in ("page_id", "url", "host", "digest")}
    columns["blocks"] = pa.array([[{"text": t, "marks": m} for t, m in page] for page in pages], pa.list_(struct))
    return pa.table(columns)


def templates(parsed: DataFrame, min_pages: int, min_share: float) -> DataFrame:
    """Host, hash and number of pages of each template subtree."""
    once = parsed.select("host", "digest", F.explode(page_marks()).alias("mark")).distinct()
    counts = once.groupBy("host", "mark").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    hosts = parsed.select("host", "digest").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    enough = F.least(min_share * F.col("pages"), F.lit(MANY_PAGES))
    return counts.join(hosts, "host").filter(F.col("n") >= enough).select("host", "mark", "n")


def page_marks() -> Column:
    return F.array_distinct(F.flatten(F.col("blocks.marks")))


def with_templates(parsed: DataFrame, found: DataFrame) -> DataFrame:
    """``parsed`` with the template subtrees that each page holds."""
    row_bytes = F.octet_length("host") + 32
    size, total = found.agg(F.coalesce(F.sum(row_bytes), F.lit(0)), F.coalesce(F.sum(F.col("n") * row_bytes), F.lit(0))).first()
    if size <= BROADCAST_BYTES:
        per_host = F.broadcast(found.groupBy("host").agg(F.collect_list("mark").alias("_of_host")))
        own = F.array_intersect(page_marks(), F.col("_of_host"))
        return parsed.join(per_host, "host", "left").withColumn("templates", own).drop("_of_host")
    # Those on most pages are broadcast, so no key that is joined has more than total / BROADCAST_BYTES pages.
    hot = F.col("n") * BROADCAST_BYTES >= total if BROADCAST_BYTES else F.lit(False)
    marks = parsed.select("row", "host", F.explode(page_marks()).alias("mark"))
    asked = [F.broadcast(found.filter(hot).select("host", "mark")), found.filter(~hot).select("host", "mark")]
    held = [marks.join(some, ["host", "mark"]).select("row", "mark") for some in asked]
    own = held[0].unionByName(held[1]).groupBy("row").agg(F.collect_list("mark").alias("templates"))
    return parsed.join(own, "row", "left")


def main_text(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    page: str = "html",
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """page_id, url, text and n_chars, one row per row of ``pages``."""
    content = F.coalesce(F.col(page).cast("string"), F.lit(""))
    given = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        host(F.col(url).cast("string")).alias("host"),
        F.xxhash64(content).alias("digest"),
        content.alias("html"),
    )
    kinds = {name: given.schema[name].dataType.simpleString() for name in ("page_id", "url")}
    schema = (
        f"page_id {kinds['page_id']}, url {kinds['url']}, host string, digest bigint, "
        "blocks array<struct<text: string, marks: array<bigint>>>"
    )
    numbered = batch_map(given, parse, schema, "html").withColumn("row", F.monotonically_increasing_id())
    parsed = stored(numbered, "templates-parsed")
    joined = with_templates(parsed, stored(templates(parsed, min_pages, min_share), "templates-hosts"))
    own = F.filter(
        "blocks", lambda block: F.col("templates").isNull() | ~F.arrays_overlap(block["marks"], F.col("templates"))
    )
    text = F.array_join(own["text"], "\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))


def op9(spark, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))

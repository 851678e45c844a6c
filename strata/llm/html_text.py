"""Main text of web pages by page structure and nearest-URL page differencing.

A page becomes text blocks, each marked by where it stands: inside the page's article, inside
something that is no main text (menu, header, footer, sidebar, notice, advert, form, comments,
...), or elsewhere. Pages are put in the order of host and URL path; a page is aligned with the
page of other content with the nearest URL by the longest common subsequence of their lines, and the lines
both share are deleted, for they belong to the site. Blocks inside an article stay: sister
articles may quote the same passage. Blocks inside menus and the like go, shared or not. All
others stay unless they are shared, on pages with an article as on those without.

For the alignment only hashes of the lines outside articles move; pages are shuffled once.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.shared import global_rank, single_column, stored

#: Elements without content of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
RAW = frozenset("script style noscript template textarea title iframe svg math canvas object select option datalist".split())
#: Elements that are no main text.
ASIDE = frozenset("nav header footer aside form button menu dialog label fieldset".split())
MAIN = frozenset(("article", "main"))
#: Elements that start and end a block.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Elements that a start tag of the kind closes when left open, up to the nearest enclosing block of another kind.
CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dd": {"dd", "dt", "p"}, "dt": {"dd", "dt", "p"}, "td": {"td", "th", "p"},
    "th": {"td", "th", "p"}, "tr": {"tr", "td", "th", "p"}, "option": {"option"},
}
#: Words in class, id or role that mark what is no main text.
MARKS = frozenset(
    "ad ads advert advertisement adverts advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent gdpr notice alert popup modal "
    "overlay newsletter subscribe signup login search share sharing social comment comments reply replies disqus "
    "related recommended recommendations widget toolbar pagination pager skip contentinfo complementary".split()
)

UNMARKS = frozenset("no not with without has have open closed".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)|</?\Z"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(>|\Z)",
    re.S,
)
_MARK = re.compile(r"""(?i)\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[a-z]+")


def _is_mark(words: list[str]) -> bool:
    """``site-header`` and ``ad`` are marks, ``no-sidebar`` and ``comments-open`` are not."""
    return not MARKS.isdisjoint(words) and UNMARKS.isdisjoint(words)


def _is_aside(tag: str, attributes: str) -> bool:
    if tag in ASIDE:
        return True
    if tag in ("html", "body") or tag in MAIN:
        return False
    for match in _MARK.finditer(attributes):
        name, value = match[1].lower(), (match[2] or "").strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        elif any(_is_mark(_WORD.findall(token)) for token in value.split()):
            return True
    return False


def page_blocks(page: str) -> list[tuple[str, bool, bool]]:
    """(text, is in an article, is no main text) of the blocks of a page, in page order.

    References are decoded, white space is one space and trimmed, empty blocks are left out.
    What is cut off in the middle of a tag is no text.
    """
    blocks: list[tuple[str, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    in_main = aside = False

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append((text, in_main, aside))
            parts.clear()

    at, size = 0, len(page)
    while at < size:
        match = _TOKEN.search(page, at)
        if match is None:
            parts.append(entities.unescape(page[at:]))
            break
        if match.start() > at:
            parts.append(entities.unescape(page[at : match.start()]))
        at = match.end()
        tag = match[2]
        if tag is None:
            if match[0].startswith("<![CDATA["):
                parts.append(match[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if match[4] == "":
            break
        if match[1]:
            if tag in BLOCK:
                flush()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    if stack[depth][1:] != (in_main, aside):
                        flush()
                    in_main, aside = stack[depth][1:]
                    del stack[depth:]
                    break
                if stack[depth][0] in MAIN and tag not in ("html", "body", "main", "article"):
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if not match[3].rstrip().endswith("/"):
                at = end.end() if end else size
            continue
        if tag == "br":
            parts.append(" ")
        if tag in BLOCK:
            flush()
        if tag in VOID:
            continue
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in CLOSES.get(tag, ()):
                in_main, aside = stack[depth][1:]
                del stack[depth:]
            elif stack[depth][0] in BLOCK:
                break
        stack.append((tag, in_main, aside))
        outside = _is_aside(tag, match[3])
        if (outside and not aside) or (tag in MAIN and not in_main):
            flush()
        aside = aside or outside
        in_main = in_main or tag in MAIN
    flush()
    return blocks


def common_lines(one: list[int], other: list[int]) -> list[int]:
    """Positions in ``one`` of a longest common subsequence with ``other``."""
    start = 0
    while start < min(len(one), len(other)) and one[start] == other[start]:
        start += 1
    end = 0
    while end < min(len(one), len(other)) - start and one[-1 - end] == other[-1 - end]:
        end += 1
    middle, where = range(start, len(one) - end), {}
    for j in range(start, len(other) - end):
        where.setdefault(other[j], []).append(j)
    # The longest increasing run of matches, by the smallest last position for each length.
    last: list[int] = []
    tails: list[tuple] = []
    for i in middle:
        for j in reversed(where.get(one[i], ())):
            k = bisect_left(last, j)
            chain = (i, tails[k - 1] if k else None)
            if k == len(last):
                last.append(j)
                tails.append(chain)
            else:
                last[k], tails[k] = j, chain
    found, chain = [], tails[-1] if tails else None
    while chain:
        found.append(chain[0])
        chain = chain[1]
    return [*range(start), *reversed(found), *range(len(one) - end, len(one))]


def _line_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _site_lines(blocks: list[tuple[str, bool, bool]]) -> list[int]:
    return [_line_hash(text) for text, in_main, aside in blocks if aside or not in_main]


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(..., html) -> (..., hashes of the lines outside the article)."""
    for batch in batches:
        lines = [_site_lines(page_blocks(page or "")) for page in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(lines, pa.list_(pa.int64()))], names=[*batch.schema.names[:-1], "lines"]
        )


def main_text(page: str | None, neighbour: list[int] | None) -> str:
    """The text of a page, given the line hashes of the page beside it ([] if it has none).

    With None nothing is known of the site, and where a page has an article only that stays.
    """
    blocks = page_blocks(page or "")
    only_article = neighbour is None and any(in_main and not aside for _, in_main, aside in blocks)
    shared: set[int] = set()
    if neighbour:
        shared = set(common_lines(_site_lines(blocks), neighbour))
    kept, line = [], -1
    for text, in_main, aside in blocks:
        site = aside or not in_main
        line += site
        if not site or (not aside and not only_article and line not in shared):
            kept.append(text)
    return "\n\n".join(kept)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(..., html, lines of the neighbour) -> (..., text)."""
    for batch in batches:
        pages, neighbours = batch.columns[-2].to_pylist(), batch.columns[-1].to_pylist()
        texts = [main_text(page, lines or []) for page, lines in zip(pages, neighbours)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=[*batch.schema.names[:-2], "text", "n_chars"],
        )


def shared_path(one: str, other: str) -> Column:
    """How many leading steps two URL paths have in common."""
    steps = F.zip_with(F.split(one, "/"), F.split(other, "/"), lambda a, b: a.eqNullSafe(b))
    differs = F.array_position(steps, False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(steps))


def extract_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` without its html column, with text and n_chars (code points).

    The text holds the blocks that stay, joined by empty lines; "" if there are none, for null
    and for empty pages. Pages without a URL count as one host. The neighbour of a page is that of
    the two beside it, in the order of path on the same host, whose path has more leading steps in
    common with its own (the one before, if both have as many), among pages with other lines
    (pages of equal lines count once, at the smallest path), so that copies of a page do not
    delete each other; a host with one kind of page deletes nothing. Repeated rows get
    equal texts; columns named text or n_chars make way; an empty table gives no rows.
    """
    columns = [c for c in pages.columns if c not in (html,) and c.lower() not in ("text", "n_chars")]
    key = single_column("_page", *pages.columns)
    address = F.lower(F.coalesce(F.col(url).cast("string"), F.lit("")))
    host = F.regexp_extract(address, r"^(?:[a-z][a-z0-9+.-]*:)?(?://)?([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?[^/?#]*([^?#]*)", 1)
    body = F.col(html).cast("string")
    # The same for rows of equal address and content, and for no others.
    name = F.sha2(F.concat_ws("\u0000", F.coalesce(F.col(url).cast("string"), F.lit("")), F.coalesce(body, F.lit(""))), 256)

    outlined = stored(
        pages.select(name.alias("page"), host.alias("host"), path.alias("path"), body.alias("html")).mapInArrow(
            _outlines, "page string, host string, path string, lines array<bigint>"
        )
    )
    digest = F.sha2(F.array_join("lines", ","), 256)
    kinds = stored(
        outlined.groupBy("host", digest.alias("kind")).agg(F.min("path").alias("path"), F.first("lines").alias("lines"))
    )
    placed = stored(global_rank(kinds.select("host", "path", "kind"), "host", "path", "kind"))
    beside = placed.select("host", F.col("kind").alias("other"), F.col("path").alias("there"), "rank")
    before = beside.withColumn("rank", F.col("rank") + 1).withColumnsRenamed({"other": "previous", "there": "before"})
    after = beside.withColumn("rank", F.col("rank") - 1).withColumnsRenamed({"other": "next", "there": "after"})
    nearer = F.col("previous").isNull() | (shared_path("path", "after") > shared_path("path", "before"))
    pairs = (
        placed.join(before, ["host", "rank"], "left")
        .join(after, ["host", "rank"], "left")
        .select("host", "kind", F.when(F.col("next").isNotNull() & nearer, F.col("next")).otherwise(F.col("previous")).alias("other"))
    )
    lines = kinds.select(F.col("host"), F.col("kind").alias("other"), F.col("lines").alias("beside"))
    beside_kind = stored(pairs.join(lines, ["host", "other"]).select("host", "kind", "beside"))
    # What a page is aligned with; a page without a neighbour is in none of these rows.
    known = stored(
        outlined.select("page", "host", digest.alias("kind"))
        .distinct()
        .join(beside_kind, ["host", "kind"])
        .select(F.col("page").alias(key), "beside")
    )
    markup, near = single_column("_html", *pages.columns, key), single_column("_beside", *pages.columns, key)
    source = pages.select(*columns, name.alias(key), body.alias(markup))
    source = source.join(known.withColumnRenamed("beside", near), key, "left").select(*columns, markup, near)
    schema = source.select(*columns).schema.add("text", T.StringType()).add("n_chars", T.LongType())
    return source.mapInArrow(_texts, schema)

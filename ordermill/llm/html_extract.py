"""Main text of web pages: markup first, then what the pages of a host share.

Parsing gives a page's text blocks, without what the markup itself marks as
no main text (scripts, menus, headers, footers, sidebars, notices, adverts,
forms, reader comments: by element, role, class or id). Where the page marks
its main part (article, main, or a container named as the content), only
that part's blocks are left. What is left is judged by the page's host, over
its distinct pages (copies of a page count as one), marked and other pages
each by themselves:

* The words of all blocks of a page are its token stream. The streams of a
  host's pages are put into suffix arrays, sorted by their suffixes' first
  ``RUN`` words, and neighbours are compared: those that agree are the places
  of a repeated string. If nearly all pages have it (``SHARE``, of
  ``MIN_HOST`` or more; ``MIN_PAGES`` where no main part is marked), its
  words are boilerplate; a longer string is the overlapping places of its
  parts. Passages that recur on some pages only, like quotes, stay.
* A whole block that nearly all pages have (``SHARE``, of ``MIN_HOST`` or
  more) is boilerplate however short it is.

All other words stay. A large host's distinct pages are dealt to several
suffix arrays of about ``ARRAY_WORDS`` words, no page to two of them. A
string on a share of all pages is on that share of the pages of one array at
least, so what the arrays find are all the strings that need be counted over
the whole host: each is looked for in every page, by its words.

Counts are partial aggregates first: a line that all pages of a large host
share is one row per task.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import stored

RUN = 10
MIN_PAGES = 3
MIN_HOST = 10
SHARE = 0.8
#: Words of a suffix array, so many pages at least (as the mean), and as many rows of one page's copies.
ARRAY_WORDS = 1 << 16
ARRAY_PAGES = 40
COPIES = 100

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|title|textarea|iframe|svg|math|select|object)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*?"
    r"(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
#: Elements that hold no main text.
SKIP = frozenset("head nav footer aside form button menu dialog audio video canvas noframes".split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form comment".split())
#: Parts of a class or id that say the same.
SKIP_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead banner cookie cookies consent gdpr notice "
    "notices notification popup modal overlay newsletter subscribe subscription signup login promo promotion sponsor "
    "sponsored advert adverts advertisement advertising ad ads adsense social share sharing related recommended "
    "comment comments disqus respond reply replies pagination pager toolbar widget widgets copyright skip".split())
#: Of article and main elements themselves, only these (with the parts below) say that they are none.
REMARKS = frozenset("comment comments disqus respond reply replies".split())
#: Parts that say nothing by themselves: inside the main part, a name rules text out only if all its other parts do.
FILLERS = frozenset(
    "area articles bar block bottom box btn button buttons container feed form group icons inner item items left links list "
    "main media news outer page pages panel post posts right row section site slot stories story text thread title top "
    "unit wrap wrapper".split())
MAIN_NAMES = frozenset("article content post entry story".split())
_PART = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

SKIPPED, FREE, MAIN = 0, 1, 2


def _names(value: str) -> set[str]:
    out = set()
    for word in value.split():
        word = _CAMEL.sub("-", word).lower()
        if not word.startswith(("has-", "with-", "no-", "is-", "js-")):
            out |= set(_PART.findall(word))
    return out


def _ruled_out(value: str, names: frozenset[str]) -> bool:
    """Whether a class or id consists of the names (and fillers), like related-posts but not related-work."""
    for word in value.split():
        parts = set(_PART.findall(_CAMEL.sub("-", word).lower()))
        if parts & names and parts <= names | FILLERS:
            return True
    return False


def _kind(name: str, attributes: str, outer: int) -> int:
    """What the blocks of an element are, given what its parent's are."""
    if outer == SKIPPED or name in SKIP:
        return SKIPPED
    kind = MAIN if name in ("article", "main") else outer
    if name == "header" and outer != MAIN:
        return SKIPPED
    if not attributes.strip():
        return kind
    found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return SKIPPED
    if found.get("role", "").lower() in SKIP_ROLES:
        return SKIPPED
    if name in ("html", "body"):
        return kind
    value = found.get("class", "") + " " + found.get("id", "")
    if found.get("itemprop", "").lower() == "comment" or _ruled_out(value, REMARKS):
        return SKIPPED
    if outer == MAIN:
        return SKIPPED if _ruled_out(value, SKIP_NAMES) else kind
    if name in ("article", "main"):
        return kind
    names = _names(value)
    if names & SKIP_NAMES or "header" in names:
        return SKIPPED
    if found.get("role", "").lower() in ("main", "article") or (names & MAIN_NAMES and name in ("div", "section")):
        return MAIN
    return kind


def blocks(page: str) -> list[tuple[int, str]]:
    """(FREE or MAIN, text) of a page's blocks that the markup doesn't rule out."""
    out: list[tuple[int, str]] = []
    pieces: list[str] = []
    stack: list[tuple[str, int]] = [("", FREE)]  # open elements and their kinds
    at = 0

    def close_block() -> None:
        if pieces:
            if (text := " ".join("".join(pieces).split())) and stack[-1][1] != SKIPPED:
                out.append((stack[-1][1], text))
            pieces.clear()

    def pop(name: str, fence: tuple[str, ...] = ()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == name:
                if stack[i][1] != stack[-1][1] or stack[i][1] != stack[i - 1][1] or name not in INLINE:
                    close_block()
                del stack[i:]
                return
            if stack[i][0] in fence:
                return

    for m in _TAG.finditer(page):
        if m.start() > at and stack[-1][1] != SKIPPED:
            pieces.append(html.unescape(page[at:m.start()]))
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if m[2]:
            pop(name, ("article", "main", "body") if name in INLINE or name == "p" else ())
        elif name in ("br", "wbr", "img"):
            pieces.append(" " if name == "br" else "")
        else:
            if name not in INLINE:
                close_block()
                pop("p", ("div", "article", "main", "section", "td", "th", "li", "body"))
                if name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    pop(name, ("ul", "ol", "dl", "table"))
            if name not in VOID and not m[4].endswith("/"):
                kind = _kind(name, m[4], stack[-1][1])
                if kind != stack[-1][1]:
                    close_block()
                stack.append((name, kind))
    if at < len(page) and stack[-1][1] != SKIPPED:
        pieces.append(html.unescape(page[at:]))
    close_block()
    return out


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/@]*@)?([^/:?#]*)", (url or "").strip(), re.I)
    return m[1].lower() if m else ""


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, marked, page, blocks): the blocks of the main part;
    or, if none is marked, the page's other blocks. page names the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, marked, kept = batch.column("url").to_pylist(), [], []
            for page in batch.column("html").to_pylist():
                found = blocks(page or "")
                main = [t for kind, t in found if kind == MAIN]
                marked.append(bool(main) or not found)
                kept.append(main or [t for _, t in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").cast(pa.int64()), batch.column("url"),
                 pa.array(map(host_of, urls), pa.string()), pa.array(marked, pa.bool_()), pa.array(kept, pa.list_(pa.string()))],
                ["page_id", "url", "host", "marked", "blocks"])

    return pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id bigint, url string, host string, marked boolean, blocks array<string>").withColumn(
        "page", F.xxhash64("blocks"))


def shared_blocks(facts: DataFrame, sizes: DataFrame, min_host: int, share: float) -> DataFrame:
    """(host, marked, shared): the hashes of blocks (marks) that nearly all pages of a host have."""
    sizes = sizes.where(F.col("pages") >= min_host)
    each = facts.select("host", "marked", "page", F.explode("marks").alias("mark")).groupBy("host", "marked", "mark").agg(
        F.count_distinct("page").alias("n"))
    return each.join(sizes, ["host", "marked"]).where(F.col("n") >= F.col("pages") * share).groupBy("host", "marked").agg(
        F.collect_set("mark").alias("shared"))


def suffix_array(words: pa.Array, run_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The suffixes of pages' words (one string a page) of ``run_length``
    words or more, sorted by that many words: (places, their pages, whether
    one's words agree with those of the one before it, all words)."""
    split = pc.split_pattern(words, " ")
    tokens = split.flatten()
    ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))
    ranks = tokens.dictionary_encode().indices.to_numpy().astype(np.int64)
    depth = 1
    while depth < run_length:  # ranks by twice as many words, from those by so many
        step = min(depth, run_length - depth)
        after = np.full(len(ranks), -1)
        after[:-step] = ranks[step:]
        ranks = np.unique(ranks * (len(ranks) + 1) + after + 1, return_inverse=True)[1].astype(np.int64)
        depth += step
    pages = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    whole = np.flatnonzero(np.arange(len(ranks)) + run_length <= ends[pages])
    places = whole[np.argsort(ranks[whole], kind="stable")]
    agrees = np.zeros(len(places), bool)
    agrees[1:] = ranks[places[1:]] == ranks[places[:-1]]
    return places, pages[places], agrees, tokens


def repeated_strings(words: pa.Array, run_length: int, least: float) -> list[str]:
    """The strings of ``run_length`` words that ``least`` of the pages have, or more."""
    places, pages, agrees, tokens = suffix_array(words, run_length)
    if not len(places):
        return []
    string = np.cumsum(~agrees) - 1
    new = ~agrees
    new[1:] |= pages[1:] != pages[:-1]  # places of a string are in the order of the pages
    found = np.flatnonzero(np.bincount(string[new]) >= least)
    return [" ".join(tokens[p:p + run_length].to_pylist()) for p in places[~agrees][found].tolist()]


def _candidates(found: DataFrame, distinct: DataFrame, sizes: DataFrame, run_length: int, min_pages: int, min_host: int, share: float,
                array_words: int, copies: int) -> DataFrame:
    """(host, marked, string): what nearly all pages of one of a host's suffix arrays have."""
    group = ["host", "marked"]
    enough = F.when(F.col("marked"), min_host).otherwise(min_pages)
    arrays = F.ceil(F.least(F.col("words") / array_words, F.col("pages") / ARRAY_PAGES))
    hosts = sizes.where(F.col("pages") >= enough).select(*group, F.greatest(arrays, F.lit(1)).cast("int").alias("arrays"))
    texts = found.select(*group, F.xxhash64("page_id", "url").alias("copy"), "page", F.array_join("blocks", " ").alias("words"))
    often = stored(distinct.where(F.col("rows") > copies).select(*group, "page", "first"), "html-copies")
    if not often.isEmpty():
        texts = texts.join(often, [*group, "page"], "left").where("first IS NULL OR first = copy")
    texts = texts.join(hosts, group).select(*group, F.pmod("page", "arrays").alias("array"), "page", "words")

    def strings(table: pa.Table) -> pa.Table:
        _, first = np.unique(table.column("page").to_numpy(), return_index=True)
        least = max(share * len(first) - 1e-6, 1)
        found = repeated_strings(table.column("words").take(first).combine_chunks(), run_length, least)
        return pa.table([pa.array([table.column(c)[0].as_py()] * len(found), t) for c, t in zip(group, (pa.string(), pa.bool_()))]
                        + [pa.array(found, pa.string())], [*group, "string"])

    return texts.groupBy(*group, "array").applyInArrow(strings, "host string, marked boolean, string string").distinct()


def places_of(strings: list[str], run_length: int, blocks: list[str]) -> list[tuple[int, int]]:
    """(place, string's number) of the strings of so many words in the blocks' words."""
    numbers = {s: i for i, s in enumerate(strings)}
    tokens = " ".join(blocks).split(" ")
    runs = (" ".join(tokens[p:p + run_length]) for p in range(len(tokens) - run_length + 1))
    return [(p, numbers[r]) for p, r in enumerate(runs) if r in numbers]


def shared_strings(found: DataFrame, distinct: DataFrame, sizes: DataFrame, run_length: int, min_pages: int, min_host: int, share: float,
                   array_words: int, copies: int) -> DataFrame:
    """(host, marked, strings): those of ``run_length`` words that nearly all pages of a host have."""
    group = ["host", "marked"]
    candidates = stored(_candidates(found, distinct, sizes, run_length, min_pages, min_host, share, array_words, copies), "html-candidates")
    lists = stored(candidates.groupBy(*group).agg(F.collect_list("string").alias("strings")), "html-lists")
    if lists.isEmpty():
        return lists

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [sorted({i for _, i in places_of(s, run_length, b)})
                    for s, b in zip(batch.column("strings").to_pylist(), batch.column("blocks").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*group, "page")), pa.array(hits, pa.list_(pa.int32()))],
                                             [*group, "page", "hits"])

    hits = found.join(lists, group).select(*group, "page", "blocks", "strings").mapInArrow(
        run, "host string, marked boolean, page bigint, hits array<int>")
    hits = hits.groupBy(*group, "page").agg(F.first("hits").alias("hits"))
    n = hits.select(*group, F.explode("hits").alias("i")).groupBy(*group, "i").agg(F.count(F.lit(1)).alias("n"))
    wanted = n.join(sizes, group).where(F.col("n") >= F.col("pages") * share).groupBy(*group).agg(F.collect_list("i").alias("wanted"))
    return wanted.join(lists, group).select(*group, F.transform("wanted", lambda i: F.col("strings")[i]).alias("strings"))


def unique_words(blocks: list[str], covered: list[int], run_length: int, common: list[bool]) -> str:
    """The blocks that are not common, without the words that repeated strings cover."""
    sizes = [len(t.split(" ")) for t in blocks]
    keep = np.ones(sum(sizes), bool)
    for p in covered:
        keep[p:p + run_length] = False
    out, at = [], 0
    for text, n, drop in zip(blocks, sizes, common):
        left = [] if drop else [w for w, kept in zip(text.split(" "), keep[at:at + n]) if kept]
        at += n
        if left:
            out.append(" ".join(left))
    return "\n".join(out)


def extract(pages: DataFrame, run: int = RUN, min_pages: int = MIN_PAGES, min_host: int = MIN_HOST, share: float = SHARE,
            array_words: int = ARRAY_WORDS, copies: int = COPIES) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars.

    A null or empty html gives an empty text. n_chars counts code points.
    ``array_words`` bounds a suffix array; from more rows than ``copies`` of
    one page, only those of one page_id and url go to it, where a page counts
    once in any case (neither changes the results).
    """
    group = ["host", "marked"]
    found = parsed(pages)
    mark = lambda block: F.xxhash64(block)
    words = F.aggregate("blocks", F.lit(0).cast("bigint"), lambda n, block: n + F.length(block) - F.length(F.replace(block, F.lit(" "))) + 1)
    facts = stored(found.select(F.xxhash64("page_id", "url").alias("copy"), *group, "page", F.transform("blocks", mark).alias("marks"), words.alias("words")), "html-facts")
    distinct = facts.groupBy(*group, "page").agg(F.count(F.lit(1)).alias("rows"), F.min("copy").alias("first"), F.first("words").alias("words"))
    distinct = stored(distinct, "html-pages")
    dealt = F.col("words") * F.when(F.col("rows") > copies, 1).otherwise(F.col("rows"))
    sizes = stored(distinct.groupBy(*group).agg(F.count(F.lit(1)).alias("pages"), F.sum(dealt).alias("words")), "html-hosts")
    blocks_ = stored(shared_blocks(facts, sizes, min_host, share), "html-shared")
    strings = stored(shared_strings(found, distinct, sizes, run, min_pages, min_host, share, array_words, copies), "html-strings")
    if blocks_.isEmpty() and strings.isEmpty():
        texts = found.select("page_id", "url", F.array_join("blocks", "\n").alias("text"))
    else:
        common = F.transform("blocks", lambda block: F.coalesce(F.array_contains("shared", mark(block)), F.lit(False)))
        known = found.join(blocks_.join(strings, group, "full"), group, "left").select("page_id", "url", "blocks", "strings", common.alias("common"))

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [unique_words(b, [p for p, _ in places_of(s or [], run, b)] if s else [], run, c)
                         for b, s, c in zip(*(batch.column(x).to_pylist() for x in ("blocks", "strings", "common")))]
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                                 ["page_id", "url", "text"])

        texts = known.mapInArrow(clean, "page_id bigint, url string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))

"""Main text of web pages: markup where it settles the matter, a suffix array over each host's pages elsewhere."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.reputation import with_address
from tideline.llm.tables import shuffle_partitions
from tideline.llm.words import tokenised
from tideline.session import stored

# Names in markup that say what an element is.
RAW = frozenset("script style template noscript iframe svg textarea title select button object canvas".split())
CHROME = frozenset("head nav header footer aside form menu dialog".split())
MAIN = frozenset("article main".split())
BLOCKS = CHROME | MAIN | frozenset(
    "address blockquote body center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html legend li ol "
    "p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer header masthead menu modal nav navbar navigation newsletter notice notices popup promo related share "
    "sharing sidebar social sponsor sponsored subscribe".split()
)
#: A name that begins so tells what an element holds or lacks, not what it is.
STATE_PARTS = frozenset("has with without no is not".split())
#: Elements that are no part of a page's surroundings whatever they are named.
FRAMES = frozenset("html body main article".split())
CHROME_ROLES = frozenset("alert banner complementary contentinfo dialog form menu navigation search".split())

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME_PARTS = re.compile(r"[a-z]+")

#: Kinds of blocks: settled main text, unsettled, and what never is main text.
SETTLED, OPEN, NEVER = 0, 1, 2
#: Tokens of a run that counts as long.
MIN_RUN = 8


def role_of(tag: str, attributes: str, outer: int) -> int:
    """What an element's text is, given what the element around it is."""
    if outer == NEVER or tag in CHROME:
        return NEVER
    main = tag in MAIN
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "role":
            if value in CHROME_ROLES:
                return NEVER
            main = main or value == "main"
        elif tag not in FRAMES and any(names_chrome(word) for word in value.split()):
            return NEVER
    return SETTLED if main else outer


def names_chrome(name: str) -> bool:
    """Whether a class or id names an element of the page's surroundings."""
    parts = NAME_PARTS.findall(name)
    return bool(parts) and parts[0] not in STATE_PARTS and any(part in CHROME_NAMES for part in parts)


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(kind, text) of the blocks of a page in order, white space as one space, references decoded."""
    out: list[tuple[int, str]] = []
    pieces: list[str] = []
    stack: list[tuple[str, int]] = []
    kind, at = OPEN, 0

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            out.append((kind, text))

    while found := MARKUP.search(page, at):
        if found.start() > at:
            pieces.append(html.unescape(page[at : found.start()]))
        at = found.end()
        closing, tag, attributes = found.group(1), (found.group(2) or "").lower(), found.group(3) or ""
        if not tag:
            continue
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            pieces.append(" ")
        if tag in BLOCKS:
            flush()
        if closing:
            if any(open_tag == tag for open_tag, _ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag not in VOID and not attributes.endswith("/"):
            if tag in ("p", "li") and stack and any(t == tag for t, _ in stack[-3:]):
                while stack.pop()[0] != tag:
                    pass
            stack.append((tag, role_of(tag, attributes, stack[-1][1] if stack else OPEN)))
        kind = stack[-1][1] if stack else OPEN
    if at < len(page):
        pieces.append(html.unescape(re.sub(r"<[a-zA-Z/!][^>]*\Z", "", page[at:])))
    flush()
    return out


def token_streams(blocks: list[tuple[int, str]]) -> Iterator[tuple[int, list[int], bytes]]:
    """The page's token stream outside of settled text, cut where settled text stands: (first token, lengths, text)."""
    first, lengths, texts = 0, [], []
    for kind, text in [*blocks, (SETTLED, "")]:
        if kind != SETTLED:
            lengths.append(len(text.split()))
            texts.append(text)
        elif texts:
            yield first, lengths, " ".join(texts).encode()
            first, lengths, texts = first + sum(lengths), [], []


def suffixes(stream: bytes) -> list[bytes]:
    """The stream's suffixes from each token on, cut at MIN_RUN tokens: hashes that sort token by token."""
    hashes = (tokenised([stream]).hashes >> np.uint64(32)).astype(">u4").tobytes()
    return [hashes[i : i + 4 * MIN_RUN] for i in range(0, len(hashes) - 4 * MIN_RUN + 1, 4)]


READ = (
    "page long, page_id long, url string, host string, html string, text string, "
    "suffix binary, first_page long, last_page long"
)


def read_pages(pages: DataFrame) -> DataFrame:
    """Two kinds of rows from one reading of the pages (page, page_id, url, host, html), written once.

    Each page with its text if markup settles it all, else with its html. And the suffixes of all pages, each once
    per host and batch with the first and last page that has it.
    """
    schema = pa.schema(
        [
            ("page", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()),
            ("html", pa.string()), ("text", pa.string()), ("suffix", pa.binary()),
            ("first_page", pa.int64()), ("last_page", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends: dict[tuple[str, bytes], tuple[int, int]] = {}
            rows = []
            for row in batch.to_pylist():
                blocks = blocks_of(row["html"] or "")
                if any(kind == OPEN for kind, _ in blocks):
                    rows.append(row)
                else:
                    rows.append(row | {"html": None, "text": main_text(blocks, [])})
                page, host = row["page"], row["host"]
                for _, _, stream in token_streams(blocks):
                    for suffix in suffixes(stream):
                        first, last = ends.get((host, suffix), (page, page))
                        ends[host, suffix] = min(first, page), max(last, page)
            rows += [{"host": h, "suffix": s, "first_page": a, "last_page": b} for (h, s), (a, b) in ends.items()]
            yield from pa.Table.from_pylist(rows, schema).to_batches()

    return stored(pages.mapInArrow(run, READ))


def repeated_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk the sorted suffixes: neighbours with a long common prefix that come from different pages."""
    run, pages, told = None, set(), False
    schema = pa.schema([("host", pa.string()), ("suffix", pa.binary())])
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            key = (row["host"], row["suffix"])
            if key != run:
                run, pages, told = key, set(), False
            pages = {min([*pages, row["first_page"]]), max([*pages, row["last_page"]])}
            if len(pages) > 1 and not told:
                out.append({"host": key[0], "suffix": key[1]})
                told = True
        yield from pa.Table.from_pylist(out, schema).to_batches()


def repeated_runs(evidence: DataFrame) -> DataFrame:
    """(host, suffix): the token runs of MIN_RUN that stand on two or more pages of a host.

    All suffixes are sorted over the whole cluster by range, so together the partitions are the suffix array of
    every host, and a host with a third of all pages is spread over many of them. Equal suffixes of many pages were
    brought down to one row per batch before.
    """
    dealt = evidence.repartitionByRange(shuffle_partitions(evidence), "host", "suffix").sortWithinPartitions("host", "suffix")
    return dealt.mapInArrow(repeated_neighbours, "host string, suffix binary")


def main_text(blocks: list[tuple[int, str]], covered: list[int]) -> str:
    """Settled blocks as they are, unsettled ones without the covered tokens; ``covered`` has starts of repeated runs."""
    gone = {t for start in covered for t in range(start, start + MIN_RUN)}
    kept, token = [], 0
    for kind, text in blocks:
        if kind == SETTLED:
            kept.append(text)
            continue
        words = text.split()
        if kind == OPEN:
            left = " ".join(w for i, w in enumerate(words, token) if i not in gone)
            kept += [left] if left else []
        token += len(words)
    return "\n".join(kept)


LOOKUP = "page long, host string, start int, suffix binary"


def lookups(open_pages: DataFrame) -> DataFrame:
    """The suffixes of pages with unsettled text, with the token they start at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page", pa.int64()), ("host", pa.string()), ("start", pa.int32()), ("suffix", pa.binary())])
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("page", "host", "html"))
            for page, host, body in zip(*columns, strict=True):
                rows = [
                    {"page": page, "host": host, "start": first + i, "suffix": suffix}
                    for first, _, stream in token_streams(blocks_of(body or ""))
                    for i, suffix in enumerate(suffixes(stream))
                ]
                yield from pa.Table.from_pylist(rows, schema).to_batches()

    return open_pages.select("page", "host", "html").mapInArrow(run, LOOKUP)


def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("html", "covered"))
        texts = [main_text(blocks_of(body or ""), covered or []) for body, covered in zip(*columns, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """The main text of each page.

    An article or main element is main text; navigation, headers, footers, asides, forms, scripts, styles, and what
    a class, id or role names as advert, notice, comment and the like is none, wherever it stands. The rest is open:
    of that, runs of ``MIN_RUN`` tokens or more that other pages of the host have too, in open text or outside it,
    are boilerplate, and only the tokens no such run covers stay. Nothing settled is dropped for being repeated, as
    articles may be printed twice.

    Blocks are joined by newlines, white space in a block is one space, character references are decoded. Null html
    counts as empty and gives empty text; a null or malformed url has the empty host. Repeated rows, and a page that is
    served under several addresses, get a row each and are one page for each other; an empty table gives no rows; other columns are not read. Returns page_id, url,
    text, n_chars.
    """
    rows = with_address(
        pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    ).select(F.xxhash64("host", "html").alias("page"), "page_id", "url", "host", "html")
    read = read_pages(rows)
    done = read.where("text IS NOT NULL").select("page_id", "url", "text")
    opened = read.where("suffix IS NULL AND text IS NULL").select("page", "page_id", "url", "host", "html")
    evidence = read.where("suffix IS NOT NULL").select("host", "suffix", "first_page", "last_page")
    covered = lookups(opened).distinct().join(repeated_runs(evidence), ["host", "suffix"])
    covered = covered.groupBy("page").agg(F.collect_list("start").alias("covered"))
    rest = opened.join(covered, "page", "left").mapInArrow(assembled, "page_id long, url string, text string")
    return done.unionByName(rest).withColumn("n_chars", F.length("text").cast("long"))

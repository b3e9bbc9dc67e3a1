"""Main text of web pages by differencing pages with the nearest URL.

A page becomes text lines, one per block, each in a zone: article (inside ``article`` or
``main``), furniture (inside elements that by name, role or class are menus, headers, footers,
sidebars, notices, adverts, forms or comments) or loose. Pages of a host are put in order of
their URL path; a page is compared with the neighbour whose path has the longer common beginning.
Their lines are aligned by a longest common subsequence, and the lines both share are deleted:
they belong to the site, not to the page. Two checks follow, for what differencing cannot tell:

* a shared line that is prose (of ``PROSE`` code points or more, or in an article, and no link text) goes only if
  more than two and more than half of the host's pages share it with their neighbours: two
  pages may quote the same passage, or one may be a later version of the other. The lines of a page whose
  neighbour has all of them are treated alike;
* furniture that no neighbour shares, such as reader comments, goes by its zone, and so do loose lines
  where there is an article, unless they hold so much more prose that the article is a teaser.

Copies prove nothing about each other. Pages of a host with the same lines are one page while neighbours are
looked for, and what the first of them loses all of them lose.

The order of pages is a distributed sort of addresses. The rank of a page is its place in its part plus the rows
of the parts before, so neighbours meet by an equi-join on the rank, and a host with a
third of all pages is spread like any other. Line hashes are joined to the pair that was found.
"""

from __future__ import annotations

import html
import os.path
import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from blotter.sources import stored

FURNITURE, LOOSE, ARTICLE = 0, 1, 2

#: The lines of a site are copied so often.
PIECES = 32
#: Lines of so many code points that are no links are prose.
PROSE = 80
#: Pages that are parsed before their lines are passed on.
TOGETHER = 256
#: An article line of which at least this part is link text is no prose.
LINKED = 0.5

# Names of HTML elements.
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
MAIN = frozenset("article main".split())
DROPPED = frozenset(
    "head nav footer aside form menu svg math template object audio video canvas select button dialog map".split()
)
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
    "ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)

# Words in class, id and role that name something other than the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe signup nav navbar "
    "navigation menu menus breadcrumb breadcrumbs sidebar aside widget widgets footer masthead topbar comment "
    "comments commentlist respond disqus share sharing social related recommended pagination pager toolbar login "
    "search contentinfo complementary form dialog".split()
)
#: Marks that count outside an article only; inside it they hold its title.
OUTSIDE = frozenset({"header"})

# Words before a mark that tell what goes with an element, and words behind it for its form only.
STATES = frozenset("has have with without no not is in after before under near".split())
FORMS = frozenset(
    "area articles bar block body bottom box column container content frame group holder inner item items left "
    "link links list outer panel posts region right row section slot stories top unit wrap wrapper zone".split()
)
#: Loose prose this many times as long as that of all articles is no furniture: the articles are teasers then.
TEASER = 2

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[/!?][^>]*>", re.DOTALL
)
NAMED = re.compile(r"(?:^|[\s\"'])(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.IGNORECASE)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

Line = tuple[str, int, bool]


def lines(page: str) -> list[Line]:
    """(text, zone, linked) of each block with text, in page order."""
    found: list[Line] = []
    # Name, whether all below is furniture, whether it is an article, what was dropped outside of a main element.
    stack: list[tuple[str, bool, bool, int]] = []
    dropped = articles = links = 0
    pieces: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            zone = FURNITURE if dropped else ARTICLE if articles else LOOSE
            found.append((text, zone, linked >= LINKED * len(text)))
        pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            pieces.append(html.unescape(text) if "&" in text else text)
            if links:
                linked += len(pieces[-1].strip())

    def pop() -> None:
        nonlocal dropped, articles, links
        name, drops, article, outside = stack.pop()
        dropped += outside - drops
        articles -= article
        links -= name == "a"

    at = 0
    while True:
        tag = TAG.search(page, at)
        add(page[at : tag.start() if tag else len(page)])
        if tag is None:
            break
        at = tag.end()
        name = tag[2].lower() if tag[2] else ""
        if not name:
            continue
        if name in BLOCK:
            close()
        if tag[1]:
            if any(name == open_name for open_name, *_ in stack):
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in VOID:
            continue
        if name in ("p", "li", "dt", "dd", "option", "tr", "td", "th") and stack:
            _close_implied(name, stack, pop)
        attributes = tag[3]
        drops = name in DROPPED or (name in OUTSIDE and not articles)
        if not drops and attributes and name not in ("html", "body", "article", "main"):
            for value in NAMED.findall(attributes):
                heads = _heads(value)
                if heads & MARKS or (heads & OUTSIDE and not articles):
                    drops = True
        article = name in MAIN
        # What holds the main element is not furniture, whatever it is called.
        outside = dropped if name == "main" else 0
        stack.append((name, drops, article, outside))
        dropped += drops - outside
        articles += article
        links += name == "a"
    close()
    return found


def _heads(value: str) -> set[str]:
    """What each name in a class, id or role means: its last word but for those that tell its form only.

    ``site-nav`` and ``commentList`` are a nav and a comment, ``notice-period`` is a period; ``has-sidebar`` says
    what stands beside an element, not what it is.
    """
    found = set()
    for name in value.strip("\"'").split():
        words = [word.lower() for word in WORDS.findall(name)]
        if not words or words[0] in STATES:
            continue
        while len(words) > 1 and words[-1] in FORMS:
            words.pop()
        found.add(words[-1])
    return found


def _close_implied(name: str, stack: list, pop) -> None:
    """An open element of the same kind ends where the next one begins, in the same container."""
    for depth in range(len(stack) - 1, -1, -1):
        open_name = stack[depth][0]
        if open_name == name:
            while len(stack) > depth:
                pop()
            return
        if open_name in BLOCK:
            return


def shared(a: Sequence[int], b: Sequence[int]) -> set[int]:
    """Places in ``a`` that a longest common subsequence of both aligns."""
    common = set(a) & set(b)
    left = [i for i, x in enumerate(a) if x in common]
    right = [x for x in b if x in common]
    found: set[int] = set()
    _align([a[i] for i in left], right, left, found)
    return found


def _align(a: list[int], b: list[int], places: list[int], found: set[int]) -> None:
    """Halves ``a`` and splits ``b`` where the two halves align best, so memory stays linear."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        found.add(places[start])
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        found.add(places[-1 - end])
        end += 1
    a, b, places = (x[start : len(x) - end] for x in (a, b, places))
    if not a or not b:
        return
    if len(a) == 1:
        if a[0] in b:
            found.add(places[0])
        return
    half = len(a) // 2
    ahead = _lengths(a[:half], b)
    behind = _lengths(a[half:][::-1], b[::-1])
    best = max(range(len(b) + 1), key=lambda j: ahead[j] + behind[len(b) - j])
    _align(a[:half], b[:best], places[:half], found)
    _align(a[half:], b[best:], places[half:], found)


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """Length of a longest common subsequence of ``a`` with each beginning of ``b``.

    One bit per place of ``b``: a bit is cleared where the length grows by one.
    """
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hits = row & where.get(x, 0)
        row = ((row + hits) | (row - hits)) & full
    lengths, total = [0], 0
    for bit in reversed(f"{row:0{len(b)}b}"):
        total += bit == "0"
        lengths.append(total)
    return lengths


def chosen(own: list[Line]) -> list[tuple[int, str, bool]]:
    """(place, text, open) of the lines that the zones leave; an open one goes if it is shared, others if most
    pages of the host share them."""
    prose = {zone: sum(len(text) for text, z, linked in own if z == zone and not linked) for zone in (LOOSE, ARTICLE)}
    if not any(z == ARTICLE for _, z, _ in own):
        zones = {LOOSE}
    elif prose[LOOSE] > TEASER * prose[ARTICLE]:
        zones = {LOOSE, ARTICLE}
    else:
        zones = {ARTICLE}
    return [
        (i, text, linked or (z == LOOSE and len(text) < PROSE)) for i, (text, z, linked) in enumerate(own) if z in zones
    ]


PARSED = (
    "page_id long, url string, part int, row long, texts array<string>, "
    "places array<int>, open array<boolean>, hashes array<long>"
)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, row = TaskContext.get().partitionId(), 0
    for batch in (whole.slice(at, TOGETHER) for whole in batches for at in range(0, whole.num_rows, TOGETHER)):
        texts, places, opened, hashes = [], [], [], []
        for page in batch.column(2):
            own = lines((page.as_py() or b"").decode(errors="replace"))
            left = chosen(own)
            places.append([i for i, _, _ in left])
            texts.append([text for _, text, _ in left])
            opened.append([is_open for _, _, is_open in left])
            hashes.append([xxhash.xxh64_intdigest(t.encode(errors="replace")) - (1 << 63) for t, _, _ in own])
        size = len(texts)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([part] * size, pa.int32()),
                pa.array(range(row, row + size), pa.int64()),
                pa.array(texts, pa.list_(pa.string())),
                pa.array(places, pa.list_(pa.int32())),
                pa.array(opened, pa.list_(pa.bool_())),
                pa.array(hashes, pa.list_(pa.int64())),
            ],
            names=["page_id", "url", "part", "row", "texts", "places", "open", "hashes"],
        )
        row += size


SHARED = "part int, row long, host string, digest long, shared array<struct<at int, open boolean, hash long>>"


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page that shares chosen lines with its neighbour: which, as places in the list of chosen lines."""
    kind = pa.list_(pa.struct([("at", pa.int32()), ("open", pa.bool_()), ("hash", pa.int64())]))
    for batch in batches:
        kept, found = [], []
        for number, page in enumerate(batch.select(["places", "open", "hashes", "other_hashes"]).to_pylist()):
            places = shared(page["hashes"], page["other_hashes"])
            lines_shared = [
                {"at": at, "open": is_open, "hash": page["hashes"][i]}
                for at, (i, is_open) in enumerate(zip(page["places"], page["open"]))
                if i in places
            ]
            if len(lines_shared) == len(page["places"]):  # nothing would be left of it
                lines_shared = [{**line, "open": False} for line in lines_shared]
            if lines_shared:
                kept.append(number)
                found.append(lines_shared)
        rows = batch.select(["part", "row", "host", "digest"]).take(pa.array(kept, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(found, kind)], names=["part", "row", "host", "digest", "shared"]
        )


@F.pandas_udf(BooleanType())
def _next_is_nearer(paths: pd.Series, before: pd.Series, after: pd.Series) -> pd.Series:
    """Whether the path after has the longer common beginning; of equally near ones the one before counts."""
    length = lambda a, b: len(os.path.commonprefix([a, b]))
    return pd.Series([length(p, n) > length(p, b) for p, b, n in zip(paths, before, after)], dtype="bool")


def addressed(pages: DataFrame) -> DataFrame:
    """``pages`` (url, places, open, hashes and others) with host, path and a digest of the lines."""
    address = F.coalesce(F.col("url"), F.lit(""))
    start = r"^[A-Za-z][A-Za-z0-9+.-]*://"
    return pages.withColumns(
        {
            "host": F.regexp_extract(address, start + r"([^/?#]*)", 1),
            "path": F.regexp_extract(address, start + r"[^/?#]*([^?#]*)", 1),
            "digest": F.xxhash64("places", "open", "hashes"),
        }
    )


def neighbours(firsts: DataFrame) -> DataFrame:
    """host, digest, part, row, other_part, other_row: the neighbour of each page that has one.

    ``firsts`` has host, digest, path, url, page_id, part and row of different pages. They are put in order of their
    addresses; of the pages before and after, that of the same host with the nearer path is taken.
    """
    order = ["host", "path", "url", "page_id", "digest"]
    placed = firsts.repartitionByRange(*order).sortWithinPartitions(*order).drop("url", "page_id")
    # The upper bits of this number are the sorted part, the lower 33 the place in it.
    placed = stored(placed.withColumn("place", F.monotonically_increasing_id()), "page-order")
    placed = placed.withColumn("sorted", F.shiftright("place", 33))
    ahead = Window.orderBy("sorted").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("sorted").agg(F.count("*").alias("size"))
    before = sizes.select("sorted", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = placed.join(stored(before, "page-parts"), "sorted").withColumn("rank", rank)
    ranked = ranked.drop("sorted", "before", "place")
    joined = ranked
    for side, step in (("prev", 1), ("next", -1)):
        other = ranked.select(
            (F.col("rank") + step).alias("rank"),
            F.struct("host", "path", "part", "row").alias(side),
        )
        joined = joined.join(other, "rank", "left")
        joined = joined.withColumn(side, F.when(F.col(f"{side}.host") == F.col("host"), F.col(side)))
    either = joined.where(F.col("prev").isNotNull() | F.col("next").isNotNull())
    blank = F.lit("")
    nearer = _next_is_nearer("path", F.coalesce("prev.path", blank), F.coalesce("next.path", blank))
    later = F.col("prev").isNull() | (F.col("next").isNotNull() & nearer)
    chosen_one = F.when(later, F.col("next")).otherwise(F.col("prev"))
    return either.withColumn("other", chosen_one).select(
        "host", "digest", "part", "row", F.col("other.part").alias("other_part"), F.col("other.row").alias("other_row")
    )


def lost_lines(parsed: DataFrame) -> DataFrame:
    """part, row, lost for each page that loses lines: their places in the list of chosen lines."""
    narrow = addressed(parsed.select("page_id", "url", "part", "row", "places", "open", "hashes"))
    narrow = stored(narrow.drop("places", "open", "hashes"), "page-addresses")
    first = F.min(F.struct("path", "url", "page_id", "part", "row")).alias("first")
    firsts = stored(narrow.groupBy("host", "digest").agg(first).select("host", "digest", "first.*"), "page-firsts")
    own = parsed.select("part", "row", "places", "open", "hashes")
    other = parsed.select(
        F.col("part").alias("other_part"), F.col("row").alias("other_row"), F.col("hashes").alias("other_hashes")
    )
    pairs = stored(neighbours(firsts), "page-pairs")
    pairs = pairs.join(own, ["part", "row"]).join(other, ["other_part", "other_row"]).drop("other_part", "other_row")
    common = stored(pairs.mapInArrow(_difference, SHARED), "page-shared")

    once = F.array_distinct(F.transform("shared", lambda line: line["hash"]))
    lines_shared = common.select("host", F.explode(once).alias("hash"))
    often = lines_shared.groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") > 2)
    sizes = firsts.groupBy("host").agg(F.count("*").alias("size"))
    # More than half of the pages hold each, so a host has no more of them than twice the lines of its mean page.
    site = (
        often.join(sizes, "host")
        .where(2 * F.col("n") > F.col("size"))
        .groupBy("host")
        .agg(F.collect_list("hash").alias("site"))
    )
    # Dealt out by host and piece, as one host may have a third of all pages.
    site = site.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    common = common.withColumn("piece", F.pmod(F.xxhash64("part", "row"), F.lit(PIECES)).cast("int"))
    goes = lambda line: line["open"] | F.coalesce(F.array_contains("site", line["hash"]), F.lit(False))
    lost = (
        common.join(site, ["host", "piece"], "left")
        .select("host", "digest", F.transform(F.filter("shared", goes), lambda line: line["at"]).alias("lost"))
        .where(F.size("lost") > 0)
    )
    return narrow.select("part", "row", "host", "digest").join(lost, ["host", "digest"]).select("part", "row", "lost")


def main_texts(table: DataFrame) -> DataFrame:
    """page_id, url, text for every row of a table with page_id, url and html.

    Null html is as empty html: empty text. A null URL has empty host and path. Repeated rows
    come back as often; like all pages of a host with the same lines they lose the same lines, against a page that differs. A
    host whose pages are all alike has no neighbours, and only zones decide.
    Other columns are not looked at. Texts stay where they were parsed: only addresses are
    sorted, and only pages that lose a line are joined back.
    """
    rows = table.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("binary").alias("html"),
    )
    parsed = stored(rows.mapInArrow(_parse, PARSED), "page-lines")
    losses = stored(lost_lines(parsed), "page-losses")
    joined = parsed.select("page_id", "url", "part", "row", "texts").join(losses, ["part", "row"], "left")
    left = F.filter("texts", lambda text, at: ~F.array_contains("lost", at))
    texts = F.when(F.col("lost").isNull(), F.col("texts")).otherwise(left)
    return joined.select("page_id", "url", F.array_join(texts, "\n").alias("text"))

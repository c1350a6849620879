"""Main text of web pages by differencing with the nearest page of the host (operator 7).

Pages of a host are put in the order of their URL paths and each is paired with the
neighbour whose path has the longer beginning in common; neighbours that are copies are passed
over. The two pages' lines are aligned by longest common subsequence; lines they share, and a
third page of the host has too, are the site's, not the page's, and go. A line of an article
goes only if half of the host's pages have it: ordinary sentences stand on several pages of a large
host. Lines that the markup itself names as navigation, adverts and the like go whether
shared or not, and an article whose lines are all shared stays, since it is a copy.
"""

from __future__ import annotations

import os.path
import re
from collections.abc import Iterator
from html import unescape
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from opinara.session import cut_lineage

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*>|</?([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Elements whose content is not markup.
RAW = {"script", "style", "noscript", "template", "textarea", "svg", "math", "iframe", "object", "canvas", "title", "xmp"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
BLOCK = set("""address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre search section summary table
tbody td tfoot th thead tr ul""".split())
#: Elements, words of a class or id, and roles that are never a page's own text.
ASIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "search"}
ASIDE_WORDS = set("""ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent
cookie cookies disqus footer gdpr menu modal nav navbar navigation newsletter notice overlay pagination popup promo
promotion recommended related share sharing sidebar social sponsor sponsored subscribe toolbar widget""".split())
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu"}
SITE, ARTICLE, OPEN = 0, 1, 2
#: Neighbours that share this part of the longer one's text are copies and do not tell text from template.
COPY = 0.8
#: Different pages of a host that must have a line before it counts as the site's (all, if the host has fewer).
COMMON = 3
#: Part of the host's different pages, ``COMMON`` at least, that must have a line before it goes from an article.
ARTICLE_SHARE = 0.5
KEYS = "key long, host string, path string, lines array<long>, sizes array<int>, articles array<boolean>, site array<long>, content long"
PLACES = "array<struct<place:int,line:long,article:boolean>>"
#: Elements whose end tag may be left out, and what the start of an element ends: the open elements,
#: the blocks between that do not matter (None: all), and where the search stops.
OPTIONAL = {"p", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "option"}
_LOOSE, _ROWS = {"address", "div", "p"}, {"tbody", "thead", "tfoot"}
ENDED_BY = {
    "li": [({"li"}, _LOOSE, set())], **dict.fromkeys(("dd", "dt"), [({"dd", "dt"}, _LOOSE, set())]),
    **dict.fromkeys(("td", "th"), [({"td", "th"}, None, {"table", "tr"} | _ROWS)]),
    "tr": [({"td", "th", "tr"}, None, {"table"} | _ROWS)],
    **dict.fromkeys(sorted(_ROWS), [({"td", "th", "tr"} | _ROWS, None, {"table"})]),
    "option": [({"option"}, _LOOSE, {"select"})],
}


def _aside(name: str, raw: str, in_article: bool) -> bool:
    if name in ASIDE or name == "header" and not in_article:
        return True
    if not raw.strip():
        return False
    for m in ATTRIBUTE.finditer(raw):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in ASIDE_ROLES:
            return True
        if key in ("class", "id") and name not in ("body", "html", "main"):
            # an article may be about adverts or cookies, and only a comment is not the page's
            names = {"comment", "comments"} if name == "article" else ASIDE_WORDS
            if not names.isdisjoint(re.split(r"[^a-z0-9]+", value)):
                return True
    return False


def _events(html: str) -> list[tuple[str, str, str, bool]]:
    """Text before each tag, the tag's name and attributes, and whether it is an end tag."""
    events: list[tuple[str, str, str, bool]] = []
    held: list[str] = []
    at, size = 0, len(html)
    while at < size:
        found = TOKEN.search(html, at)
        held.append(html[at:found.start() if found else size])
        if not found:
            break
        at = found.end()
        if found[1] is None:
            continue
        name, raw, ending = found[1].lower(), found[2] or "", html[found.start() + 1] == "/"
        if name in RAW and not ending:
            if not raw.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
                at = end.end() if end else size
            if name != "title":
                continue
        events.append(("".join(held), name, raw, ending))
        held.clear()
    events.append(("".join(held), "", "", False))
    return events


def _walk(events: list[tuple[str, str, str, bool]], unclosed: set[int] | None) -> tuple[list[str], list[int], set[int] | None]:
    """Lines and kinds, and the asides around an article that nobody closed, if there are asides around one.

    An article in one of ``unclosed`` ends that aside; None ends no aside.
    """
    lines: list[str] = []
    kinds: list[int] = []
    held: list[str] = []
    stack: list[list] = []   # open blocks and asides: name, kind (SITE for an aside), number of the tag
    asides = articles = 0
    opened: dict[str, int] = {}
    around: set[int] = set()
    closed: set[int] = set()

    def close() -> None:
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        if text:
            lines.append(text)
            kinds.append(SITE if asides else ARTICLE if articles else OPEN)

    def cut(to: int, by_name: bool) -> None:
        nonlocal asides, articles
        for place in range(len(stack) - 1, to - 1, -1):
            name, kind, number = stack.pop()
            opened[name] -= 1
            asides -= kind == SITE
            articles -= kind == ARTICLE
            if by_name and place == to or name in OPTIONAL:
                closed.add(number)

    def implied(names: set[str], through: set[str] | None, stop: set[str]) -> None:
        """Ends the open elements of ``names`` that the start of another ends."""
        if not any(opened.get(n) for n in names):
            return
        to = None
        for place in range(len(stack) - 1, -1, -1):
            name, kind, _ = stack[place]
            if name in names:
                to = place
            elif kind == ARTICLE or name in stop or through is not None and name in BLOCK and name not in through:
                break
        if to is not None:
            cut(to, False)

    for number, (text, name, raw, ending) in enumerate(events):
        held.append(text)
        if name in BLOCK or name == "title":
            close()
        if not name or name == "title":
            continue
        if ending:
            if opened.get(name):
                for place in range(len(stack) - 1, -1, -1):
                    if stack[place][0] == name:
                        close()
                        cut(place, True)
                        break
                    if stack[place][1] == ARTICLE and name not in ("article", "main"):
                        break  # an end tag too many does not end the article
            continue
        if name in BLOCK and name != "br":
            implied({"p"}, set(), set())
            for group, through, stop in ENDED_BY.get(name, ()):
                implied(group, through, stop)
        if name in VOID or raw.endswith("/") and name not in ASIDE:
            continue
        kind = OPEN
        if _aside(name, raw, bool(articles)):
            close()
            kind = SITE
        elif name in ("article", "main"):
            if asides and not articles:
                here = [e for e in stack if e[1] == SITE]
                around.update(e[2] for e in here)
                if unclosed is not None:
                    for e in here:  # main is the page's own wherever it stands, and a form may hold the whole page
                        if name == "main" or e[0] == "form" or e[2] in unclosed:
                            e[1] = OPEN
                            asides -= 1
            kind = OPEN if asides else ARTICLE
        elif name not in BLOCK and not opened.get(name):
            continue
        stack.append([name, kind, number])
        opened[name] = opened.get(name, 0) + 1
        asides += kind == SITE
        articles += kind == ARTICLE
    close()
    return lines, kinds, around - closed if around else None


def page_lines(html: str) -> tuple[list[str], list[int]]:
    """Lines of a page in order, and whether each is the site's, the article's or open."""
    events = _events(html)
    lines, kinds, unclosed = _walk(events, None)
    if unclosed is not None:
        lines, kinds, _ = _walk(events, unclosed)
        if not any(kinds):  # the aside around the article holds all there is
            lines, kinds, _ = _walk(events, set(range(len(events))))
    return lines, kinds


def line_hashes(lines: list[str]) -> list[int]:
    import xxhash

    return [xxhash.xxh64_intdigest(line) - (1 << 63) for line in lines]


def align(own: list[int], other: list[int]) -> list[tuple[int, int]]:
    """Places in both of a longest common subsequence, by bit vectors over ``own``."""
    # lines that only one page has are no part of it; equal beginnings always are
    both = set(own) & set(other)
    places = [i for i, line in enumerate(own) if line in both]
    others = [j for j, line in enumerate(other) if line in both]
    begin = 0
    while begin < min(len(places), len(others)) and own[places[begin]] == other[others[begin]]:
        begin += 1
    first = list(zip(places[:begin], others[:begin]))
    places, others = places[begin:], others[begin:]
    n = len(places)
    masks: dict[int, int] = {}
    for i, place in enumerate(places):
        masks[own[place]] = masks.get(own[place], 0) | 1 << i
    full, row, rows = (1 << n) - 1, (1 << n) - 1, [(1 << n) - 1]
    for place in others:
        hit = row & masks.get(other[place], 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    # a zero bit i of row j: one more line is common when line i is added
    out, i, j = [], n - 1, len(others)
    while i >= 0 and j > 0:
        if rows[j] >> i & 1:
            i -= 1
        elif not rows[j - 1] >> i & 1:
            j -= 1
        else:
            out.append((places[i], others[j - 1]))
            i, j = i - 1, j - 1
    return first + out[::-1]


def shared_lines(own: list[int], other: list[int]) -> list[int]:
    return [i for i, _ in align(own, other)]


def own_lines(html: str) -> tuple[list[str], list[bool]]:
    """Lines that the markup does not give to the site, and whether each is in an article."""
    kept = [(line, kind == ARTICLE) for line, kind in zip(*page_lines(html)) if kind != SITE]
    return [line for line, _ in kept], [article for _, article in kept]


def text_of(lines: list[str], articles: list[bool], shared: list[int], compared: bool) -> str:
    """``lines`` without those ``shared``, in and outside an article.

    An article all of whose lines are shared is a copy and stays. Of a page not ``compared``
    with another only the article, if it marks one, is known to be its own.
    """
    kept = set(range(len(lines))) - set(shared)
    article = {i for i, inside in enumerate(articles) if inside}
    if article and not compared:
        kept = article
    elif not kept & article:
        kept |= article
    return "\n".join(line for i, line in enumerate(lines) if i in kept)


def main_text(html: str, shared: list[int], compared: bool = False) -> str:
    """Text of a page of whose own lines those at the places ``shared`` are the site's."""
    return text_of(*own_lines(html), shared, compared)


def _split_url(url: str | None) -> tuple[str | None, str | None]:
    try:
        parts = urlsplit(url or "")
        return (parts.netloc.lower() or None, parts.path)
    except ValueError:
        return None, None


def page_keys(rows: DataFrame) -> DataFrame:
    """``key, host, path, lines, sizes, articles, site, content`` of each distinct page: hashes, lengths and
    places of its own lines, hashes of the lines that the markup gives to the site."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = [_split_url(u) for u in batch.column("url").to_pylist()]
            lines, sizes, articles, site, contents = [], [], [], [], []
            for html in batch.column("html").to_pylist():
                texts, kinds = page_lines(html)
                own = [(t, kind == ARTICLE) for t, kind in zip(texts, kinds) if kind != SITE]
                lines.append(line_hashes([t for t, _ in own]))
                sizes.append([len(t) for t, _ in own])
                articles.append([inside for _, inside in own])
                site.append(line_hashes([t for t, kind in zip(texts, kinds) if kind == SITE]))
                contents.append(line_hashes(["\n".join(t for t, _ in own)])[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([u[0] for u in urls], pa.string()),
                 pa.array([u[1] for u in urls], pa.string()), pa.array(lines, pa.list_(pa.int64())),
                 pa.array(sizes, pa.list_(pa.int32())), pa.array(articles, pa.list_(pa.bool_())),
                 pa.array(site, pa.list_(pa.int64())), pa.array(contents, pa.int64())],
                names=["key", "host", "path", "lines", "sizes", "articles", "site", "content"])
    return rows.select("key", "url", "html").mapInArrow(make, KEYS)


def are_copies(sizes: list[int], other: list[int], shared: list[int]) -> bool:
    return sum(sizes[i] for i in shared) >= COPY * max(sum(sizes), sum(other))


def _running(n: str) -> Window:
    return Window.orderBy(n).rowsBetween(Window.unboundedPreceding, -1)  # over one row per part


def _numbered(keys: DataFrame) -> DataFrame:
    """``key, host, path, at``: pages numbered in the order of host and path.

    The order is made by range, numbered inside partitions and shifted by the partitions'
    sizes, so a host of any size is spread; neighbours meet by an equi-join of numbers.
    """
    placed = cut_lineage(keys.filter("host IS NOT NULL").select("key", "host", "path").repartitionByRange("host", "path", "key")
                         .sortWithinPartitions("host", "path", "key").withColumn("at", F.monotonically_increasing_id()))
    placed = placed.withColumns({"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))})
    shifts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(_running("part")), F.lit(0)).alias("shift"))
    return cut_lineage(placed.join(shifts, "part").select("key", "host", "path", (F.col("at") + F.col("shift")).alias("at")))


def _aligned(pairs: DataFrame, keys: DataFrame) -> DataFrame:
    """``key, peer, at, copy, shared, peer_shared`` of pairs ``key, peer, at``: whether they are copies, and
    if not, the lines that they share as they lie in each."""
    own = keys.select("key", "lines", "sizes", "articles")
    both = pairs.join(own, "key").join(own.toDF("peer", "other", "other_sizes", "other_articles"), "peer")
    kind = pa.list_(pa.struct([("place", pa.int32()), ("line", pa.int64()), ("article", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, shared, peer_shared = [], [], []
            for r in batch.select(["lines", "sizes", "articles", "other", "other_sizes", "other_articles"]).to_pylist():
                places = align(r["lines"], r["other"])
                copies.append(are_copies(r["sizes"], r["other_sizes"], [i for i, _ in places]))
                if copies[-1]:
                    places = []
                shared.append([(i, r["lines"][i], r["articles"][i]) for i, _ in places])
                peer_shared.append([(j, r["other"][j], r["other_articles"][j]) for _, j in places])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "peer", "at")), pa.array(copies, pa.bool_()), pa.array(shared, kind), pa.array(peer_shared, kind)],
                names=["key", "peer", "at", "copy", "shared", "peer_shared"])

    return both.mapInArrow(run, f"key long, peer long, at long, copy boolean, shared {PLACES}, peer_shared {PLACES}")


def _neighbours(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The numbered pages and each page aligned with the one before it on its host."""
    numbered = _numbered(keys)
    before = numbered.select((F.col("at") + 1).alias("at"), "host", F.col("key").alias("peer"))
    return numbered, cut_lineage(_aligned(numbered.join(before, ["at", "host"]).select("key", "peer", "at"), keys))


def _runs(numbered: DataFrame, beside: DataFrame) -> DataFrame:
    """``key, host, path, at, run``: neighbours that are copies of each other are one run."""
    found = beside.filter("copy").select("at", F.lit(1).alias("copy"))
    marked = numbered.join(found, "at", "left").select(
        "key", "host", "path", "at", F.shiftright("at", 16).alias("part"), F.when(F.col("copy").isNull(), 1).otherwise(0).alias("begins"))
    marked = cut_lineage(marked.withColumn("run", F.sum("begins").over(
        Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))))
    shifts = marked.groupBy("part").agg(F.sum("begins").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(_running("part")), F.lit(0)).alias("shift"))
    return cut_lineage(marked.join(shifts, "part").select("key", "host", "path", "at", (F.col("run") + F.col("shift")).alias("run")))


def _nearest(runs: DataFrame) -> DataFrame:
    edges = runs.groupBy("run").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    for step, (name, edge) in ((1, ("before", F.col("first"))), (-1, ("behind", F.col("last")))):
        beside = runs.select((F.col("at") + step).alias("edge"), F.col("key").alias(name),
                             F.col("host").alias(f"{name}_host"), F.col("path").alias(f"{name}_path"))
        edges = edges.withColumn("edge", edge).join(beside, "edge", "left").drop("edge")
    both = runs.join(edges.drop("first", "last"), "run")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, peers = [], []
            for r in batch.to_pylist():
                found = [(len(os.path.commonprefix([r["path"], r[f"{s}_path"]])), s == "before", r[s])
                         for s in ("before", "behind") if r[s] is not None and r[f"{s}_host"] == r["host"]]
                if found:
                    keys.append(r["key"])
                    peers.append(max(found)[2])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(peers, pa.int64())], names=["key", "peer"])

    return both.mapInArrow(choose, "key long, peer long")


def nearest(keys: DataFrame) -> DataFrame:
    """``key, peer``: of the next pages before and behind in the order of host and path that
    are no copies, the one with the longer common path."""
    return _nearest(_runs(*_neighbours(keys)))


def common_lines(keys: DataFrame, runs: DataFrame) -> DataFrame:
    """``host, line, everywhere`` of the lines on ``COMMON`` different pages of a host (all, if it has fewer), and
    whether on ``ARTICLE_SHARE`` of them; copies are one page."""
    pages = runs.select("key", "run").join(keys.select("key", "host", "content", "lines", "site"), "key")
    first = pages.groupBy("host", "content").agg(F.min("run").alias("page"))
    pages = pages.join(first, ["host", "content"])
    sizes = pages.groupBy("host").agg(F.count_distinct("page").alias("pages"))
    return pages.select("host", "page", F.explode(F.array_union("lines", "site")).alias("line")).groupBy("host", "line").agg(
        F.count_distinct("page").alias("n")).join(sizes, "host").filter(F.col("n") >= F.least("pages", F.lit(COMMON))).select(
        "host", "line", ((F.col("n") >= COMMON) & (F.col("n") >= ARTICLE_SHARE * F.col("pages"))).alias("everywhere"))


def shared_with_nearest(keys: DataFrame) -> DataFrame:
    """``key, shared``: places of the lines that a page shares with its nearest page and that
    are common on the host. Pages that have no other to compare with have no row.

    Most nearest pages are neighbours, which are aligned already; only pages with copies beside
    them are aligned with another.
    """
    numbered, beside = _neighbours(keys)
    runs = _runs(numbered, beside)
    pairs = cut_lineage(_nearest(runs))
    near = beside.filter("NOT copy")
    known = near.select("key", "peer", "shared").unionByName(near.select(
        F.col("peer").alias("key"), F.col("key").alias("peer"), F.col("peer_shared").alias("shared")))
    apart = pairs.join(known.select("key", "peer"), ["key", "peer"], "left_anti").withColumn("at", F.lit(0).cast("long"))
    aligned = pairs.join(known, ["key", "peer"]).select("key", "shared").unionByName(
        _aligned(apart, keys).filter("NOT copy").select("key", "shared"))
    places = aligned.join(runs.select("key", "host"), "key").select("key", "host", F.explode_outer("shared").alias("s")).select(
        "key", "host", "s.place", "s.line", "s.article")
    goes = F.col("everywhere").isNotNull() & (F.col("everywhere") | ~F.col("article"))
    return places.join(common_lines(keys, runs), ["host", "line"], "left").groupBy("key").agg(
        F.collect_list(F.when(goes, F.col("place"))).alias("shared"))


def _packed(rows: DataFrame, kind: str) -> DataFrame:
    """``key, page_id, url, lines``: the own lines of each row, compressed page by page, so that no html is shuffled."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pressed = zstandard.ZstdCompressor(level=6)
        for batch in batches:
            packed = []
            for html in batch.column("html").to_pylist():
                lines, articles = own_lines(html)
                packed.append(pressed.compress("\n".join("OA"[a] + line for line, a in zip(lines, articles)).encode("utf-8", "surrogatepass")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "page_id", "url")), pa.array(packed, pa.binary())],
                                             names=["key", "page_id", "url", "lines"])
    return rows.select("key", "page_id", "url", "html").mapInArrow(pack, f"key long, page_id {kind}, url string, lines binary")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars`` (code points of the text).

    References are decoded, white space inside a block becomes one space, blocks are joined
    by a line feed in page order; the whole page is read. Null html counts as empty and gives
    an empty text. A page without a URL or alone on its host, but for copies, is compared with no other.
    Repeated rows count as one page in the comparison and give the same text. Other columns
    are ignored whatever their names. No rows, no result.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html")).withColumn(
        "key", F.xxhash64(F.coalesce(F.col("page_id").cast("string"), F.lit("")), "url", "html"))
    keys = cut_lineage(page_keys(rows).dropDuplicates(["key"]))
    shared = shared_with_nearest(keys)

    kind = rows.schema["page_id"].dataType.simpleString()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        plain = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = []
            for packed, shared in zip(batch.column("lines").to_pylist(), batch.column("shared").to_pylist()):
                # lines hold no white space but single spaces
                lines = [line for line in plain.decompress(packed).decode("utf-8", "surrogatepass").split("\n") if line]
                texts.append(text_of([line[1:] for line in lines], [line[0] == "A" for line in lines], shared or [], shared is not None))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return _packed(rows, kind).join(shared, "key", "left").select("page_id", "url", "lines", "shared").mapInArrow(
        extract, f"page_id {kind}, url string, text string, n_chars long")

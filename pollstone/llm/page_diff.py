"""Main text by nearest-URL page differencing.

Pages of a host whose URL paths lie next to each other share a template. Each
page's text lines are aligned with its nearest neighbour's by a longest common
subsequence, and the shared lines go: they are the template's. What the markup
itself declares is respected: menus, forms and the like never count as text,
and lines inside a declared article are the page's own even if a neighbour
quotes the same passage. Lines outside of it stay if the neighbour lacks them;
without a neighbour to ask, they go where an article is declared.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pollstone.llm.common import frames, stored
from pollstone.llm.list_join import host_of, path_of

#: A neighbour that shares this part of a page's lines is a copy of it and says nothing about the template.
COPY = 0.8

# Fixed: elements by what they mean for a page's text.
_UNSEEN = "script style noscript template svg math canvas iframe object textarea select title".split()
_CHROME = set("nav aside form menu dialog button fieldset".split())
_EDGES = set("header footer".split())  # those of the page; an article's own header is part of it
_BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_ROLES = set("navigation banner contentinfo complementary search dialog alert menu menubar".split())
_NAMES = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent gdpr notice "
    "comment comments respond sidebar share sharing social related recommended breadcrumb breadcrumbs newsletter popup "
    "modal menu navbar navigation pagination".split()
)
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{'|'.join(_UNSEEN)})\b[^>]*>.*?(?:</(?P=raw)\s*>|(?=<body\b)|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)

ARTICLE, PLAIN, DROPPED = 0, 1, 2


def _kind(name: str, rest: str, inside: int) -> int:
    """What an element makes of the text in it, inside text of another kind."""
    if inside == DROPPED or name in _CHROME:
        return DROPPED
    if name in _EDGES and inside != ARTICLE:
        return DROPPED
    if "=" in rest:
        for what, *values in _MARK.findall(rest):
            words = re.split(r"[\s_-]+", "".join(values).lower())
            if what.lower() == "role" and words[0] == "main":
                return ARTICLE
            if any(w in (_ROLES if what.lower() == "role" else _NAMES) for w in words) and name not in ("body", "html", "article", "main"):
                return DROPPED
    return ARTICLE if name in ("article", "main") else inside


def lines(page: str | None) -> list[tuple[int, str]]:
    """The text blocks of a page in order, each with its kind; white space is one blank, references are decoded."""
    page = page or ""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    held: list[str] = []
    kind, at = PLAIN, 0

    def flush() -> None:
        text = " ".join("".join(held).split())
        if text:
            out.append((kind, text))
        held.clear()

    for tag in _TAG.finditer(page):
        if tag.start() > at:
            held.append(html.unescape(page[at : tag.start()]))
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            held.append(" ")
        if name in _BLOCKS:
            flush()
        if name in _VOID or (name not in _BLOCKS and "=" not in tag["rest"] and not tag["close"]):
            continue
        if tag["close"]:
            if any(n == name for n, _ in stack):
                while stack.pop()[0] != name:
                    pass
                after = stack[-1][1] if stack else PLAIN
                if after != kind:
                    flush()
                kind = after
            continue
        if name in _BLOCKS and stack and stack[-1][0] == "p":
            stack.pop()  # a paragraph ends where the next block begins
            kind = stack[-1][1] if stack else PLAIN
        following = _kind(name, tag["rest"], kind)
        if following != kind:
            flush()
        stack.append((name, following))
        kind = following
    if at < len(page):
        held.append(html.unescape(page[at:]))
    flush()
    return out


def common(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence of both; memory is linear in the longer."""
    low, high = 0, 0
    while low < len(a) and low < len(b) and a[low] == b[low]:
        low += 1
    while high < len(a) - low and high < len(b) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    inner_a, inner_b = a[low : len(a) - high], b[low : len(b) - high]
    shared = set(inner_a) & set(inner_b)
    places = [k for k, x in enumerate(inner_a) if x in shared]
    found = _aligned([inner_a[k] for k in places], [x for x in inner_b if x in shared])
    return [*range(low), *(low + places[k] for k in found), *range(len(a) - high, len(a))]


def _aligned(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) == 1:
        return [0] if a[0] in b else []
    middle = len(a) // 2
    ahead, back = _lengths(a[:middle], b), _lengths(a[middle:][::-1], b[::-1])[::-1]
    cut = int(np.argmax(ahead + back))
    return _aligned(a[:middle], b[:cut]) + [middle + k for k in _aligned(a[middle:], b[cut:])]


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each prefix of ``b``, all of b's places in the bits of a number."""
    places: dict[int, int] = {}
    for k, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer((~row & full).to_bytes(-(-len(b) // 8), "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate(([0], np.cumsum(bits)))


def digests(texts: list[str]) -> list[int]:
    return np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t in texts], np.uint64).view(np.int64).tolist()


def main_text(kinds: list[int], texts: list[str], neighbours: list[list[int]]) -> str:
    """Blocks that aren't the template's, joined by blank lines; the nearest neighbour that isn't a copy decides."""
    own, shared = digests(texts), None
    for other in neighbours:
        found = common(own, other)
        if len(found) < COPY * len(own):
            shared = set(found)
            break
    if shared is None:  # no page to differ from: only the markup decides
        shared = set(range(len(own))) if ARTICLE in kinds else set()
    kept = [t for k, (kind, t) in enumerate(zip(kinds, texts, strict=True)) if kind == ARTICLE or kind == PLAIN and k not in shared]
    return "\n\n".join(kept)


def neighbours(keys: DataFrame) -> DataFrame:
    """``(unit, others)``: for each unit of ``keys (unit, host, path)`` its neighbours on the host, the nearest first.

    Order is by host, path and unit over the whole table, so it doesn't depend
    on how the rows are spread. Slices of that order are looked at apart, and
    only their first and last rows, two a slice, are held against each other.
    """
    order = ["host", "path", "unit"]
    slices = stored(keys.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()), "slices")
    inside = Window.partitionBy("slice").orderBy(*order)
    row = F.struct(*order)
    sided = slices.select(*order, "slice", F.lag(row).over(inside).alias("before"), F.lead(row).over(inside).alias("after"))
    edges = slices.groupBy("slice").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    over = Window.orderBy("slice")
    edges = edges.select("slice", F.lag("last").over(over).alias("left"), F.lead("first").over(over).alias("right"))
    joined = sided.join(F.broadcast(edges), "slice")  # one row a slice
    both = joined.select(*order, F.coalesce("before", "left").alias("before"), F.coalesce("after", "right").alias("after"))

    def near(side: str) -> str:
        # How many path parts agree from the start on: the place of the first that doesn't, or all.
        same = f"zip_with(split(path, '/'), split({side}.path, '/'), (x, y) -> x <=> y)"
        return (
            f"CASE WHEN {side}.host = host THEN named_struct('parts', CASE array_position({same}, false) WHEN 0 THEN size({same})"
            f" ELSE int(array_position({same}, false)) - 1 END, 'unit', {side}.unit) END"
        )

    found = both.select("unit", F.expr(near("before")).alias("b"), F.expr(near("after")).alias("a"))
    nearest = F.expr("filter(CASE WHEN a.parts > b.parts THEN array(a, b) ELSE array(b, a) END, x -> x IS NOT NULL)")
    return found.select("unit", F.transform(nearest, lambda x: x["unit"]).alias("others"))


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)``: the main text of each row of ``pages``.

    A null page is empty, and so is its text. A page without a URL or whose
    host has no other page has no neighbour, and only its markup decides.
    Repeated rows come out as often as they come in and are no one's
    neighbours but once; no rows give none, and other columns play no part.
    """
    text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", "url", text.alias("html")).withColumn("unit", F.xxhash64("page_id", "url", "html"))
    rows = rows.select("page_id", "url", "unit", "html")

    def digest(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames(stream):
            found = [digests([t for _, t in lines(page)]) for page in frame["html"]]
            columns = [pa.array(frame["unit"], pa.int64()), pa.array(frame["url"], pa.string(), from_pandas=True), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["unit", "url", "lines"])

    def split(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            found = [lines(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    batch.column("unit"),
                    pa.array([[k for k, _ in some] for some in found], pa.list_(pa.int8())),
                    pa.array([[t for _, t in some] for some in found], pa.list_(pa.string())),
                ],
                names=["page_id", "url", "unit", "kinds", "texts"],
            )

    def choose(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            columns = [batch.column(n).to_pylist() for n in ("kinds", "texts", "others")]
            found = [main_text(k, t, o or []) for k, t, o in zip(*columns, strict=True)]
            sizes = pa.array([len(t) for t in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.select("page_id", "url").schema.fields}
    named = f"page_id {kinds['page_id']}, url {kinds['url']}"
    marked = rows.select("unit", "url", "html").mapInArrow(digest, "unit long, url string, lines array<long>")
    known = stored(marked.dropDuplicates(["unit"]).withColumns({"host": host_of("url"), "path": path_of("url")}), "lines")
    pairs = neighbours(known.where("host <> ''").select("unit", "host", "path"))
    asked = pairs.select("unit", F.posexplode("others").alias("rank", "other"))
    answers = (
        asked.join(known.select(F.col("unit").alias("other"), "lines"), "other")
        .groupBy("unit")
        .agg(F.expr("transform(array_sort(collect_list(struct(rank, lines))), x -> x.lines)").alias("others"))
    )
    blocks = rows.mapInArrow(split, f"{named}, unit long, kinds array<tinyint>, texts array<string>")
    joined = blocks.join(answers, "unit", "left").select("page_id", "url", "kinds", "texts", "others")
    return joined.mapInArrow(choose, f"{named}, text string, n_chars long")

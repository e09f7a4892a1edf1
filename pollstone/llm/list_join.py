"""URL filtering by dated lists: every capture is judged by the entries active on the day it was fetched.

Entries are dated: an address is added to or removed from a list on a day.
Per address, each change holds until the next, which gives validity intervals
that don't overlap. Captures are joined to the intervals as of their day, on
all addresses that cover their URL. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days in a block. Intervals and captures meet by address and block, so a long history isn't searched through.
BLOCK = 64
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: str) -> Column:
    return F.lower(F.regexp_extract(url, _HOST, 1))


def path_of(url: str) -> Column:
    return F.regexp_replace(F.regexp_extract(url, _PATH, 1), "/+$", "")


def intervals(entries: DataFrame) -> DataFrame:
    """``(kind, pattern, listing, from_day, to_day)`` from ``(kind, pattern, listing, action, listed_on)``.

    ``kind`` is host, domain (the host and all below it) or prefix (a host and
    the first parts of a path). ``listing`` is block or allow. An ``add`` holds
    from its day until the address's next change on that list; a ``remove``
    only ends what held. Of changes on one day the removal counts. There is one
    change a day at most, so an address's history is bounded by its days.
    Entries with a null count for nothing, and neither do repeated ones.
    """
    known = entries.where("action IN ('add', 'remove') AND listing IN ('block', 'allow')").dropna(
        subset=["kind", "pattern", "listed_on"]
    )
    days = known.groupBy("kind", F.lower("pattern").alias("pattern"), "listing", F.col("listed_on").cast("date").alias("from_day"))
    changes = days.agg(F.max("action").alias("action"))
    until = F.expr("lead(from_day) OVER (PARTITION BY kind, pattern, listing ORDER BY from_day)")
    held = changes.withColumn("to_day", until).where("action = 'add'")
    return held.select("kind", "pattern", "listing", "from_day", "to_day")


def _addresses(url: str) -> Column:
    """Every address that covers a URL, as structs of kind and pattern; the widest domain has two labels."""
    return F.expr(
        """CASE WHEN host <> '' THEN concat(
             array(named_struct('kind', 'host', 'pattern', host)),
             transform(filter(sequence(1, size(labels)), i -> size(labels) - i >= 1),
               i -> named_struct('kind', 'domain', 'pattern', array_join(slice(labels, i, size(labels)), '.'))),
             transform(filter(sequence(1, size(segments)), i -> i > 1),
               i -> named_struct('kind', 'prefix', 'pattern', lower(concat(host, array_join(slice(segments, 1, i), '/'))))))
           END"""
    )


def verdicts(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """``captures`` with ``verdict``, ``pattern`` and ``n_active``.

    Of the entries active on the capture's day the most specific decides: a
    prefix over a host over a domain, then the longer pattern, then allow over
    block. ``n_active`` counts them all. No active entry, no host or a null:
    verdict ``none``, a null pattern, zero. Each row of ``captures`` comes out
    once, with its columns; columns of those three names are replaced.

    Equal URLs of a day are judged once. A host with a third of all captures is
    joined by address and block of days, whose larger side adaptive execution
    splits.
    """
    taken = [c for c in captures.columns if c not in ("verdict", "pattern", "n_active")]
    rows = captures.select(*taken, F.col(url).cast("string").alias("_url"), F.col(fetched).cast("date").alias("_day"))
    span = intervals(entries)
    asked = rows.select("_url", "_day").where("_url IS NOT NULL AND _day IS NOT NULL").distinct()
    latest = asked.agg(F.max("_day")).first()[0]
    day = "datediff({}, DATE'1970-01-01')"
    blocks = span.withColumn("last", F.least(F.coalesce("to_day", F.lit(latest)), F.lit(latest)) if latest else F.col("from_day"))
    blocks = blocks.where("from_day <= last").withColumn(
        "block", F.expr(f"explode(sequence({day.format('from_day')} DIV {BLOCK}, {day.format('last')} DIV {BLOCK}))")
    )
    asked = asked.withColumn("host", host_of("_url")).withColumn("path", path_of("_url"))
    asked = asked.withColumns({"labels": F.split("host", r"\."), "segments": F.split("path", "/")})
    probes = (
        asked.withColumn("address", F.explode(_addresses("_url")))
        .select("_url", "_day", "address.*", F.expr(f"{day.format('_day')} DIV {BLOCK}").alias("block"))
    )
    met = probes.join(blocks, ["kind", "pattern", "block"]).where("from_day <= _day AND (to_day IS NULL OR _day < to_day)")
    rank = F.expr("CASE kind WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END")
    best = F.max(F.struct(rank.alias("rank"), F.length("pattern").alias("size"), (F.col("listing") == "allow").alias("allowed"), "pattern"))
    judged = met.groupBy("_url", "_day").agg(best.alias("best"), F.count("*").alias("n"))
    verdict = F.expr("CASE WHEN best IS NULL THEN 'none' WHEN best.allowed THEN 'allow' ELSE 'block' END")
    return rows.join(judged, ["_url", "_day"], "left").select(
        *taken, verdict.alias("verdict"), F.col("best.pattern").alias("pattern"), F.coalesce("n", F.lit(0)).cast("long").alias("n_active")
    )


# Captures and lists from the table of pages, which has neither dates nor lists

_FIRST_DAY, _DAYS = "2022-01-01", 1096


def _number(text: str) -> str:
    """SQL that both engines read: a number up to 2^32 from a text."""
    return f"substr(md5({text}), 1, 8)"


def captures_of(pages: DataFrame) -> DataFrame:
    """``(page_id, url, fetched_on)``: a day drawn from the page's id."""
    drawn = F.conv(F.expr(_number("concat('day:', page_id)")), 16, 10).cast("long") % _DAYS
    return pages.select("page_id", "url", F.date_add(F.lit(_FIRST_DAY).cast("date"), drawn.cast("int")).alias("fetched_on"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Four dated entries for each host, two for its parent domain and two for its first path part."""
    hosts = pages.select(host_of("url").alias("host"), F.split(path_of("url"), "/").alias("segments")).where("host <> ''")
    addresses = hosts.select(
        F.explode(
            F.expr(
                """array(named_struct('kind', 'host', 'pattern', host, 'n', 4),
                         named_struct('kind', 'domain', 'pattern', regexp_replace(host, '^[^.]*[.]', ''), 'n', 2),
                         named_struct('kind', 'prefix', 'pattern', concat(host, '/', coalesce(get(segments, 1), '')), 'n', 2))"""
            )
        ).alias("a")
    ).select("a.*").distinct()
    drawn = addresses.withColumn("k", F.expr("explode(sequence(1, n))")).withColumn(
        "drawn", F.conv(F.expr(_number("concat(kind, ':', pattern, ':', k)")), 16, 10).cast("long")
    )
    return drawn.select(
        "kind",
        "pattern",
        F.expr("CASE WHEN drawn % 7 < 4 THEN 'block' ELSE 'allow' END").alias("listing"),
        F.expr("CASE WHEN drawn % 5 < 3 THEN 'add' ELSE 'remove' END").alias("action"),
        F.date_add(F.lit(_FIRST_DAY).cast("date"), (F.col("drawn") % _DAYS).cast("int")).alias("listed_on"),
    )


ORACLE = rf"""
WITH p AS (
  SELECT page_id, url, lower(regexp_extract(url, '{_HOST}', 1)) AS host,
    string_split(regexp_replace(regexp_extract(url, '{_PATH}', 1), '/+$', ''), '/') AS segments,
    DATE '{_FIRST_DAY}' + (('0x' || {_number("'day:' || page_id")})::BIGINT % {_DAYS})::INT AS fetched_on
  FROM pages
), a AS (
  SELECT DISTINCT unnest([
    {{'kind': 'host', 'pattern': host, 'n': 4}},
    {{'kind': 'domain', 'pattern': regexp_replace(host, '^[^.]*[.]', ''), 'n': 2}},
    {{'kind': 'prefix', 'pattern': host || '/' || coalesce(segments[2], ''), 'n': 2}}]) AS s
  FROM p WHERE host <> ''
), d AS (
  SELECT s.kind AS kind, s.pattern AS pattern, ('0x' || {_number("s.kind || ':' || s.pattern || ':' || k")})::BIGINT AS drawn
  FROM a, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE k <= s.n
), e AS (
  SELECT kind, lower(pattern) AS pattern, CASE WHEN drawn % 7 < 4 THEN 'block' ELSE 'allow' END AS listing,
    CASE WHEN drawn % 5 < 3 THEN 'add' ELSE 'remove' END AS action, DATE '{_FIRST_DAY}' + (drawn % {_DAYS})::INT AS from_day
  FROM d
), c AS (
  SELECT kind, pattern, listing, from_day, max(action) AS action FROM e GROUP BY ALL
), v AS (
  SELECT *, lead(from_day) OVER (PARTITION BY kind, pattern, listing ORDER BY from_day) AS to_day FROM c
), m AS (
  SELECT p.page_id, p.url, p.fetched_on, v.*,
    row_number() OVER (PARTITION BY p.page_id, p.url ORDER BY
      CASE kind WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END DESC, length(pattern) DESC, listing = 'allow' DESC, pattern DESC) AS r,
    count(*) OVER (PARTITION BY p.page_id, p.url) AS n
  FROM p JOIN v ON action = 'add' AND from_day <= fetched_on AND (to_day IS NULL OR fetched_on < to_day) AND p.host <> '' AND (
    kind = 'host' AND pattern = p.host
    OR kind = 'domain' AND (pattern = p.host OR ends_with(p.host, '.' || pattern)) AND contains(pattern, '.')
    OR kind = 'prefix' AND starts_with(lower(p.host || array_to_string(p.segments, '/')) || '/', pattern || '/'))
)
SELECT p.page_id, p.url, p.fetched_on, CASE WHEN m.r IS NULL THEN 'none' ELSE m.listing END AS verdict, m.pattern AS pattern,
  coalesce(m.n, 0)::BIGINT AS n_active
FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.url = p.url AND m.r = 1
"""

"""A Merkle manifest of a dataset: records of digest to children, and proofs found by descending them.

Rows are leaves, in order within their group; runs of two become their hash
until one node is left, the group's subroot, and the subroots become the root
in the same way. Levels are built in segments of ``DEPTH`` levels: a task gets
the nodes under one node ``DEPTH`` levels up, at most two to the power of
``DEPTH``, and writes a record for each node it makes.

A proof is found from the root down. A request descends by the binary digits
of its rank, takes the child of each digit and collects the other one. Requests
that agree on their leading digits descend together: the path to the top of a
segment is found once and handed to the segments below, and the path of a leaf
is the reversed sequence of its segments' paths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pollstone.llm.common import parts, stored

DEPTH = 9
#: Equal leaves that one task numbers at a time.
COPIES = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows are grouped by language; no language comes first, then by UTF-8 bytes.
TOP = "root"


def field_bytes(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field_bytes, values)).cast("binary"), 256)


def digest(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


# Ranks


def ranked(leaves: DataFrame) -> DataFrame:
    """``(grp, at, leaf, ...)`` with ``idx``, the rank by ``at`` and ``leaf`` within the group, and ``n``, how many it has.

    Rows are dealt by ranges of (group, place), counted for each range, and
    numbered within it, so a large group is many ranges. Rows that are equal
    are counted first and numbered in blocks. More columns must follow from
    the leaf.
    """
    spark, columns = leaves.sparkSession, leaves.columns
    counted = leaves.groupBy(*columns).agg(F.count("*").alias("copies"))
    dealt = counted.repartitionByRange(parts(spark), "grp", "at", "leaf").withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "leaves")
    sums = dealt.groupBy("grp", "part").agg(F.sum("copies").alias("rows"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "grp", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"), F.sum("rows").over(Window.partitionBy("grp")).alias("n")
    )
    within = Window.partitionBy("grp", "part").orderBy("at", "leaf").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("idx", F.coalesce(F.sum("copies").over(within), F.lit(0))).join(offsets, ["grp", "part"])
    placed = placed.withColumn("idx", F.col("idx") + F.col("offset")).select(*columns, "idx", "n", "copies")
    blocks = placed.where("copies > 1").withColumn("block", F.expr(f"explode(sequence(0L, (copies - 1) DIV {COPIES}))"))
    spread = blocks.repartition(parts(spark), "grp", "idx", "block")
    several = spread.withColumn("k", F.expr(f"explode(sequence(block * {COPIES}, least(copies, (block + 1) * {COPIES}) - 1))"))
    single = placed.where("copies = 1").select(*columns, "idx", "n")
    return single.unionByName(several.select(*columns, (F.col("idx") + F.col("k")).alias("idx"), "n"))


def _height() -> Column:
    """Levels above the leaves of a group of ``n``: the smallest h with two to the power of h not below n."""
    return F.expr("CASE WHEN n <= 1 THEN 0 ELSE length(bin(n - 1)) END").cast("int")


# Building

NODES = "grp string, stage int, segment long, level int, idx long, digest string, children array<string>"


def build(leaves: DataFrame) -> tuple[DataFrame, int]:
    """The records of all inner nodes of ranked leaves ``(grp, idx, leaf, n)``, and how many stages of segments there are.

    A record has the digest of a node and those of its children, with the
    node's group, level and index there; ``segment`` is the index of the node
    that tops its segment. A group of one leaf has no records.
    """

    def rise(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group["idx"].to_pylist(), group["digest"].to_pylist(), strict=True))
        grp, stage, height, segment = (group[name][0].as_py() for name in ("grp", "stage", "height", "segment"))
        first, now = rows[0][0], [d for _, d in rows]
        out: dict[str, list] = {"level": [], "idx": [], "digest": [], "children": []}
        for level in range(stage * DEPTH + 1, min((stage + 1) * DEPTH, height) + 1):
            runs = [now[k : k + 2] for k in range(0, len(now), 2)]
            first, now = first >> 1, [digest(run) for run in runs]
            out["level"] += [level] * len(now)
            out["idx"] += range(first, first + len(now))
            out["digest"] += now
            out["children"] += runs
        count = len(out["level"])
        return pa.table(
            {
                "grp": pa.array([grp] * count, pa.string()),
                "stage": pa.array([stage] * count, pa.int32()),
                "segment": pa.array([segment] * count, pa.int64()),
                "level": pa.array(out["level"], pa.int32()),
                "idx": pa.array(out["idx"], pa.int64()),
                "digest": pa.array(out["digest"], pa.string()),
                "children": pa.array(out["children"], pa.list_(pa.string())),
            }
        )

    tall = leaves.where("n > 1").select("grp", "idx", F.col("leaf").alias("digest"), _height().alias("height"))
    highest = tall.agg(F.max("height")).first()[0] or 0
    found, stage, records = [], 0, None
    while stage * DEPTH < highest:
        held = tall.withColumn("stage", F.lit(stage)).withColumn("segment", F.shiftright("idx", DEPTH))
        found.append(stored(held.groupBy("grp", "segment").applyInArrow(rise, NODES), "records"))
        stage += 1
        tops = found[-1].where(F.col("level") == stage * DEPTH).select("grp", "idx", "digest")
        heights = leaves.where((F.col("idx") == 0) & (F.col("n") > 1)).select("grp", _height().alias("height"))
        tall = tops.join(heights.where(F.col("height") > stage * DEPTH), "grp")
    for part in found:
        records = part if records is None else records.unionByName(part)
    if records is None:
        records = leaves.sparkSession.createDataFrame([], NODES)
    return records, stage


# Descending


def _descend(rows: list[dict], bottom: int) -> Iterator[tuple[int, list[str], str]]:
    """From the top of a segment down to level ``bottom``: the index of each node there, its path from the root and its digest.

    A path has one step a level: "L" or "R" and the digest of the sibling on
    that side, or "" where a run had no other.
    """
    children = {(r["level"], r["digest"]): r["children"] for r in rows if r["level"] >= 0}
    (top,) = [r for r in rows if r["level"] < 0]
    height = max(level for level, _ in children)
    now = [(top["idx"], top["children"], top["digest"])]
    for level in range(height, bottom, -1):
        below = []
        for idx, path, name in now:
            run = children[level, name]
            for digit, child in enumerate(run):
                step = "" if len(run) == 1 else f"R{run[1]}" if digit == 0 else f"L{run[0]}"
                below.append((2 * idx + digit, [*path, step], child))
        now = below
    yield from now


def _paths_at(bottom: int) -> Callable[[pa.Table], pa.Table]:
    """Of a segment's records and its top: the paths to the tops of the segments below."""

    def below(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        found = list(_descend(rows, bottom)) if any(r["level"] < 0 for r in rows) else []
        idx, path, name = zip(*found, strict=True) if found else ((), (), ())
        return pa.table(
            {
                "grp": pa.array([rows[0]["grp"]] * len(idx), pa.string()),
                "idx": pa.array(idx, pa.int64()),
                "children": pa.array(path, pa.list_(pa.string())),
                "digest": pa.array(name, pa.string()),
            }
        )

    return below


def descend(records: DataFrame, stages: int, tops: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests (grp, idx, ...)`` with the ``proof`` of each: the siblings on its path, from the leaf to the root.

    ``tops`` has ``(grp, subroot, path)``, the path from the root of all to each
    group's subroot. Only segments with a request below them are visited.
    """
    others = [f for f in requests.schema.fields if f.name not in ("grp", "idx")]
    request = F.struct(F.col("idx"), *[F.col(f.name) for f in others])

    above = tops.select("grp", F.lit(0).cast("long").alias("idx"), F.col("path").alias("children"), F.col("subroot").alias("digest"))
    where = requests.select("grp", "idx")
    done: list[DataFrame] = []
    # Groups are of different heights: each enters at the stage of its own top.
    entry = records.groupBy("grp").agg(F.max("stage").alias("entry"))
    entered = above.join(entry, "grp", "left").withColumn("entry", F.coalesce("entry", F.lit(-1)))
    carried = None
    for stage in reversed(range(stages)):
        tops_here = entered.where(F.col("entry") == stage).select("grp", "idx", "children", "digest")
        if carried is not None:
            tops_here = tops_here.unionByName(carried)
        asked = where.select("grp", F.shiftright("idx", (stage + 1) * DEPTH).alias("idx")).distinct()
        tops_here = tops_here.join(asked, ["grp", "idx"], "left_semi").withColumn("segment", F.col("idx"))
        nodes = records.where(F.col("stage") == stage).select("grp", "segment", "level", "idx", "digest", "children")
        segment = nodes.unionByName(tops_here.withColumn("level", F.lit(-1)))
        if stage:
            shape = "grp string, idx long, children array<string>, digest string"
            carried = stored(segment.groupBy("grp", "segment").applyInArrow(_paths_at(stage * DEPTH), shape), "paths")
            continue

        def last(asked: pa.Table, group: pa.Table) -> pa.Table:
            rows = group.to_pylist()
            paths = {idx: path[::-1] for idx, path, _ in _descend(rows, 0)} if asked.num_rows and rows else {}
            wanted = asked["request"].combine_chunks()
            proofs = pa.array([paths[i] for i in wanted.field("idx").to_pylist()], pa.list_(pa.string()))
            return pa.table({"grp": asked["grp"], "request": wanted, "proof": proofs})

        held = requests.select("grp", F.shiftright("idx", DEPTH).alias("segment"), request.alias("request"))
        lone = entered.where("entry = -1").select("grp")
        met = held.join(lone, "grp", "left_anti").groupBy("grp", "segment").cogroup(segment.groupBy("grp", "segment"))
        kind = held.schema["request"].dataType.simpleString()
        done.append(met.applyInArrow(last, f"grp string, request {kind}, proof array<string>").select("grp", "request.*", "proof"))
    # A group of one leaf has no records: its leaf is the subroot.
    lone = entered.where("entry = -1").select("grp", F.reverse("children").alias("proof"))
    alone = requests.join(lone, "grp")
    columns = ["grp", "idx", *[f.name for f in others], "proof"]
    out = alone.select(columns)
    for frame in done:
        out = out.unionByName(frame.select(columns))
    return out


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def step(now: Column, sibling: Column) -> Column:
        other = F.substring(sibling, 2, 64)
        both = F.when(sibling == "", now).when(F.startswith(sibling, F.lit("L")), F.concat(other, now)).otherwise(F.concat(now, other))
        return F.sha2(both.cast("binary"), 256)

    return F.aggregate(proof, leaf, step)


# The manifest


def subroots(leaves: DataFrame, records: DataFrame) -> DataFrame:
    """``(grp, subroot)`` for each group of ranked leaves."""
    tops = records.groupBy("grp").agg(F.max_by("digest", "level").alias("subroot"))
    lone = leaves.where("n = 1").select("grp", F.col("leaf").alias("subroot"))
    return tops.unionByName(lone)


def manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """``(doc_id, lang, leaf, tampered, subroot, root, proof)`` for each row of ``docs``.

    Leaves hash ``doc_id``, ``source``, ``lang``, ``n_chars`` and ``text``.
    ``changed``, a condition, says which rows are tampered with after the
    manifest is made: their ``n_chars`` grows by one, and ``tampered`` is the
    leaf that this gives (else null; a null ``n_chars`` stays, and so does the
    leaf). ``proof`` lists the siblings from the leaf to the root, each with
    its side, "" where there is none. In a language rows ascend by ``doc_id``
    (null first), then by leaf; rows repeated whole are leaves of their own. A
    language of one row is its own subroot, and with one language the subroot
    is the root. No rows, no result. Other columns play no part.
    """
    fields = {name: F.col(name) for name in FIELDS}
    tampered = leaf_digest(*{**fields, "n_chars": F.col("n_chars") + 1}.values())
    grp = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    hashed = docs.select(
        grp.alias("grp"),
        F.col("doc_id").cast("long").alias("at"),
        leaf_digest(*fields.values()).alias("leaf"),
        (F.lit(None).cast("string") if changed is None else F.when(changed, tampered)).alias("tampered"),
    )
    leaves = stored(ranked(hashed), "ranked")
    records, stages = build(leaves)
    tops = stored(subroots(leaves, records), "subroots")

    # The tree over the groups is of the same kind, with one group.
    upper = stored(ranked(tops.select(F.lit(TOP).alias("grp"), F.col("grp").alias("at"), F.col("subroot").alias("leaf"))), "ranked")
    upper_records, upper_stages = build(upper)
    root = subroots(upper, upper_records).withColumnRenamed("subroot", "root")
    start = root.select("grp", F.col("root").alias("subroot"), F.array().cast("array<string>").alias("path"))
    paths = descend(upper_records, upper_stages, start, upper.select("grp", "idx", F.col("at").alias("name"), F.col("leaf").alias("subroot")))
    paths = stored(paths.join(root, "grp").select(F.col("name").alias("grp"), "subroot", F.reverse("proof").alias("path"), "root"), "tops")

    requests = leaves.select("grp", "idx", "at", "leaf", "tampered").join(paths.select("grp", "subroot", "root"), "grp")
    found = descend(records, stages, paths.select("grp", "subroot", "path"), requests)
    lang = F.expr("CASE WHEN grp <> '' THEN substr(grp, 2) END")
    return found.select(F.col("at").alias("doc_id"), lang.alias("lang"), "leaf", "tampered", "subroot", "root", "proof")


def audit(docs: DataFrame) -> DataFrame:
    """Proofs of all rows, checked after every row with 7 dividing the crc32 of its decimal ``doc_id`` is tampered with."""
    changed = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 7 == 0
    found = manifest(docs, changed)
    siblings = F.array_join(F.transform("proof", lambda s: F.substring(s, 2, 64)), "")
    folded = found.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


ORACLE = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents
), hashed AS (
  SELECT doc_id, lang,
    sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS tampered
  FROM fields
), places AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM hashed
), tree AS (
  SELECT lang, 0 AS level, idx::BIGINT AS idx, n::BIGINT AS n, leaf AS digest FROM places
  UNION ALL
  SELECT lang, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM tree WHERE n > 1 GROUP BY lang, level, idx // 2, n
), subroots AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM tree WHERE n = 1
), upper_ AS (
  SELECT 0 AS level, idx::BIGINT AS idx, n::BIGINT AS n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM upper_ WHERE n > 1 GROUP BY level, idx // 2, n
), wanted AS (
  SELECT p.*, s.subroot, s.idx AS place, CASE WHEN xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END
    )) % 7 = 0 THEN tampered ELSE leaf END AS given, row_number() OVER () AS r
  FROM places p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
), walked AS (
  SELECT r, lang, place, false AS above, 0 AS level, idx::BIGINT AS idx, given AS digest, '' AS siblings FROM wanted
  UNION ALL
  SELECT w.r, w.lang, w.place, CASE WHEN NOT w.above AND t.n = 1 THEN true ELSE w.above END,
    CASE WHEN NOT w.above AND t.n = 1 THEN 0 ELSE w.level + 1 END,
    CASE WHEN NOT w.above AND t.n = 1 THEN w.place ELSE w.idx // 2 END,
    CASE WHEN NOT w.above AND t.n = 1 THEN w.digest
      WHEN b.digest IS NULL THEN sha256(w.digest) WHEN w.idx % 2 = 0 THEN sha256(w.digest || b.digest) ELSE sha256(b.digest || w.digest) END,
    CASE WHEN NOT w.above AND t.n = 1 THEN w.siblings ELSE w.siblings || coalesce(b.digest, '') END
  FROM walked w
  JOIN (SELECT lang, false AS above, level, idx, n FROM tree UNION ALL SELECT NULL, true, level, idx, n FROM upper_) t
    ON t.above = w.above AND t.level = w.level AND t.idx = w.idx AND (w.above OR t.lang IS NOT DISTINCT FROM w.lang)
  LEFT JOIN (SELECT lang, false AS above, level, idx, digest FROM tree UNION ALL SELECT NULL, true, level, idx, digest FROM upper_) b
    ON b.above = w.above AND b.level = w.level AND b.idx = xor(w.idx, 1) AND (w.above OR b.lang IS NOT DISTINCT FROM w.lang)
  WHERE t.n > 1 OR NOT w.above
), last_ AS (
  SELECT r, arg_max(digest, level) AS folded_root, arg_max(siblings, level) AS siblings FROM walked WHERE above GROUP BY r
)
SELECT doc_id, leaf, subroot, (SELECT digest FROM upper_ WHERE n = 1) AS root, sha256(siblings) AS proof_sha256, folded_root,
  folded_root = (SELECT digest FROM upper_ WHERE n = 1) AS verified
FROM wanted JOIN last_ USING (r)
"""

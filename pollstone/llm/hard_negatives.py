"""Hard negatives for contrastive training, by bounds along a spanning tree of the anchors.

An anchor's positives are its best rows of the same label. A positive's hard
negatives are the best rows of other labels whose score lies in a window that
the positive's score sets. Scores are integer inner products.

Anchors are dealt to blocks, and a minimum spanning tree is laid through each
block. A candidate's score at an anchor and at its parent differ by at most the
length of the edge times the candidate's norm, so from the root's scores down
every anchor knows a lower and an upper bound for each candidate. Only
candidates whose bounds meet a window of the anchor are scored again; the
others hand on their bounds, widened by each edge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pollstone.llm.common import stored

SCALE = 256
#: Anchors, and candidates, that a task holds at a time.
ANCHORS = 512
BLOCK = 8192
#: Rounded components beyond this could give scores that are no longs.
MOST = 1 << 26


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, the shorter ones filled up with zeros."""
    rows = column.combine_chunks()
    sizes = np.diff(rows.offsets.to_numpy())
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(rows), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max((int(np.diff(c.combine_chunks().offsets.to_numpy()).max(initial=0)) for c in columns if len(c)), default=0)


def _exact(high: np.ndarray, low: np.ndarray) -> bool:
    """Whether all products of two matrices' rows are exact as doubles."""
    return high.shape[1] * float(np.abs(high).max(initial=0)) * float(np.abs(low).max(initial=0)) < 2**53


def _products(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Exact products of rows with a vector or the columns of a matrix."""
    if _exact(rows, one[None, :] if one.ndim == 1 else one.T):
        return (rows.astype(np.float64) @ one.astype(np.float64)).astype(np.int64)
    return rows @ one


# The tree


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a minimum spanning tree: the points in an order with parents first, and each one's parent (the root's is -1)."""
    count = len(points)
    at = points.astype(np.float64)
    norms = (at * at).sum(axis=1)
    order, parent = [0], np.full(count, -1)
    near = norms + norms[0] - 2 * (at @ at[0])
    parent[1:] = 0
    near[0] = np.inf
    for _ in range(count - 1):
        k = int(near.argmin())
        order.append(k)
        nearer = norms + norms[k] - 2 * (at @ at[k])
        open_ = np.isfinite(near)
        open_[k] = False
        better = open_ & (nearer < near)
        near[better], parent[better] = nearer[better], k
        near[k] = np.inf
    return np.array(order), parent


def tree_scores(
    points: np.ndarray, order: np.ndarray, parent: np.ndarray, windows: list[tuple[int, int]], rows: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """For each point: itself, the rows that may lie in its window, their exact scores, and how many were rescored.

    ``windows`` has the lowest and highest score a point asks for; none if the
    first is larger.
    """
    values = rows.astype(np.float64)
    norms = np.sqrt((values * values).sum(axis=1))
    children = np.bincount(parent[parent >= 0], minlength=len(points))
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for k in order.tolist():
        lowest, highest = windows[k]
        above = int(parent[k])
        if above < 0:
            score = _products(rows, points[k])
            low, high = score.astype(np.float64), score.astype(np.float64)
            meets = np.flatnonzero((score >= lowest) & (score <= highest))
            exact, work = score[meets], len(rows)
        else:
            edge = float(np.sqrt(((points[k] - points[above]).astype(np.float64) ** 2).sum()))
            reach = edge * norms * (1 + 1e-9) + 1
            low, high = bounds[above][0] - reach, bounds[above][1] + reach
            meets = np.flatnonzero((high >= lowest) & (low <= highest)) if lowest <= highest else np.zeros(0, int)
            exact, work = _products(rows[meets], points[k]), len(meets)
            low[meets] = high[meets] = exact
            children[above] -= 1
            if not children[above]:
                del bounds[above]
        if children[k]:
            bounds[k] = (low, high)
        yield k, meets, exact, work


# The operator


def _blocks(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    count = max(1, -(-rows.count() // size))
    return rows.withColumn(name, F.expr(f"pmod(xxhash64(vec_id, label), {count}L)")), count


def _every(count: int, name: str):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))).alias(name)


def rounded(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, v)`` of the rows that take part, each once, with components rounded down to 1/``scale``."""
    known = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding").where(
        "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL"
        " AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    )
    whole = known.select("vec_id", "label", F.expr(f"transform(embedding, x -> CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))").alias("v"))
    return whole.where(f"forall(v, x -> x BETWEEN -{MOST} AND {MOST})").distinct()


def mine(
    vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90)
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Both tables have ``vec_id``, ``label`` and ``embedding``. For each anchor
    its first ``positives`` other rows of its label, and for each of these the
    first ``negatives`` rows of other labels whose score is from ``window[0]``
    to ``window[1]`` hundredths of the positive's; higher scores come first,
    ties by smaller ``vec_id``, and fewer rows if there are no more. A negative
    positive score has an empty window, so it gives no rows.

    Rows with a null id, label or vector, or a component that is null or not
    finite, take no part, and neither do those with a rounded component beyond
    ``MOST``, whose scores could leave the range of a long. Rows repeated whole
    count once; rows that share an id are never each other's positives or
    negatives. Vectors of different lengths agree on the shorter. Other columns
    play no part; empty tables give no rows.
    """
    low, high = window
    rows = stored(rounded(vectors), "rows")
    asked = rounded(anchors).select("vec_id", "label", "v", F.xxhash64("vec_id", "label", "v").alias("anchor"))
    asked = stored(asked, "anchors")
    found, n_found = _blocks(rows, BLOCK, "block")

    best = stored(_positives(found, asked, positives), "positives")
    windows = best.groupBy("anchor").agg(F.collect_list(F.struct("positive_id", "score")).alias("positives"))
    asked, n_asked = _blocks(stored(asked.join(windows, "anchor"), "windows"), ANCHORS, "tree")

    def grow(block: pa.Table) -> pa.Table:
        points = _matrix(block["v"], _width(block["v"]))
        order, parent = spanning_tree(points)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return block.append_column("place", pa.array(place)).append_column("parent", pa.array(parent, pa.int64()))

    kinds = {f.name: f.dataType.simpleString() for f in asked.schema.fields}
    shape = ", ".join(f"{name} {kind}" for name, kind in kinds.items()) + ", place long, parent long"
    trees = stored(asked.groupBy("tree").applyInArrow(grow, shape), "trees")

    def search(tree: pa.Table, block: pa.Table) -> pa.Table:
        out: dict[str, list[np.ndarray]] = {name: [] for name in ("anchor", "anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")}
        if tree.num_rows and block.num_rows:
            width = _width(tree["v"], block["v"])
            order = np.argsort(block["vec_id"].to_numpy(), kind="stable")
            block = block.take(pa.array(order))
            ids, labels, values = block["vec_id"].to_numpy(), block["label"].to_numpy(), _matrix(block["v"], width)
            points, parent = _matrix(tree["v"], width), tree["parent"].to_numpy()
            anchor, anchor_id, label = (tree[name].to_numpy() for name in ("anchor", "vec_id", "label"))
            wanted = [[(p["positive_id"], p["score"]) for p in some] for some in tree["positives"].to_pylist()]
            hull = [
                (min(-(-low * s // 100) for _, s in some if s >= 0), max(high * s // 100 for _, s in some if s >= 0))
                if any(s >= 0 for _, s in some)
                else (1, 0)
                for some in wanted
            ]
            for k, meets, score, _ in tree_scores(points, np.argsort(tree["place"].to_numpy()), parent, hull, values):
                able = (labels[meets] != label[k]) & (ids[meets] != anchor_id[k])
                meets, score = meets[able], score[able]
                for positive, given in wanted[k]:
                    if given < 0:
                        continue
                    inside = np.flatnonzero((100 * score >= low * given) & (100 * score <= high * given))
                    if len(inside) > negatives:  # those above the last that counts, and its ties; ids ascend
                        least = np.partition(score[inside], len(inside) - negatives)[len(inside) - negatives]
                        inside = inside[score[inside] >= least]
                    first = inside[np.argsort(-score[inside], kind="stable")][:negatives]
                    for name, value in (("anchor", anchor[k]), ("anchor_id", anchor_id[k]), ("positive_id", positive), ("positive_score", given)):
                        out[name].append(np.full(len(first), value, np.int64))
                    out["negative_id"].append(ids[meets[first]])
                    out["negative_score"].append(score[first])
        return pa.table({name: pa.array(np.concatenate(some) if some else np.zeros(0, np.int64), pa.int64()) for name, some in out.items()})

    met = (
        trees.select("*", _every(n_found, "block"))
        .groupBy("tree", "block")
        .cogroup(found.select("vec_id", "label", "v", "block", _every(n_asked, "tree")).groupBy("tree", "block"))
        .applyInArrow(search, "anchor long, anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    )
    # Rows of one id with different vectors are candidates of their own; of equal ids and scores one is enough.
    within = Window.partitionBy("anchor", "positive_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = met.distinct().withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _positives(found: DataFrame, asked: DataFrame, count: int) -> DataFrame:
    """``(anchor, positive_id, score)``: for each anchor its ``count`` best others of its label.

    Anchors meet the blocks of their own label only.
    """
    sizes = asked.groupBy("label").agg(F.ceil(F.count("*") / ANCHORS).alias("n"))
    dealt = stored(asked.join(sizes, "label").withColumn("part", F.pmod("anchor", "n")).drop("n"), "dealt")
    blocks = found.select(F.col("label").alias("its"), F.col("block").alias("b")).distinct()
    parts = dealt.select(F.col("label").alias("its"), F.col("part").alias("p")).distinct()

    def search(some: pa.Table, block: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if some.num_rows and block.num_rows:
            width = _width(some["v"], block["v"])
            block = block.take(pa.array(np.argsort(block["vec_id"].to_numpy(), kind="stable")))
            ids, values = block["vec_id"].to_numpy(), _matrix(block["v"], width)
            points = _matrix(some["v"], width)
            for anchor, own, point in zip(some["anchor"].to_numpy(), some["vec_id"].to_numpy(), points, strict=True):
                score = _products(values, point)
                able = np.flatnonzero(ids != own)
                if len(able) > count:
                    least = np.partition(score[able], len(able) - count)[len(able) - count]
                    able = able[score[able] >= least]
                first = able[np.argsort(-score[able], kind="stable")][:count]
                out[0].append(np.full(len(first), anchor, np.int64))
                out[1].append(ids[first])
                out[2].append(score[first])
        columns = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out]
        return pa.table(dict(zip(("anchor", "positive_id", "score"), columns, strict=True)))

    keys = ["label", "part", "block"]
    left = dealt.join(blocks, F.col("label") == F.col("its")).select("anchor", "vec_id", "v", "label", "part", F.col("b").alias("block"))
    right = found.join(parts, F.col("label") == F.col("its")).select("vec_id", "v", "label", F.col("p").alias("part"), "block")
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "anchor long, positive_id long, score long").distinct()
    within = Window.partitionBy("anchor").orderBy(F.desc("score"), "positive_id")
    return met.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= count).drop("rank")


def mine_every(vectors: DataFrame, step: int = 100, noise: int = 7, labels: int = 10) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``step``, after the labels of ids divisible by ``noise`` move on by one."""
    label = F.when(F.col("vec_id") % noise == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    rows = vectors.select("vec_id", label.alias("label"), "embedding")
    return mine(rows, rows.where(F.col("vec_id") % step == 0))


ORACLE = f"""
WITH v AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label, list_inner_product(a.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE label <> anchor_label AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

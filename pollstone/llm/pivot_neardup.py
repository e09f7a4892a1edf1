"""SimHash near-duplicates, found with pivot distance tables.

Each text gets a 64-bit fingerprint of its word shingles. Texts whose
fingerprints differ in few bits are linked. Distinct fingerprints meet in
groups that share half of their bits (any two within two bits of each other
share two of four 16-bit parts). Inside a group every fingerprint has a row of
Hamming distances to many reference fingerprints (pivots). By the triangle
inequality two fingerprints within ``d`` bits differ by at most ``d`` in every
coordinate, so pairs with a larger difference are discarded unseen and only
survivors are compared bit by bit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollstone.llm.common import WORD, frames, stored
from pollstone.llm.components import components
from pollstone.llm.decision_list import fresh_name

_WORD = re.compile(WORD.encode())
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)
PARTS = 4
#: Groups above this many fingerprints are split by two more quarter parts.
SPLIT_ABOVE = 2048
PIVOTS = 24


def fingerprint(text: str | None, width: int = 3, chunk: int = 1 << 16) -> int:
    """Bit majority over the XXH64 (seed 42) of all word shingles, repeats included.

    A-Z are lower-cased. Fewer than ``width`` words are one shingle; none give
    zero. Hashes are summed in chunks, so memory doesn't grow with the text.
    """
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate(([0], ends[:-1] + 1))[:count].tolist()
    last = ends[min(width, len(words)) - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, count, chunk):
        hashes = np.array([digest(joined[i:j], 42) for i, j in zip(first[k : k + chunk], last[k : k + chunk], strict=True)], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(_BITS[2 * ones > count].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``(doc_id, body, fp)`` for each row of ``docs``: its text's digest, and its bits as a signed long."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames(stream):
            found = np.array([fingerprint(text, width) for text in frame["text"]], np.uint64).view(np.int64)
            ids = pa.array(frame["doc_id"], pa.int64(), from_pandas=True)
            body = pa.array(frame["body"], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, body, pa.array(found)], names=["doc_id", "body", "fp"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("body"), text.alias("text"))
    return rows.mapInArrow(batches, "doc_id long, body long, fp long")


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: fixed pseudo-random words, the same in every task."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % k, 7) for k in range(count)], np.uint64)


def _ones(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).astype(np.int16)


def close_links(values: np.ndarray, most: int, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Indices ``(i, j)`` that connect all of ``values`` within ``most`` bits of each other.

    Values are sorted by their distance to the first pivot. Each block is held
    against the window of later values whose first coordinate can still be
    near; the other coordinates discard pairs, and the bits decide. Of the
    close pairs only those that join two trees of a local union-find come out,
    so a group of ``n`` yields fewer than ``n`` links.
    """
    coordinates = _ones(values[:, None] ^ pivots()[None, :])
    order = np.lexsort((values, coordinates[:, 0]))
    values, coordinates = values[order], coordinates[order]
    parent = np.arange(len(values))
    left, right = [], []

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for start in range(0, len(values), block):
        stop = min(start + block, len(values))
        until = int(np.searchsorted(coordinates[:, 0], coordinates[stop - 1, 0] + most, "right"))
        near = np.ones((stop - start, until - start), bool)
        for c in range(coordinates.shape[1]):
            if c < 4 or near.sum() > 4 * near.shape[0]:
                near &= np.abs(coordinates[start:stop, c, None] - coordinates[None, start:until, c]) <= most
        i, j = np.nonzero(near)
        i, j = i[j > i] + start, j[j > i] + start
        i, j = (x[(np.abs(coordinates[i] - coordinates[j]) <= most).all(axis=1)] for x in (i, j))
        sure = _ones(values[i] ^ values[j]) <= most
        for a, b in zip(i[sure].tolist(), j[sure].tolist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                left.append(order[a])
                right.append(order[b])
    return np.array(left, np.int64), np.array(right, np.int64)


def _quarters(fp: str, bits: int, shift: str) -> list[str]:
    return [f"(shiftrightunsigned({fp}, {shift} + {bits * k}) & {(1 << bits) - 1})" for k in range(PARTS)]


def links(distinct: DataFrame, most: int = 2) -> DataFrame:
    """Links ``(a, b)`` between nodes of ``distinct (fp, node)`` that keep every component whole.

    A fingerprint joins one group for each pair of its four 16-bit parts. A
    group with more than ``SPLIT_ABOVE`` members is split again by two of four
    8-bit quarters of the remaining 32 bits; as fingerprints are distinct, such
    a group can't hold more than 65,536 of them, however large the corpus is.
    """
    if not 0 <= most <= PARTS - 2:
        raise ValueError("the parts only guarantee up to two differing bits")
    pairs = list(combinations(range(PARTS), 2))
    whole = _quarters("fp", 16, "0")
    cells = ", ".join(
        f"struct({n} AS cell, ({whole[i]} << 16) | {whole[j]} AS half, "
        f"({whole[rest[0]]} << 16) | {whole[rest[1]]} AS other)"
        for n, (i, j) in enumerate(pairs)
        for rest in [[k for k in range(PARTS) if k not in (i, j)]]
    )
    keyed = distinct.select("fp", "node", F.expr(f"inline(array({cells}))"))
    sizes = keyed.groupBy("cell", "half").agg(F.count("*").alias("members"))
    shared = sizes.where("members > 1")
    fine = _quarters("other", 8, "0")
    second = ", ".join(f"({n} << 16) | ({fine[i]} << 8) | {fine[j]}" for n, (i, j) in enumerate(pairs))
    grouped = (
        keyed.join(shared, ["cell", "half"])
        .withColumn("sub", F.expr(f"explode(CASE WHEN members > {SPLIT_ABOVE} THEN array({second}) ELSE array(-1L) END)"))
        .select("cell", "half", "sub", "fp", "node")
    )

    def join(group: pd.DataFrame) -> pd.DataFrame:
        if len(group) < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        nodes = group["node"].to_numpy()
        i, j = close_links(group["fp"].to_numpy().view(np.uint64), most)
        return pd.DataFrame({"a": nodes[i], "b": nodes[j]})

    return grouped.groupBy("cell", "half", "sub").applyInPandas(join, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = 3, most: int = 2, keep_body: bool = False) -> DataFrame:
    """``(doc_id, fp, component_id)`` for each row of ``docs``, with ``body`` on request.

    ``component_id`` is the smallest doc_id reachable over links, the row's own
    included. Rows of one fingerprint (exact copies, empty and null texts among
    them) are one node, so a group of copies never meets pair by pair. Rows
    without a doc_id stay, but can't name a component: if no row of theirs has
    an id, it is null. An empty table gives no rows.
    """
    marked = stored(fingerprints(docs, width), "fingerprints")
    named = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    distinct = named.select("fp", F.col("fp").alias("node"))
    roots = components(links(distinct, most))
    member = named.join(roots, named["fp"] == roots["node"], "left").select(
        named["fp"], "least", F.coalesce("component", named["fp"]).alias("root")
    )
    member = stored(member, "members")
    lowest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = member.join(lowest, "root").select("fp", "component_id")
    return marked.join(by_print, "fp").select("doc_id", *["body"] * keep_body, "fp", "component_id")


def first_of_groups(docs: DataFrame, width: int = 3, most: int = 2) -> DataFrame:
    """``docs`` without later near-copies: of each component the row with the smallest doc_id stays.

    Between rows of one doc_id the smaller text digest decides, and a row that
    is repeated whole is kept once. Rows without a doc_id are kept.
    """
    body = fresh_name(docs, "body")
    known = docs.where("doc_id IS NOT NULL").withColumn(body, F.xxhash64(F.col("text").cast("string")))
    found = near_duplicates(docs.select("doc_id", "text"), width, most, keep_body=True)
    kept = (
        found.where("doc_id IS NOT NULL")
        .groupBy("component_id")
        .agg(F.min(F.struct("doc_id", "body")).alias("first"))
        .select(F.col("first.doc_id").alias("doc_id"), F.col("first.body").alias(body))
        .distinct()
    )
    once = known.join(kept, ["doc_id", body], "left_semi").dropDuplicates(["doc_id", body])
    return once.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))

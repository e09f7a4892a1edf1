"""Exact substring deduplication with longest-previous-factor (LPF) arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller doc_id. Within a suffix order that is a question about
neighbours: the nearest suffixes before and after that come from a smaller
document (previous and next smaller values) hold the longest earlier match.

One suffix array over a whole corpus would have a row for each byte, so the
suffixes are dealt out first. Each string of 50 bytes is filed under its
smallest 26-byte gram, hence equal strings are filed alike, and the strings of
one gram occurrence form a segment of at most 74 bytes. Segments are compared
by digest; only where a gram has different segments in different documents are
their bytes fetched, suffix-sorted, and their LPF values computed. What is
fetched is the segment, once for all strings in it, and it goes to its gram's
bucket; only strings of a gram with very many segments go one by one, each to
the bucket of its own hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollstone.llm.common import dealt, frames, parts, stored, text_or_empty

LENGTH = 50
GRAM = 26
#: Long texts are cut into pieces of so many string starts, which is also how much is worked on at once.
PIECE = 1 << 20
#: Characters of text whose segments are gathered and compared before they are sent.
FILED_AT_ONCE = 6 << 20
#: A gram with more segments than this has its strings dealt one by one, so that no bucket gets them all.
SHARED = 4096
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_M64 = (1 << 64) - 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


# The longest-previous-factor array


def longest_previous_factor(source: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For suffixes in suffix order: the longest match with a suffix of a smaller ``source``.

    ``lcp[i]`` is the common prefix of suffixes ``i - 1`` and ``i``. Previous and
    next smaller values are found for all positions at once: whoever points at
    a value that isn't smaller takes over that one's pointer, and with it the
    smallest ``lcp`` on the way.
    """
    return np.maximum(_previous(source, lcp), _previous(source[::-1], np.concatenate((lcp[:1] * 0, lcp[:0:-1])))[::-1])


def _previous(source: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    values = np.concatenate(([np.iinfo(np.int64).min], source.astype(np.int64)))
    least = np.concatenate(([0], lcp.astype(np.int64)))
    if len(least) > 1:
        least[1] = 0
    to = np.maximum(np.arange(len(values)) - 1, 0)
    open_ = np.arange(1, len(values))
    while len(open_):
        open_ = open_[values[to[open_]] >= values[open_]]
        at = to[open_]
        hop, reach = to[at], np.minimum(least[open_], least[at])
        to[open_], least[open_] = hop, reach
    found = np.where(to == 0, 0, least)
    return found[1:]


def previous_matches(strings: np.ndarray, source: np.ndarray) -> np.ndarray:
    """LPF values of ``strings`` (rows of equally many bytes), each from document ``source``."""
    n, width = strings.shape
    if n == 0:
        return np.zeros(0, np.int64)
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = strings
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort((source, *[words[:, k] for k in reversed(range(words.shape[1]))]))
    ranked = strings[order]
    same = ranked[1:] == ranked[:-1]
    lcp = np.concatenate(([0], np.where(same.all(axis=1), width, np.argmin(same, axis=1))))
    found = np.empty(n, np.int64)
    found[order] = longest_previous_factor(source[order], lcp)
    return found


# Segments


def _rolling(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    if base not in _powers or len(_powers[base][0]) < count:
        n = max(count, PIECE + 2 * LENGTH)
        ups = []
        for b in (base, pow(base, -1, 1 << 64)):
            up = np.ones(n, np.uint64)
            size = 1
            while size < n:
                step = np.uint64(pow(b, size, 1 << 64))
                up[size : 2 * size] = up[: min(size, n - size)] * step
                size *= 2
            ups.append(up)
        _powers[base] = (ups[0], ups[1])
    return _powers[base]


class _Hashes:
    """Digests of any byte range of a buffer, from prefix sums."""

    def __init__(self, data: np.ndarray, base: int):
        self.up, self.down = _rolling(base, len(data) + 1)
        values = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values * self.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        found = (self.sums[stop] - self.sums[start]) * self.down[start]
        return _mixed(found)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def segments(data: np.ndarray, piece_of: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segments of the pieces that ``data`` strings together: ``(start, count, gram, digest)``.

    ``starts`` are the positions at which a string of LENGTH bytes lies within
    one piece, ``piece_of`` their pieces. A segment is a run of such starts
    whose strings have the same smallest gram (the leftmost of equals).
    """
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    low = np.uint64((1 << 21) - 1)
    first = _Hashes(data, _BASES[0])
    at = np.arange(len(data) - GRAM + 1)
    grams = _mixed((first.sums[GRAM:] - first.sums[: len(at)]) * first.down[: len(at)])
    window = (grams & ~low) | at.astype(np.uint64)
    span, width = LENGTH - GRAM + 1, 1
    while 2 * width <= span:
        window = np.minimum(window[:-width], window[width:])
        width *= 2
    if width < span:
        window = np.minimum(window[: len(window) - (span - width)], window[span - width :])
    anchor = (window[starts] & low).astype(np.int64)
    cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(piece_of) != 0)) + 1
    begin = np.concatenate(([0], cut))
    count = np.diff(np.concatenate((begin, [len(starts)])))
    start = starts[begin]
    second = _Hashes(data, _BASES[1])
    digest = second.of(start, start + count + LENGTH - 1) ^ (count.astype(np.uint64) << np.uint64(56))
    return start, count, grams[anchor[begin]], digest


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (document, offset, bytes) of about PIECE bytes; neighbours share LENGTH - 1 bytes."""
    held, size = [], 0
    for k, text in enumerate(texts):
        for at in range(0, max(0, len(text) - LENGTH + 1), PIECE):
            part = text[at : at + PIECE + LENGTH - 1]
            if held and size + len(part) > PIECE:
                yield held
                held, size = [], 0
            held.append((k, at, part))
            size += len(part)
    if held:
        yield held


def _planes(*columns: np.ndarray) -> bytes:
    """Columns byte plane by byte plane: high bytes of sorted numbers then compress to nothing."""
    return b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns)


def _unplaned(data: bytes, count: int, kinds: tuple[str, ...]) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, size * count, at).reshape(size, count)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(-1))
        at += size * count
    return out


_RUN = ("<i8", "<i4", "<u1")  # document key, first start, count of starts
_WANTED = (*_RUN, "<u8")  # and the gram that all strings of the run are dealt by, 0 if each has a bucket of its own


def _runs(
    key: np.ndarray, start: np.ndarray, count: np.ndarray, buckets: int, kind: int, gram: np.ndarray | None = None
) -> Iterator[tuple[int, int, int, bytes]]:
    """Rows of runs, with their grams if given, dealt to the buckets of their documents."""
    for bucket, rows in dealt(np.mod(key.astype(np.int64), np.int64(buckets))):  # signed, as pmod deals the documents
        rows = rows[np.lexsort((start[rows], key[rows]))]
        more = () if gram is None else (gram[rows].astype("<u8"),)
        yield kind, bucket, len(rows), _planes(key[rows].astype("<i8"), start[rows].astype("<i4"), count[rows].astype("<u1"), *more)


_FILED = "kind int, bucket int, n int, body binary"


def _filed(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kind, bucket, n, body = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(n, pa.int32()), pa.array(body, pa.binary())],
        names=["kind", "bucket", "n", "body"],
    )


def _file(texts: list[bytes], ids: np.ndarray, keys: np.ndarray, buckets: int, grams_to: int) -> Iterator[tuple[int, int, int, bytes]]:
    """File the segments of some documents under their grams (kind 0).

    Of the segments that are alike here, only those of the smallest document
    are sent. The others are known to have come earlier (kind 1), so a passage
    in a third of all documents leaves a task as one row.
    """
    grams, digests, docs, places, counts = [], [], [], [], []
    for pieces in _pieces(texts):
        data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
        sizes = np.array([len(p[2]) for p in pieces])
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        valid = sizes - LENGTH + 1
        piece_of = np.repeat(np.arange(len(pieces)), valid)
        starts = np.arange(valid.sum()) + np.repeat(begins - np.concatenate(([0], np.cumsum(valid)[:-1])), valid)
        start, count, gram, digest = segments(data, piece_of, starts)
        piece = np.searchsorted(begins, start, "right") - 1
        docs.append(np.array([p[0] for p in pieces])[piece])
        places.append(start - begins[piece] + np.array([p[1] for p in pieces])[piece])
        grams.append(gram)
        digests.append(digest)
        counts.append(count)
    if not grams:
        return
    gram, digest, doc, place, count = map(np.concatenate, (grams, digests, docs, places, counts))
    both = _mixed(gram + np.uint64(3) * digest)
    order = np.lexsort((ids[doc], both))
    fresh = np.concatenate(([True], both[order][1:] != both[order][:-1]))
    least = np.empty(len(order), np.int64)
    least[order] = ids[doc[order]][np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
    first = ids[doc] == least
    yield from _runs(keys[doc[~first]], place[~first], count[~first], buckets, 1)
    gram, digest, doc, place, count = (x[first] for x in (gram, digest, doc, place, count))
    for bucket, rows in dealt((gram >> np.uint64(40)) % np.uint64(grams_to)):
        here, local = np.unique(doc[rows], return_inverse=True)
        head = np.array([len(here)], "<i8").tobytes() + _planes(ids[here].astype("<i8"), keys[here].astype("<i8"))
        where = (local.astype(np.uint32), place[rows].astype("<i4"), count[rows].astype("<u1"))
        low, high = gram[rows].view(np.uint8).reshape(-1, 8)[:, :5], digest[rows].view(np.uint8).reshape(-1, 8)[:, 2:8]
        body = head + _planes(*where) + low.T.tobytes() + high.T.tobytes()
        yield 0, bucket, len(rows), body


def _read_filed(n: int, body: bytes) -> tuple[np.ndarray, ...]:
    docs = int(np.frombuffer(body, "<i8", 1)[0])
    ids, keys = _unplaned(body[8 : 8 + 16 * docs], docs, ("<i8", "<i8"))
    at = 8 + 16 * docs
    local, place, count = _unplaned(body[at : at + 9 * n], n, ("<u4", "<i4", "<u1"))
    at += 9 * n
    gram, digest = np.zeros((n, 8), np.uint8), np.zeros((n, 8), np.uint8)
    gram[:, :5] = np.frombuffer(body, np.uint8, 5 * n, at).reshape(5, n).T
    digest[:, :6] = np.frombuffer(body, np.uint8, 6 * n, at + 5 * n).reshape(6, n).T
    return gram.view("<u8").ravel(), digest.view("<u8").ravel(), ids[local], keys[local], place, count


def _meet(bucket: list[tuple[int, bytes]], buckets: int, shared: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Segments of some grams: those that came earlier (kind 1), and those whose bytes are wanted (kind 2)."""
    gram, digest, ids, keys, place, count = map(np.concatenate, zip(*[_read_filed(n, body) for n, body in bucket], strict=True))
    order = np.lexsort((ids, digest, gram))
    gram, digest, ids, keys, place, count = (x[order] for x in (gram, digest, ids, keys, place, count))
    new_gram = np.concatenate(([True], gram[1:] != gram[:-1]))
    new = new_gram | np.concatenate(([True], digest[1:] != digest[:-1]))
    segment = np.cumsum(new) - 1
    least = ids[new]
    first = ids == least[segment]
    yield from _runs(keys[~first], place[~first], count[~first], buckets, 1)
    group = np.cumsum(new_gram[new]) - 1
    begin = np.flatnonzero(new_gram[new])
    differ = np.minimum.reduceat(least, begin) != np.maximum.reduceat(least, begin)
    wanted = first & differ[group][segment]
    common = np.bincount(group[segment[wanted]], minlength=len(begin)) > shared
    dealt_by = np.where(common[group[segment[wanted]]], np.uint64(0), gram[wanted])
    yield from _runs(keys[wanted], place[wanted], count[wanted], buckets, 2, dealt_by)


def _read_runs(rows: pd.DataFrame, kinds: tuple[str, ...]) -> list[np.ndarray]:
    if not len(rows):
        return [np.zeros(0, kind) for kind in kinds]
    found = [_unplaned(body, n, kinds) for n, body in zip(rows["n"], rows["body"], strict=True)]
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def _of_documents(docs: pa.Table, runs: pa.Table, kinds: tuple[str, ...] = _RUN) -> Iterator[tuple]:
    """Each row's position and bytes, with the starts and counts (and what follows them in ``kinds``) that lie in it."""
    key, start, count, *more = _read_runs(runs.to_pandas(), kinds)
    order = np.argsort(key, kind="stable")
    key, columns = key[order], [start[order].astype(np.int64), count[order].astype(np.int64), *[c[order] for c in more]]
    wanted = docs["key"].to_numpy()
    low, high = np.searchsorted(key, wanted, "left"), np.searchsorted(key, wanted, "right")
    for k, text in enumerate(docs["text"]):
        yield k, text.as_py().encode("utf-8", "surrogatepass"), *[c[low[k] : high[k]] for c in columns]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of ranges, one range after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


_STRETCH = ("<i8", "<i8", "<i4", "<u1")  # document id and key, first start, count of starts
_STRING = ("<i8", "<i8", "<i4", "<u8")  # document id and key, start, hash


def _stretches(rows: list[tuple[int, int, bytes, np.ndarray, np.ndarray, np.ndarray]], buckets: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Wanted segments (kind 0) by gram, and single strings (kind 1) by hash: (document id, key, bytes, starts, counts, grams)."""
    if not rows:
        return
    sizes = [len(r[3]) for r in rows]
    ids, keys = (np.repeat(np.array([r[k] for r in rows], np.int64), sizes) for k in (0, 1))
    start, count, gram = (np.concatenate([r[k] for r in rows]) for k in (3, 4, 5))
    data = np.frombuffer(b"".join(r[2] for r in rows), np.uint8)
    begin = np.repeat(np.cumsum([0, *[len(r[2]) for r in rows[:-1]]]), sizes) + start
    whole, single = np.flatnonzero(gram != 0), np.flatnonzero(gram == 0)
    for bucket, at in dealt(gram[whole] % np.uint64(buckets)):
        at = whole[at]
        body = _planes(ids[at].astype("<i8"), keys[at].astype("<i8"), start[at].astype("<i4"), count[at].astype("<u1"))
        yield 0, bucket, len(at), body + data[_ranges(begin[at], count[at] + LENGTH - 1)].tobytes()
    if len(single):
        many = count[single]
        each = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[_ranges(begin[single], many)]
        ids, keys, start = np.repeat(ids[single], many), np.repeat(keys[single], many), _ranges(start[single], many)
        hashes = _string_hashes(each)
        for bucket, at in dealt(hashes % np.uint64(buckets)):
            body = _planes(ids[at].astype("<i8"), keys[at].astype("<i8"), start[at].astype("<i4"), hashes[at].astype("<u8"))
            yield 1, bucket, len(at), body + each[at].tobytes()


def _read_strings(kind: int, n: int, body: bytes) -> tuple[np.ndarray, ...]:
    """Document ids, keys, starts and hashes of the strings of a row, and the strings."""
    if kind:
        ids, keys, start, hashes = _unplaned(body, n, _STRING)
        return ids, keys, start.astype(np.int64), hashes, np.frombuffer(body, np.uint8, LENGTH * n, 28 * n).reshape(n, LENGTH)
    ids, keys, start, count = _unplaned(body, n, _STRETCH)
    count = count.astype(np.int64)
    size = count + LENGTH - 1
    data = np.frombuffer(body, np.uint8, int(size.sum()), 21 * n)
    strings = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[_ranges(np.cumsum(size) - size, count)]
    return np.repeat(ids, count), np.repeat(keys, count), _ranges(start.astype(np.int64), count), _string_hashes(strings), strings


# The operator


def earlier_runs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with ``key`` and ``bucket``, and by bucket the runs of string starts that came earlier.

    Columns of ``docs`` but the text follow as ``c0, c1, ...``, so that their
    names can't clash. Ids for comparing are strings, which nulls can't turn
    into floats. A task sends one row to each bucket it has something for, as
    a shuffle does with its blocks.
    """
    buckets = grams_to = parts(docs.sparkSession)
    text = text_or_empty()
    key = F.xxhash64(F.col("doc_id").cast("long").cast("string"), text)
    keyed = docs.select(
        F.pmod(key, F.lit(buckets)).cast("int").alias("bucket"),
        key.alias("key"),
        F.col("doc_id").cast("long").cast("string").alias("id"),
        text.alias("text"),
        F.col("text").isNull().alias("absent"),
        *[F.col(f"`{name}`").alias(f"c{k}") for k, name in enumerate(docs.columns) if name != "text"],
    )

    def file(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, ids, keys, size = [], [], [], 0
        for frame in frames(stream):
            texts += [t.encode("utf-8", "surrogatepass") for t in frame["text"]]
            ids += map(int, frame["id"])
            keys += frame["key"].tolist()
            size += int(frame["text"].str.len().sum())
            if size > FILED_AT_ONCE:
                yield _filed(list(_file(texts, np.array(ids, np.int64), np.array(keys, np.int64), buckets, grams_to)))
                texts, ids, keys, size = [], [], [], 0
        yield _filed(list(_file(texts, np.array(ids, np.int64), np.array(keys, np.int64), buckets, grams_to)))

    def meet(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, bytes]]] = {}
        for batch in stream:
            for row in batch.to_pylist():
                if row["kind"]:
                    yield _filed([(row["kind"], row["bucket"], row["n"], row["body"])])
                else:
                    held.setdefault(row["bucket"], []).append((row["n"], row["body"]))
        for bucket in list(held):
            yield _filed(list(_meet(held.pop(bucket), buckets, SHARED)))

    filed = keyed.where("id IS NOT NULL AND length(text) > 0").select("id", "key", "text").mapInArrow(file, _FILED)
    met = stored(filed.repartition(parts(docs.sparkSession), "kind", "bucket").mapInArrow(meet, _FILED), "segments")

    def fetch(texts: pa.Table, runs: pa.Table) -> pa.Table:
        found, seen = [], set()
        doc_ids, doc_keys = texts["id"].to_pylist(), texts["key"].to_numpy()
        for k, data, start, count, gram in _of_documents(texts, runs, _WANTED):
            if not len(start) or int(doc_keys[k]) in seen:
                continue
            seen.add(int(doc_keys[k]))
            _, once = np.unique(start, return_index=True)  # a row that is repeated wants its strings but once
            found.append((int(doc_ids[k]), int(doc_keys[k]), data, start[once], count[once], gram[once]))
        return _strings(list(_stretches(found, grams_to)))

    def factor(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple[int, bytes]]] = {}
        for batch in stream:
            for row in batch.to_pylist():
                held.setdefault((row["kind"], row["bucket"]), []).append((row["n"], row["body"]))
        for kind, bucket in list(held):
            read = [_read_strings(kind, n, body) for n, body in held.pop((kind, bucket))]
            hashes = np.concatenate([r[3] for r in read])
            _, back, times = np.unique(hashes, return_inverse=True, return_counts=True)
            again = times[back] > 1  # a string whose hash is alone has no match
            cuts = np.cumsum([len(r[3]) for r in read])[:-1]
            some = [[column[mask] for column in r] for r, mask in zip(read, np.split(again, cuts), strict=True)]
            ids, keys, starts, _, strings = map(np.concatenate, zip(*some, strict=True))
            hit = previous_matches(strings, ids) >= LENGTH
            yield _filed(list(_runs(keys[hit], starts[hit], np.ones(int(hit.sum()), np.int64), buckets, 1)))

    wanted = met.where("kind = 2").select("bucket", "n", "body")
    strings = keyed.groupBy("bucket").cogroup(wanted.groupBy("bucket")).applyInArrow(fetch, _FILED)
    matched = strings.repartition(parts(docs.sparkSession), "kind", "bucket").mapInArrow(factor, _FILED)
    covered = met.where("kind = 1").unionByName(matched).select("bucket", "n", "body")
    return keyed, covered


def _strings(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    return pa.Table.from_batches([_filed(rows)])


def _string_hashes(strings: np.ndarray) -> np.ndarray:
    found = np.zeros(len(strings), np.uint64)
    for k in range(strings.shape[1]):
        found = found * np.uint64(_BASES[0]) + strings[:, k].astype(np.uint64) + np.uint64(1)
    return _mixed(found)


def _removed(size: int, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    steps = np.zeros(size + 1, np.int32)
    np.add.at(steps, start, 1)
    np.add.at(steps, np.minimum(start + count - 1 + LENGTH, size), -1)
    return np.cumsum(steps[:-1]) > 0


def _kept(data: bytes, start: np.ndarray, count: np.ndarray) -> tuple[bytes, list[list[int]]]:
    """What remains of a text, and the removed ranges."""
    gone = _removed(len(data), start, count)
    spans = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))).reshape(-1, 2).tolist()
    return (np.frombuffer(data, np.uint8)[~gone].tobytes() if spans else data), spans


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept)`` for each row of ``docs``.

    ``spans`` are the removed byte ranges (start, stop), ``kept`` is what
    remains as text; a character that loses some of its bytes loses all of
    them there. A null text is empty. Rows of one doc_id, repeated or not, are
    never each other's copies; rows without a doc_id neither lose bytes nor
    cost others theirs. Texts shorter than LENGTH stay as they are. Nothing
    comes from an empty table, and other columns play no part.
    """
    keyed, covered = earlier_runs(docs.select("doc_id", "text"))

    def cut(texts: pa.Table, runs: pa.Table) -> pa.Table:
        sizes, removed, digests, ranges, kept = [], [], [], [], []
        for _, data, start, count in _of_documents(texts, runs):
            rest, spans = _kept(data, start, count)
            sizes.append(len(data))
            removed.append(len(data) - len(rest))
            digests.append(hashlib.sha256(rest).hexdigest())
            ranges.append(spans)
            kept.append(rest.decode("utf-8", "ignore"))
        return pa.table(
            {
                "id": texts["id"],
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(map(len, ranges), pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "spans": pa.array(ranges, pa.list_(pa.list_(pa.int64()))),
                "kept": pa.array(kept, pa.string()),
            }
        )

    shape = "id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>, kept string"
    found = keyed.groupBy("bucket").cogroup(covered.groupBy("bucket")).applyInArrow(cut, shape)
    return found.select(F.col("id").cast("long").alias("doc_id"), *found.columns[1:])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` (and ``n_chars``, if there) cut down to what no earlier document has.

    Rows come out as often as they come in. Null texts stay null; other
    columns are handed on as they are. Both looks at the texts read one shuffle.
    """
    keyed, covered = earlier_runs(docs)
    handed = [f"c{k}" for k, name in enumerate(docs.columns) if name != "text"]

    def cut(texts: pa.Table, runs: pa.Table) -> pa.Table:
        kept, changed = [], []
        for _, data, start, count in _of_documents(texts, runs):
            kept.append(_kept(data, start, count)[0].decode("utf-8", "ignore"))
            changed.append(len(start) > 0)
        columns = {name: texts[name] for name in ("absent", *handed)}
        return pa.table(columns | {"kept": pa.array(kept, pa.string()), "changed": pa.array(changed, pa.bool_())})

    kinds = {f.name: f.dataType.simpleString() for f in keyed.schema.fields}
    shape = ", ".join([f"{name} {kinds[name]}" for name in ("absent", *handed)] + ["kept string", "changed boolean"])
    found = keyed.groupBy("bucket").cogroup(covered.groupBy("bucket")).applyInArrow(cut, shape)
    out = []
    for k, name in enumerate(docs.columns):
        value = F.expr("CASE WHEN NOT absent THEN kept END") if name == "text" else F.col(f"c{k}")
        if name == "n_chars":
            value = F.when(F.col("changed"), F.length("kept").cast(kinds[f"c{k}"])).otherwise(value)
        out.append(value.alias(name))
    return found.select(*out)

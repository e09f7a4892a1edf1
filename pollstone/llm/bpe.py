"""Byte-pair encoding with a segment tree over the ranks of adjacent pairs.

The leaves of a tree are the ranks of a piece's adjacent pairs (none: infinity),
each combined with its place, so the root holds the leftmost pair of the lowest
rank. A merge changes three leaves and the paths above them, which is
logarithmic. Pieces of like length are worked on together, one tree a row of an
array; a long piece has a tree of its own.

The files are those of the tokenizers library: byte-level, with an ordered list
of merges. Texts are split into pieces by the file's fixed pattern first.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollstone.llm.common import frames, text_or_empty
from pollstone.llm.memo import Memo

# Fixed: Unicode's white space, and the pattern that byte-level files split by.
_SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
#: No piece spans two of these, and each is split alike wherever it stands.
_CHUNK = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_NONE = np.iinfo(np.int32).max
#: Pieces with more pairs than this get a tree of their own.
TOGETHER = 64
#: So many chunks are worked on at a time.
STRETCH = 1 << 19


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level files: printable bytes for themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(shown))
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Bpe:
    """The vocabulary, merges and special tokens of a byte-level file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        back = {letter: byte for byte, letter in letters.items()}
        self.of_byte = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.size = max(vocab.values()) + 1
        self.bytes_of = {k: bytes(back[c] for c in token) for token, k in vocab.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left, right = (np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.rank_of = dict(zip(keys.tolist(), range(len(merges)), strict=True))
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {k: content.encode() for content, k in self.special.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pattern = regex.compile(PATTERN)

    # Ranks of pairs; of a pair with a negative id, none

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], _NONE)

    # Encoding

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece, merged until no pair has a rank."""
        out: list[list[int]] = [[] for _ in pieces]
        sizes = np.array([len(p) for p in pieces], np.int64)
        done, leaves = 1, 1
        for k in np.flatnonzero(sizes == 1).tolist():
            out[k] = [int(self.of_byte[pieces[k][0]])]
        while leaves <= TOGETHER:
            here = np.flatnonzero((sizes > done) & (sizes <= leaves + 1))
            for start in range(0, len(here), 1 << 14):
                some = here[start : start + (1 << 14)].tolist()
                for k, ids in zip(some, self._together([pieces[k] for k in some], leaves), strict=True):
                    out[k] = ids
            done, leaves = leaves + 1, 2 * leaves
        for k in np.flatnonzero(sizes > done).tolist():
            out[k] = self._alone(pieces[k])
        return out

    def _together(self, pieces: list[bytes], leaves: int) -> list[list[int]]:
        """Pieces of up to ``leaves`` pairs: trees in the rows of one array, a merge in each row at a time."""
        n, width, slots = len(pieces), leaves + 1, leaves + 2
        sizes = np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        places = np.arange(slots)
        # A row has a slot for each symbol and one more, which is no one's neighbour.
        ids = np.full((n, slots), -1, np.int64)
        ids[:, :width] = np.where(places[:width] < sizes[:, None], self.of_byte[data], -1)
        after = np.where(places + 1 < sizes[:, None], places + 1, width).astype(np.int64)
        before = np.tile(np.concatenate(([width], places[: width - 1], [width])), (n, 1))
        tree = np.full((n, 2 * leaves), _NONE, np.int64)
        rank = self.pair_ranks(ids[:, :leaves], ids[:, 1:width])
        tree[:, leaves:] = np.where(rank < _NONE, rank * np.int64(leaves) + places[:leaves], _NONE)
        level = leaves
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        flat_tree, flat_ids, flat_after, flat_before = tree.ravel(), ids.ravel(), after.ravel(), before.ravel()
        rows = np.arange(n)
        depth = leaves.bit_length() - 1
        while True:
            root = flat_tree[rows * (2 * leaves) + 1]
            open_ = root < _NONE
            rows, root = rows[open_], root[open_]
            if not len(rows):
                break
            at, new = root % leaves, self.merged[root // leaves]
            base, trunk = rows * slots, rows * (2 * leaves)
            here = base + at
            gone = flat_after[here]
            following, earlier = flat_after[base + gone], flat_before[here]
            flat_ids[here], flat_ids[base + gone] = new, -1
            flat_after[here] = following
            flat_before[base + following] = at
            low = self.pair_ranks(np.concatenate((new, flat_ids[base + earlier])), np.concatenate((flat_ids[base + following], new)))
            low = low.astype(np.int64)
            low = np.where(low < _NONE, low * leaves + np.concatenate((at, earlier)), _NONE)
            inside = gone < leaves
            flat_tree[(trunk + leaves + gone)[inside]] = _NONE
            flat_tree[trunk + leaves + at] = low[: len(rows)]
            inside_too = earlier < leaves
            flat_tree[(trunk + leaves + earlier)[inside_too]] = low[len(rows) :][inside_too]
            if depth:
                # The paths above the three leaves; where a leaf isn't there, the middle one's is walked again.
                node = np.concatenate((np.where(inside, gone, at), at, np.where(inside_too, earlier, at))) + leaves
                trunk3 = np.concatenate((trunk, trunk, trunk))
                for _ in range(depth):
                    node >>= 1
                    child = trunk3 + 2 * node
                    flat_tree[trunk3 + node] = np.minimum(flat_tree[child], flat_tree[child + 1])
        kept = ids[:, :width]
        there = kept >= 0
        flat, cuts = kept[there].tolist(), np.cumsum(there.sum(axis=1)).tolist()
        return [flat[i:j] for i, j in zip([0, *cuts[:-1]], cuts, strict=True)]

    def _alone(self, piece: bytes) -> list[int]:
        """One piece of any length; point updates are logarithmic in it."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        n, none, rank_of, size = len(ids), 1 << 62, self.rank_of, self.size
        leaves = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [none] * (2 * leaves)
        for k in range(n - 1):
            rank = rank_of.get(ids[k] * size + ids[k + 1])
            if rank is not None:
                tree[leaves + k] = rank * leaves + k
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]

        def put(place: int, value: int) -> None:
            node = leaves + place
            tree[node] = value
            node >>= 1
            while node:
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low
                node >>= 1

        def pair(place: int) -> int:
            rank = rank_of.get(ids[place] * size + ids[after[place]]) if after[place] >= 0 else None
            return none if rank is None else rank * leaves + place

        while tree[1] < none:
            at = tree[1] % leaves
            ids[at] = int(self.merged[tree[1] // leaves])
            gone = after[at]
            after[at] = after[gone]
            if after[at] >= 0:
                before[after[at]] = at
            ids[gone] = -1
            if gone < leaves:
                put(gone, none)
            if at < leaves:
                put(at, pair(at))
            if before[at] >= 0:
                put(before[at], pair(before[at]))
        return [k for k in ids if k >= 0]

    def chunks(self, text: str) -> Iterator[str | int]:
        """The text as an id for each special token, and chunks that are encoded apart."""
        for part in self.split_special.split(text) if self.split_special else [text]:
            if part in self.special:
                yield self.special[part]
            else:
                yield from _CHUNK.findall(part)

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        split = [self.pattern.findall(chunk) for chunk in chunks]
        flat = list({piece for pieces in split for piece in pieces})
        found = dict(zip(flat, self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in flat]), strict=True))
        return [[k for piece in pieces for k in found[piece]] for pieces in split]

    def encode(self, text: str | None) -> list[int]:
        parts = list(self.chunks(text or ""))
        words = list({p for p in parts if isinstance(p, str)})
        found = dict(zip(words, self.encode_chunks(words), strict=True))
        return [k for p in parts for k in (found[p] if isinstance(p, str) else [p])]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens included; bytes that aren't UTF-8 become U+FFFD, unknown ids nothing."""
        return b"".join([self.bytes_of.get(k, b"") for k in ids]).decode("utf-8", "replace")


class _Worked:
    """A tokenizer with memories of chunks and pieces, whose values are their ids in decimal, each with a comma."""

    def __init__(self, path: str):
        self.bpe = Bpe(path)
        self.decimal = [b"%d," % k for k in range(self.bpe.size + len(self.bpe.special))]
        self.pieces = Memo(self._encoded, most=500_000)
        self.memo = Memo(self._split, most=800_000)

    def _encoded(self, pieces: list[str]) -> Iterator[bytes]:
        data = [p.encode("utf-8", "surrogatepass") for p in pieces]
        for piece, ids in zip(data, self.bpe.encode_pieces(data), strict=True):
            # Decoding is by bytes, so what holds for every piece holds for the text.
            if b"".join([self.bpe.bytes_of[k] for k in ids]) != piece:
                raise ValueError(f"{ids} don't decode to {piece!r}")
            yield b"".join([self.decimal[k] for k in ids])

    def _split(self, chunks: list[str]) -> Iterator[bytes]:
        find = self.bpe.pattern.findall
        split = [[c] if c[0] == " " and c[1:].isalpha() or c.isalpha() else find(c) for c in chunks]
        known = self.pieces.of({piece for found in split for piece in found})
        for found in split:
            yield known[found[0]] if len(found) == 1 else b"".join([known[piece] for piece in found])


_loaded: dict[str, _Worked] = {}


def _worked(path: str) -> _Worked:
    if path not in _loaded:
        _loaded[path] = _Worked(path)
    return _loaded[path]


def digested(texts: list[str], path: str) -> Iterator[tuple[int, bytes]]:
    """For each text: how many ids, and the ids in decimal joined by commas.

    Texts are worked on a stretch of chunks at a time, several short ones or a
    part of a long one, so that many new chunks are encoded together.
    """
    worked = _worked(path)
    held: list[tuple[bool, list[str], bytes]] = []
    size, ids = 0, []

    def flush() -> Iterator[tuple[int, bytes]]:
        nonlocal size
        known = worked.memo.of(set().union(*[chunks for _, chunks, _ in held])).__getitem__
        for last, chunks, special in held:
            ids.append(b"".join(map(known, chunks)))
            ids.append(special)
            if last:
                joined = b"".join(ids)
                yield joined.count(b","), joined[:-1]
                ids.clear()
        held.clear()
        size = 0

    for text in texts:
        for last, chunks, special in _stretches(text, worked):
            held.append((last, chunks, special))
            size += len(chunks)
            if size > STRETCH:
                yield from flush()
    yield from flush()


def _stretches(text: str, worked: _Worked) -> Iterator[tuple[bool, list[str], bytes]]:
    """Lists of chunks, each with the special token that follows it, in decimal; whether a list is the text's last."""
    bpe = worked.bpe
    parts = bpe.split_special.split(text) if bpe.split_special else [text]
    for k in range(0, len(parts), 2):
        special = worked.decimal[bpe.special[parts[k + 1]]] if k + 1 < len(parts) else b""
        chunks = []
        if len(parts[k]) <= STRETCH:  # in characters, of which a chunk has one at least
            chunks = _CHUNK.findall(parts[k])
        else:
            for found in _CHUNK.finditer(parts[k]):
                chunks.append(found[0])
                if len(chunks) >= STRETCH:
                    yield False, chunks, b""
                    chunks = []
        yield k + 1 >= len(parts), chunks, special


def decoded(ids: bytes, path: str) -> bytes:
    """The bytes that decimal ids joined by commas decode to."""
    bytes_of = _worked(path).bpe.bytes_of
    return b"".join([bytes_of[k] for k in np.fromstring(ids, np.int64, sep=",").tolist()]) if ids else b""


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for each row of ``docs``.

    The digests are of the decimal ids joined by commas, and of the text the
    ids decode to. A null text is empty: no ids, and the digests of nothing.
    Repeated rows come out as often as they come in, a null doc_id stays null,
    other columns play no part, and an empty table gives no rows. Rows stay in
    their tasks: nothing is shuffled.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames(stream):
            rows = []
            for count, ids in digested(frame["text"].tolist(), tokenizer):
                text = decoded(ids, tokenizer).decode("utf-8", "replace").encode("utf-8")
                rows.append((count, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()))
            n_tokens, ids_sha, decoded_sha = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(frame["doc_id"], pa.string(), from_pandas=True),
                    pa.array(n_tokens, pa.int64()),
                    pa.array(ids_sha, pa.string()),
                    pa.array(decoded_sha, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("text"))
    found = rows.mapInArrow(run, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def with_ids(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` as ``(doc_id, ids)``: the ids themselves, for pipelines that go on with them."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames(stream):
            found = [[int(k) for k in ids.split(b",") if k] for _, ids in digested(frame["text"].tolist(), tokenizer)]
            ids = pa.array(found, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(frame["doc_id"], pa.string(), from_pandas=True), ids], names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id string, ids array<int>").withColumn("doc_id", F.col("doc_id").cast("long"))

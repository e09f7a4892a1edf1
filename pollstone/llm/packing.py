"""Sequence packing by non-negative least squares over length combinations.

Documents are dealt to buckets of a fixed size by a hash of the row. Within a
bucket, full windows are cut off long documents; what remains of each document
has a length below the window, and the lengths have a histogram. Shallow
combinations of one to three lengths that fill a window (or, alone, a power of
two) are enumerated, and how often to use each is solved as a non-negative
least squares problem against the histogram. The counts are rounded, and what
they leave over is packed greedily: the longest first, cut where a window ends.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pollstone.llm.bpe import byte_letters
from pollstone.llm.common import parts, stored, text_or_empty

WINDOW = 2048
END = 1
#: Characters of text in a bucket, on average. A bucket is what one task holds at a time.
BUCKET_CHARS = 8_000_000
#: What a row counts for on top of its characters, so that short rows don't pile up in a bucket.
ROW_CHARS = 16
#: Rows that are equal are dealt to buckets by blocks of this share of a bucket.
BLOCKS = 4
#: Triples tried for each shortest length.
TRIPLES = 12

# Fixed: the kinds of lower-case characters up to U+00FF that the tokenizer splits words between (each digit stands alone).
_KINDS = np.full(256, 3, np.uint8)  # 0 blank, 1 letter, 2 digit, 3 other
_KINDS[[0x0A, 0x20]] = 0
_KINDS[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzªµº"] + [k for k in range(0xDF, 0x100) if k != 0xF7]] = 1
_KINDS[[ord(c) for c in "0123456789²³¹¼½¾"]] = 2
#: Words of these characters are, once in lower case, as the tokenizer's normaliser leaves them.
_PLAIN = re.compile(r"[!-&(-~\xa1-\xff]*")
_ALL_PLAIN = re.compile(r"[ \n!-&(-~\xa1-\xff]*")
#: Characters of a text that are worked on at a time.
STRETCH = 1 << 20

_loaded: dict[str, Words] = {}


class Words:
    """A word tokenizer. Plain texts go through another library's merge loop, other words through its own.

    A part of a word ends with a marker, which files write as ``</w>`` and here
    is the byte 0, as plain words have no such character. Then every token has
    its own string of bytes, and merging by the rank of the merged string is
    merging by the rank of the pair (a test holds that for all tokens).
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = tuple(t["content"] for t in spec["added_tokens"])
        end, vocab = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"]
        letters = byte_letters()
        back = {letter: byte for byte, letter in letters.items()}
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        self.ranks: dict[bytes, int] = {b"\0": 0}
        ids = [0]
        for token in [*letters.values(), *(c + end for c in letters.values()), *merges]:
            data = bytes(back[c] for c in token.removesuffix(end)) + b"\0" * token.endswith(end)
            if data not in self.ranks:
                self.ranks[data] = len(self.ranks)
                ids.append(vocab[token])
        self.ids = np.array(ids, "<u4")
        self.last = np.array([data.endswith(b"\0") for data in self.ranks])
        self.merge = tiktoken.Encoding("words", pat_str="[^\\x00]+\\x00", mergeable_ranks=self.ranks, special_tokens={})

    def merged(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a plain text: its characters, which of them end a part of a word, and the merged tokens."""
        data = np.frombuffer(text.lower().encode("latin-1"), np.uint8)
        kind = _KINDS[data]
        there = kind != 0
        ends = there.copy()
        ends[:-1] &= (kind[1:] != kind[:-1]) | (kind[:-1] == 2)
        kept, ending = data[there], ends[there]
        out = np.zeros(len(kept) + np.count_nonzero(ending), np.uint8)
        at = np.arange(len(kept))
        at[1:] += np.cumsum(ending[:-1])
        out[at] = kept
        return data, ends, np.array(self.merge.encode_ordinary(out.tobytes().decode("latin-1")), np.int64)

    def by_word(self, text: str) -> bytes:
        """Ids of any text, word by word: plain words are merged together, the tokenizer itself does the rest."""
        words = text.replace("\n", " ").split(" ")
        distinct = set(words)
        odd = [w for w in distinct if not _PLAIN.fullmatch(w) or any(token in w for token in self.special)]
        known = {}
        for word, ids in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False), strict=True):
            known[word] = np.array(ids.ids, "<u4").tobytes()
        plain = list(distinct.difference(odd))
        data, ends, found = self.merged("\n".join(plain))
        after = np.concatenate(([0], np.flatnonzero(self.last[found]) + 1))
        stops = np.concatenate((np.flatnonzero(data == 0x0A), [len(data)])) if plain else []
        cuts = (4 * after[np.concatenate(([0], np.cumsum(ends)))[stops]]).tolist() if plain else []
        body = self.ids[found].tobytes()
        known.update(zip(plain, [body[i:j] for i, j in zip([0, *cuts[:-1]], cuts, strict=True)], strict=True) if plain else ())
        return b"".join([known[word] for word in words])

    def __call__(self, text: str) -> bytes:
        """Ids of a text. No token spans a blank, so a long text is worked on from blank to blank."""
        found, start = [], 0
        while start < len(text):
            stop = text.find(" ", start + STRETCH)
            stop = len(text) if stop < 0 else stop
            part = text[start:stop]
            if _ALL_PLAIN.fullmatch(part) and not any(token in part for token in self.special):
                found.append(self.ids[self.merged(part)[2]].tobytes())
            else:
                found.append(self.by_word(part))
            start = stop
        return b"".join(found)


def token_ids(texts: list[str], path: str) -> Iterator[bytes]:
    """Each text's ids as little-endian unsigned 32-bit numbers, those of the tokenizer at ``path``."""
    if path not in _loaded:
        _loaded[path] = Words(path)
    return map(_loaded[path], texts)


def combinations(lengths: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Rows of up to three ascending lengths (0 fills up), each of which fills a window.

    Pairs and triples sum to the window; a single one is a power of two, which
    needs no padding. Of the triples, each shortest length tries a few second
    lengths spread over the whole range.
    """
    there = np.zeros(window + 1, bool)
    there[lengths[(lengths > 0) & (lengths < window)]] = True
    there[0] = False
    singles = [(0, 0, 1 << k) for k in range(window.bit_length()) if 1 << k < window and there[1 << k]]
    values = np.flatnonzero(there[: window // 2 + 1])
    pairs = [(0, int(a), window - int(a)) for a in values if there[window - a]]
    triples = []
    for a in np.flatnonzero(there[: window // 3 + 1]):
        seconds = np.flatnonzero(there[a : (window - a) // 2 + 1]) + a
        seconds = seconds[there[window - a - seconds]]
        step = max(1, len(seconds) // TRIPLES)
        triples += [(int(a), int(b), int(window - a - b)) for b in seconds[::step]]
    return np.array(singles + pairs + triples, np.int64).reshape(-1, 3)


def non_negative_counts(combos: np.ndarray, histogram: np.ndarray, rounds: int = 150) -> np.ndarray:
    """``x >= 0`` that minimises ``|A x - histogram|``; column j of ``A`` counts the lengths of combination j.

    Accelerated projected gradient; ``A`` is only ever used through its three rows per column.
    """
    if not len(combos):
        return np.zeros(0)
    target = histogram.astype(float).copy()
    target[0] = 0
    used = combos > 0

    def times(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(combos[:, k], x * used[:, k], len(target)) for k in range(3))

    def back(y: np.ndarray) -> np.ndarray:
        return sum(y[combos[:, k]] * used[:, k] for k in range(3))

    bound = float(back(times(np.ones(len(combos)))).max())  # of the largest eigenvalue, by row sums
    x = np.zeros(len(combos))
    look, momentum = x, 1.0
    for _ in range(rounds):
        step = np.maximum(0, look - back(times(look) - target) / bound)
        following = (1 + (1 + 4 * momentum * momentum) ** 0.5) / 2
        look = step + (momentum - 1) / following * (step - x)
        x, momentum = step, following
    return x


def pack(lengths: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` that hold each token of each document once."""
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    for doc in np.flatnonzero(lengths >= window).tolist():
        for k in range(int(lengths[doc]) // window):
            pieces.append((doc, k * window, window, sequence, 0))
            sequence += 1
    rest = lengths % window
    start = lengths - rest
    histogram = np.bincount(rest, minlength=window + 1)
    order = np.argsort(rest, kind="stable")
    ends = np.cumsum(histogram)
    begins = ends - histogram
    free = histogram.copy()
    free[0] = 0
    combos = combinations(rest, window)
    counts = non_negative_counts(combos, histogram)
    for j in np.argsort(-counts, kind="stable").tolist():
        combo = [int(c) for c in combos[j] if c]
        need = {c: combo.count(c) for c in combo}
        times = min(round(float(counts[j])), *(int(free[c]) // n for c, n in need.items()))
        for _ in range(max(0, times)):
            offset = 0
            for c in reversed(combo):
                free[c] -= 1
                doc = int(order[begins[c] + free[c]])
                pieces.append((doc, int(start[doc]), c, sequence, offset))
                offset += c
            sequence += 1
    offset = 0
    left = [int(order[begins[c] + k]) for c in range(window - 1, 0, -1) for k in range(int(free[c]))]
    total = int(rest[left].sum()) if left else 0
    room = window if total >= window else _power(total)
    for doc in left:
        at, remaining = int(start[doc]), int(rest[doc])
        while remaining:
            taken = min(remaining, room - offset)
            pieces.append((doc, at, taken, sequence, offset))
            at, remaining, offset, total = at + taken, remaining - taken, offset + taken, total - taken
            if offset == room:
                sequence, offset = sequence + 1, 0
                room = window if total >= window else _power(total)
    return pieces


def _power(n: int) -> int:
    """The largest power of two up to n; the last tokens end in windows of such lengths, without padding."""
    return 1 << max(0, n.bit_length() - 1)


def _dealt(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, bucket)`` for each row: by a hash of the row, and by block where many rows are equal.

    Which rows are so many is counted by hash, which shuffles no text. Those
    rows are counted whole, a row for each task, and their copies are numbered
    by blocks that are small next to a bucket. All other rows go straight to
    their buckets.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("text"))
    marked = rows.withColumn("h", F.expr("xxhash64(doc_id, text)"))
    size = (F.length("text") + ROW_CHARS).cast("long")
    counted = marked.groupBy("h").agg(F.sum(size).alias("size"), F.max(size).alias("longest"))
    total = stored(counted, "sizes")
    buckets = max(1, -(-int(total.agg(F.sum("size")).first()[0] or 0) // BUCKET_CHARS))
    block = max(1, BUCKET_CHARS // BLOCKS)
    hot = stored(total.where(f"size > {block} AND size > longest").select("h"), "hot")
    many = marked.join(hot, "h", "left_semi").groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    many = many.withColumn("some", F.greatest(F.lit(1), F.floor(F.lit(block) / size)).cast("long"))
    blocks = many.withColumn("block", F.expr("explode(sequence(0L, (copies - 1) DIV some))"))
    spread = blocks.repartition(parts(docs.sparkSession), "doc_id", "block")
    numbered = spread.withColumn("copy", F.expr("explode(sequence(1L, least(some, copies - block * some)))"))
    few = marked.join(hot, "h", "left_anti").select("doc_id", "text", F.expr(f"pmod(h, {buckets}L)").alias("bucket"))
    return few.unionByName(numbered.select("doc_id", "text", F.expr(f"pmod(xxhash64(doc_id, text, block), {buckets}L)").alias("bucket")))


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """One row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``.

    ``ids`` are the piece's token ids. Every row of ``docs`` ends with id END,
    so null and empty texts are that one token. Repeated rows are packed one by
    one; a null doc_id stays null. ``sequence_id`` is unique: its upper 32 bits
    are the bucket. Nothing comes from an empty table; other columns play no part.
    """
    keyed = _dealt(docs)

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "text"], ignore_index=True)
        end = np.array([END], "<u4").tobytes()
        ids = [found + end for found in token_ids(group["text"].tolist(), tokenizer)]
        lengths = np.array([len(x) // 4 for x in ids], np.int64)
        above = int(group["bucket"].iloc[0]) << 32
        names, out = group["doc_id"].tolist(), []
        for doc, start, length, sequence, offset in pack(lengths, window):
            piece = ids[doc][4 * start : 4 * (start + length)]
            out.append((names[doc], start, length, zlib.crc32(piece), int(lengths[doc]), above + sequence, offset, piece))
        columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "body"]
        return pd.DataFrame(out, columns=columns)

    shape = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, body binary"
    return keyed.groupBy("bucket").applyInPandas(fill, shape).withColumn("doc_id", F.col("doc_id").cast("long"))

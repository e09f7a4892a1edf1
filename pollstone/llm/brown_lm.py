"""A class-based bigram model: exchange clustering, smoothed, scored over all documents.

A word's probability is that of its class after the class before, times that of
the word within its class. All training words are clustered, by likelihood of
the training bigrams. The most frequent ones go through sweeps in which each
moves to its best class, some blocks of them in each sweep; meanwhile the others have
classes by their shape (last character, ASCII or not). Then all the others are
weighed, whatever their number: their neighbours' classes are counted in one
pass and gathered by word, and a word moves from its shape's class to its best
one if the log-likelihood gained is over log(CLASSES), what naming a class takes.
The end of a text has a class of its own.

Words travel as little as they have to. A dictionary of the most frequent ones,
of bounded size, is sent to all tasks and texts are written once as its numbers;
only rarer words go as text, and are joined with their classes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollstone.llm.common import frames, stored, text_or_empty

#: Words that are clustered in sweeps, words whose counts are sent to all tasks, and the longest such word.
CLUSTERED = 4096
SENT = 131_072
LONGEST = 64
CLASSES = 64
SWEEPS = 24
#: Blocks of bigrams, and every how many of them one is worked on in a sweep.
BLOCKS, TURNS = 24, 8
#: Log-likelihood that a move gains at least.
LEAST = 1e-6
#: Weight of a class's overall frequency in the frequency after another class, and of unseen words.
PRIOR, UNSEEN = 4.0, 0.1
#: What each known word leaves of its count to unseen words of its shape.
DISCOUNT = 0.5
#: Tokens whose contexts a task counts at a time, and contexts that it weighs at a time.
CHUNK, WEIGHED = 1 << 20, 20_000
#: Bytes of text that a task has as words at a time.
FRAME_BYTES = 2 << 20
END = "\n"  # no word has a line end
_END = END.encode()
OPEN = 8
#: By an ASCII character that a word ends with.
_KINDS = bytes(0 if c == "." else 1 if c == "," else 2 if c.isalnum() else 3 for c in map(chr, range(128)))
END_CLASS = CLASSES + OPEN
ALL_CLASSES = END_CLASS + 1
#: The state after each kind of token: its class or, for words that training lacks, the class of their shape.
_STATES = np.concatenate((np.arange(ALL_CLASSES), CLASSES + np.arange(OPEN)))
#: Numbers of words by the last of their characters, if all are ASCII (see FIRST_ID).
_ASCII_IDS = [-2 - 2 * kind for kind in _KINDS]
#: A class before a word or, shifted by all classes, after it, and how often.
_CONTEXT = np.dtype([("code", "u1"), ("n", "<u4")])
#: Numbers of tokens: a sent word's place, END_ID, or from FIRST_ID on the shape of a word that isn't sent.
END_ID, FIRST_ID = -1, -1 - OPEN


def open_class(word: bytes) -> int:
    """The class of a word that isn't clustered, by its shape."""
    if word == _END:
        return END_CLASS
    last = word[-1]
    kind = _KINDS[last] if last < 128 else 3 - word.decode()[-1].isalnum()
    return CLASSES + 2 * kind + (not word.isascii())


def tokens(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased, and the end."""
    # Of bytes, lower() changes A-Z only and split() goes by the six white space characters of WORD.
    words = text.lower().split()
    words.append(_END)
    return words


class _Numbers(dict[bytes, int]):
    """Numbers of words; a word that has none is noted in ``rare`` and gets the number of its shape."""

    rare: list[bytes]

    def __missing__(self, word: bytes) -> int:
        self.rare.append(word)
        return _ASCII_IDS[word[-1]] if word.isascii() else CLASSES - 2 - open_class(word)


@dataclass
class Model:
    """Counts of the sent words, classes by tokens' numbers, tokens of each class, its words by shape, tokens and words at all."""

    counts: np.ndarray
    classes: np.ndarray
    inside: np.ndarray
    shapes: np.ndarray
    total: int
    distinct: int

    @property
    def floor(self) -> float:
        return self.total + UNSEEN * (self.distinct + 1)

    def emission(self, n: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 of the share of a word with ``n`` > 0 occurrences in its class."""
        return np.log10((n - DISCOUNT) / (self.inside[classes] + UNSEEN))


def _rows(docs: DataFrame) -> DataFrame:
    """Rows with a key that repeated rows share, and whether they are held out; a null id counts as an empty one."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    return named.withColumns({"key": F.xxhash64("doc_id", "text"), "held_out": held})


def word_counts(rows: DataFrame) -> DataFrame:
    """``(word, n)`` of all training tokens."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for frame in frames(stream, FRAME_BYTES):
            for text in frame["text"]:
                found.update(tokens(text))
            if len(found) > 200_000:
                yield batch(found)
                found = Counter()
        yield batch(found)

    def batch(found: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

    some = rows.where("NOT held_out").select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "word string, n long")
    return stored(some.groupBy("word").agg(F.sum("n").alias("n")), "words")


def encoded(rows: DataFrame, sent: list[str]) -> DataFrame:
    """Each row's tokens as numbers, ``(key, doc_id, held_out, ids, rare)``; ``rare`` has the words that aren't sent, in order."""
    index = rows.sparkSession.sparkContext.broadcast({_END: END_ID} | {w.encode(): k for k, w in enumerate(sent)})

    def encode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Numbers(index.value)
        for frame in frames(stream, FRAME_BYTES):
            bodies, rare = [], []
            for text in frame["text"]:
                words = tokens(text)
                known.rare = []
                bodies.append(np.fromiter(map(known.__getitem__, words), "<i4", len(words)).tobytes())
                rare.append(known.rare)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(frame["key"], pa.int64()),
                    pa.array(frame["doc_id"], pa.string(), from_pandas=True),
                    pa.array(frame["held_out"], pa.bool_()),
                    pa.array(bodies, pa.binary()),
                    pa.array(rare, pa.list_(pa.string())),
                ],
                names=["key", "doc_id", "held_out", "ids", "rare"],
            )

    some = rows.select("key", F.col("doc_id").cast("string").alias("doc_id"), "held_out", F.col("text").cast("binary").alias("text"))
    return stored(some.mapInArrow(encode, "key long, doc_id string, held_out boolean, ids binary, rare array<string>"), "tokens", "zstd")


def _chunks(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """Numbers of all tokens of some rows, one after another, with the rows."""
    for batch in stream:
        sizes = np.cumsum(pc.binary_length(batch["ids"]).to_numpy()) // 4
        start = 0
        while start < batch.num_rows:
            done = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, done + CHUNK, "right")))
            part = batch.slice(start, stop - start)
            yield np.frombuffer(b"".join(part["ids"].to_pylist()), "<i4"), part
            start = stop


def _open_numbers(top: pd.DataFrame, clustered: np.ndarray) -> np.ndarray:
    """By a token's number less FIRST_ID: what ``clustered`` has for the first words, for others and the end the open class."""
    shapes = CLASSES + np.arange(OPEN + 1)
    others = top["class"].to_numpy(np.int64)[len(clustered) :]
    return np.concatenate((shapes[:-1][::-1], shapes[-1:], clustered, others))


def bigrams(numbered: DataFrame, top: pd.DataFrame) -> DataFrame:
    """Packed bigram counts ``(block, n, body)`` over nodes: the first words, then open classes and the end.

    A block has all pairs that some nodes are part of, in both directions. There
    are at most (CLUSTERED + 9) squared pairs, however large the corpus is.
    """
    nodes = CLUSTERED + OPEN + 1
    first = np.arange(min(CLUSTERED, len(top))) - CLUSTERED + CLASSES
    sent = numbered.sparkSession.sparkContext.broadcast(_open_numbers(top, first) + CLUSTERED - CLASSES)

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for ids, _ in _chunks(stream):
            at = sent.value[ids - FIRST_ID]
            before = np.concatenate(([nodes - 1], at[:-1]))
            held.append(np.unique(before * nodes + at, return_counts=True))
            if len(held) == 4:
                held = [_added(held)]
        if held:
            codes, n = _added(held)
            yield pa.RecordBatch.from_arrays([pa.array(codes // nodes, pa.int32()), pa.array(codes % nodes, pa.int32()), pa.array(n)], names=["u", "v", "n"])

    pairs = numbered.where("NOT held_out").select("ids").mapInArrow(count, "u int, v int, n long").groupBy("u", "v").agg(F.sum("n").alias("n"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        body = group[["u", "v", "n"]].to_numpy(np.int64).tobytes()
        return pd.DataFrame({"block": group["block"].iloc[:1], "n": [len(group)], "body": [body]})

    ends = F.array_distinct(F.array(F.col("u") % BLOCKS, F.col("v") % BLOCKS))
    blocks = pairs.withColumn("block", F.explode(ends))
    return stored(blocks.groupBy("block").applyInPandas(pack, "block int, n long, body binary"), "bigrams")


def _added(some: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, back = np.unique(np.concatenate([c for c, _ in some]), return_inverse=True)
    return codes, np.bincount(back, np.concatenate([n for _, n in some]), len(codes)).astype(np.int64)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def moves(nodes: np.ndarray, pairs: np.ndarray, assigned: np.ndarray, matrix: np.ndarray) -> list[tuple[int, int, float]]:
    """For each node its best class and the gain in log-likelihood; the nodes move one after another.

    ``pairs`` has rows ``(u, v, n)``, all that the nodes are part of.
    """
    out = []
    assigned = assigned.copy()
    by_left, by_right = pairs[np.argsort(pairs[:, 0], kind="stable")], pairs[np.argsort(pairs[:, 1], kind="stable")]
    count = len(matrix)
    for w in nodes.tolist():
        after = by_left[slice(*np.searchsorted(by_left[:, 0], [w, w + 1]))]
        before = by_right[slice(*np.searchsorted(by_right[:, 1], [w, w + 1]))]
        if not len(after) and not len(before):
            continue
        alone = float(after[after[:, 1] == w][:, 2].sum())
        right = np.bincount(assigned[after[:, 1]], after[:, 2] * (after[:, 1] != w), count)
        left = np.bincount(assigned[before[:, 0]], before[:, 2] * (before[:, 0] != w), count)
        own = int(assigned[w])
        without = matrix.copy()
        without[own] -= right
        without[:, own] -= left
        without[own, own] -= alone
        rows, columns = without.sum(axis=1), without.sum(axis=0)
        gain = (_xlogx(without + right) - _xlogx(without)).sum(axis=1) + (_xlogx(without + left[:, None]) - _xlogx(without)).sum(axis=0)
        d = np.diagonal(without)
        gain += _xlogx(d + right + left + alone) + _xlogx(d) - _xlogx(d + right) - _xlogx(d + left)
        gain -= _xlogx(rows + right.sum() + alone) - _xlogx(rows) + _xlogx(columns + left.sum() + alone) - _xlogx(columns)
        best = int(np.argmax(gain[:CLASSES]))
        out.append((w, best, float(gain[best] - gain[own])))
        if gain[best] - gain[own] > LEAST:
            assigned[w] = best
            without[best] += right
            without[:, best] += left
            without[best, best] += alone
            matrix = without
    return out


def cluster(packed: DataFrame, clustered: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all nodes, and the matrix of class bigrams. The driver sees one row for each clustered word."""
    assigned = np.concatenate((np.arange(CLUSTERED) % CLASSES, CLASSES + np.arange(OPEN + 1)))

    def matrix_of(now: np.ndarray) -> np.ndarray:
        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(ALL_CLASSES**2)
            for frame in batches:
                for block, body in zip(frame["block"], frame["body"], strict=True):
                    pairs = np.frombuffer(body, np.int64).reshape(-1, 3)
                    pairs = pairs[pairs[:, 0] % BLOCKS == block]  # each pair once, by its left node
                    total += np.bincount(now[pairs[:, 0]] * ALL_CLASSES + now[pairs[:, 1]], pairs[:, 2], ALL_CLASSES**2)
            cells = np.flatnonzero(total)
            yield pd.DataFrame({"cell": cells, "n": total[cells].astype(np.int64)})

        out = np.zeros(ALL_CLASSES**2)
        for row in packed.mapInPandas(add, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
            out[row["cell"]] = row["n"]
        return out.reshape(ALL_CLASSES, ALL_CLASSES)

    matrix = matrix_of(assigned)
    idle = 0
    for sweep in range(SWEEPS if clustered else 0):
        # Words that move at once all see the same classes and would crowd into one, so few blocks take part.
        turn = packed.where(F.col("block") % TURNS == sweep % TURNS)

        def best(batches: Iterator[pd.DataFrame], now=assigned, known=matrix) -> Iterator[pd.DataFrame]:
            for frame in batches:
                for block, body in zip(frame["block"], frame["body"], strict=True):
                    pairs = np.frombuffer(body, np.int64).reshape(-1, 3)
                    mine = np.arange(int(block), clustered, BLOCKS)
                    yield pd.DataFrame(moves(mine, pairs, now, known), columns=["w", "c", "gain"])

        assigned = assigned.copy()
        found = turn.repartition(BLOCKS, "block").mapInPandas(best, "w long, c long, gain double").where(F.col("gain") > LEAST).collect()
        for row in found:
            assigned[row["w"]] = row["c"]
        idle = 0 if found else idle + 1
        if idle == TURNS:
            break
        matrix = matrix_of(assigned)
    return assigned, matrix


def _whole(stream: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """Sorted rows, in batches that part no group of equal ``name``."""
    held: list[pa.RecordBatch] = []
    for batch in stream:
        if not batch.num_rows:
            continue
        differ = pc.not_equal(batch[name], batch[name][-1]).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(differ)[-1]) + 1 if differ.any() else 0
        if held and (cut or batch[name][0] != held[-1][name][0]):
            whole = pa.concat_batches([*held, batch.slice(0, cut)])
            held = []
            yield whole
        elif cut:
            yield batch.slice(0, cut)
        held.append(batch.slice(cut))
    if held:
        yield pa.concat_batches(held)


def _group_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's group of equal neighbours, and the first row of each."""
    new = np.ones(len(column), bool)
    new[1:] = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return np.cumsum(new) - 1, np.flatnonzero(new)


def _by_word(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """Rows sorted by the hash of their words, so that equal words are neighbours; with their groups, as in :func:`_group_of`."""
    word_of, firsts = _group_of(batch["word"])
    if len(firsts) > len(_group_of(batch["hash"])[1]):  # unlike words of one hash may lie mixed
        batch = batch.take(pc.sort_indices(batch["word"]))
        word_of, firsts = _group_of(batch["word"])
    return batch, word_of, firsts


def contexts(numbered: DataFrame, top: pd.DataFrame, numbers: np.ndarray, clustered: int) -> DataFrame:
    """``(word, rank, open, body)`` of the training words but the first ones: classes around them and how often, task by task.

    ``rank`` is the place of a sent word, -1 for others.
    """
    send = numbered.sparkSession.sparkContext.broadcast((numbers, pa.array(top["word"], pa.string())))

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, sent = send.value
        for ids, rows in _chunks(stream):
            classes = numbers[ids - FIRST_ID]
            at = np.flatnonzero((ids >= clustered) | (ids < END_ID))
            if not len(at):
                continue
            rare = rows["rare"].flatten().dictionary_encode()
            word = ids[at].astype(np.int64)
            word[word < 0] = len(sent) + rare.indices.to_numpy().astype(np.int64)
            before = np.where(at > 0, classes[at - 1], END_CLASS)
            codes = np.concatenate((word * 2 * ALL_CLASSES + before, word * 2 * ALL_CLASSES + ALL_CLASSES + classes[at + 1]))
            found, n = np.unique(codes, return_counts=True)
            word_of = found // (2 * ALL_CLASSES)
            starts = np.flatnonzero(np.diff(word_of, prepend=-1))
            body = np.empty(len(found), _CONTEXT)
            body["code"], body["n"] = found % (2 * ALL_CLASSES), n
            offsets = (np.append(starts, len(found)) * _CONTEXT.itemsize).astype(np.int32)
            some = word_of[starts]
            shape = np.zeros(len(sent) + len(rare.dictionary), np.int32)
            shape[word] = numbers[ids[at] - FIRST_ID]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([sent, rare.dictionary]).take(pa.array(some)),
                    pa.array(np.where(some < len(sent), some, -1), pa.int32()),
                    pa.array(shape[some], pa.int32()),
                    pa.BinaryArray.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(body.tobytes())]),
                ],
                names=["word", "rank", "open", "body"],
            )

    return numbered.where("NOT held_out").select("ids", "rare").mapInArrow(count, "word string, rank int, open int, body binary")


def _grown(n: np.ndarray, at: np.ndarray, of: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``_xlogx(of[at] + n) - _xlogx(of[at])``; ``table`` has it for all places and small n."""
    out = table[np.minimum(n, len(table) - 1), at]
    large = np.flatnonzero(n >= len(table))
    old = of[at[large]]
    out[large] = _xlogx(old + n[large].reshape(-1, *[1] * (old.ndim - 1))) - _xlogx(old)
    return out


def best_classes(word_of: np.ndarray, contexts: np.ndarray, own: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For words 0, 1, .. with their contexts: the class each goes to or its own, and how often the word is there."""
    codes, back = np.unique(word_of * 2 * ALL_CLASSES + contexts["code"], return_inverse=True)
    n = np.bincount(back, contexts["n"], len(codes)).astype(np.int64)
    word, code = codes // (2 * ALL_CLASSES), codes % (2 * ALL_CLASSES)
    count = int(word[-1]) + 1
    # Bigrams of each class with the class of a context, and those of each class at all.
    cells = np.concatenate((matrix[:, :CLASSES], matrix[:CLASSES].T))
    sums = np.stack((matrix.sum(axis=0)[:CLASSES], matrix.sum(axis=1)[:CLASSES]))
    small = np.arange(16)[:, None, None]
    of_cells, of_sums = (_xlogx(x + small) - _xlogx(x) for x in (cells, sums))
    left = np.bincount(word, n * (code < ALL_CLASSES), count).astype(np.int64)
    right = np.bincount(word, n * (code >= ALL_CLASSES), count).astype(np.int64)
    starts = np.searchsorted(word, np.arange(count))
    # What the words give where they are; the matrix has them there.
    there = np.concatenate((matrix, matrix.T))[code, own[word]]
    stay = np.bincount(word, _xlogx(there) - _xlogx(np.maximum(there - n, 0)), count)
    for side, total in enumerate((left, right)):
        there = matrix.sum(axis=side)[own]
        stay -= _xlogx(there) - _xlogx(there - total)
    best = np.empty(count, np.int32)
    for first, last in _cuts(starts, len(word)):
        part = slice(starts[first], starts[last] if last < count else len(word))
        gain = np.add.reduceat(_grown(n[part], code[part], cells, of_cells), starts[first:last] - starts[first])
        for side, total in enumerate((left, right)):
            gain -= _grown(total[first:last], np.full(last - first, side), sums, of_sums)
        # All words are weighed at once and would meet in a class without words, whatever they are.
        gain[:, sums.sum(axis=0) == 0] = -np.inf
        leaves = gain.max(axis=1) - stay[first:last] > np.log(CLASSES)
        best[first:last] = np.where(leaves, np.argmax(gain, axis=1), own[first:last])
    return best, left


def _cuts(starts: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """Ranges of words with about WEIGHED contexts each."""
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + WEIGHED)))
        yield first, last
        first = last


def lexicon(numbered: DataFrame, top: pd.DataFrame, assigned: np.ndarray, clustered: int, matrix: np.ndarray) -> DataFrame:
    """``(word, rank, open, class, n)`` of all training words but the first ones, each in its best class."""
    numbers = _open_numbers(top, assigned[:clustered])

    def assign(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole(stream, "hash"):
            batch, word_of, firsts = _by_word(batch)
            body = np.frombuffer(b"".join(batch["body"].to_pylist()), _CONTEXT)
            sizes = pc.binary_length(batch["body"]).to_numpy() // _CONTEXT.itemsize
            one = batch.take(pa.array(firsts))
            best, n = best_classes(np.repeat(word_of, sizes), body, one["open"].to_numpy(), matrix)
            yield pa.RecordBatch.from_arrays(
                [one["word"], one["rank"], one["open"], pa.array(best, pa.int32()), pa.array(n, pa.int64())],
                names=["word", "rank", "open", "class", "n"],
            )

    # One column of numbers is sorted by its digits, text by comparing rows.
    gathered = contexts(numbered, top, numbers, clustered).repartition("word").withColumn("hash", F.xxhash64("word")).sortWithinPartitions("hash")
    return stored(gathered.mapInArrow(assign, "word string, rank int, open int, class int, n long"), "lexicon", "zstd")


def fit(rows: DataFrame) -> tuple[Model, DataFrame, DataFrame]:
    """The model from the training rows, all rows' tokens as numbers, and the words that aren't sent with their classes."""
    counts = word_counts(rows)
    ends = F.sum(F.when(F.col("word") == END, F.col("n")))
    total, distinct, ends = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(ends, F.lit(0))).first()
    top = counts.where(F.length("word") <= LONGEST).where(F.col("word") != END).orderBy(F.desc("n"), "word").limit(SENT).toPandas()
    top["class"] = np.fromiter((open_class(word.encode()) for word in top["word"]), np.int64, len(top))
    numbered = encoded(rows, top["word"].tolist())
    clustered = min(CLUSTERED, len(top))
    assigned, matrix = cluster(bigrams(numbered, top), clustered)
    others = lexicon(numbered, top, assigned, clustered, matrix)
    classes = _open_numbers(top, assigned[:clustered])
    for row in others.where("rank >= 0").select("rank", "class").collect():
        classes[row["rank"] - FIRST_ID] = row["class"]
    # Tokens of a class, and its words by shape.
    inside, shapes = np.zeros(ALL_CLASSES), np.zeros((END_CLASS, OPEN))
    inside[END_CLASS] = ends
    for row in others.groupBy("class", "open").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        inside[row["class"]] += row["n"]
        shapes[row["class"], row["open"] - CLASSES] += row["v"]
    for c, shape, n in zip(assigned[:clustered], top["class"][:clustered], top["n"][:clustered], strict=True):
        inside[c] += n
        shapes[c, shape - CLASSES] += 1
    model = Model(top["n"].to_numpy(np.int64), classes, inside, shapes, int(total), int(distinct))
    return model, numbered, others.where("rank < 0").select("word", "class", "n")


_CLASSED = "key long, copies long, doc_id string, held_out boolean, seq binary, n_known long, base double, score double"


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(",")]


def _first_ones(keys: pa.Array, seen: set[int]) -> np.ndarray:
    """Which keys the task hasn't seen before."""
    return np.array([not (k in seen or seen.add(k)) for k in keys.to_pylist()])


def classed(numbered: DataFrame, others: DataFrame, model: Model) -> DataFrame:
    """Per different row the classes of its tokens and what doesn't hang on the order of classes.

    ``(key, copies, doc_id, held_out, seq, n_known, base, score)``: ``score`` is
    the words' share in their classes so far. Words that aren't sent are joined
    with their classes and go back to their places. A task sends equal rows once.
    """
    sent = numbered.sparkSession.sparkContext.broadcast(model)

    def spread(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, seen = sent.value, set()
        emit, base = np.zeros(len(m.classes)), np.zeros(len(m.classes))
        words = slice(-FIRST_ID, None)
        emit[words] = m.emission(m.counts, m.classes[words])
        base[words] = np.log10((m.counts + UNSEEN) / m.floor)
        base[END_ID - FIRST_ID] = np.log10((m.inside[END_CLASS] + UNSEEN) / m.floor)
        there = np.arange(len(m.classes)) >= -FIRST_ID
        there[END_ID - FIRST_ID] = m.inside[END_CLASS] > 0
        seqs = np.where(np.arange(len(m.classes)) < END_ID - FIRST_ID, np.arange(len(m.classes)) + FIRST_ID, m.classes).astype(np.int8)
        for ids, rows in _chunks(stream):
            sizes = pc.binary_length(rows["ids"]).to_numpy() // 4
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            at = ids - FIRST_ID
            new = _first_ones(rows["key"], seen)
            flat = seqs[at].tobytes()
            bodies = [flat[a : a + n] if w else None for a, n, w in zip(starts.tolist(), sizes.tolist(), new.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    rows["key"],
                    pa.array(np.ones(rows.num_rows, np.int64)),
                    rows["doc_id"],
                    rows["held_out"],
                    pa.array(bodies, pa.binary()),
                    pa.array(np.add.reduceat(there[at].astype(np.int64), starts), pa.int64()),
                    pa.array(np.add.reduceat(base[at], starts)),
                    pa.array(np.add.reduceat(emit[at], starts)),
                ],
                names=_names(_CLASSED),
            )

    def places(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for ids, rows in _chunks(stream):
            sizes = pc.binary_length(rows["ids"]).to_numpy() // 4
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            row_of = np.repeat(np.arange(len(sizes)), sizes)
            rare = np.flatnonzero(ids < END_ID)
            kept = _first_ones(rows["key"], seen)[row_of[rare]]
            place = rare[kept]
            of = row_of[place]
            yield pa.RecordBatch.from_arrays(
                [rows["key"].take(pa.array(of)), pa.array(place - starts[of], pa.int32()), rows["rare"].flatten().filter(pa.array(kept))],
                names=["key", "pos", "word"],
            )

    def gather(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in _whole(stream, "key"):
            group, firsts = _group_of(batch["key"])
            order = np.lexsort((batch["pos"].to_numpy(), group))
            pos = batch["pos"].to_numpy()[order]
            row = dict(zip(_names(_CLASSED)[1:], batch["doc"].flatten(), strict=True))
            copies = np.bincount(group, pc.fill_null(row["copies"], 0).to_numpy(), len(firsts)).astype(np.int64)
            full = np.flatnonzero(pc.is_valid(row["seq"]).to_numpy(zero_copy_only=False))
            full = full[np.diff(group[full], prepend=-1) > 0]
            docs = {name: column.take(pa.array(full)) for name, column in row.items()}
            bodies = docs["seq"].to_pylist()
            seq = np.frombuffer(bytearray(b"".join(bodies)), np.int8)
            sizes = np.array([len(b) for b in bodies])
            # The same word of equal rows comes once from each task.
            once = (pos >= 0) & ((np.diff(group, prepend=-1) > 0) | (np.diff(pos, prepend=-1) > 0))
            found = order[once]
            n = pc.fill_null(batch["n"], 0).to_numpy()[found]
            slots = np.flatnonzero(seq < END_ID)
            unseen = ALL_CLASSES + END_ID - 1 - seq[slots].astype(np.int64)
            c = np.where(n > 0, pc.fill_null(batch["class"], 0).to_numpy()[found], unseen)
            seq[slots] = c
            of = group[once]
            emit = np.where(n > 0, m.emission(np.maximum(n, 1), _STATES[c]), 0)
            base = np.log10((n + UNSEEN) / m.floor)
            sums = [np.bincount(of, x, len(firsts)) for x in (n > 0, base, emit)]
            body, ends = seq.tobytes(), np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"].take(pa.array(full)),
                    pa.array(copies, pa.int64()),
                    docs["doc_id"],
                    docs["held_out"],
                    pa.array([body[e - k : e] for e, k in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.binary()),
                    pa.array(docs["n_known"].to_numpy() + sums[0].astype(np.int64), pa.int64()),
                    pa.array(docs["base"].to_numpy() + sums[1], pa.float64()),
                    pa.array(docs["score"].to_numpy() + sums[2], pa.float64()),
                ],
                names=_names(_CLASSED),
            )

    words = numbered.select("key", "ids", "rare").mapInArrow(places, "key long, pos int, word string").join(others, "word", "left")
    docs = numbered.select("key", "doc_id", "held_out", "ids").mapInArrow(spread, _CLASSED)
    # A row of its own for the document, besides its words.
    doc = F.struct(*_names(_CLASSED)[1:]).alias("doc")
    whole = docs.select("key", F.lit(-1).alias("pos"), doc).unionByName(words.select("key", "pos", "class", "n"), allowMissingColumns=True)
    dealt = whole.repartition("key").sortWithinPartitions("key")  # places are put in order in gather, which costs less
    return stored(dealt.mapInArrow(gather, _CLASSED), "classed", "zstd")


def _steps(seqs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each token's step, from a state to a kind of token, as a cell of the matrix, and where the rows begin."""
    flat = np.frombuffer(b"".join(seqs), np.int8).astype(np.int64)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in seqs])[:-1])).astype(np.int64)
    before = np.concatenate(([END_CLASS], _STATES[flat[:-1]]))
    before[starts] = END_CLASS
    return before * len(_STATES) + flat, starts


def transitions(docs: DataFrame, model: Model) -> np.ndarray:
    """log10 of the frequency of each class after each state, from the training rows, and of an unseen word of each shape."""
    width = len(_STATES)

    def add(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ALL_CLASSES * width)
        for frame in frames(stream, FRAME_BYTES):
            cells, _ = _steps(frame["seq"].tolist())
            total += np.bincount(cells, np.repeat(frame["copies"].to_numpy(), [len(s) for s in frame["seq"]]), len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some].astype(np.int64))], names=["cell", "n"])

    matrix = np.zeros(ALL_CLASSES * width)
    counted = docs.where("NOT held_out").select("seq", "copies").mapInArrow(add, "cell long, n long")
    for row in counted.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        matrix[row["cell"]] = row["n"]
    matrix = matrix.reshape(ALL_CLASSES, width)[:, :ALL_CLASSES]
    # Every class gets a share, so that what training hasn't seen has a probability.
    overall = (matrix.sum(axis=0) + UNSEEN) / (matrix.sum() + UNSEEN * ALL_CLASSES)
    share = (matrix + PRIOR * overall) / (matrix.sum(axis=1, keepdims=True) + PRIOR)
    # What known words leave to those unseen, of whom there may be as many.
    left = (DISCOUNT * model.shapes + UNSEEN / OPEN) / (model.inside[:END_CLASS, None] + UNSEEN)
    unseen = share[:, :END_CLASS] @ left / (model.shapes.sum(axis=0) + 1)
    return np.log10(np.hstack((share, unseen)))


def score_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for each row of ``docs``.

    Scores are sums of log10 probabilities over the words and the end. A null
    text is empty and scores its end. A row without a doc_id is treated as if
    the id were an empty text, and so held out. Repeated rows come out as often
    as they come in. With no training rows every token is unknown; an empty
    table gives no rows; other columns play no part.
    """
    model, numbered, others = fit(_rows(docs))
    rows = classed(numbered, others, model)
    sent = rows.sparkSession.sparkContext.broadcast(transitions(rows, model).ravel())

    shape = "copies long, doc_id string, held_out boolean, n_known long, base double, n_tokens long, score double"
    names = _names(shape)

    def score(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if not batch.num_rows:
                continue
            cells, starts = _steps(batch["seq"].to_pylist())
            steps = np.add.reduceat(sent.value[cells], starts)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[name] for name in names[:-2]],
                    pc.binary_length(batch["seq"]).cast(pa.int64()),
                    pa.array(batch["score"].to_numpy() + steps),
                ],
                names=names,
            )

    each = rows.mapInArrow(score, shape).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )

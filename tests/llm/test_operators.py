"""Operators against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and odd columns."""

import hashlib
import html
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pollstone.llm import (
    bpe,
    brown_lm,
    decision_list,
    list_join,
    maxscore,
    packing,
    page_diff,
    pivot_neardup,
    sharding,
    suffix_dedup,
)

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHAPE = "doc_id long, text string, key string, bucket int, n_bytes int"
PASSAGE = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf"
ROWS = [
    (1, f"{PASSAGE} once", "a", 1, None),
    (2, f"Again {PASSAGE} twice", None, 2, 5),
    (3, f"{PASSAGE} once", "c", None, 5),
    (3, f"{PASSAGE} once", "c", None, 5),
    (4, "", None, 0, 0),
    (5, None, None, None, None),
    (None, f"{PASSAGE} once", "x", 1, 1),
    (6, "é" * 60 + " naïve ² <|endoftext|> it's", "x", 1, 1),
    (7, "word " * 30_000, "long", 1, 1),
    (8, "x" * 3_000, "one word", 1, 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SHAPE)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def removed_by_hand(rows):
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - 49) if doc is not None else ():
            first[data[i : i + 50]] = min(doc, first.get(data[i : i + 50], doc))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 49) if doc is not None else ():
            if first[data[i : i + 50]] < doc:
                gone[i : i + 50] = True
        spans = int((np.diff(np.concatenate(([0], gone, [0]))) == 1).sum()) if len(data) else 0
        rest = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_suffix_dedup(request, which):
    frame = request.getfixturevalue(which)
    found = suffix_dedup.dedup_substrings(frame).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, found), key=str) == removed_by_hand([(r.doc_id, r.text) for r in frame.collect()])


def test_suffix_dedup_deals_common_grams_by_string(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARED", 1)
    found = suffix_dedup.dedup_substrings(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, found), key=str) == removed_by_hand([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("partitions", [7, 51, 200])
def test_suffix_dedup_at_any_number_of_partitions(spark, docs, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = suffix_dedup.dedup_substrings(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
        assert sorted(map(tuple, found), key=str) == removed_by_hand([(r.doc_id, r.text) for r in docs.collect()])
        cut = suffix_dedup.without_repeats(docs)
        assert sum(r.n for r in cut.select(F.octet_length(F.coalesce("text", F.lit(""))).alias("n")).collect()) <= sum(
            r.n_bytes - r.n_removed for r in found
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_suffix_dedup_hands_columns_on(odd, none):
    found = suffix_dedup.without_repeats(odd)
    assert found.columns == odd.columns and found.count() == odd.count()
    assert found.where("doc_id = 5 AND text IS NULL").count() == 1
    assert suffix_dedup.dedup_substrings(none).count() == 0


def test_longest_previous_factor():
    draw = np.random.default_rng(1)
    for _ in range(200):
        n = int(draw.integers(1, 30))
        source, lcp = draw.integers(0, 5, n), draw.integers(0, 6, n)
        lcp[0] = 0
        want = [max([min(lcp[min(i, j) + 1 : max(i, j) + 1]) for j in range(n) if source[j] < source[i]], default=0) for i in range(n)]
        assert suffix_dedup.longest_previous_factor(source, lcp).tolist() == want


def test_sharding(odd, none, docs):
    assert sharding.shard(none).count() == 0
    assert sharding.shard(odd, 1000).count() == len(ROWS)
    found = sharding.shard(docs, 20_000).collect()
    sizes = {}
    for r in found:
        sizes.setdefault(r.shard, []).append(r.n_bytes)
    assert all(sum(v) <= 20_000 or len(v) == 1 for v in sizes.values())
    assert all(sum(sizes[r.shard]) == r.shard_bytes and len(sizes[r.shard]) == r.shard_docs for r in found)
    assert not any(a != b and b.startswith(a) for a in sizes for b in sizes)


def test_brown_scores(odd, none, docs):
    rows = docs.collect()
    lower = {k: k + 32 for k in range(65, 91)}
    words = {r.doc_id: [*WORD.findall((r.text or "").translate(lower)), "\n"] for r in rows}
    counts = {}
    for doc, some in words.items():
        if zlib.crc32(str(doc).encode()) % 10:
            for w in some:
                counts[w] = counts.get(w, 0) + 1
    total, floor = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    base = score = 0.0
    for r in brown_lm.score_documents(docs).collect():
        some = words[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(some), sum(w in counts for w in some), total)
        assert r.base_score == pytest.approx(sum(np.log10((counts.get(w, 0) + 0.1) / floor) for w in some))
        if r.held_out:
            base, score = base + r.base_score, score + r.score
    assert score > base
    assert brown_lm.score_documents(odd).count() == len(ROWS)
    assert brown_lm.score_documents(none).count() == 0


def test_brown_tokens():
    # Characters that are white space to str.split alone, Turkish and Greek capitals, ends of all shapes.
    text = "A\x1cB\x85 \xa0c\u2028D\x0bİx, Σ. \u3000 naïve\r\n! ² a٣ \x00\tÉ-"
    words = WORD.findall(text.encode().lower().decode())
    assert [w.decode() for w in brown_lm.tokens(text.encode())] == [*words, "\n"]
    assert brown_lm.tokens(b"") == [b"\n"]
    for w in words:
        kind = 0 if w[-1] == "." else 1 if w[-1] == "," else 2 if w[-1].isalnum() else 3
        assert brown_lm.open_class(w.encode()) == brown_lm.CLASSES + 2 * kind + (not w.isascii())


def test_brown_clusters_all_words(spark):
    # Words too long to be sent, and so never among the first ones, alike in shape.
    after_the, after_of = ([f"{c * 70}{i}x" for i in range(30)] for c in "ab")
    texts = [f"the {v} runs home now of {w} sleeps there" for v, w in zip(after_the, after_of, strict=True) for _ in range(8)]
    texts += ["the cat runs home now of dog sleeps there"] * 300
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, _, others = brown_lm.fit(brown_lm._rows(frame))
    classes = {r["word"]: r["class"] for r in others.collect()}
    assert set(classes) == {*after_the, *after_of}
    found = [{classes[w] for w in some} for some in (after_the, after_of)]
    assert not found[0] & found[1] and max(found[0] | found[1]) < brown_lm.CLASSES
    # A word whose neighbours are those of class 5 goes there, one at home among its shape stays.
    matrix = np.zeros((brown_lm.ALL_CLASSES, brown_lm.ALL_CLASSES))
    matrix[3, 5], matrix[5, 4], matrix[3, 64], matrix[64, 4], matrix[1, 64], matrix[64, 2] = 900, 900, 11, 11, 500, 500
    contexts = np.array([(3, 10), (73 + 4, 10), (1, 1), (73 + 2, 1)], brown_lm._CONTEXT)
    best, n = brown_lm.best_classes(np.array([0, 0, 1, 1]), contexts, np.array([64, 64]), matrix)
    assert best.tolist() == [5, 64] and n.tolist() == [10, 1]


def test_brown_words_are_brought_together_by_hash(spark):
    """Rows are sorted by one number each; words that share a hash still make groups of their own."""
    hashes = pa.array([1, 1, 1, 1, 2, 2, 3], pa.int64())
    mixed = pa.RecordBatch.from_arrays([pa.array(["b", "a", "b", "a", "c", "c", "a1"]), hashes], names=["word", "hash"])
    batch, word_of, firsts = brown_lm._by_word(mixed)
    words = batch["word"].to_pylist()
    assert sorted(words) == sorted(mixed["word"].to_pylist()) and len(firsts) == 4
    assert len({(w, g) for w, g in zip(words, word_of.tolist(), strict=True)}) == 4
    alone = mixed.slice(4)
    assert brown_lm._by_word(alone)[0].equals(alone)
    rows = brown_lm._rows(spark.createDataFrame([(k, f"word{k % 7} once{k}") for k in range(200)], "doc_id long, text string"))
    assert brown_lm.word_counts(rows).columns == ["word", "n"]


def test_maxscore(spark):
    draw = np.random.default_rng(2)
    vectors = [(k, [float(x) for x in draw.normal(0, 0.1, 8)]) for k in range(60)] + [(k, [0.5] * 8) for k in range(60, 130)]
    bad = [(200, None), (300, [0.1, None]), (400, [float("nan")] * 8), (None, [1.0] * 8), (0, vectors[0][1])]
    frame = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<double>")
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in maxscore.search_every(frame).collect()}
    whole = {k: np.floor(1024 * np.array(v)).astype(int) for k, v in vectors}
    for q in (0, 100):
        want = sorted((-int(whole[q] @ v), k) for k, v in whole.items() if k != q)[:10]
        assert [found[q, r] for r in range(1, 11)] == [(k, -s) for s, k in want]
    assert len(found) == 20
    assert maxscore.search_every(frame.where("false")).count() == 0


def test_page_text(spark):
    def page(body, k):
        return f"<html><body><div>Top of site</div><p>{body}</p><p>Own {k}</p><div class='ad'>Buy</div><div>Foot</div></body></html>"

    rows = [(k, f"http://a.b/x/{k}", page(f"Text &amp; more {k}", k)) for k in range(4)]
    rows += [(9, None, None), (10, "http://c.d/", "<article><h1>T</h1><p>one<br>two</p></article><footer>f</footer>"), (11, "nonsense", "")]
    found = {r.page_id: r for r in page_diff.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[k].text == f"Text & more {k}\n\nOwn {k}" for k in range(4))
    assert found[9].text == "" and found[11].text == "" and found[10].text == "T\n\none two" and found[10].n_chars == 10
    assert page_diff.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    a, b = [1, 2, 3, 4, 2, 5], [2, 9, 3, 2, 5, 1]
    assert [a[k] for k in page_diff.common(a, b)] == [2, 3, 2, 5]
    assert html.unescape("&lt;") == "<"


def test_neighbours_decide_lines_outside_articles(spark):
    def page(k):
        return f"<div>Top of site</div><div>Text {k}</div><div>More {k}</div><article>Teaser</article><div>Foot</div>"

    rows = [(k, f"http://a.b/x/{k}", page(k)) for k in range(3)] + [(9, "http://alone.b/", page(9))]
    found = {r.page_id: r.text for r in page_diff.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {k: f"Text {k}\n\nMore {k}\n\nTeaser" for k in range(3)} | {9: "Teaser"}


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_packing(request, which):
    frame = request.getfixturevalue(which)
    own = Tokenizer.from_file(WORDS)
    pieces, sequences = {}, {}
    for p in packing.pack_documents(frame, WORDS).collect():
        pieces.setdefault(p.doc_id, []).append((p.start, p.length, p.body))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert p.ids_crc32 == zlib.crc32(p.body)
    want = {}
    for r in frame.collect():
        ids = [*own.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.setdefault(r.doc_id, []).append(np.array(ids, "<u4").tobytes())
    assert set(pieces) == set(want)
    assert all(sum(len(x[2]) for x in pieces[d]) == sum(map(len, want[d])) for d in want)
    assert all(b"".join(x[2] for x in sorted(pieces[d])) == want[d][0] for d in want if len(want[d]) == 1)
    for some in sequences.values():
        ends = 0
        for offset, length in sorted(some):
            assert offset == ends
            ends += length
        assert ends <= 2048


def test_equal_rows_are_dealt_to_many_buckets(spark, monkeypatch):
    """A third of all rows are equal, once with a doc_id and once without; no bucket holds more than its share."""
    monkeypatch.setattr(packing, "BUCKET_CHARS", 4_000)
    texts = [(7, "hot words of a row", 400), (None, "hot words without an id", 400), (8, None, 300)]
    rows = [(k, f"own words {k}") for k in range(100, 500)] + [(k, text) for k, text, n in texts for _ in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    dealt = packing._dealt(frame)
    assert sorted(map(str, ((r.doc_id, r.text) for r in dealt.collect()))) == sorted(str((k if k is None else str(k), t or "")) for k, t in rows)
    sizes = dealt.groupBy("bucket").agg(F.sum(F.length("text") + packing.ROW_CHARS).alias("size"), F.count("*").alias("n")).collect()
    assert len(sizes) > 8 and max(r["size"] for r in sizes) < 4 * 4_000
    own = Tokenizer.from_file(WORDS)
    want = {}
    for k, text in rows:
        want[k] = want.get(k, 0) + len(own.encode(text or "", add_special_tokens=False).ids) + 1
    packed = packing.pack_documents(frame, WORDS)
    assert {r.doc_id: r.n for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == want
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.expr("offset + length")).alias("e")).where("n <> e").isEmpty()


def test_merged_strings_have_one_way_to_arise():
    """Merging by strings and by pairs agree: with lower ranks only, each token's bytes end as two tokens at most."""
    words = packing.Words(WORDS)
    ranks = sorted(words.ranks.items(), key=lambda x: x[1])
    for token, rank in ranks[1000::97]:
        if len(token) < 3 or rank < 600:
            continue
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 1:
            low = min((words.ranks.get(a + b, rank), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if low[0] >= rank:
                break
            parts[low[1] : low[1] + 2] = [parts[low[1]] + parts[low[1] + 1]]
        assert len(parts) == 2


def test_empty_tables_pack_and_link(none, odd):
    assert packing.pack_documents(none, WORDS).count() == 0
    assert pivot_neardup.near_duplicates(none).count() == 0
    kept = pivot_neardup.first_of_groups(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 4, 6, 7, 8]


def test_near_duplicates(docs):
    found = pivot_neardup.near_duplicates(docs).collect()
    prints = np.array([r.fp for r in found], np.int64).view(np.uint64)
    reach = {r.doc_id: r.doc_id for r in found}
    changed = True
    near = [np.flatnonzero(np.bitwise_count(prints ^ p) <= 2).tolist() for p in prints]
    while changed:
        changed = False
        for k, others in enumerate(near):
            low = min(reach[found[j].doc_id] for j in others)
            if low < reach[found[k].doc_id]:
                reach[found[k].doc_id], changed = low, True
    assert {r.doc_id: r.component_id for r in found} == reach


def test_quality_counts_and_rules(spark, odd, none, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = decision_list.quality_rows(odd, labels)
    for r, text in zip(rows.where("doc_id = 7 OR doc_id = 2").orderBy("doc_id").collect(), (ROWS[1][1], ROWS[8][1]), strict=True):
        assert r.n_words == len(WORD.findall(text))
    by = {r.doc_id: r for r in rows.collect()}
    assert by[7].n_repeat_words == 30_000 and by[7].base_failed and not by[7].kept
    assert by[5].n_words == 0 and by[5].base_failed and by[2].n_repeat_words == 0
    assert decision_list.quality_rows(none, labels).count() == 0
    empty = labels.where("false")
    assert decision_list.keep_good(odd, empty).columns == odd.columns


def counts_by_hand(text):
    """Words, their characters, symbols, repeated lines, words in repeated windows, and the base rule, as the contract says."""
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k : k + 8]), []).append(k)
    repeated = {k + j for places in windows.values() if len(places) > 1 for k in places for j in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def test_quality_counts_by_hand(spark, odd, docs, folder):
    """All counts of each document of a table, and of odd ones."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for frame in (odd, docs):
        want = sorted(str((r.doc_id, *counts_by_hand(r.text))) for r in frame.collect())
        found = decision_list.quality_rows(frame, labels).collect()
        names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert sorted(str(tuple(r[name] for name in names)) for r in found) == want
        assert not any(r.kept for r in found if r.base_failed)


def test_fingerprints_by_hand(odd, docs):
    """Every bit counted one by one, over the shingles of whole texts."""
    for frame in (odd, docs):
        want = {}
        for r in frame.where("doc_id IS NOT NULL").collect():
            words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), r.text or ""))
            shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
            hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in shingles]
            bits = [sum(h >> k & 1 for h in hashes) for k in range(64)]
            want[r.doc_id] = f"{sum(1 << k for k in range(64) if 2 * bits[k] > len(hashes)):016x}"
        found = {r.doc_id: f"{r.fp & (1 << 64) - 1:016x}" for r in pivot_neardup.near_duplicates(frame).where("doc_id IS NOT NULL").collect()}
        assert found == want


def test_url_lists(spark):
    pages = spark.createDataFrame([(1, "http://a.b.c/x/y", "2022-05-01"), (2, "http://a.b.c/x/y", "2022-01-01"), (3, None, "2022-05-01"), (4, "http://a.b.c/z", None)], "page_id long, url string, on string")
    captures = pages.selectExpr("page_id", "url", "cast(on as date) AS fetched_on", "'mine' AS verdict")
    entries = spark.createDataFrame(
        [
            ("domain", "b.c", "block", "add", "2022-02-01"),
            ("prefix", "a.b.c/x", "allow", "add", "2022-03-01"),
            ("prefix", "a.b.c/x", "allow", "remove", "2022-04-01"),
            ("host", "A.B.C", "block", "add", "2022-05-01"),
            ("host", "a.b.c", "block", "add", "2022-05-01"),
            ("host", None, "block", "add", "2022-05-01"),
        ],
        "kind string, pattern string, listing string, action string, listed_on string",
    )
    found = {r.page_id: (r.verdict, r.pattern, r.n_active) for r in list_join.verdicts(captures, entries, fetched="fetched_on").collect()}
    assert found == {1: ("block", "a.b.c", 2), 2: ("none", None, 0), 3: ("none", None, 0), 4: ("none", None, 0)}
    assert list_join.verdicts(captures.where("false"), entries, fetched="fetched_on").count() == 0


@pytest.mark.parametrize("which", ["odd", "docs", "none"])
def test_bpe(request, which):
    frame = request.getfixturevalue(which)
    own = Tokenizer.from_file(BYTES)
    want = []
    for r in frame.collect():
        ids = own.encode(r.text or "", add_special_tokens=False).ids
        back = own.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, bpe.encode_documents(frame, BYTES).collect()), key=str) == sorted(want, key=str)
    assert bpe.Bpe(BYTES).encode("a  b\n\nc's") == own.encode("a  b\n\nc's").ids

"""Registered corpus queries against their SQL, and the pipeline's stages on a small table."""

import itertools
import re
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from acceptance import compare as comparing

import corpus_pipeline
from pollstone.llm import close_texts
from pollstone.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, folder, monkeypatch, name):
    monkeypatch.setattr(comparing, "queries", lambda: QUERIES)
    assert comparing.compare(spark, comparing.connect(folder), folder, name, ORACLES[name]) == []


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    total = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns
        docs = spark.createDataFrame(after.collect(), after.schema)
    kept = docs.count()
    assert 0.6 * total < kept < total
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert packed.select("doc_id").distinct().count() == kept


def test_near_copies_keep_columns_and_hot_bands(spark):
    """A group of a third of all rows, columns named as the operator's own, and no rows at all."""
    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join([*words, f"tail{k}"]), 7, "d") for k in range(300)]
    rows += [(k, " ".join(f"{k}x{j}" for j in range(50)), 8, "b") for k in range(300, 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, body int, d string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [rows[0], *rows[300:]]
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0


def test_near_copies_against_brute_force(spark, folder):
    """The stage keeps one row of each group that five-word Jaccard of 0.8 links, whatever SimHash says."""
    words = [f"w{k}" for k in range(300)]
    rows = [(1, " ".join(words))]
    for doc, changed in ((2, [40, 150]), (3, [40, 150, 260, 290]), (4, [0, 60, 120, 180, 240, 299]), (5, range(0, 300, 20))):
        rows.append((doc, " ".join("new%d" % (doc * 1000 + k) if k in changed else w for k, w in enumerate(words))))
    rows += [(6, "short one of five"), (7, "short one of five"), (8, " "), (9, None), (None, " ".join(words))]
    rows += [(20 + k, " ".join(words[:8] + [f"end{k // 2}"])) for k in range(4)]
    rows += [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]

    def grams(text):
        some = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
        return frozenset(tuple(some[k : k + 5]) for k in range(max(1, len(some) - 4))) if some else frozenset()

    sets = [(doc, grams(text)) for doc, text in rows if doc is not None]
    group = {doc: doc for doc, _ in sets}
    linked = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if x == y or 5 * len(x & y) >= 4 * len(x | y)]
    assert (1, 3) in linked and (1, 5) not in linked
    while any(group[a] != group[b] for a, b in linked):
        for a, b in linked:
            group[a] = group[b] = min(group[a], group[b])
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), folder)
    found = [r.doc_id for r in kept.collect()]
    assert found.count(None) == 1
    assert sorted(d for d in found if d is not None) == sorted(set(group.values()))


def _varied(count, changes, words=400):
    """Texts that differ from one text in other places each; any two are a little less alike than 0.8."""
    draw = np.random.default_rng(3)
    plain = [f"w{k}" for k in range(words)]
    for k in range(count):
        some = list(plain)
        for j in draw.choice(words, changes, replace=False):
            some[j] = f"new{k}x{j}"
        yield " ".join(some)


def test_pivots_choose_the_pairs_of_a_band(spark, monkeypatch):
    """Of a band's sets that are apart, those that pivots and outlines can't keep apart come out, each pair once, however the band is cut."""
    monkeypatch.setattr(close_texts, "CELL", 16)
    texts = [*_varied(60, 9), *_varied(40, 12, 300), *(" ".join(f"v{k}" for k in range(30 + j)) for j in range(20))]
    sets = [close_texts.shingles(text) for text in texts]
    count = len(sets)
    nodes = spark.createDataFrame([(k, len(s), bytearray(close_texts.histogram(s))) for k, s in enumerate(sets)], "node long, size long, bins binary")
    label = [k % 7 for k in range(count)]
    keys = {1: range(count), 2: range(0, count, 2), 3: range(60)}
    members = spark.createDataFrame([(key, k, label[k], len(some)) for key, some in keys.items() for k in some], "key long, node long, label long, n long")
    found = [tuple(r) for r in close_texts._apart(members, nodes).collect()]
    bins = [np.frombuffer(close_texts.histogram(s), "<u2").astype(int) for s in sets]

    def near(a, b):
        m, n = len(sets[a]), len(sets[b])
        return label[a] != label[b] and 5 * min(m, n) >= 4 * max(m, n) and np.abs(bins[a] - bins[b]).sum() <= (m + n) // 9

    want = [(a, b) for a, b in itertools.combinations(range(count), 2) if near(a, b)]
    assert want and sorted(found) == want
    assert {(a, b) for a, b in itertools.combinations(range(count), 2) if label[a] != label[b] and close_texts.alike(sets[a], sets[b])} <= set(want)


def test_pivot_tables_discard_pairs():
    """Sets along a line: tables of distances discard all pairs that outlines would, and no other."""
    shares = np.arange(400) % 50
    sets = [np.arange(300, dtype=np.uint64) * np.uint64(64 * 400) + np.uint64(64 * k) + (np.arange(300) >= 6 * s) for k, s in enumerate(shares.tolist())]
    cells = pd.DataFrame({"key": 1, "p": 0, "q": 0, "side": 0, "label": range(400), "size": [len(s) for s in sets]})
    cells["bins"] = [close_texts.histogram(s.astype(np.uint64)) for s in sets]
    cells["keys"] = [[1]] * 400
    steps = {}
    i, j = close_texts.close_pairs(cells, steps)
    want = [(a, b) for a, b in itertools.combinations(range(400), 2) if 12 * abs(shares[a] - shares[b]) <= 600 // 9]
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == want
    assert steps["outline"] == 0 and sum(n for name, n in steps.items() if name.startswith("pivot")) == 400 * 399 // 2 - len(want)


def test_large_group_of_texts_apart(spark):
    """Texts of one group, few of which are alike, against brute force."""
    rows = list(enumerate(_varied(120, 5)))
    sets = [close_texts.shingles(text) for _, text in rows]
    every = [(a, b) for a, b in itertools.combinations(range(120), 2) if close_texts.alike(sets[a], sets[b])]
    group = list(range(120))
    while any(group[a] != group[b] for a, b in every):
        for a, b in every:
            group[a] = group[b] = min(group[a], group[b])
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert every and {r.doc_id for r in kept.collect()} == set(group)


def test_a_stage_deletes_what_the_one_before_stored(spark, folder, tmp_path):
    """Once a stage's rows are written its tables go; rows that are read from them keep them."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    place = Path(spark.conf.get("spark.checkpoint.dir"))
    (_, rules), (_, near), (_, passages), _ = corpus_pipeline.STAGES
    known = set(place.iterdir())

    def here():
        return {path.name.split("-")[0] for path in set(place.iterdir()) - known if any(path.glob("*.parquet"))}

    kept = rules(spark, docs, folder)
    assert here() == {"statistics", "labelled"}
    expected = sorted(r.doc_id for r in near(spark, kept, folder).collect())
    assert "statistics" in here() and "labelled" not in here()  # the rows of the first stage weren't written

    known = set(place.iterdir())
    rules(spark, docs, folder).write.parquet(f"{tmp_path}/0")
    again = near(spark, spark.read.parquet(f"{tmp_path}/0"), folder)
    assert "nodes" in here() and not here() & {"statistics", "labelled"}
    again.write.parquet(f"{tmp_path}/1")
    assert sorted(r.doc_id for r in spark.read.parquet(f"{tmp_path}/1").collect()) == expected
    passages(spark, spark.read.parquet(f"{tmp_path}/1"), folder)
    assert here() == {"segments"}


def test_alike_texts_without_a_common_band(spark):
    """Texts with eight of ten shingles in common meet, also where no band of MinHash values is the same."""
    ends = ((3, 704, 979), (4, 698, 861), (6, 1217, 1429), (7, 78, 953))
    texts = [" ".join([*(f"w{group}x{j}" for j in range(12)), f"e{end}"]) for group, *pair in ends for end in pair]
    sets = [close_texts.shingles(text) for text in texts]
    for a, b in zip(sets[::2], sets[1::2], strict=True):
        assert close_texts.alike(a, b) and not np.intersect1d(close_texts.band_keys(a), close_texts.band_keys(b)).size
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 4, 6]


def test_rows_without_a_doc_id_link(spark):
    """They join groups like any row, and one of a group's stays beside the one with the smallest doc_id."""
    words = [f"w{k}" for k in range(300)]
    one, other, middle = (" ".join("new" if k in changed else w for k, w in enumerate(words)) for changed in ((10, 40, 70, 100), (160, 190, 220, 250), ()))
    a, b, m = map(close_texts.shingles, (one, other, middle))
    assert close_texts.alike(a, m) and close_texts.alike(m, b) and not close_texts.alike(a, b)
    big = 2**60
    rows = [(big + 3, one), (big + 5, other), (None, middle), (None, middle), (big + 7, "text of its own"), (None, "another"), (None, "another"), (0, "another"), (None, None), (None, " ")]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [0, big + 3, big + 7]
    assert sorted((r.text or "").strip() for r in kept if r.doc_id is None) == ["", "another", middle]


def test_alike_sets_share_first_and_rarest_shingles(spark, monkeypatch):
    """Brute force over sets of many sizes about the limit: no pair is lost before sets are compared, whatever the buckets."""
    draw = np.random.default_rng(5)
    texts = [*_varied(40, 8), *_varied(30, 10), *_varied(10, 30)]
    for size in (8, 9, 10, 12, 13, 17, 28, 60):
        for k in range(12):
            plain = [f"s{size}x{j}" for j in range(size + int(draw.integers(0, 3)))]
            plain[-1 - int(draw.integers(0, 2))] = f"end{k}"
            texts.append(" ".join(plain))
    texts += [" ".join(f"own{k}x{j}" for j in range(30)) for k in range(50)]
    texts = list(dict.fromkeys(texts))
    by = {}
    for text in texts:
        found = close_texts.shingles(text)
        by[int(np.uint64(close_texts._node(found)).astype(np.int64))] = found
    every = {(a, b) for a, b in itertools.combinations(by, 2) if close_texts.alike(by[a], by[b])}
    assert len(by) == len(texts) and len({a for a, _ in every}) > 30
    some = spark.createDataFrame([(text,) for text in [*texts, *texts]], "text string").repartition(5)
    nodes = spark.createDataFrame([(node, len(found)) for node, found in by.items()], "node long, size long")
    for filed in (1 << 20, 200):
        monkeypatch.setattr(close_texts, "FILED", filed)
        paired = {r.node for r in close_texts._with_partners(some, nodes).collect()}
        assert {node for pair in every for node in pair} <= paired < set(by)
        keys = {}
        for r in close_texts.rarest(some, nodes).collect():
            keys.setdefault(r.node, set()).add(r.key)
        assert all(keys.get(a, set()) & keys.get(b, set()) for a, b in every)
        assert sum(map(len, keys.values())) < sum(map(len, by.values())) / 3

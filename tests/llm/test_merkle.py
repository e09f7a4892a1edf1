"""Merkle manifests against a plain recursion, proofs that hold and fail, and odd rows."""

import hashlib
import zlib

import pytest
from acceptance import compare as comparing

from pollstone.llm import merkle
from pollstone.llm.queries import ORACLES, QUERIES

SHAPE = "doc_id long, source string, lang string, n_chars long, text string, leaf string, grp int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(leaves):
    """The top, and for each leaf its siblings from below as (side, digest) or None."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 2]) for k in range(0, len(levels[-1]), 2)])
    proofs = []
    for rank in range(len(leaves)):
        steps, at = [], rank
        for level in levels[:-1]:
            other = at ^ 1
            steps.append(None if other >= len(level) else ("L" if other < at else "R", level[other]))
            at >>= 1
        proofs.append(steps)
    return levels[-1][0], proofs


def by_hand(rows):
    langs, out = {}, []
    for row in rows:
        langs.setdefault(row[2], []).append(row)
    names = sorted(langs, key=lambda lang: (lang is not None, (lang or "").encode()))
    found = {}
    for name in names:
        langs[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        found[name] = tree([leaf(*r) for r in langs[name]])
    root, upper = tree([found[name][0] for name in names])
    for name, above in zip(names, upper, strict=True):
        subroot, proofs = found[name]
        for row, proof in zip(langs[name], proofs, strict=True):
            steps = proof + above
            doc_id, source, lang, n_chars, text = row
            changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
            now = leaf(doc_id, source, lang, n_chars + 1 if changed and n_chars is not None else n_chars, text)
            for step in steps:
                now = h(now) if step is None else h(step[1], now) if step[0] == "L" else h(now, step[1])
            out.append((doc_id, leaf(*row), subroot, root, h(*[s[1] for s in steps if s]), now, now == root))
    return sorted(out, key=str)


def audited(spark, rows):
    docs = spark.createDataFrame([(*row, "clash", 1) for row in rows], SHAPE)
    return sorted((tuple(r) for r in merkle.audit(docs).collect()), key=str)


ROWS = [(k, f"s{k % 3}", ["en", "de", None, "", "é"][k % 5 if k < 23 else 0], k if k % 4 else None, "t" * k) for k in range(60)]
ROWS += [(7, "s", "en", 1, "again")] * 9 + [(None, None, None, None, None)] * 2 + [(61, "s", "one", 5, "long " * 50_000)]


@pytest.mark.parametrize("count, depth", [(1, 9), (2, 9), (5, 1), (8, 2), (len(ROWS), 2), (len(ROWS), 9)])
def test_manifest(spark, monkeypatch, count, depth):
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "COPIES", 4)
    rows = ROWS[:count]
    assert audited(spark, rows) == by_hand(rows)


def test_one_language_and_none(spark):
    rows = [(k, "s", "en", 1, str(k)) for k in range(6)]
    found = audited(spark, rows)
    assert found == by_hand(rows) and found[0][2] == found[0][3]
    assert audited(spark, []) == []


def test_audit_tells_tampered_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = merkle.audit(docs)
    plain = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in found.collect()), key=str) == by_hand(plain)
    assert 0 < found.where("NOT verified").count() < docs.count()


@pytest.mark.parametrize("name", ["op12_merkle"])
def test_query_matches_sql(spark, folder, monkeypatch, name):
    monkeypatch.setattr(comparing, "queries", lambda: QUERIES)
    assert comparing.compare(spark, comparing.connect(folder), folder, name, ORACLES[name]) == []

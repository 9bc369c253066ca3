"""Fingerprints: likeness against plain sets, edited texts, recovered digests, plan without Python, edge rows."""

import hashlib
import random
import re

import pytest

from demandkit.llm import fingerprints
from demandkit.llm.queries import QUERIES


def units(text):
    return {p for p in re.split(r"\n|(?<=[.!?]) ", text) if p}


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, text) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + other[:cut]
        near = lambda x: 1.0 if not units(text) | units(x) else len(units(text) & units(x)) / len(units(text) | units(x))  # noqa: B023, E731
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), near(edited), near(other)))
    return out


def got(frame):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in frame.collect()]


def same(found, expected):
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    found, expected = order(found), order(expected)
    assert [f[:3] for f in found] == [e[:3] for e in expected]
    for f, e in zip(found, expected):
        assert f[3:] == pytest.approx(e[3:], abs=1e-12), (f, e)


ROWS = []
_pick = random.Random(6)
for _i in range(60):
    _n = _pick.choice([0, 1, 3, 12, 60, 400])
    ROWS.append((_i * 3, "".join(f"Word{_pick.randrange(900)} ä{_j}{_pick.choice(['. ', chr(10), '! '])}" for _j in range(_n))))
ROWS += [(1000, None), (1001, ""), (1002, ROWS[4][1]), (1003, ROWS[4][1]), (None, "No id. Here."), (1003, ROWS[4][1])]


def test_small_ranges_equal_plain_sets(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_DOCUMENTS", 7)
    docs = spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, text string, cells string")
    out = fingerprints.fingerprints(docs)
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()
    same(got(out), brute(ROWS))
    prints = {r.doc_id: r.fingerprint for r in out.collect()}
    assert prints[1002] == prints[1003] == prints[12] and len(set(prints.values())) > 20


def test_recovered_digests(spark):
    docs = spark.createDataFrame([(1, "A b. C d. E f."), (2, "C d. X y.")], "doc_id long, text string")
    out = {r.doc_id: r for r in fingerprints.fingerprints(docs, keep_digests=True).collect()}
    digest = {p: spark.sql(f"SELECT xxhash64('{p}') AS h").first().h for p in ("A b.", "E f.", "X y.")}
    assert {(d.k, d.n) for d in out[1].next_digests} == {(digest["A b."], 1), (digest["E f."], 1), (digest["X y."], -1)}


def test_one_document_and_none(spark):
    same(got(fingerprints.fingerprints(spark.createDataFrame([(5, "Only one. Here.")], "doc_id long, text string"))), brute([(5, "Only one. Here.")]))
    assert fingerprints.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_plain_sets(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    same(got(QUERIES["op6_iblt"](spark, sf)), brute(rows))

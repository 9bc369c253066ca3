"""Repeated strings against a plain count of all substrings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from demandkit.llm import cover, substrings
from demandkit.llm.queries import QUERIES


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()), key=repr)


def corpus(seed):
    pick = random.Random(seed)
    letters = "abcdefgh é"
    make = lambda n: "".join(pick.choice(letters) for _ in range(n))
    shared = [make(n) for n in (15, 24, 25, 40, 90, 300)]
    rows = []
    for i in range(70):
        parts = [make(pick.randrange(60))]
        for _ in range(pick.randrange(4)):
            parts += [pick.choice(shared)[pick.randrange(6) :], make(pick.choice([0, 3, 40]))]
        rows.append((i, "".join(parts)))
    near = list(make(200))
    for i in range(6):
        near[pick.randrange(200)] = "Z"
        rows.append((100 + i, "".join(near)))
    rows += [(200, None), (201, ""), (202, "aaaa" * 40), (203, "ab" * 60), (204, "short"), (204, "short"), (205, shared[5]), (205, shared[5]), (None, shared[4])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_all_substrings(spark, seed, monkeypatch):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ranks string")
    # 24 bytes with a sample of 10, so cells and single starts matter.
    monkeypatch.setattr(substrings, "CELL", 4)
    monkeypatch.setattr(substrings, "BLOCK", 150)
    assert got(substrings.remove_repeats(docs, length=24, gram=10)) == brute(rows, 24)


def test_blocks_of_a_long_text(monkeypatch):
    draw = np.random.default_rng(0)
    data = draw.integers(97, 100, 5000).astype(np.uint8)
    whole = next(substrings._all_intervals(data, 24, 10))
    starts = lambda parts: np.concatenate([np.arange(f, e + 1) + b for b, first, last, *_ in parts for f, e in zip(first, last)])
    owners = lambda parts: np.concatenate([np.full(e - f + 1, p + b) for b, first, last, place, _ in parts for f, e, p in zip(first, last, place)])
    monkeypatch.setattr(substrings, "BLOCK", 700)
    parts = list(substrings._all_intervals(data, 24, 10))
    assert len(parts) > 5 and (starts(parts) == np.arange(5000 - 23)).all()
    assert (owners(parts) == owners([whole])).all()


def test_hashes_do_not_depend_on_the_place():
    data = np.frombuffer(b"xxhello worldyyhello world", np.uint8)
    s = cover.Strings(data)
    for k in (0, 1):
        a, b, c = s.hash(np.array([2, 15, 0]), np.array([13, 26, 11]), k)
        assert a == b != c


def test_empty_table(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_plain_count(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(QUERIES["op8_repeats"](spark, sf)) == brute(rows, 200)

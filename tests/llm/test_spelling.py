"""Spelling variants against all pairs by brute force, and the query against its SQL."""

import random
import re
import zlib
from collections import Counter

import pytest

from compare import connect, differences
from demandkit.llm import spelling
from demandkit.llm.oracle import ORACLE
from demandkit.llm.queries import QUERIES


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, times=10):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v.encode()), default=None)
        out[w] = (n, len(near), best if best is not None and counts[best] >= times * n else None)
    found = {}
    for w, (n, k, form) in out.items():
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        found[w] = (form, root, n, k, counts[form] if form else None)
    return found


def run(spark, counts):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(words).collect()}


def test_all_pairs(spark):
    pick = random.Random(5)
    letters = "abécß"
    words = set()
    while len(words) < 500:
        w = "".join(pick.choice(letters) for _ in range(pick.choice([7, 7, 8, 9, 13])))
        words.add(w)
        for _ in range(pick.choice([0, 1, 4])):
            i = pick.randrange(len(w) + 1)
            v = pick.choice([w[:i] + pick.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + pick.choice(letters) + w[i + 1 :]])
            if len(v) >= 7:
                words.add(v)
    counts = {w: pick.choice([2, 3, 20, 30, 200, 300, 3000]) for w in sorted(words)}
    found = run(spark, counts)
    assert found == brute(counts)
    assert any(v[1] not in (v[0], k) and v[0] for k, v in found.items()), "no chain of forms"


def test_every_place_and_kind_of_edit(spark):
    for length in range(7, 16):
        base = "abcdefghijklmnopqr"[:length]
        edits = {base[:i] + "z" + base[i:] for i in range(length + 1)} | {base[:i] + "z" + base[i + 1 :] for i in range(length)}
        edits |= {base[:i] + base[i + 1 :] for i in range(length)}
        counts = {base: 1000} | {e: 2 for e in edits}
        found = run(spark, counts)
        assert found[base][3] == len(edits)
        assert all(found[e][:2] == (base, base) for e in edits)


def test_ties_take_the_smallest_word(spark):
    found = run(spark, {"aaaaaaa": 2, "aaaaaaz": 20, "aaaaaaé": 20, "aaaaaab": 19})
    assert found["aaaaaaa"] == ("aaaaaaz", "aaaaaaz", 2, 3, 20)


def test_words_of_documents(spark):
    texts = [(1, "Läuferin läuferin LÄUFERIN kurz"), (2, None), (None, "x" * 7 + " " + "x" * 7), (3, ""), (3, "×÷×÷×÷× läuferinĀläuferin")]
    wanted = Counter()
    for i, t in texts:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            at = h % len(w)
            w = w[:at] + w[at + 1 :] if h % 3 == 0 else w
            if len(w) >= 7:
                wanted[w] += 1
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in texts], "doc_id long, text string, word string, n int")
    found = {r.word: r.n for r in spelling.count_words(docs, min_count=1, every=3).collect()}
    assert found == dict(wanted)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.count_words(docs)).collect() == []


def test_long_text(spark):
    docs = spark.createDataFrame([(1, "gewitter " * 600_000)], "doc_id long, text string")
    assert [tuple(r) for r in spelling.count_words(docs, every=10**12).collect()] == [("gewitter", 600_000)]


def test_query_equals_sql(spark, sf):
    assert differences(QUERIES["op12_spelling"](spark, sf), connect(sf), ORACLE["op12_spelling"]) == []


@pytest.mark.parametrize("length", [7, 8, 9, 20])
def test_chunks_are_disjoint(length):
    q = length // 2
    assert 2 * q <= length and (length - q) // 2 >= 2

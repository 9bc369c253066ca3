"""Near duplicates against all pairs by brute force; signatures against the sequential algorithm."""

import random
import re

import numpy as np
import pytest

from demandkit.llm import near_dup
from demandkit.llm.components import components
from demandkit.llm.queries import QUERIES


def brute_sets(texts, k):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def brute(ids, texts, k, percent=80):
    sets = brute_sets(texts, k)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_word = {}
    for i, s in zip(ids, sets):
        for x in s:
            by_word.setdefault(x, []).append(i)
    of = dict(zip(ids, sets))
    pairs = {(a, b) for group in by_word.values() if len(group) < 400 for a in group for b in group if a < b}
    for a, b in pairs:
        common = len(of[a] & of[b])
        if 100 * common >= percent * (len(of[a]) + len(of[b]) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(of[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k", [2, 5])
def test_random_copies(spark, k, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_MEMBERS", 3)
    pick = random.Random(k)
    words = ["w%d" % i for i in range(400)]
    texts = []
    for _ in range(25):
        base = [pick.choice(words) for _ in range(pick.choice([1, 2, 4, 30, 200]))]
        for _ in range(pick.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(pick.choice([0, 0, 1, 3, 8])):
                copy[pick.randrange(len(copy))] = pick.choice(words)
            texts.append(" ".join(copy) + pick.choice(["", "\n", "  "]))
    texts += [None, "", " \t", "One", "one"]
    rows = [(i * 7 % 1009, t, "x") for i, t in enumerate(texts)]
    out = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, node string"), shingle=k)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()}
    assert found == brute([r[0] for r in rows], [r[1] for r in rows], k)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def test_chains_across_leaders(spark):
    """A chain of documents, each near the next only, and none near the smallest id."""
    words = ["w%d" % i for i in range(150)]
    texts = [" ".join(words[8 * s : 8 * s + 80]) for s in range(9)]
    rows = [(i, t) for i, t in enumerate(texts)]
    out = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=1)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == brute(range(9), texts, 1)


def test_repeated_rows_and_null_ids(spark):
    rows = [(4, "a b c d"), (4, "a b c d"), (None, "a b c d"), (None, "other words here"), (2, "q r s")]
    out = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in out) == [(-1, -1, True), (-1, 4, False), (2, 2, True), (4, 4, True), (4, 4, True)]


def test_empty_table(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def sequential(elements, m):
    """One element after the other, one step after the other."""
    out = [near_dup._UNSET] * m
    for e in elements:
        slots = list(range(m))
        for level in range(m):
            place, value = near_dup._offer(np.asarray([e]), level, m)
            k = int(place[0])
            slots[level], slots[k] = slots[k], slots[level]
            out[slots[level]] = min(out[slots[level]], value[0])
    return out


def test_signatures_equal_the_sequential_ones():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 2, 7, 40, 300)] + [np.zeros(0, np.uint64)]
    got = near_dup.signatures(sets, 20)
    for s, row in zip(sets, got):
        assert row.tolist() == [int(x) for x in sequential(s, 20)]


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(2)
    x = np.unique(draw.integers(0, 2**63, 1000, dtype=np.uint64))
    a, b = x[:900], x[100:]
    s = near_dup.signatures([a, b], 200)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.09


def test_components(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    out = components(spark.createDataFrame(edges, "u long, v long"))
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.component for r in out.collect()} == {x: find(x) for x in linked}


def test_few_links_take_few_tasks(spark, monkeypatch):
    from demandkit.llm import components as module

    kept, files = module.settle, []

    def counted(df, purpose):
        out = kept(df, purpose)
        files.append((purpose, len(out.inputFiles())))
        return out

    monkeypatch.setattr(module, "settle", counted)
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = components(spark.createDataFrame([(i, i + 1) for i in range(300)], "u long, v long"))
        assert {r.component for r in out.collect()} == {0} and out.count() == 301
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(n for _, n in files[1:]) <= 8


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    out = QUERIES["op10_superminhash"](spark, sf).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute([d.doc_id for d in docs], [d.text for d in docs], 2)


@pytest.mark.parametrize("sizes", [{1: 30, 50: 2, 60: 1}, {1: 4, 10: 4, 20: 4, 30: 1}, {1: 3, 9: 2}, {5: 1, **{100 + i: 1 for i in range(25)}}])
def test_members_of_different_components_meet_once(spark, sizes, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_MEMBERS", 5)
    main, n_main = max(sizes.items(), key=lambda s: (s[1], s[0]))
    n = sum(sizes.values())
    rows = [(7, 1000 * c + k, c, main, n_main, n - n_main) for c, size in sizes.items() for k in range(size)]
    open_ = spark.createDataFrame(rows, "bucket long, node long, component long, main long, n_main long, n_other long")
    groups = {}
    for r in near_dup._dealt(open_).collect():
        groups.setdefault((r.i, r.j), []).append(r)
    met = {}
    for (i, j), members in groups.items():
        left, right = [m for m in members if m.block == i], [m for m in members if m.block == j]
        for a in left:
            for b in right:
                if (i != j or a.node < b.node) and a.component != b.component:
                    pair = tuple(sorted((a.node, b.node)))
                    met[pair] = met.get(pair, 0) + 1
    wanted = {tuple(sorted((a[1], b[1]))) for a in rows for b in rows if a[2] != b[2]}
    assert met == dict.fromkeys(wanted, 1)
    if n_main > 5 and n - n_main <= 5:
        assert sum(map(len, groups.values())) <= n_main + (n - n_main) * (-(-n_main // 5) + 1)

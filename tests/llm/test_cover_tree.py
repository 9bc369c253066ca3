"""Links between embeddings against all pairs by brute force."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from demandkit.llm import cover_tree
from demandkit.llm.queries import QUERIES


def brute(ids, vectors, least=0.95):
    """(id, links, smallest id reachable) of every row, sorted."""
    good = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for v in vectors]
    at = np.flatnonzero(good)
    x = np.array([vectors[i] for i in at], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    component = np.arange(len(at))
    while True:
        least_near = np.where(near, component[None, :], component[:, None]).min(axis=1)
        if (least_near == component).all():
            break
        component = least_near
    out = [(i, 0, i) for i, g in zip(ids, good) if not g]
    for row, k in enumerate(at):
        own = [ids[at[j]] for j in np.flatnonzero(component == component[row])]
        out.append((ids[k], int(near[row].sum()), min((i for i in own if i is not None), default=None)))
    return sorted(out, key=repr)


def found(frame):
    rows = frame.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=repr)


def groups(rng, sizes, d, spread):
    """Around each of some directions, vectors at growing distances."""
    out = []
    for n in sizes:
        base = rng.normal(size=d)
        base /= np.linalg.norm(base)
        out.append(base + rng.normal(size=(n, d)) * (rng.uniform(0, spread, size=(n, 1)) / np.sqrt(d)))
    return np.concatenate(out)


@pytest.mark.parametrize("d, spread, sample, block", [(16, 0.5, 20, 1), (3, 0.4, 8, 1), (64, 0.3, 512, 1 << 22), (8, 1.2, 4, 4096), (2, 0.1, 3, 1)])
def test_all_pairs(spark, d, spread, sample, block, monkeypatch):
    monkeypatch.setattr(cover_tree, "TILE", 4096)
    rng = np.random.default_rng(d)
    x = groups(rng, [1] * 40 + [3] * 10 + [30] * 4 + [200], d, spread) * rng.uniform(0.1, 9, size=(1 * 40 + 30 + 120 + 200, 1))
    x = np.concatenate([x, x[rng.integers(0, len(x), 40)], 3 * x[:5]])
    order = rng.permutation(len(x))
    ids, vectors = [int(i) * 3 + 1 for i in order], x.tolist()
    frame = spark.createDataFrame(list(zip(ids, vectors)), "vec_id long, embedding array<double>")
    assert found(cover_tree.link_embeddings(frame, sample=sample, block_bytes=block)) == brute(ids, vectors)


def test_query_on_the_whole_table(spark, sf):
    table = pq.read_table(f"{sf}/embeddings.parquet")
    ids, vectors = table.column("vec_id").to_pylist(), table.column("embedding").to_pylist()
    assert found(QUERIES["op11_cover_tree"](spark, sf)) == brute(ids, vectors)


def test_unusable_and_repeated_rows(spark):
    v, w = [1.0, 0.0, 0.1], [0.0, 1.0, 0.0]
    rows = [(4, v), (4, v), (None, v), (2, w), (9, None), (8, []), (7, [0.0, 0.0, 0.0]), (6, [None, 1.0, 0.0]), (5, [float("nan"), 1.0, 0.0])]
    rows += [(3, [float("inf"), 0.0, 0.0]), (None, None), (11, [1e-30, 0.0, 1e-31]), (12, [1e30, 0.0, 1e29])]
    frame = spark.createDataFrame([(i, x, 1, 2) for i, x in rows], "vec_id long, embedding array<float>, n int, leaf int")
    out = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in cover_tree.link_embeddings(frame).collect()), key=repr)
    alone = [(i, 0, i, True) for i in (2, 3, 5, 6, 7, 8, 9, None)]
    together = [(4, 4, 4, True), (4, 4, 4, True), (None, 4, 4, False), (11, 4, 4, False), (12, 4, 4, False)]
    assert out == sorted([*alone, *together], key=repr)


def test_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert cover_tree.link_embeddings(spark.createDataFrame([], schema)).collect() == []
    none = cover_tree.link_embeddings(spark.createDataFrame([(1, None)], schema)).collect()
    assert [tuple(r) for r in none] == [(1, 0, 1, True)]
    with pytest.raises(ValueError, match="one length"):
        cover_tree.link_embeddings(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema))


def test_levels_are_nested_and_cover():
    rng = np.random.default_rng(2)
    x = groups(rng, [50, 50, 5], 8, 0.8)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    leaves = x[:3]
    leaf, far = cover_tree.nearest(x, leaves)
    levels = cover_tree.radii(0.3)
    path = cover_tree.paths(x, leaf, far, levels)
    for level, radius in enumerate(levels):
        center = path[:, level]
        assert (cover_tree.chord((x * x[center]).sum(axis=1)) <= radius + 1e-9).all()
        for below in range(level, len(levels)):
            assert (path[center, below] == center).all(), "a center stays one below"
        assert (leaf[center] == leaf).all() and (level == 0 or (path[center, level - 1] == path[:, level - 1]).all())


def test_groups_of_a_dense_leaf_are_not_compared_one_by_one(monkeypatch):
    """1000 vectors around one cost a fraction of their pairs."""
    rng = np.random.default_rng(4)
    x = groups(rng, [1000], 32, 0.1)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    leaves = x[:1]
    leaf, far = cover_tree.nearest(x, leaves)
    path = cover_tree.paths(x, leaf, far, cover_tree.radii(0.3162))
    tree = cover_tree.Tree(x, np.ones(len(x), np.int64), leaf, path, leaves)
    links = cover_tree.Links(tree, tree, 0.95)
    seen = []
    decide = links._decide
    monkeypatch.setattr(links, "_decide", lambda level, i, j, cosines: (seen.append(len(i)), decide(level, i, j, cosines)))
    links.run(np.full((1, 1), cover_tree.OPEN, np.int8))
    assert (links.count == 999).all() and (links.root == 0).all()
    assert sum(seen) < 1000 * 999 // 2 // 5

"""Raking against numpy, targets, topics, sampling and edge rows."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest

from demandkit.llm import mixing
from demandkit.llm.queries import QUERIES


def brute_rake(table, targets, rate, sweeps):
    x = np.full(table.shape, float(rate))
    for _ in range(sweeps):
        for axis, target in enumerate(targets):
            rest = tuple(i for i in range(3) if i != axis)
            capped = x >= 1
            fixed, open_ = (table * capped).sum(rest), (table * np.where(capped, 0, x)).sum(rest)
            room = target - fixed
            shrink = room <= 0
            f = np.where(shrink, target / np.maximum(fixed + open_, 1e-300), np.where(open_ > 0, room / np.maximum(open_, 1e-300), 1.0))
            shape = [-1 if i == axis else 1 for i in range(3)]
            x = np.where(shrink.reshape(shape), np.minimum(x, 1), x) * f.reshape(shape)
    return np.minimum(x, 1)


@pytest.mark.parametrize("rate", [0.2, 0.7])
def test_rake_equals_numpy_and_meets_targets(spark, rate):
    draw = np.random.default_rng(4)
    table = np.ceil(draw.lognormal(5, 1, (4, 3, 2)))
    table[0] *= 12
    rows = [(f"s{i}", f"l{j}", f"t{k}", float(table[i, j, k])) for i, j, k in itertools.product(range(4), range(3), range(2))]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")
    out = {(r.source, r.lang, r.topic): r.probability for r in mixing.rake(cells, rate, tolerance=0.0, sweeps=4).collect()}
    got = np.array([out[r[:3]] for r in rows]).reshape(table.shape)
    targets = []
    for axis, margin in enumerate(mixing.MARGINS):
        sums = table.sum(tuple(i for i in range(3) if i != axis)) ** mixing.POWERS[margin]
        targets.append(rate * table.sum() * sums / sums.sum())
    assert np.allclose(got, brute_rake(table, targets, rate, sweeps=4), atol=1e-9)
    if rate == 0.2:
        for axis in range(3):
            kept = (table * got).sum(tuple(i for i in range(3) if i != axis))
            assert np.allclose(kept, targets[axis], rtol=0.02)


def test_confounded_cells_are_raked_until_they_fit(spark):
    """Sources nearly tied to languages take many sweeps; the misfits tell the end."""
    draw = np.random.default_rng(3)
    rows = [(f"s{i}", f"l{j}", "t", 1000.0 if i == j else float(draw.integers(20, 40))) for i in range(8) for j in range(8)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")
    shares = {"source": {f"s{i}": 1.0 + i / 60 for i in range(8)}, "lang": {f"l{j}": 1.0 + (7 - j) / 60 for j in range(8)}}
    _, early = mixing.rake_with_misfits(cells, 0.3, shares=shares, sweeps=2)
    raked, misfits = mixing.rake_with_misfits(cells, 0.3, shares=shares)
    found = {(r.margin, r.value): r.misfit for r in misfits.collect()}
    assert len(found) == 17 and max(found.values()) <= 0.01 < max(r.misfit for r in early.collect())
    assert raked.filter("probability < 0 or probability > 1").isEmpty()


def test_contradicting_targets_end_and_are_told(spark):
    rows = [("a", "x", "t", 100.0), ("b", "y", "t", 100.0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")
    _, misfits = mixing.rake_with_misfits(cells, 0.5, shares={"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.1, "y": 0.9}})
    assert max(r.misfit for r in misfits.filter("margin <> 'topic'").collect()) > 0.5


def test_given_shares(spark):
    rows = [("a", "x", "t", 100.0), ("b", "x", "t", 300.0), ("c", "x", "t", 100.0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")
    out = mixing.rake(cells, 0.2, shares={"source": {"a": 0.5, "b": 0.5}}).collect()
    assert {r.source: round(r.probability, 3) for r in out} == {"a": 0.5, "b": 0.167, "c": 0.0}


def test_documents(spark):
    pick = random.Random(1)
    rows = [(i, " ".join(pick.choice(["garden", "planet", "of", "it"]) for _ in range(pick.randrange(1, 60))), pick.choice(["a", "a", "b", None]), pick.choice(["en", "de"])) for i in range(400)]
    rows += [(1000, None, "a", "en"), (1001, "", None, None), (None, "planet of it", "b", "de"), (7, rows[7][1], rows[7][2], rows[7][3])]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, lang string, topic int")
    assert {k: set(v) for k, v in mixing.topic_terms(docs).items()} == {k: {"garden", "planet"} for k in ("en", "de")}
    terms = mixing.topic_terms(docs)
    out = mixing.mix(docs, carry=docs.columns).collect()
    assert len(out) == len(rows) and out[0].rest.topic == 5
    for r in out:
        words = Counter((r.rest.text or "").split())
        assert r.n_tokens == sum(words.values()) and 0 < r.probability <= 1
        own = terms.get(r.lang, [])
        most = max(range(len(own)), key=lambda i: (words[own[i]], -i)) if any(words[w] for w in own) else None
        assert r.topic == ("other" if most is None else f"topic {most + 1}")
    kept = sum(r.n_tokens for r in out if r.kept)
    assert abs(kept / sum(r.n_tokens for r in out) - 0.5) < 0.12
    assert len({r.kept for r in out if r.rest.doc_id == 7}) == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string, lang string")
    assert mixing.mix(docs).count() == 0


def test_query_keeps_the_marginals(spark, sf):
    out = QUERIES["op7_mixing"](spark, sf).toPandas()
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    tokens = out.n_tokens * out.probability
    assert abs(tokens.sum() / out.n_tokens.sum() - 0.5) < 0.01
    by = out.groupby("lang").n_tokens.sum() ** mixing.POWERS["lang"]
    assert np.allclose((tokens.groupby(out.lang).sum() / tokens.sum()).sort_index(), (by / by.sum()).sort_index(), atol=0.02)

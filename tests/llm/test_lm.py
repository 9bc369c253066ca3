"""The language model: counts against plain Python, gradients, carried state, probabilities, learning, edge rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandkit.llm import lm
from demandkit.runtime import settle
from demandkit.llm.language import held_out
from demandkit.llm.queries import QUERIES


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    count = Counter(w for i, t in rows if not held[i] for w in words(t))
    ends = sum(not held[i] for i, _ in rows)
    n, v = sum(count.values()) + ends, len(count) + (ends > 0)
    out = []
    for i, t in rows:
        c = [count[w] for w in words(t)] + [ends]
        out.append((i, held[i], len(c), sum(x > 0 for x in c), n, sum(math.log10((x + 1) / (n + v + 1)) for x in c)))
    return out


def test_query_counts_and_held_out_gain(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = {r.doc_id: r for r in QUERIES["op4_gru_lm"](spark, sf).collect()}
    for i, held, n, known, total, base in brute(rows):
        r = out[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    test = [r for r in out.values() if r.held_out]
    assert sum(r.score for r in test) > sum(r.base_score for r in test)


def test_edge_rows(spark):
    rows = [(1, "a b A"), (2, None), (3, ""), (None, "b c"), (4, "a b A"), (4, "a b A"), (5, "x" * 5000 + " é")]
    docs = spark.createDataFrame([(*r, "y") for r in rows], "doc_id long, text string, words string")
    out = lm.score(docs, held_out("doc_id", 7, 2)).collect()
    order = lambda rows: sorted(rows, key=repr)
    got = order((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9)) for r in out)
    assert got == order((*r[:5], round(r[5], 9)) for r in brute(rows))
    assert len({r.score for r in out if r.doc_id in (1, 4)}) == 1 and all(r.score < 0 for r in out)
    assert lm.score(docs.limit(0), held_out("doc_id", 7, 2)).count() == 0


def small():
    draw = np.random.default_rng(0)
    return lm.Network.start(draw.integers(1, 50, lm.SYMBOLS).astype(float)), draw


def test_probabilities_add_up_to_one():
    net, draw = small()
    h = draw.standard_normal((1, lm.HIDDEN)).astype(np.float32)
    logs, _ = net.log_probabilities(np.repeat(h, lm.SYMBOLS, axis=0), np.arange(lm.SYMBOLS))
    assert np.exp(logs.astype(float)).sum() == pytest.approx(1, abs=1e-4)


def test_gradients_equal_differences():
    net, draw = small()
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x = draw.integers(0, 200, (5, 3))
    x[2, 1] = 0
    y = draw.integers(0, 200, (5, 3))

    def loss():
        hidden, _ = net.run(x, np.full((3, lm.HIDDEN), 0.1))
        return -net.log_probabilities(hidden.reshape(-1, lm.HIDDEN).astype(np.float64), y.reshape(-1))[0].mean()

    g, trace = {k: np.zeros_like(v) for k, v in net.w.items()}, []
    hidden, _ = net.run(x, np.full((3, lm.HIDDEN), 0.1), trace)
    _, back = net.log_probabilities(hidden.reshape(-1, lm.HIDDEN).astype(np.float64), y.reshape(-1), g)
    net._backward(trace, back.reshape(hidden.shape), g)
    for name in net.NAMES:
        flat = net.w[name].reshape(-1)
        places = np.argsort(-np.abs(g[name].reshape(-1)))[:3]
        for p in places:
            flat[p] += 1e-3
            up = loss()
            flat[p] -= 2e-3
            down = loss()
            flat[p] += 1e-3
            assert (up - down) / 2e-3 == pytest.approx(g[name].reshape(-1)[p], rel=0.03, abs=1e-5)


def test_gates_lie_without_gaps_and_equal_the_plain_recurrence():
    """Arithmetic on gates that lie interleaved takes most of an epoch's time."""
    net, draw = small()
    x = draw.integers(0, 40, (9, 6)) * 50
    x[4] = 0
    trace, state = [], draw.standard_normal((6, lm.HIDDEN)).astype(np.float32)
    hidden, last = net.run(x, state, trace)
    assert all(gate.flags.c_contiguous for step in trace for gate in step[2:])
    h, n, u = state.astype(float), lm.HIDDEN, net.w["recurrent"].astype(float)
    for t, given in enumerate(net.w["inputs"].astype(float)[x]):
        before = h * (x[t] != 0)[:, None]
        past = before @ u
        z, r = (1 / (1 + np.exp(-(given + past)[:, i : i + n])) for i in (0, n))
        new = np.tanh(given[:, 2 * n :] + r * past[:, 2 * n :])
        h = (1 - z) * new + z * before
        assert np.allclose(hidden[t], h, atol=1e-6)
    assert np.array_equal(last, hidden[-1])
    far = lm.Network({k: v * 1e4 for k, v in net.w.items()}).run(x, state)[0]
    assert np.isfinite(far).all() and np.abs(far).max() <= max(1, np.abs(state).max())


def test_state_is_carried_across_windows(monkeypatch):
    net, draw = small()
    sizes = [0, 1, 63, 64, 65, 300]
    at = np.concatenate([[0], np.cumsum(sizes)])
    symbols = draw.integers(1, 300, at[-1])
    whole = lm.document_scores(net, symbols, at)
    monkeypatch.setattr(lm, "SCORE_STEPS", 7)
    assert np.allclose(whole, lm.document_scores(net, symbols, at), rtol=1e-4)
    one = lm.document_scores(net, symbols[at[4] : at[5]], np.array([0, 65]))
    assert whole[4] == pytest.approx(one[0], rel=1e-4)


def test_learns_a_pattern():
    frequency = np.zeros(lm.SYMBOLS)
    frequency[[0, 100, 101, 102]] = 1
    net = lm.Network.start(frequency)
    streams = lm.streams_of([np.array([100, 101, 102] * 8 + [0])] * 800)
    first = net.learn(streams)
    assert net.learn(streams) < 0.5 * first


def test_every_training_document_is_trained_on(spark):
    # Over ten million words, in batches of several chunks: the share of the documents that train must not fall with the size.
    n, length = 1400, 9000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("w"), F.col("id"), F.lit(" ")), length).alias("text"), (F.col("id") % 7 == 2).alias("held"))
    chunks = lm.encode(docs).withColumn("chunk", F.monotonically_increasing_id())
    held = n // 7
    empty = lm.Vocabulary(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(lm.SYMBOLS), (n - held) * (length + 1), n, n - held, np.zeros(lm.BUCKETS), np.zeros(lm.BUCKETS))
    chunks = settle(chunks, "chunks")
    got = lm.learned(chunks, empty, lm.Network.start(np.ones(lm.SYMBOLS)), 3).groupBy("block").agg(F.sum("weight")).collect()
    assert {r[1] for r in got} == {(n - held) * (length + 1)} and chunks.count() > 10

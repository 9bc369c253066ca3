"""A gated recurrent language model: log probabilities of complete documents.

Text is read once, into chunks: the distinct words of some megabytes of text as hashes,
and each document as indexes into them. Word counts cover all training documents, are
added up by chunk before they are shuffled, and come back to the chunks by word, so every
token is scored with its exact count while a word crosses the network once a chunk.

The model predicts symbols: the most frequent words, the end, and buckets of rarer words
by their ending. The softmax is factored into classes of symbols. A rare word's
probability is its bucket's times (count + 1) / (bucket's tokens + words + 1).

Training is truncated backpropagation in numpy over all training documents, one way at
every size. The chunks are dealt into rounds; each chunk of a round trains from the same
weights, where it is stored, and the weights are averaged by tokens in two levels, once a
round. The hidden state is carried from window to window, in
training and in scoring.

Defined results: a null or empty text is the end alone; a null ``doc_id`` is not held
out; repeated rows are scored alike and each counts in training; with nothing to learn
from, counts are 0 and scores come from the uniform start; an empty table gives an empty
result; further columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from demandkit.llm.words import coded, filled, hashed, mix, slices, split_words
from demandkit.runtime import settle

#: Symbols: the end, rare buckets, then frequent words. CLASSES x MEMBERS in all.
CLASSES, MEMBERS = 32, 64
SYMBOLS = CLASSES * MEMBERS
BUCKETS = 64
HIDDEN = 24
#: Steps of backpropagation, parallel streams of a shard, steps of scoring at a time.
UNROLL, LANES, SCORE_STEPS = 32, 256, 64
LEARNING_RATE, CLIP = 0.02, 1.0
#: Windows of a shard at least; a small shard has fewer streams.
LEAST_WINDOWS = 64
#: Rows of the softmax that are scored at a time.
SCORE_ROWS = 16_384
#: Rounds of averaging, each on chunks of its own.
ROUNDS = 2
#: Bytes of text of a chunk, which is a shard of training.
CHUNK_BYTES = 6 << 20
#: Weights that are averaged together.
BLOCK = 8192

CHUNK = (
    "doc_ids array<long>, held array<boolean>, at array<int>, words array<long>, buckets array<int>, "
    "counts array<long>, codes binary"
)

LEARNED = "part int, block int, weight double, sums binary"


def _buckets(words: pa.Array) -> np.ndarray:
    """The bucket of each word by its last two bytes."""
    data = words.cast(pa.large_binary())
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int32)
    offsets = np.frombuffer(data.buffers()[1], np.int64, n + 1, data.offset * 8)
    raw = np.frombuffer(data.buffers()[2], np.uint8)
    last = raw[offsets[1:] - 1].astype(np.uint64)
    second = np.where(np.diff(offsets) > 1, raw[np.maximum(offsets[1:] - 2, 0)], 0).astype(np.uint64)
    return (mix(last * np.uint64(256) + second) % np.uint64(BUCKETS)).astype(np.int32)


def encode(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, held) as chunks; ``counts`` are those in the chunk's training documents."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=CHUNK_BYTES):
            words, at = split_words(filled(part.column("text")), lower=True)
            codes, distinct = coded(words)
            held = part.column("held").to_numpy(zero_copy_only=False).astype(bool)
            trained = ~np.repeat(held, np.diff(at))
            counts = np.bincount(codes[trained], minlength=len(distinct))
            row = {
                "doc_ids": part.column("doc_id").to_pylist(), "held": held, "at": at.astype(np.int32),
                "words": hashed(distinct).view(np.int64), "buckets": _buckets(distinct), "counts": counts.astype(np.int64),
                "codes": codes.astype("<u2" if len(distinct) <= 1 << 16 else "<u4").tobytes(),
            }
            kinds = {"doc_ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()), "at": pa.list_(pa.int32()), "words": pa.list_(pa.int64()), "buckets": pa.list_(pa.int32()), "counts": pa.list_(pa.int64()), "codes": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array([row[c]], k) for c, k in kinds.items()], list(kinds))

    return docs.mapInArrow(make, CHUNK)


@dataclass
class Vocabulary:
    """Frequent words (sorted hashes) with their symbols, and the totals of the training tokens."""

    hashes: np.ndarray
    symbols: np.ndarray
    frequency: np.ndarray  # by symbol
    tokens: int
    words: int
    ends: int
    rare_tokens: np.ndarray  # by bucket, without the frequent words
    rare_words: np.ndarray

    def symbols_of(self, hashes: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        out = 1 + buckets.astype(np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            found = self.hashes[at] == hashes
            out[found] = self.symbols[at[found]]
        return out


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    """From word, bucket and count; only the frequent words and sums by bucket reach the driver."""
    top = counts.orderBy(F.desc("n"), "word").limit(SYMBOLS - 1 - BUCKETS).toArrow()
    by = counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    tokens, words = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in by:
        tokens[r.bucket], words[r.bucket] = r.n, r.v
    total, distinct = int(tokens.sum()), int(words.sum())
    hashes, n, bucket = (top.column(c).to_numpy() for c in ("word", "n", "bucket"))
    np.subtract.at(tokens, bucket, n)
    np.subtract.at(words, bucket, 1)
    frequency = np.zeros(SYMBOLS)
    frequency[0], frequency[1 : 1 + BUCKETS] = ends, tokens
    symbols = np.arange(1 + BUCKETS, 1 + BUCKETS + len(hashes))
    frequency[symbols] = n
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], symbols[order], frequency, total + ends, distinct + (ends > 0), ends, tokens, words)


class Network:
    """Gated recurrent units with an output over classes and over the members of the right class."""

    NAMES = ("inputs", "recurrent", "class_w", "class_b", "word_w", "word_b")

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def start(cls, frequency: np.ndarray, seed: int = 5) -> Network:
        """Small random weights; biases are the logarithms of the observed frequencies."""
        draw = np.random.default_rng(seed)
        normal = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
        share = (frequency + 0.5).reshape(CLASSES, MEMBERS)
        by_class = share.sum(axis=1)
        return cls({
            "inputs": normal(SYMBOLS, 3 * HIDDEN, scale=0.1), "recurrent": normal(HIDDEN, 3 * HIDDEN, scale=0.2),
            "class_w": normal(HIDDEN, CLASSES, scale=0.05), "class_b": np.log(by_class / by_class.sum()).astype(np.float32),
            "word_w": normal(CLASSES, HIDDEN, MEMBERS, scale=0.05), "word_b": np.log(share / by_class[:, None]).astype(np.float32),
        })

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w[k].reshape(-1) for k in self.NAMES])

    def _views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for k in self.NAMES:
            out[k] = flat[at : at + self.w[k].size].reshape(self.w[k].shape)
            at += self.w[k].size
        return out

    def filled(self, flat: np.ndarray) -> Network:
        return Network({k: v.astype(np.float32) for k, v in self._views(flat).items()})

    def run(self, symbols: np.ndarray, state: np.ndarray, trace: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hidden states (steps, lanes, HIDDEN) after the input symbols (steps, lanes). The end starts afresh."""
        # The gates lie one after the other, so that all work on a gate is on memory without gaps.
        inputs, u = _gates_first(self.w["inputs"]), _gates_first(self.w["recurrent"])
        out = np.empty((*symbols.shape, HIDDEN), np.result_type(u, state))
        ended, h = symbols == 0, state
        some = ended.any(axis=1).tolist()
        with np.errstate(over="ignore"):
            for t, x in enumerate(symbols):
                before = h
                if some[t]:
                    before = h.copy()
                    before[ended[t]] = 0
                gates, past = inputs.take(x, axis=1), before @ u
                # The logistic function; where the exponential is infinite it is 0, as it should be.
                both, new = gates[:2], gates[2]
                both += past[:2]
                np.negative(both, out=both)
                np.exp(both, out=both)
                both += 1
                np.reciprocal(both, out=both)
                z, r = both
                new += r * past[2]
                np.tanh(new, out=new)
                h = np.subtract(before, new, out=out[t])
                h *= z
                h += new
                if trace is not None:
                    trace.append((x, before, z, r, new, past[2]))
        return out, h.copy()

    def log_probabilities(self, hidden: np.ndarray, targets: np.ndarray, gradients: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural logarithms for each row; with ``gradients``, adds those of the mean loss and returns the one by state."""
        n = len(targets)
        cls, member = targets // MEMBERS, targets % MEMBERS
        rows = np.arange(n)
        p = hidden @ self.w["class_w"]
        p += self.w["class_b"]
        back = None
        if gradients is None:
            out = _picked(p, rows, cls)
        else:
            _softmax(p)
            out = np.log(np.maximum(p[rows, cls], 1e-30))
            p[rows, cls] -= 1
            p /= n
            gradients["class_w"] += hidden.T @ p
            gradients["class_b"] += np.ones(n, p.dtype) @ p
            back = p @ self.w["class_w"].T
        # Rows by class: products class by class, everything else at once.
        order = _order(cls)
        cuts = np.searchsorted(cls[order], np.arange(CLASSES + 1))
        present = [(c, slice(cuts[c], cuts[c + 1])) for c in range(CLASSES) if cuts[c] < cuts[c + 1]]
        place = np.empty(n, np.int64)
        place[order] = rows
        h, m = hidden.take(order, axis=0), member.take(order)
        q = np.empty((n, MEMBERS), np.result_type(h, self.w["word_w"]))
        for c, own in present:
            np.matmul(h[own], self.w["word_w"][c], out=q[own])
            q[own] += self.w["word_b"][c]
        if gradients is None:
            out += _picked(q, rows, m).take(place)
        else:
            _softmax(q)
            out += np.log(np.maximum(q[rows, m], 1e-30)).take(place)
            q[rows, m] -= 1
            q /= n
            by_word = np.empty((n, HIDDEN), q.dtype)
            for c, own in present:
                gradients["word_w"][c] += (q[own].T @ h[own]).T
                gradients["word_b"][c] += np.ones(own.stop - own.start, q.dtype) @ q[own]
                np.matmul(q[own], self.w["word_w"][c].T, out=by_word[own])
            back += by_word.take(place, axis=0)
        return out, back

    def learn(self, streams: np.ndarray) -> float:
        """One pass over streams (lanes, steps) of symbols; returns the mean loss of the pass."""
        flat = self.flat()
        self.w = self._views(flat)
        slope, momentum, second, spare = (np.zeros_like(flat) for _ in range(4))
        g = self._views(slope)
        state, losses = np.zeros((len(streams), HIDDEN), np.float32), []
        for step, begin in enumerate(range(0, streams.shape[1] - 1, UNROLL), 1):
            window = streams[:, begin : begin + UNROLL + 1].T
            trace: list = []
            hidden, state = self.run(window[:-1], state, trace)
            slope.fill(0)
            logs, back = self.log_probabilities(hidden.reshape(-1, HIDDEN), window[1:].reshape(-1), g)
            losses.append(-logs.mean())
            self._backward(trace, back.reshape(hidden.shape), g)
            slope *= min(1.0, CLIP / max(math.sqrt(float(slope @ slope)), 1e-12))
            rate = LEARNING_RATE * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            # In place: m += 0.1 (g - m), v += 0.001 (g g - v), w -= rate m / (sqrt(v) + 1e-8).
            momentum *= 0.9
            momentum += np.multiply(slope, 0.1, out=spare)
            second *= 0.999
            slope *= slope
            second += np.multiply(slope, 0.001, out=spare)
            np.sqrt(second, out=spare)
            spare += 1e-8
            np.divide(momentum, spare, out=spare)
            spare *= rate
            flat -= spare
        return float(np.mean(losses)) if losses else 0.0

    def _backward(self, trace: list, back: np.ndarray, g: dict[str, np.ndarray]) -> None:
        u, carry = self.w["recurrent"], np.zeros_like(back[0])
        shape = (len(trace), len(back[0]), 3, HIDDEN)
        given, past_ = np.empty(shape, back.dtype), np.empty(shape, back.dtype)
        own = np.empty((3, *back[0].shape), back.dtype)
        for t in range(len(trace) - 1, -1, -1):
            x, before, z, r, new, past = trace[t]
            d = carry + back[t]
            shut = 1 - z
            d_z, d_r, d_new = own
            np.multiply(d, shut, out=d_new)
            d_new *= 1 - new * new
            np.multiply(d, before - new, out=d_z)
            d_z *= z
            d_z *= shut
            np.multiply(d_new, past, out=d_r)
            d_r *= r
            d_r *= 1 - r
            given[t] = own.transpose(1, 0, 2)
            d_new *= r
            past_[t] = own.transpose(1, 0, 2)
            d *= z
            d += past_[t].reshape(-1, 3 * HIDDEN) @ u.T
            d[x == 0] = 0
            carry = d
        g["recurrent"] += np.concatenate([step[1] for step in trace]).T @ past_.reshape(-1, 3 * HIDDEN)
        # The rows of a symbol are added up before they meet its gradient.
        symbols = np.concatenate([step[0] for step in trace])
        order = _order(symbols)
        first = np.flatnonzero(np.diff(symbols[order], prepend=-1))
        rows = given.reshape(-1, 3 * HIDDEN).take(order, axis=0)
        # Two numbers at a time, as the parts of a complex one: sums of complex numbers are sums of their parts.
        pairs = rows.view(np.result_type(rows.dtype, np.complex64))
        g["inputs"][symbols[order[first]]] += np.add.reduceat(pairs, first, axis=0).view(rows.dtype)


def _gates_first(weights: np.ndarray) -> np.ndarray:
    """(rows, 3 * HIDDEN) as (3, rows, HIDDEN)."""
    return np.ascontiguousarray(weights.reshape(-1, 3, HIDDEN).transpose(1, 0, 2))


def _order(values: np.ndarray) -> np.ndarray:
    """The stable order of symbols or classes, by a radix sort, which numpy has for short integers."""
    return np.argsort(values.astype(np.uint16), kind="stable")


def _exponentials(logits: np.ndarray) -> np.ndarray:
    """In place; returns the sum of each row. One shift for all rows will do, as logits are a few
    dozen apart at most; sums that vanish all the same are kept above 0."""
    if not logits.size:
        return logits.sum(axis=1)
    logits -= logits.max()
    np.exp(logits, out=logits)
    return np.maximum(logits @ np.ones(logits.shape[1], logits.dtype), np.finfo(logits.dtype).tiny)


def _picked(logits: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Logarithms of the softmax at one place of each row; the logits are used up."""
    out = logits[rows, wanted] - (logits.max() if logits.size else 0)
    return out - np.log(_exponentials(logits))


def _softmax(logits: np.ndarray) -> np.ndarray:
    """In place."""
    logits *= (1 / _exponentials(logits))[:, None]
    return logits


def streams_of(sequences: list[np.ndarray]) -> np.ndarray:
    """Documents (each ending with the end) one after the other, cut into parallel streams."""
    joined = np.concatenate([np.zeros(1, np.int64), *sequences])
    lanes = max(1, min(LANES, (len(joined) - 1) // (LEAST_WINDOWS * UNROLL)))
    steps = (len(joined) - 1) // lanes
    return np.stack([joined[i * steps : (i + 1) * steps + 1] for i in range(lanes)])


def _codes(row: dict) -> np.ndarray:
    return np.frombuffer(row["codes"], "<u2" if len(row["words"]) <= 1 << 16 else "<u4").astype(np.int64)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows with lists as numpy arrays."""
    for i in range(batch.num_rows):
        row = {}
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            value = column[i]
            if isinstance(value, pa.ListScalar) and name != "doc_ids":
                row[name] = np.zeros(0, np.int64) if value.values is None else value.values.to_numpy(zero_copy_only=False)
            else:
                row[name] = value.as_py()
        yield row


def learned(rows: DataFrame, vocabulary_: Vocabulary, network: Network, width: int) -> DataFrame:
    """part, block, weight (training tokens) and sums: the weights of a network trained on each chunk
    from ``network``, in blocks, times the tokens."""
    shared = rows.sparkSession.sparkContext.broadcast((vocabulary_, network))

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary_, network = shared.value
        for batch in batches:
            for row in _rows(batch):
                symbols = vocabulary_.symbols_of(row["words"], row["buckets"])[_codes(row)]
                at, trained = row["at"], np.flatnonzero(~row["held"].astype(bool)).tolist()
                sequences = [np.append(symbols[at[i] : at[i + 1]], 0) for i in trained]
                weight = float(sum(map(len, sequences)))
                if not weight:
                    continue
                own = network.filled(network.flat())
                own.learn(streams_of(sequences))
                flat = own.flat().astype(np.float64) * weight
                blocks = [flat[i : i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)]
                n = len(blocks)
                part = int(mix(np.asarray([row["chunk"]]).astype(np.uint64))[0] % np.uint64(width))
                columns = [pa.array([part] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([weight] * n), pa.array(blocks, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "block", "weight", "sums"])

    return rows.select("chunk", "held", "at", "words", "buckets", "codes").mapInArrow(fit, LEARNED)


def train(chunks: DataFrame, vocabulary_: Vocabulary, start: Network) -> Network:
    """Rounds of local training on the chunks, and averages of their weights by tokens.

    A chunk is a shard: its training documents are read where they are stored, and only weights move.
    """
    now, width = start, max(1, math.isqrt(chunks.count()))

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.float64) for b in table.column("sums").to_pylist())
        weight = sum(table.column("weight").to_pylist())
        return pa.table({"part": pa.array([0], pa.int32()), "block": table.column("block").slice(0, 1), "weight": [weight], "sums": pa.array([total.tobytes()], pa.binary())})

    for turn in range(ROUNDS):
        local = learned(chunks.filter(F.pmod(F.xxhash64("chunk"), F.lit(ROUNDS)) == turn), vocabulary_, now, width)
        sums = local.groupBy("part", "block").applyInArrow(add, LEARNED).groupBy("block").applyInArrow(add, LEARNED)
        blocks = settle(sums, "weights").orderBy("block").collect()  # as many rows as the model has blocks
        if blocks:
            now = now.filled(np.concatenate([np.frombuffer(b.sums, np.float64) / b.weight for b in blocks]))
    return now


def document_scores(network: Network, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log probability (base 10) of each document's symbols and its end; the state goes from window to window."""
    n = len(at) - 1
    out = np.zeros(n)
    lengths = np.diff(at) + 1
    order = np.argsort(-lengths, kind="stable")
    state, active, begin = np.zeros((n, HIDDEN), np.float32), n, 0
    while active:
        lanes = order[:active]
        steps = int(min(SCORE_STEPS, lengths[lanes[0]] - begin))
        place = begin + np.arange(steps)[:, None]
        # Target t of a document is its word t, or the end; the input is the symbol before it.
        valid = place < lengths[lanes]
        targets = np.where(place < lengths[lanes] - 1, symbols[np.minimum(at[lanes] + place, len(symbols) - 1)], 0) if len(symbols) else np.zeros(valid.shape, np.int64)
        inputs = np.where(place > 0, symbols[np.clip(at[lanes] + place - 1, 0, len(symbols) - 1)], 0) if len(symbols) else targets
        hidden, state = network.run(inputs, state[:active])
        rows, wanted = hidden[valid], targets[valid]
        logs = np.concatenate([network.log_probabilities(rows[i : i + SCORE_ROWS], wanted[i : i + SCORE_ROWS])[0] for i in range(0, len(wanted), SCORE_ROWS)])
        out += np.bincount(np.broadcast_to(lanes, valid.shape)[valid], logs, minlength=n)
        begin += steps
        active = int(np.searchsorted(-lengths[order], -begin, "left"))
    return out / math.log(10)


def score(docs: DataFrame, held: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held.alias("held"))
    chunks = settle(encode(source).withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    found = chunks.select(F.explode(F.arrays_zip("words", "buckets", "counts")).alias("w")).select("w.*").filter("counts > 0")
    counts = settle(found.groupBy(F.col("words").alias("word")).agg(F.min("buckets").alias("bucket"), F.sum("counts").alias("n")), "counts")
    ends = chunks.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    vocabulary_ = vocabulary(counts, int(ends))

    network = train(chunks, vocabulary_, Network.start(vocabulary_.frequency))

    # The counts come back to the chunks: word by word, then chunk by chunk.
    wanted = chunks.select("chunk", F.posexplode("words").alias("place", "word"))
    known = (
        wanted.join(counts.select("word", "n"), "word")
        .groupBy("chunk").agg(F.collect_list("place").alias("places"), F.collect_list("n").alias("ns"))
    )
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary_, network))

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, net = shared.value
        buckets = np.log10(voc.rare_tokens + voc.rare_words + 1)
        whole = math.log10(voc.tokens + voc.words + 1)
        for batch in batches:
            for row in _rows(batch):
                c = np.zeros(len(row["words"]))
                c[row["places"]] = row["ns"]
                codes, at = _codes(row), row["at"].astype(np.int64)
                symbols = voc.symbols_of(row["words"], row["buckets"])
                inner = np.where(symbols <= BUCKETS, np.log10(c + 1) - buckets[row["buckets"]], 0.0)
                base = np.concatenate([[0.0], np.cumsum((np.log10(c + 1) - whole)[codes])])
                rare = np.concatenate([[0.0], np.cumsum(inner[codes])])
                seen = np.concatenate([[0], np.cumsum((c > 0)[codes])])
                of = lambda total: total[at[1:]] - total[at[:-1]]  # noqa: B023, E731
                n = len(row["held"])
                columns = [
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"].astype(bool)), pa.array(np.diff(at) + 1),
                    pa.array(of(seen) + (voc.ends > 0)), pa.array(np.full(n, voc.tokens)),
                    pa.array(of(base) + math.log10(voc.ends + 1) - whole),
                    pa.array(document_scores(net, symbols[codes], at) + of(rare)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    ready = chunks.join(known, "chunk", "left").select("doc_ids", "held", "at", "words", "buckets", "codes", "places", "ns")
    return ready.mapInArrow(make, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

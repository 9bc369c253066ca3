"""Near duplicates by SuperMinHash signatures, banding, verification and union-find.

A document's set holds its distinct word shingles (lower-cased A-Z). Documents with
equal sets form a class; only one of a class is searched for neighbours. Its signature
is cut into bands; the classes that share a band are a bucket. In each bucket one leader
is compared with all others, on whole sets, so a bucket of n near copies costs n
comparisons. Where a bucket still holds several components, the members outside its main
component are compared block against block with all others, until every pair is either
compared or in one component. So no bucket is capped, no task holds a whole bucket, and
no list of all pairs is made.

Only the signature can lose a link: with 40 bands of 5 values, two sets of similarity
0.8 share no band with a probability of 1.3e-7. Every pair that shares a band is verified.

Defined results: null and empty texts, and texts without words, have the empty set and
no links; fewer words than a shingle count as one shingle; rows with one ``doc_id`` are
one node, and so share a component; a null ``doc_id`` is kept unless others have its
set, whose component it then joins; an empty table gives an empty result; further
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from demandkit.llm.components import components
from demandkit.llm.words import GOLDEN, coded, filled, hashed, mix, slices, split_words
from demandkit.runtime import settle, small_side

ROWS, BANDS = 5, 40
#: Members of a block of a bucket.
BLOCK_MEMBERS = 1024
#: Elements whose permutations a step of the signature holds at once.
STEP_ELEMENTS = 60_000
_UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)
_LEVEL = np.uint64(56)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, at = split_words(texts, lower=True)
    codes, dictionary = coded(words)
    h = hashed(dictionary)[codes] if len(codes) else np.zeros(0, np.uint64)
    n = len(h) - size + 1
    acc = np.zeros(0, np.uint64)
    if n > 0:
        acc = mix(h[:n] + GOLDEN)
        for i in range(1, size):
            acc = mix(acc * GOLDEN ^ h[i : n + i])
    out = []
    for begin, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if end - begin >= size:
            out.append(np.unique(acc[begin : end - size + 1]))
        elif end > begin:
            one = mix(h[begin : begin + 1] + GOLDEN)
            for i in range(begin + 1, end):
                one = mix(one * GOLDEN ^ h[i : i + 1])
            out.append(mix(one + np.uint64(end - begin)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash: (sets, m) values, of which the upper 8 bits are the level.

    Each element walks through a random permutation of the slots. On its j-th step it
    offers j plus a random fraction to one slot. A set is done once all its slots are
    below the next level, so most elements take a single step. The steps of all sets are
    taken together.
    """
    out = np.full((len(sets), m), _UNSET)
    begin = 0
    sizes = np.asarray([len(s) for s in sets], dtype=np.int64)
    while begin < len(sets):
        end = max(begin + 1, int(np.searchsorted(np.cumsum(sizes[begin:]), STEP_ELEMENTS, "right")) + begin)
        _sign(sets[begin:end], sizes[begin:end], m, out[begin:end])
        begin = end
    return out


def _offer(h: np.ndarray, level: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The place in the permutation that a step swaps in, and the value it offers."""
    step = [np.uint64(int(GOLDEN) * (2 * level + i) % 2**64) for i in (1, 2)]
    a = mix(h + step[0])
    place = level + ((a >> np.uint64(32)) * np.uint64(m - level) >> np.uint64(32)).astype(np.int64)
    return place, (np.uint64(level) << _LEVEL) | (mix(h ^ step[1]) >> np.uint64(8))


def _sign(sets: list[np.ndarray], sizes: np.ndarray, m: int, out: np.ndarray) -> None:
    h, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    flat = out.reshape(-1)
    place, value = _offer(h, 0, m)
    np.minimum.at(flat, owner * m + place, value)
    open_ = out.max(axis=1) >> _LEVEL >= 1
    keep = open_[owner]
    h, owner, place = h[keep], owner[keep], place[keep]
    if not len(h):
        return
    slots = np.tile(np.arange(m, dtype=np.uint8), (len(h), 1))
    rows = np.arange(len(h))
    slots[rows, place], slots[:, 0] = slots[:, 0].copy(), place
    for level in range(1, m):
        place, value = _offer(h, level, m)
        slot = slots[rows, place]
        slots[rows, place] = slots[:, level]
        np.minimum.at(flat, owner * m + slot.astype(np.int64), value)
        still = out.max(axis=1) >> _LEVEL > level
        if not still[owner].all():
            keep = still[owner]
            h, owner, slots = h[keep], owner[keep], slots[keep]
            rows = np.arange(len(h))
        if not len(h):
            return


def band_hashes(signature: np.ndarray, rows: int) -> np.ndarray:
    """(sets, bands) 64-bit hashes; the number of the band goes into the hash."""
    n, m = signature.shape
    parts = signature.reshape(n, m // rows, rows)
    acc = mix(np.broadcast_to(np.arange(m // rows, dtype=np.uint64) + GOLDEN, parts.shape[:2]))
    for i in range(rows):
        acc = mix(acc * GOLDEN ^ parts[:, :, i])
    return acc


def features(docs: DataFrame, shingle: int, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """doc_id, n_shingles, set_id (16 bytes; null for the empty set) and band hashes."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = shingle_sets(filled(part.column("text")), shingle)
            hashes = band_hashes(signatures(sets, rows * bands), rows).view(np.int64)
            ids = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, hashes.size + 1, bands, dtype=np.int32), pa.array(hashes.reshape(-1))),
                ],
                ["doc_id", "n_shingles", "set_id", "bands"],
            )

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(make, "doc_id long, n_shingles long, set_id binary, bands array<long>")


def full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, n (size) and the whole set (sorted hashes as bytes)."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = shingle_sets(filled(part.column("text")), shingle)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "shingles"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(make, "doc_id long, shingles binary")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * common >= percent * (len(a) + len(b) - common)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets have ``100 * intersection >= percent * union``."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a"), batch.column("b"), strict=True):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                keep.append(_similar(a, b, percent))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    own = pairs.join(sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a")), "u")
    both = own.join(sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b")), "v")
    return both.select("u", "v", "a", "b").mapInArrow(compare, "u long, v long")


def _still_open(members: DataFrame, components_: DataFrame) -> DataFrame:
    """The members, but their leader, of the buckets that hold several components, with the bucket's
    largest component (``main``), its members and the other members."""
    rest = (
        members.filter("node <> leader").select("bucket", "node").join(components_, "node", "left")
        .select("bucket", "node", F.coalesce("component", "node").alias("component"))
    )
    sizes = rest.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    several = (
        sizes.groupBy("bucket")
        .agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"))
        .filter("parts > 1").select("bucket", F.col("top.component").alias("main"), F.col("top.n").alias("n_main"), (F.col("n") - F.col("top.n")).alias("n_other"))
    )
    # Written first, so that the join can split a bucket with most of the members.
    return settle(rest.join(settle(several, "several"), "bucket"), "open")


def _dealt(open_: DataFrame) -> DataFrame:
    """bucket, i, j, block, node and component: the members of each bucket in pairs of blocks.

    A small bucket is one block. In a larger one, the members of its main component, among
    which nothing is left to find, and the others have blocks of their own: those of the
    others meet all blocks, those of the main component no others of their kind. So a bucket of
    near copies with few strangers is dealt about once.
    """
    small = F.col("n_main") + F.col("n_other") <= BLOCK_MEMBERS
    in_main = F.col("component") == F.col("main")
    mains, others = (F.ceil(F.col(c) / F.lit(BLOCK_MEMBERS)).cast("int") for c in ("n_main", "n_other"))
    place = F.xxhash64("node")
    # Blocks of the others are 0, 1, ..., and those of the main component follow.
    block = F.when(small, 0).when(in_main, F.col("others") + F.pmod(place, F.col("mains"))).otherwise(F.pmod(place, F.col("others"))).cast("int")
    last = F.when(small, 0).when(in_main, F.col("others") - 1).otherwise(F.col("others") + F.col("mains") - 1).cast("int")
    placed = open_.withColumns({"mains": mains, "others": others}).withColumns({"block": block, "last": last})
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    return dealt.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "component")


def _blockwise_links(open_: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """Links between different components of a bucket, compared block against block.

    A task holds two blocks of a bucket, and their bands and whole sets (``whole``). Each pair is
    looked at in the first band that it shares. A task reports no more links than join its
    components.
    """

    def compare(table: pa.Table) -> pa.Table:
        bucket, i, j = (table.column(c)[0].as_py() for c in ("bucket", "i", "j"))
        node, block, root = (table.column(c).to_numpy() for c in ("node", "block", "component"))
        root = root.copy()
        own = np.stack([b.values.to_numpy() for b in table.column("bands")])
        whole = [np.frombuffer(b.as_buffer(), np.uint64) for b in table.column("shingles")]
        sizes = np.asarray([len(w) for w in whole])
        u, v = [], []
        right = np.flatnonzero(block == j)
        for a in np.flatnonzero(block == i).tolist():
            other = right[right > a] if i == j else right
            other = other[(root[other] != root[a]) & (100 * np.minimum(sizes[other], sizes[a]) >= percent * np.maximum(sizes[other], sizes[a]))]
            if not len(other):
                continue
            first = own[a][(own[other] == own[a]).argmax(axis=1)] == bucket
            for b in other[first].tolist():
                if root[a] != root[b] and _similar(whole[a], whole[b], percent):
                    root[root == root[b]] = root[a]
                    u.append(node[a])
                    v.append(node[b])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return _dealt(open_).join(whole, "node").groupBy("bucket", "i", "j").applyInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the smallest of its component) of every row."""
    found = settle(features(docs, shingle, rows, bands), "features")
    classes = settle(
        found.filter("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("node")), "classes"
    )
    # One row of a class stands for it; its bands are those of all its rows.
    stands = found.join(classes.select("set_id", F.col("node").alias("doc_id")), ["set_id", "doc_id"]).select("doc_id", "bands")
    exploded = stands.select(F.col("doc_id").alias("node"), F.explode("bands").alias("bucket"))
    shared = exploded.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("last")).filter("leader < last")
    shared = small_side(settle(shared.select("bucket", "leader"), "shared"))
    members = settle(exploded.join(shared, "bucket").select("bucket", "node", "leader").distinct(), "members")

    components_ = None
    if not members.isEmpty():
        wanted = settle(members.select(F.col("node").alias("doc_id")).distinct(), "wanted")
        sets = settle(full_sets(docs.join(small_side(wanted), "doc_id", "left_semi"), shingle), "sets")
        pairs = members.filter("node <> leader").select(F.col("node").alias("u"), F.col("leader").alias("v")).distinct()
        # Sizes that are too far apart rule a pair out before its sets are moved.
        sizes = settle(found.join(small_side(wanted), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most")), "sizes")
        u, v = (small_side(sizes).select(F.col("doc_id").alias(k), F.col("least").alias(f"least_{k}"), F.col("most").alias(f"most_{k}")) for k in ("u", "v"))
        fits = (100 * F.col("most_u") >= percent * F.col("least_v")) & (100 * F.col("most_v") >= percent * F.col("least_u"))
        pairs = settle(pairs.join(u, "u").join(v, "v").filter(fits).select("u", "v"), "pairs")
        links = settle(verified(pairs, sets, percent), "near")
        components_ = settle(components(links), "components")
        open_ = _still_open(members, components_)
        if not open_.isEmpty():
            own = stands.join(open_.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
            whole = settle(own.join(sets, "doc_id").withColumnRenamed("doc_id", "node"), "whole")
            more = settle(_blockwise_links(open_, whole, percent), "near")
            if not more.isEmpty():
                # The components so far are stars, which need no more rounds; only new links join them.
                stars = components_.select(F.col("node").alias("u"), F.col("component").alias("v"))
                components_ = settle(components(stars.unionByName(more)), "components")

    of_class = classes if components_ is None else classes.join(components_, "node", "left")
    component = F.col("node") if components_ is None else F.coalesce("component", "node")
    # Rows with one doc_id but different sets are one node: the smallest component counts.
    named = found.select("doc_id", "n_shingles", "set_id").join(of_class.select("set_id", component.alias("component_id")), "set_id", "left")
    own = F.coalesce("component_id", "doc_id")
    return named.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))

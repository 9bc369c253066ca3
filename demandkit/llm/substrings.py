"""Removal of long byte strings that occur more than once, judged on whole texts.

A byte goes if a string of ``length`` bytes that covers it starts at any other place too.
Suffixes are looked at as the strings of ``length`` bytes at their start:

1. A cover sample of the places is ranked first. The sample is content-defined: every
   string of ``length`` bytes holds a sample place, at the same offset in equal strings,
   so one rank (the hash of the bytes from that place) stands for a tie of ``gram`` bytes.
   Consecutive starts with one sample place form an interval.
2. Suffixes fall into one bucket for each rank. Buckets with a single member are unique
   strings; they end here, which is most of the text.
3. A bucket is refined by what the ranks leave open: the bytes around the sample place, as
   whole intervals first, then as cells of an interval, then start by start. Each step
   goes on only with groups that hold different strings with a common core.

Groups are counted with partial sums and joined back, never gathered; a task holds one
text at a time. Copies of one text are looked at once, with their number.

Defined results: a null text is empty; repeated rows are copies of one text; a null
``doc_id`` is kept; an empty table gives an empty result; further columns of the input
are ignored unless the text is asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from demandkit.llm.cover import BLOCK, Strings, intervals
from demandkit.llm.words import GOLDEN, filled, mix, slices
from demandkit.runtime import settle

LENGTH, GRAM = 200, 90
#: Starts of a cell.
CELL = 23


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of ``filled`` texts, and where each begins and ends (n + 1)."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if texts.buffers()[2] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _all_intervals(data: np.ndarray, length: int, gram: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, Strings]]:
    """Blocks of one text: where the block begins, and its intervals in it."""
    for begin in range(0, max(1, len(data) - length + 1), BLOCK):
        part = data[begin : begin + BLOCK + length - 1]
        yield begin, *intervals(part, np.full(len(part), len(part)), length, gram)


def _pair(strings: Strings, begin: np.ndarray, end: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the bytes and of the offset of the sample place in them."""
    offset = mix((place - begin).astype(np.uint64) + GOLDEN)
    return tuple((strings.hash(begin, end, k) ^ offset).view(np.int64) for k in (0, 1))


def _ranks(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Every text's digest, size, checksum and the ranks of its intervals."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=1 << 20):
            texts = filled(part.column("text"))
            data, at = _bytes(texts)
            lists: list[np.ndarray] = []
            if at[-1] <= BLOCK:  # short texts share one pass
                lengths = np.diff(at)
                first, _, place, strings = intervals(data, np.repeat(at[1:], lengths), length, gram)
                rank = strings.hash(place, place + gram)
                lists = np.split(rank, np.searchsorted(first, at[1:-1])) if len(lengths) > 1 else [rank]
            else:
                for a, b in zip(at[:-1], at[1:], strict=True):
                    ranks = [s.hash(place, place + gram) for _, _, _, place, s in _all_intervals(data[a:b], length, gram)]
                    lists.append(np.concatenate(ranks))
            raw = [data[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            ranks = np.concatenate(lists).view(np.int64) if lists else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array([hashlib.md5(b).digest() for b in raw], pa.binary()), pa.array(np.diff(at)),
                    pa.array([hashlib.sha256(b).hexdigest() for b in raw], pa.string()), pa.ListArray.from_arrays(ends, pa.array(ranks)),
                ],
                ["doc_id", "digest", "n_bytes", "sha256", "ranks"],
            )

    return docs.mapInArrow(make, "doc_id long, digest binary, n_bytes long, sha256 string, ranks array<long>")


def _wholes(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """The wanted intervals (numbers ``ks``) of each text: rank, where they are, and 128 bits of their bytes."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, ks in zip(batch.column("row"), batch.column("text"), batch.column("ks"), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                wanted, seen = np.sort(ks.values.to_numpy()), 0
                out: list[tuple] = []
                for begin, first, last, place, s in _all_intervals(data, length, gram):
                    own = wanted[(wanted >= seen) & (wanted < seen + len(first))] - seen
                    f, e, p = first[own], last[own], place[own]
                    one, two = _pair(s, f, e + length, p)
                    out.append((own + seen, f + begin, e + begin, p + begin, s.hash(p, p + gram).view(np.int64), one, two))
                    seen += len(first)
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                names = ["k", "first", "last", "place", "rank", "one", "two"]
                arrays = [pa.array(np.full(len(columns[0]), row.as_py())), *(pa.array(c.astype(np.int64)) for c in columns)]
                yield pa.RecordBatch.from_arrays(arrays, ["row", *names])

    return texts.select("row", "text", "ks").mapInArrow(make, "row long, k long, first long, last long, place long, rank long, one long, two long")


def _lists(batch: pa.RecordBatch, name: str) -> Iterator[list[np.ndarray]]:
    """The fields of a list of structs, row by row."""
    for value in batch.column(name):
        yield [f.to_numpy(zero_copy_only=False) for f in value.values.flatten()]


def _blocks(data: np.ndarray, low: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, int, Strings]]:
    """Which of the ``low`` starts lie in a block, where it begins, and the hashes of its bytes, block by block."""
    of = low // BLOCK
    for b in np.unique(of).tolist():
        yield np.flatnonzero(of == b), b * BLOCK, Strings(data[b * BLOCK : (b + 1) * BLOCK + length + CELL])


def _cells(texts: DataFrame, length: int) -> DataFrame:
    """The cells of the wanted intervals: the core that all their starts share, and all their bytes."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, (first, last, place) in zip(batch.column("row"), batch.column("text"), _lists(batch, "wanted"), strict=True):
                low, high, at = [], [], []
                for j in range(-(-length // CELL)):
                    lo, hi = np.maximum(first, place - CELL * j - CELL + 1), np.minimum(last, place - CELL * j)
                    real = lo <= hi
                    low.append(lo[real]), high.append(hi[real]), at.append(np.stack([place[real], np.full(real.sum(), j)]))
                lo, hi, (p, j) = np.concatenate(low), np.concatenate(high), np.concatenate(at, axis=1)
                for own, begin, s in _blocks(np.frombuffer(text.as_buffer(), np.uint8), lo, length):
                    l, h, q, i = lo[own] - begin, hi[own] - begin, p[own] - begin, j[own]
                    core = s.hash(q - CELL * i, q - CELL * i - CELL + 1 + length) ^ mix(i.astype(np.uint64) + GOLDEN)
                    one, two = _pair(s, l, h + length, q)
                    arrays = [np.full(len(l), row.as_py()), lo[own], hi[own], p[own], core.view(np.int64), one, two]
                    yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)) for a in arrays], ["row", "low", "high", "place", "core", "one", "two"])

    return texts.mapInArrow(make, "row long, low long, high long, place long, core long, one long, two long")


def _starts(texts: DataFrame, length: int) -> DataFrame:
    """Every start of the wanted cells, with 128 bits of the string there."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, (low, high) in zip(batch.column("row"), batch.column("text"), _lists(batch, "wanted"), strict=True):
                for own, begin, s in _blocks(np.frombuffer(text.as_buffer(), np.uint8), low, length):
                    n = high[own] - low[own] + 1
                    at = np.repeat(low[own] - begin - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    arrays = [np.full(len(at), row.as_py()), at + begin, *(s.hash(at, at + length, k).view(np.int64) for k in (0, 1))]
                    yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)) for a in arrays], ["row", "at", "one", "two"])

    return texts.mapInArrow(make, "row long, at long, one long, two long")


def _removed(texts: DataFrame, with_text: bool) -> DataFrame:
    """What is left of each text without its ``ranges``."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, (begin, end) in zip(batch.column("row"), batch.column("text"), _lists(batch, "ranges"), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                change = np.zeros(len(data) + 1, np.int32)
                np.add.at(change, begin, 1)
                np.add.at(change, end, -1)
                gone = np.cumsum(change[:-1], dtype=np.int32) > 0
                left = data[~gone].tobytes()
                spans = int(gone[:1].sum() + (np.diff(gone.astype(np.int8)) == 1).sum())
                arrays = [[row.as_py()], [int(gone.sum())], [spans], [hashlib.sha256(left).hexdigest()], [left if with_text else None]]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)], ["row", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])

    return texts.mapInArrow(make, "row long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary")


def _repeated_ranges(texts: DataFrame, length: int, wholes: DataFrame) -> DataFrame:
    """row, begin and end of byte ranges that lie in repeated strings.

    ``wholes`` are the intervals of repeated ranks, with the ``copies`` of their text.
    """
    same = ["rank", "one", "two"]
    kinds = settle(
        wholes.groupBy(*same).agg(F.sum("copies").alias("n"), F.min(F.struct("row", "k", "first", "last", "place")).alias("own")), "kinds"
    )
    # Whole intervals that occur again.
    twice = wholes.join(kinds.filter("n > 1").select(*same), same).select("row", F.col("first").alias("begin"), (F.col("last") + length).alias("end"))
    # Ranks with different surroundings: one interval of each kind goes on as cells.
    mixed = kinds.groupBy("rank").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("rank")
    wanted = kinds.join(mixed, "rank", "left_semi").select("own.*").groupBy("row").agg(F.collect_list(F.struct("first", "last", "place")).alias("wanted"))
    cells = settle(_cells(texts.join(wanted, "row").select("row", "text", "wanted"), length), "cells")
    same = ["core", "one", "two"]
    parts = settle(cells.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "low", "high")).alias("own")), "parts")
    again = cells.join(parts.filter("n > 1").select(*same), same).select("row", F.col("low").alias("begin"), (F.col("high") + length).alias("end"))
    # Cores with different surroundings: one cell of each goes on start by start.
    mixed = parts.groupBy("core").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("core")
    wanted = parts.join(mixed, "core", "left_semi").select("own.*").groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("wanted"))
    starts = settle(_starts(texts.join(wanted, "row").select("row", "text", "wanted"), length), "starts")
    found = settle(starts.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("one", "two"), "found")
    single = starts.join(found, ["one", "two"]).select("row", F.col("at").alias("begin"), (F.col("at") + length).alias("end"))
    return twice.unionByName(again).unionByName(single)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    ``with_text`` adds the remaining bytes of rows that lose some.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = settle(_ranks(source, length, gram).withColumn("row", F.monotonically_increasing_id()), "ranks")
    # One row stands for the copies of a text.
    stands = settle(found.groupBy("digest").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("copies")), "stands")
    places = found.select("row", "ranks").join(stands.select("row", "copies"), "row").select("row", "copies", F.posexplode("ranks").alias("k", "rank"))
    # Written, so that the join can split the places of a very common rank.
    repeated = settle(places.groupBy("rank").agg(F.sum("copies").alias("n")).filter("n > 1").select("rank"), "repeated")
    flagged = places.join(repeated, "rank").groupBy("row").agg(F.collect_list(F.col("k")).alias("ks"))
    candidates = stands.join(flagged, "row")
    whole = source.groupBy(F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest")).agg(F.first("text").alias("text"))
    texts = settle(whole.join(candidates, "digest").select("row", "copies", F.col("text").cast("binary").alias("text"), "ks"), "texts")
    wholes = settle(_wholes(texts, length, gram), "wholes").join(stands.select("row", "copies"), "row")
    ranges = _repeated_ranges(texts.select("row", "text"), length, wholes)
    by_row = ranges.groupBy("row").agg(F.collect_set(F.struct("begin", "end")).alias("ranges"))
    cut = _removed(texts.select("row", "text").join(by_row, "row"), with_text)
    of_text = stands.join(cut, "row").select("digest", "n_removed", "n_spans", "kept_sha256", "kept_bytes")
    return found.select("doc_id", "digest", "n_bytes", "sha256").join(of_text, "digest", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"), *(["kept_bytes"] if with_text else []),
    )

"""Shared helpers of the text operators: Arrow batches in bounded slices, words, hashes.

A word is a maximal run of characters outside ``[\\x20\\x09-\\x0D]``.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one step of a task handles; a longer document is a step of its own.
SLICE_BYTES = 4 << 20


def filled(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Texts as one plain string array, null as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts.cast(pa.large_string()), "")


#: What a worker remembers between the tasks of one operator; at most one thing.
_KEPT: list = []


def keep(thing: object | None) -> None:
    """Remember ``thing`` (or nothing) between tasks; what another operator left is given up."""
    if _KEPT and _KEPT[0] is not thing:
        _KEPT.pop().forget()
    if thing is not None and not _KEPT:
        _KEPT.append(thing)


def give_back() -> None:
    """Hand memory that is no longer used back to the machine: workers live on between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES, kept: object | None = None
) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces of about ``limit`` bytes of text, whatever the batch size.

    ``kept`` is what the operator remembers between tasks, if anything.
    """
    keep(kept)
    try:
        yield from _slices(batches, column, limit)
    finally:
        give_back()


def _slices(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.concatenate([[0], np.cumsum(sizes)[:-1]]) // limit if len(sizes) else np.zeros(0, np.int64)
        cuts = np.flatnonzero(np.diff(part)) + 1
        for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if end > begin:
                yield batch.slice(begin, end - begin)


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of ``filled`` texts in order, and where each text's words begin and end (n + 1)."""
    lists = pc.ascii_split_whitespace(texts)
    # The new array of words is lowered: ascii_lower damages texts that were cast from a slice.
    flat, offsets = pc.ascii_lower(lists.values) if lower else lists.values, lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not real.all():
        flat = flat.filter(pa.array(real))
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
    first = offsets[0] if len(offsets) else 0
    return flat.slice(first, offsets[-1] - first), offsets - first


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words as indexes into their distinct values."""
    dictionary = words.dictionary_encode()
    return dictionary.indices.to_numpy(zero_copy_only=False).astype(np.int64), dictionary.dictionary


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (the splitmix finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def hashed(values: pa.Array) -> np.ndarray:
    """64-bit hash of each string, by polynomials over all strings' bytes at once."""
    values = values.cast(pa.large_binary())
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    n = len(values)
    if n == 0:
        return np.zeros(0, np.uint64)
    buffers = values.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, n + 1, values.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    lengths = np.diff(offsets)
    out = mix(lengths.astype(np.uint64) + GOLDEN)
    if not len(data):
        return out
    # Each byte counts by its place in its string.
    place = np.arange(len(data), dtype=np.int64) - np.repeat(offsets[:-1], lengths)
    mixed = mix(place.astype(np.uint64) * np.uint64(257) + data.astype(np.uint64) + GOLDEN)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    return mix(out ^ (total[offsets[1:]] - total[offsets[:-1]]))

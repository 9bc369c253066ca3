"""Packing documents into training sequences.

Documents are tokenized and cut into pieces of at most a sequence. Full pieces are
sequences of their own. The others are dealt into random groups, and within each
group packed first-fit decreasing: a tournament tree over the bins holds the largest
free capacity below each node, so the first bin that fits is found in log(bins) steps.

Defined results: a null or empty text is the end token alone; a null ``doc_id`` is
kept; repeated rows are packed once each (as separate documents with equal ids); an
empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from demandkit.llm.words import SLICE_BYTES, coded, filled, hashed, slices
from demandkit.runtime import settle

#: Remembered pieces of a worker's tokenizer (about 80 bytes each, and as much while they grow); beyond it, those not met for longest go.
CACHE_WORDS = 1_500_000
#: Words whose ids are gathered at a time.
GATHER_WORDS = 1 << 20
#: Pieces that are packed together, on average.
GROUP_PIECES = 2048

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class CachedTokenizer:
    """Ids of whole texts, equal to encoding each text at once.

    The byte-level pre-tokenizer never joins a non-space character with a following
    space, so a text with single spaces and newlines only is the concatenation of its
    space-led words, and each distinct word is encoded once; letters and a full stop or
    comma after them are encoded apart. What stands between two spaces is a piece. Known pieces
    are kept in arrays, with their ids in one pool: the distinct pieces of some megabytes of
    text are looked up at once, and the ids of all texts gathered from the pool. Other texts
    are encoded whole.
    """

    _odd = re.compile(r"\s|<\|")

    def __init__(self, path: str):
        #: Remembered pieces at most; None for the module's number.
        self.cache_words: int | None = None
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.newline = self.ids("\n")
        self.marks = {m: self.ids(m) for m in ".,"}
        self.forget()

    def forget(self) -> None:
        #: Pieces led by a space, the place of their ids in the pool, how many they have (-1: a text with
        #: this piece is encoded whole), and when they were last met.
        self.known = pa.array([], pa.large_string())
        #: Sorted hashes of the pieces, and the piece of each.
        self.hashes, self.piece = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.start, self.length, self.met = (np.zeros(0, np.int64) for _ in range(3))
        self.pool, self.time = np.zeros(0, "<u4"), 0

    def ids(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _most(self) -> int:
        return CACHE_WORDS if self.cache_words is None else self.cache_words

    def _keep_half(self) -> None:
        """Give up the pieces that have not been met for longest."""
        stay = np.sort(np.argsort(-self.met, kind="stable")[: self._most() // 2])
        n = np.maximum(self.length[stay], 0)
        self.pool = self._gathered(self.start[stay], n)
        self.known, self.length, self.met = self.known.take(pa.array(stay)), self.length[stay], self.met[stay]
        self.start = np.cumsum(n) - n
        hashes = hashed(self.known)
        self.piece = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.piece]

    def _gathered(self, start: np.ndarray, n: np.ndarray) -> np.ndarray:
        ends = np.cumsum(n)
        out = np.empty(ends[-1] if len(ends) else 0, "<u4")
        for begin in range(0, len(n), GATHER_WORDS):
            part = slice(begin, begin + GATHER_WORDS)
            a, b = ends[begin] - n[begin], ends[part][-1]
            out[a:b] = self.pool[np.repeat(start[part] - (ends[part] - n[part] - a), n[part]) + np.arange(b - a)]
        return out

    def _add(self, pieces: list[str], ids: list[bytes | None]) -> None:
        n = np.asarray([-1 if x is None else len(x) // 4 for x in ids], dtype=np.int64)
        new = pa.array(pieces, pa.large_string())
        hashes = hashed(new)
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes, self.piece = np.insert(self.hashes, at, hashes[order]), np.insert(self.piece, at, len(self.known) + order)
        self.known = pa.concat_arrays([self.known, new])
        self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(np.maximum(n, 0)) - np.maximum(n, 0)])
        self.length = np.concatenate([self.length, n])
        self.met = np.concatenate([self.met, np.full(len(ids), self.time)])
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(x for x in ids if x), "<u4")])

    def _found(self, pieces: pa.Array) -> np.ndarray:
        """The places of pieces among the known ones, -1 for others. What a hash finds is compared."""
        place = np.full(len(pieces), -1)
        if len(self.known) and len(pieces):
            hashes = hashed(pieces)
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            maybe = np.flatnonzero(self.hashes[at] == hashes)
            found = self.piece[at[maybe]]
            same = pc.equal(pieces.take(pa.array(maybe)), self.known.take(pa.array(found))).to_numpy(zero_copy_only=False)
            place[maybe[same]] = found[same]
        return place

    def _encoded(self, words: set[str]) -> tuple[dict[str, bytes | None], list[str]]:
        """Ids of words, each led by a space or not and without other white space at its ends, and the
        led ones among their stems that were not known."""
        stem = lambda w: w[:-1] if w[-1] in ".," and w[:-1].lstrip(" ").isalpha() else w
        out: dict[str, bytes | None] = {}
        stems = list({stem(w) for w in words})
        led = [w for w in stems if w[0] == " "]
        for w, at in zip(led, self._found(pa.array([w[1:] for w in led], pa.large_string())).tolist(), strict=True):
            if at >= 0:
                a, n = self.start[at], self.length[at]
                out[w] = None if n < 0 else self.pool[a : a + n].tobytes()
        new = [w for w in stems if w not in out]
        out.update((w, None) for w in new if self._odd.search(w, 1 if w[0] == " " else 0))
        new = [w for w in new if w not in out]
        text = "\n".join(new) + "\n"
        ids = np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(ids == np.frombuffer(self.newline, "<u4")[0]) if len(self.newline) == 4 else ids[:0]
        if new and len(ends) != len(new):
            raise ValueError("the tokenizer has no newline token of its own")
        data, begin = ids.tobytes(), 0
        for word, end in zip(new, ends.tolist()):
            out[word] = data[4 * begin : 4 * end]
            begin = end + 1
        for w in words:
            if w not in out:
                own = out[w[:-1]]
                out[w] = None if own is None else own + self.marks[w[-1]]
        return out, [w for w in new if w[0] == " "]

    @staticmethod
    def _words(piece: str, lead: str) -> list[str] | None:
        """The lines of what stands between two spaces, the first one led; None where white space meets."""
        if "\n" not in piece:
            return [lead + piece] if piece else None
        lines = piece.split("\n")
        if not lines[0] or not lines[-1] or "\n\n\n" in piece:
            return None
        return [lead + lines[0], *lines[1:]]

    def _pieces(self, pieces: list[str], firsts: list[str], alone: list[bool]) -> list[bytes | None]:
        """Ids of unknown pieces, which are known from now on, and of the first pieces of texts."""
        # An empty text has no ids; a text that begins with a space is not empty.
        own = [[""] if not p and one else self._words(p, "") for p, one in zip(firsts, alone, strict=True)]
        split = [self._words(p, " ") for p in pieces] + own
        known, new = self._encoded({w for words in split if words for w in words if w})
        known[""] = b""
        out: list[bytes | None] = []
        for words in split:
            ids = [known[w] for w in words] if words else [None]
            out.append(None if None in ids else ids[0] if len(ids) == 1 else self.newline.join(ids))
        listed = dict.fromkeys(pieces)
        stems = [w[1:] for w in new if w[1:] not in listed]
        self._add([*pieces, *stems], [*out[: len(pieces)], *(known[" " + w] for w in stems)])
        return out[len(pieces) :]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        return [ids.tobytes() for ids in self.encode_array(pa.array(texts, pa.large_string()))]

    def encode_array(self, texts: pa.Array) -> list[np.ndarray]:
        """The same for an array of texts, as arrays."""
        if not len(texts):
            return []
        self.time += 1
        if len(self.known) > self._most():
            self._keep_half()
        lists = pc.split_pattern(texts, " ")
        at = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        flat, at = lists.values.slice(at[0], at[-1] - at[0]), at - at[0]
        codes, distinct = coded(flat)
        place = self._found(distinct)
        unknown = place < 0
        firsts = flat.take(pa.array(at[:-1])).to_pylist()
        begin = len(self.known)
        first_ids = self._pieces(distinct.filter(pa.array(unknown)).to_pylist(), firsts, (np.diff(at) == 1).tolist())
        place[unknown] = begin + np.arange(unknown.sum())
        self.met[place] = self.time
        # The first piece of a text is not led by a space: its ids stand behind the pool for this once.
        kept = len(self.pool)
        n = np.asarray([-1 if x is None else len(x) // 4 for x in first_ids], dtype=np.int64)
        starts = np.concatenate([self.start[place], kept + np.cumsum(np.maximum(n, 0)) - np.maximum(n, 0)])
        lengths = np.concatenate([self.length[place], n])
        codes[at[:-1]] = len(place) + np.arange(len(n))
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(x for x in first_ids if x), "<u4")])
        sizes = lengths[codes]
        whole = np.minimum.reduceat(sizes, at[:-1]) < 0
        sizes = np.maximum(sizes, 0)
        out = self._gathered(starts[codes], sizes)
        self.pool = self.pool[:kept]
        cuts = np.concatenate([[0], np.cumsum(sizes)])[at]
        return [
            np.frombuffer(self.ids(texts[i].as_py()), "<u4") if whole[i] else out[a:b]
            for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        ]


_TOKENIZERS: dict[str, CachedTokenizer] = {}


def tokenizer(path: str, cache_words: int | None = None) -> CachedTokenizer:
    """One for each worker process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = CachedTokenizer(path)
    _TOKENIZERS[path].cache_words = cache_words
    return _TOKENIZERS[path]


def pieces(
    docs: DataFrame, tokenizer_path: str, sequence: int = 2048, end_id: int = 1, with_ids: bool = False,
    cache_words: int | None = None, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Each document's ids with the end token, cut into pieces of at most ``sequence``.

    ``with_ids`` adds the ids themselves. ``cache_words`` and ``slice_bytes`` bound what a worker
    remembers and handles at a time; they change no result.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, end = tokenizer(tokenizer_path, cache_words), np.asarray([end_id], dtype="<u4")
        for part in slices(batches, limit=slice_bytes, kept=tok):
            rows, keys, all_ids = [], [], []
            for k, ids in zip(part.column("doc_id").to_pylist(), tok.encode_array(filled(part.column("text"))), strict=True):
                total = len(ids) + 1
                for start in range(0, total, sequence):
                    piece = ids[start : start + sequence]
                    last = start + sequence >= total
                    crc = zlib.crc32(piece)
                    keys.append(k)
                    rows.append((start, len(piece) + last, zlib.crc32(end, crc) if last else crc, total))
                    if with_ids:
                        all_ids.append((np.concatenate([piece, end]) if last else piece).astype("<i4"))
            columns = np.asarray(rows, dtype=np.int64).reshape(-1, 4).T
            arrays = [pa.array(keys, pa.int64()), *(pa.array(np.ascontiguousarray(c)) for c in columns)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                arrays.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


class BinTree:
    """Bins in order of opening; a tournament of their free capacities."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """The first bin that has room, and the room it had."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        had = free[node]
        free[node] = had - size
        bin_ = node - self.leaves
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
        return bin_, had


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each size; equal sizes in the given order."""
    tree, out = BinTree(len(sizes), capacity), [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        bin_, had = tree.place(sizes[i])
        out[i] = (bin_, capacity - had)
    return out


def pack(parts: DataFrame, sequence: int = 2048, group_pieces: int = GROUP_PIECES, seed: int = 7) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    Full pieces have negative sequence ids and move nowhere. The rest is dealt by a
    hash of its row number, so no key gathers in one group, however often it occurs.
    """
    numbered = settle(parts.withColumn("piece_id", F.monotonically_increasing_id()), "pieces")
    names = [f.name for f in parts.schema.fields]
    full = numbered.filter(F.col("length") >= sequence).select(
        *names, (-1 - F.col("piece_id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = numbered.filter(F.col("length") < sequence)
    groups = max(1, -(-rest.count() // group_pieces))
    schema = numbered.drop("piece_id").schema.add("sequence_id", "long").add("offset", "long")

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece_id")
        placed = first_fit_decreasing(table.column("length").to_pylist(), sequence)
        group = table.column("group")[0].as_py()
        return table.select(names).append_column(
            "sequence_id", pa.array([(group << 32) + b for b, _ in placed], pa.int64())
        ).append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    dealt = rest.withColumn("group", F.pmod(F.xxhash64("piece_id", F.lit(seed)), F.lit(groups)))
    return full.unionByName(dealt.groupBy("group").applyInArrow(fill, schema))

"""Quality of documents by their words and by lines that recur across a host.

Lines are normalised (lower case, white space as one space, digits as 0) and hashed. For
each host and line the documents that hold it are counted, each document once, copies of
others included. Lines of more than ``limit`` documents of a host are removed: the limit is a
number and not a share, as a template shows by its repetition, however large its host. A document is depleted, and rejected, if less than
``min_share`` of its words or fewer than ``min_words`` remain.

Defined results: a null or empty text has no words and fails the base rules; a null host
is a host of its own; repeated rows are judged alike and count as documents each; an empty
table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from demandkit.llm.words import GOLDEN, coded, filled, hashed, mix, slices, split_words
from demandkit.runtime import settle

#: Fixed values of the base rules.
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
BASE_MIN_WORDS = 10
BASE_MAX_REPEAT_PERCENT = 20

LIMIT = 20
MIN_SHARE = 0.3
MIN_WORDS = 10

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(codes: np.ndarray, at: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each text, its words inside windows that its text holds twice or more."""
    n = len(codes) - window + 1
    if n <= 0:
        return np.zeros(len(at) - 1, np.int64)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    acc = mix(owner[:n].astype(np.uint64) * GOLDEN)
    for i in range(window):
        acc = mix(acc * GOLDEN ^ codes[i : n + i].astype(np.uint64))
    starts = np.flatnonzero(owner[:n] == owner[window - 1 :])
    starts = starts[np.argsort(acc[starts], kind="stable")]
    a, b = starts[:-1], starts[1:]
    same = acc[a] == acc[b]
    a, b = a[same], b[same]
    real = owner[a] == owner[b]
    for i in range(window):
        real &= codes[a + i] == codes[b + i]
    change = np.zeros(len(codes) + 1, np.int64)
    twice = np.unique(np.concatenate([a[real], b[real]]))
    change[twice] += 1
    change[twice + window] -= 1
    covered = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
    return covered[at[1:]] - covered[at[:-1]]


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]


def normal_lines(lines: pa.Array) -> pa.Array:
    lower = pc.utf8_lower(pc.ascii_trim_whitespace(lines))
    return pc.replace_substring_regex(pc.replace_substring_regex(lower, r"[\x20\x09-\x0D]+", " "), "[0-9]", "0")


def _described(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """The base columns, and each text's distinct lines: where they end, hash, words."""
    words, at = split_words(texts)
    codes, dictionary = coded(words)
    chars = pc.utf8_length(dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
    symbols = pc.count_substring_regex(dictionary, SYMBOLS).to_numpy(zero_copy_only=False).astype(np.int64)

    split = pc.split_pattern(texts, "\n")
    lines, line_at = split.values, split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    lines = lines.slice(line_at[0], line_at[-1] - line_at[0])
    owner = np.repeat(np.arange(len(texts)), np.diff(line_at))
    line_codes, distinct = coded(lines)
    per_line = np.diff(split_words(distinct)[1])[line_codes] if len(distinct) else np.zeros(0, np.int64)
    full = per_line > 0
    owner, line_codes, per_line = owner[full], line_codes[full], per_line[full]
    pairs = np.unique(owner * (len(distinct) + 1) + line_codes) // (len(distinct) + 1)
    dup_lines = np.bincount(owner, minlength=len(texts)) - np.bincount(pairs, minlength=len(texts))

    keys = hashed(normal_lines(distinct))[line_codes] if len(distinct) else np.zeros(0, np.uint64)
    order = np.lexsort((keys, owner))
    owner, keys, per_line = owner[order], keys[order], per_line[order]
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])])) if len(keys) else np.zeros(0, np.int64)
    line_words = np.add.reduceat(per_line, first) if len(first) else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=len(texts)))])
    base = [np.diff(at), _sums(chars[codes], at), _sums(symbols[codes], at), dup_lines, repeated_words(codes, at)]
    return base, ends, keys[first].view(np.int64), line_words


def profiles(docs: DataFrame, host: str = "source", with_text: bool = False) -> DataFrame:
    """doc_id, host, the base columns and the distinct lines with their words."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = filled(part.column("text"))
            base, ends, keys, line_words = _described(texts)
            ends = ends.astype(np.int32)
            lines = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(keys), pa.array(line_words)], ["line", "words"]))
            arrays = [part.column("doc_id"), part.column("host"), *(pa.array(b.astype(np.int64)) for b in base), lines]
            names = ["doc_id", "host", *BASE, "lines"]
            if with_text:
                arrays, names = [*arrays, texts.cast(pa.string())], [*names, "text"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    source = docs.select(F.col("doc_id").cast("long"), F.col(host).cast("string").alias("host"), F.col("text").cast("string"))
    schema = "doc_id long, host string, " + ", ".join(f"{b} long" for b in BASE)
    return source.mapInArrow(make, schema + ", lines array<struct<line: long, words: long>>" + (", text string" if with_text else ""))


def base_failed() -> Column:
    few = F.col("n_words") < BASE_MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > BASE_MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(
    docs: DataFrame, host: str = "source", limit: int = LIMIT, min_share: float = MIN_SHARE,
    min_words: int = MIN_WORDS, with_text: bool = False,
) -> DataFrame:
    """The base columns, ``base_failed``, ``n_removed_words``, ``n_removed_lines`` and ``kept`` of every row.

    ``with_text`` adds the text without the removed lines.
    """
    found = settle(profiles(docs, host, with_text).withColumn("row", F.monotonically_increasing_id()), "profiles")
    # A document has each of its lines once.
    lines = found.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.line", "l.words")
    # They are written, so that the join can split the rows of a very common line.
    frequent = (
        lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("documents")).filter(F.col("documents") > limit)
        .select(F.col("host").alias("h"), F.col("line").alias("l"))
    )
    frequent = settle(frequent, "frequent-lines")
    hit = lines.join(frequent, F.col("host").eqNullSafe(F.col("h")) & (F.col("line") == F.col("l")))
    removed = hit.groupBy("row").agg(
        F.sum("words").alias("n_removed_words"), F.count(F.lit(1)).alias("n_removed_lines"),
        *([F.collect_list("line").alias("removed")] if with_text else []),
    )
    gone, left = F.coalesce("n_removed_words", F.lit(0)), F.col("n_words") - F.coalesce("n_removed_words", F.lit(0))
    failed = base_failed()
    depleted = (gone > 0) & ((left < min_words) | (left < min_share * F.col("n_words")))
    out = found.join(removed, "row", "left").select(
        "doc_id", *BASE, failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
        gone.alias("n_removed_words"), F.coalesce("n_removed_lines", F.lit(0)).alias("n_removed_lines"),
        *(["text", "removed"] if with_text else []),
    )
    return _cleaned(out) if with_text else out


def _cleaned(judged: DataFrame) -> DataFrame:
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = []
            for text, gone in zip(part.column("text").to_pylist(), part.column("removed").to_pylist(), strict=True):
                if gone:
                    gone = set(gone)
                    lines = text.split("\n")
                    keys = hashed(normal_lines(pa.array(lines, pa.large_string()))).view(np.int64).tolist()
                    text = "\n".join(line for line, key in zip(lines, keys, strict=True) if key not in gone)
                texts.append(text)
            yield part.drop_columns(["text", "removed"]).append_column("text", pa.array(texts, pa.string()))

    return judged.mapInArrow(make, judged.drop("text", "removed").schema.add("text", "string"))

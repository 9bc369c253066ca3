"""Mixing sources to target weights by iterative proportional fitting.

Token counts are added up by source, language and topic. The cells are then raked: in
turn, the expected kept tokens of each source, each language and each topic are scaled to
their targets, with no cell kept by more than a probability of 1, until all three fit.
Each document is kept with the probability of its cell, decided by a hash of its id.

Targets are shares of the kept tokens: given by the caller, or the observed shares raised
to a power below 1 (flatter than the corpus). Tokens are words between white space. A target
beyond all the tokens of its value is met as far as they reach; how far each margin is from
its target can be asked for.

Topics are told apart by the most widespread long terms of each language, counted over
all documents: a document that uses the k-th such term of its language most has topic k.

Defined results: a null or empty text has no tokens and the topic ``other``; a null
source or language is the value ``(none)``; rows with one id are kept or dropped
together; a null id counts by the text; an empty table gives an empty result; further
columns are carried along.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from demandkit.llm.words import coded, filled, slices, split_words
from demandkit.runtime import settle

MARGINS = ("source", "lang", "topic")
NONE, OTHER = "(none)", "other"
#: Topic terms of each language and the letters they have at least.
TOPICS, TOPIC_LETTERS = 6, 6
#: Powers of the observed shares that are the default targets.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.8}
#: Share of the tokens to keep; largest relative misfit of a margin that is a fit.
RATE, TOLERANCE = 0.5, 0.005
#: Sweeps without progress that end raking; the share of the misfit that counts as progress.
STALLED, FALLING = 5, 0.01


def _topic_words(distinct: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.utf8_trim(distinct, ".,;:!?()[]\"'"))


def topic_terms(docs: DataFrame, topics: int = TOPICS, letters: int = TOPIC_LETTERS) -> dict[str, list[str]]:
    """For each language, the terms of at least ``letters`` letters that most of its documents hold."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words, at = split_words(filled(part.column("text")))
            codes, distinct = coded(words)
            lang, langs = coded(part.column("lang"))
            term, names = coded(_topic_words(distinct))
            fits = pc.and_(pc.utf8_is_alpha(names), pc.greater_equal(pc.utf8_length(names), letters)).to_numpy(zero_copy_only=False)
            owner, of = np.repeat(np.arange(len(at) - 1), np.diff(at)), term[codes] if len(codes) else codes
            wanted, n = fits[of] if len(of) else np.zeros(0, bool), len(names) + 1
            pairs = np.unique(owner[wanted] * n + of[wanted])
            pairs, held = np.unique(lang[pairs // n] * n + pairs % n, return_counts=True)
            columns = [langs.take(pa.array(pairs // n)), names.take(pa.array(pairs % n)).cast(pa.string()), pa.array(held.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "n"])

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"), F.col("text").cast("string"))
    counted = rows.mapInArrow(count, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "term"))
    # topics x languages rows.
    out: dict[str, list[str]] = {}
    for r in counted.withColumn("place", place).filter(F.col("place") <= topics).orderBy("lang", "place").collect():
        out.setdefault(r.lang, []).append(r.term)
    return out


def described(docs: DataFrame, terms: Mapping[str, Sequence[str]], carry: Sequence[str]) -> DataFrame:
    """rest (the carried columns), source, lang, topic, n_tokens and the key of each document."""
    listed = sorted({t for own in terms.values() for t in own})
    number = {lang: [own.index(t) if t in own else -1 for t in listed] for lang, own in terms.items()}
    topics = max(map(len, terms.values()), default=0)

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words, at = split_words(filled(part.column("text")))
            codes, distinct = coded(words)
            found = pc.index_in(_topic_words(distinct), pa.array(listed, pa.large_string()))
            index = pc.fill_null(found, len(listed)).to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
            lang, langs = coded(part.column("lang"))
            table = np.full((len(langs), len(listed) + 1), -1)
            for i, name in enumerate(langs.to_pylist()):
                table[i, : len(listed)] = number.get(name, -1)
            of = table[lang[owner], index[codes]] if len(codes) else codes
            counts = np.bincount(owner[of >= 0] * topics + of[of >= 0], minlength=(len(at) - 1) * topics).reshape(-1, max(1, topics)) if topics else np.zeros((len(at) - 1, 1))
            topic = [f"topic {b + 1}" if c[b] else OTHER for b, c in zip(counts.argmax(axis=1).tolist(), counts, strict=True)]
            part = part.drop_columns(["text"]).append_column("topic", pa.array(topic, pa.string()))
            yield part.append_column("n_tokens", pa.array(np.diff(at)))

    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.col("text")))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carry)).alias("rest"),
        *(F.coalesce(F.col(m).cast("string"), F.lit(NONE)).alias(m) for m in MARGINS[:2]),
        key.alias("key"), F.col("text").cast("string").alias("text"),
    )
    schema = StructType(list(rows.drop("text").schema.fields)).add("topic", "string").add("n_tokens", "long")
    return rows.mapInArrow(make, schema)


def margin_targets(cells: DataFrame, margin: str, total: float, power: float, shares: Mapping[str, float] | None) -> DataFrame:
    """The margin's values and the tokens to keep of each."""
    values = cells.groupBy(margin).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    if shares is None:
        weight: Column = F.pow(F.col("tokens"), F.lit(power))
    else:
        given = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in shares.items()], f"{margin} string, share double")
        values, weight = values.join(given, margin, "left"), F.coalesce("share", F.lit(0.0))
    values = values.withColumn("weight", weight)
    whole = values.agg(F.sum("weight").alias("whole"))
    return values.join(F.broadcast(whole)).select(margin, (F.try_divide(F.lit(float(total)) * F.col("weight"), F.col("whole"))).alias("target"))


def rake_with_misfits(
    cells: DataFrame, rate: float = RATE, powers: Mapping[str, float] = POWERS, shares: Mapping[str, Mapping[str, float]] | None = None,
    margins: Sequence[str] = MARGINS, tolerance: float = TOLERANCE, sweeps: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The cells (margins and ``tokens``) with the ``probability`` to keep, and how well each margin
    is met: margin, value, target, ``expected`` (the tokens kept on average) and ``misfit``.

    Each sweep is one small job over the cells; it is written, so that the next one
    neither repeats it nor loses it with an executor. Sweeps go on until all margins fit, or until
    the largest misfit has not fallen for ``STALLED`` sweeps: then the targets contradict each
    other, or go beyond the tokens there are, and the misfits tell by how much. ``sweeps`` ends
    raking earlier if the caller wants so.
    """
    total = (cells.agg(F.sum("tokens")).first()[0] or 0) * rate
    targets = {
        m: settle(margin_targets(cells, m, total, powers.get(m, 1.0), (shares or {}).get(m)), "targets") for m in margins
    }
    now = cells.select(*margins, "tokens", F.lit(float(rate)).alias("x"))
    least, stalled, done = math.inf, 0, 0
    while True:
        off = F.lit(0.0)
        for m in margins:
            capped = F.col("x") >= 1
            sums = now.groupBy(m).agg(
                F.sum(F.when(capped, F.col("tokens")).otherwise(0)).alias("fixed"),
                F.sum(F.when(capped, 0.0).otherwise(F.col("tokens") * F.col("x"))).alias("open"),
            )
            room = F.col("target") - F.col("fixed")
            # Where capped cells alone exceed the target, all cells of the value shrink.
            factor = (
                F.when(room <= 0, F.try_divide(F.col("target"), F.col("fixed") + F.col("open")))
                .when(F.col("open") > 0, F.try_divide(room, F.col("open")))
            )
            scale = sums.join(targets[m], m).select(m, F.coalesce(factor, F.lit(1.0)).alias("f"), (room <= 0).alias("shrink"))
            # Cells without tokens have no target; they keep their x.
            now = now.join(scale, m, "left").withColumns(
                {
                    f"off_{m}": F.abs(F.coalesce("f", F.lit(1.0)) - 1),
                    "x": F.when(F.col("shrink"), F.least("x", F.lit(1.0))).otherwise(F.col("x")) * F.coalesce("f", F.lit(1.0)),
                }
            ).drop("f", "shrink")
            off = F.greatest(off, F.when(F.col("x") < 1, F.col(f"off_{m}")).otherwise(0.0))
        now = settle(now.select(*margins, "tokens", F.least("x", F.lit(1e9)).alias("x"), off.alias("off")), "raked")
        largest = now.agg(F.max("off")).first()[0] or 0
        now = now.drop("off")
        stalled = 0 if largest < least * (1 - FALLING) else stalled + 1
        least, done = min(least, largest), done + 1
        if largest <= tolerance or stalled >= STALLED or done == sweeps:
            break
    raked = now.select(*margins, "tokens", F.least("x", F.lit(1.0)).alias("probability"))
    misfits = None
    for m in margins:
        kept = raked.groupBy(m).agg(F.sum(F.col("tokens") * F.col("probability")).alias("expected"))
        part = targets[m].join(kept, m).select(
            F.lit(m).alias("margin"), F.col(m).alias("value"), "target", "expected", F.abs(F.try_divide(F.col("expected"), F.col("target")) - 1).alias("misfit")
        )
        misfits = part if misfits is None else misfits.unionByName(part)
    return raked, misfits


def rake(cells: DataFrame, *args, **options) -> DataFrame:
    """The cells of :func:`rake_with_misfits`."""
    return rake_with_misfits(cells, *args, **options)[0]


def mix(
    docs: DataFrame, carry: Sequence[str] = ("doc_id",), rate: float = RATE, powers: Mapping[str, float] = POWERS,
    shares: Mapping[str, Mapping[str, float]] | None = None, seed: int = 11,
) -> DataFrame:
    """rest (the carried columns), source, lang, topic, n_tokens, ``probability``, ``weight`` (its
    inverse) and ``kept`` of every document."""
    found = settle(described(docs, topic_terms(docs), carry), "described")
    cells = settle(found.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    raked = rake(cells, rate, powers, shares).select(*MARGINS, "probability")
    uniform = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 32)) / float(1 << 32)
    return found.join(raked, list(MARGINS)).select(
        "rest", *MARGINS, "n_tokens", "probability", F.try_divide(F.lit(1.0), F.col("probability")).alias("weight"),
        (uniform < F.col("probability")).alias("kept"),
    )

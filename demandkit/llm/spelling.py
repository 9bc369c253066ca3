"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words, the longer one (of equal lengths: the smaller one) contributes chunks, the
other grams. The two chunks are the first and the last ``q`` letters, ``q`` being half of
the word's length, so they are disjoint and one edit leaves at least one of them whole.
The other word has a surviving chunk as a gram within shift one: at the same place
before the edit, moved by the difference of the lengths behind it. Grams at other places
cannot pass that test and are left out before the shuffle. What a surviving chunk
leaves open is cut in two again, and one of these pieces is whole as well, so that words meet
by three quarters of their letters. Words that meet are verified letter by letter.

A word's form is its most frequent near word, if that is many times as frequent; the root
follows the forms to the last. Each step multiplies the frequency, so chains are short.

Defined results: null and empty texts have no words; repeated rows count again; a null
``doc_id`` is written as an empty text before the colon; of equally frequent near words
the smallest in code-point order is the form; an empty table gives an empty result;
further columns of the input are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from demandkit.runtime import settle

#: Letters of a word, as in the contract of the runs.
LETTERS = r"[A-Za-zÀ-ÿ]"
MIN_LETTERS, MIN_COUNT, TIMES = 7, 2, 10
#: One run in so many is spoilt by one lost letter.
SPOIL = 31


def spoilt(doc_id: Column, run: Column, every: int = SPOIL) -> Column:
    """The run without one letter where ``every`` divides the checksum of its document and itself."""
    h = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
    at = (h % F.length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, without).otherwise(run)


def count_words(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, every: int = SPOIL) -> DataFrame:
    """word and n: maximal runs of letters, A-Z in lower case, some of them spoilt."""
    # A run loses one letter at most, so shorter ones cannot count.
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"{LETTERS}{{{min_letters},}}"), F.lit(0))
    rows = docs.select("doc_id", F.explode(runs).alias("run"))
    low = rows.select("doc_id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    words = low.select(spoilt(F.col("doc_id"), F.col("run"), every).alias("word")).filter(F.length("word") >= min_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _keys(word: Column, own: Column, length: Column) -> list[Column]:
    """The four keys under which a word of ``own`` letters meets words of ``length`` letters.

    A half at one end (the chunk, or the gram in its place) and a piece of the rest. Places
    are counted from the end that is on the same side of the edit.
    """
    q = F.floor(length / 2).cast("int")
    r = F.floor((length - q) / 2).cast("int")

    def cut(start: Column, size: Column) -> Column:
        return F.substring(word, start + 1, size)

    zero = F.lit(0)
    first, last = cut(zero, q), cut(own - q, q)
    parts = [(first, cut(q, r)), (first, cut(own - r, r)), (last, cut(zero, r)), (last, cut(own - q - r, r))]
    return [F.xxhash64(length, F.lit(i), half, piece) for i, (half, piece) in enumerate(parts)]


def near_pairs(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b: each two words that differ by exactly one inserted, deleted or replaced letter, once."""
    size = F.length("word")
    chunks = words.select(
        F.col("word").alias("a"), F.col("n").alias("n_a"), F.explode(F.array(*_keys(F.col("word"), size, size))).alias("key")
    )
    places = [k for length in (size, size + 1) for k in _keys(F.col("word"), size, length)]
    grams = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.explode(F.array(*places)).alias("key"))
    once = (F.length("a") > F.length("b")) | (F.length("a") == F.length("b")) & (F.col("a") < F.col("b"))
    met = chunks.join(grams, "key").filter(once & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "n_a", "b", "n_b").distinct()


def forms(words: DataFrame, pairs: DataFrame, times: int = TIMES) -> DataFrame:
    """word, n, n_near, form and form_n (null where no near word is ``times`` as frequent)."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    best = F.min(F.struct((-F.col("n_b")).alias("minus"), F.col("b").alias("form")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    fits = -F.col("best.minus") >= F.col("n") * times
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.minus")).alias("form_n"),
    )


def roots(linked: DataFrame) -> DataFrame:
    """word and root of every word that has a form; each round doubles the steps taken."""
    chain = settle(linked.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        chain = settle(chain.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if chain.filter("moved").isEmpty():
            return chain.select("word", "root")
        chain = chain.select("word", "root")


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, n, n_near, form, form_n and root of every row of ``words`` (word and n)."""
    words = settle(words.select("word", "n"), "words")
    linked = settle(forms(words, near_pairs(words), times), "forms")
    return linked.join(roots(linked), "word", "left").withColumn("root", F.coalesce("root", "word"))

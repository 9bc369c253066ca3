"""Words and slices against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from demandkit.llm import words

TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB é\u00a0\x1c\x85\t\n\x0b\r漢"), max_size=20)), max_size=6)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.booleans())
def test_words_equal_the_pattern(texts, lower):
    flat, at = words.split_words(words.filled(pa.array(texts, pa.string())), lower)
    lowered = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") if lower else t or "" for t in texts]
    expected = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in lowered]
    assert [flat.slice(a, b - a).to_pylist() for a, b in zip(at, at[1:])] == expected


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 30))
def test_slices_hold_all_rows_in_order(texts, limit):
    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    parts = list(words.slices([batch], limit=limit))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts and all(p.num_rows for p in parts)


def test_hashes_tell_strings_apart():
    values = ["", "a", "b", "ab", "ba", "aa", "a" * 300, "é", "a\0", "\0a"]
    h = words.hashed(pa.array(values * 2, pa.large_string()))
    assert len(np.unique(h)) == len(values) and (h[: len(values)] == h[len(values) :]).all()


class Kept:
    forgotten = 0

    def forget(self):
        self.forgotten += 1


def test_what_one_operator_keeps_another_gives_up():
    kept = Kept()
    for _ in range(2):
        list(words.slices([], kept=kept))
    assert kept.forgotten == 0
    list(words.slices([]))
    list(words.slices([]))
    assert kept.forgotten == 1


def test_lower_words_of_a_slice():
    texts = pa.array([f"Word{i} AND and" for i in range(40)], pa.string())
    whole, _ = words.split_words(words.filled(texts), lower=True)
    part, at = words.split_words(words.filled(texts.slice(30)), lower=True)
    assert part.to_pylist() == whole.to_pylist()[90:] and at.tolist() == list(range(0, 31, 3))

"""Language ID: held-out accuracy, spans, the path against plain dynamic programming, edge rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from demandkit.llm import language
from demandkit.llm.queries import QUERIES

TRAIN = [
    ("the house of the king and that they were going there", "en"),
    ("das Haus und die Straße ist nicht weit von hier", "de"),
    ("это новый дом и он стоит на улице", "ru"),
    ("το σπίτι είναι μεγάλο και ωραίο", "el"),
]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t, lang, "x") for t, lang in TRAIN * 5] + [("zzz", None, "x"), (None, "en", "x"), ("", "de", "x")]
    return language.learn(spark.createDataFrame(rows, "text string, lang string, label string"))


def test_scripts_and_spans(spark, model):
    mixed = "the house of the king and that they were going there " + "это новый дом и он стоит на улице"
    rows = [(1, mixed), (2, "και το σπίτι"), (3, "123 !? ..."), (4, None), (5, ""), (6, "ქართული"), (7, "the\x00king"), (None, "das Haus"), (None, "das Haus")]
    docs = spark.createDataFrame([(*r, "y") for r in rows], "doc_id long, text string, score string")
    out = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert len(out) == 8
    cut = mixed.index("это")
    assert out[1].spans == f"0:{cut}:en,{cut}:{len(mixed)}:ru" and out[1].n_spans == 2 and 0 < out[1].share < 1
    assert out[2].lang_pred == "el" and out[2].spans == "0:12:el"
    for i in (3, 4, 5):
        assert (out[i].lang_pred, out[i].score, out[i].spans) == ("und", 0.0, "")
    assert out[6].lang_pred in model.languages and out[7].lang_pred == "en" and out[None].lang_pred == "de"


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    none = language.learn(empty)
    docs = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    assert language.identify(docs, none).first().lang_pred == "und"
    assert language.identify(docs.limit(0), none).count() == 0


def plain_viterbi(scores, switch):
    value, back = scores[0].copy(), []
    for row in scores[1:]:
        top = int(value.argmax())
        better = value[top] - switch > value
        back.append(np.where(better, top, np.arange(len(row))))
        value = np.where(better, value[top] - switch, value) + row
    out = [int(value.argmax())]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1]


def cost(scores, labels, switch):
    return sum(s[x] for s, x in zip(scores, labels)) - switch * sum(a != b for a, b in zip(labels, labels[1:]))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=6), st.integers(0, 2**32 - 1), st.sampled_from([0.5, 2.0, 6.0]))
def test_path_is_best(sizes, seed, switch):
    draw = np.random.default_rng(seed)
    at = np.concatenate([[0], np.cumsum(sizes)])
    scores = draw.normal(0, 2, (at[-1], 3))
    labels = language.viterbi(scores, at, switch)
    for a, b in zip(at, at[1:]):
        if b > a:
            assert np.isclose(cost(scores[a:b], labels[a:b], switch), cost(scores[a:b], plain_viterbi(scores[a:b], switch), switch))


def test_words_with_the_separator():
    g = language.grams(pa.array(["a\0b", "c"]))
    assert g.letters.tolist() == [2, 1]


def test_held_out_accuracy(spark, sf):
    out = QUERIES["op2_language_id"](spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    assert (out.held_out == out.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    both = out.merge(docs, on="doc_id")
    own = both[both.held_out & both.lang.notna()]
    assert len(out) == len(docs) and (own.lang_pred == own.lang).mean() > 0.97
    assert out.score.between(0, 1).all()


def test_too_many_labels_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    docs = spark.createDataFrame([(f"text in {x}", x) for x in "abc"], "text string, lang string")
    with pytest.raises(ValueError, match="3 labels"):
        language.learn(docs)
    language.learn(docs.filter("lang <> 'c'"))

"""The stages one after the other, against what their decisions must be."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline as pipeline  # noqa: E402
from test_near_dup import brute  # noqa: E402

STAGES = dict(pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    base = "the old house by the river has a garden and a small wooden boat that nobody uses any more since the winter "
    rows = [
        (1, base * 3, "en", "a", 0, "x"), (2, base * 3 + "extra", "en", "a", 0, "y"), (3, "Write to jo@mail.example or +49 30 1234567 today please", "en", "b", 0, "z"),
        (4, "12 34 --", "en", "b", 0, None), (5, None, "en", "b", 0, None), (6, "", None, None, 0, None), (7, "kurzer Satz über das Haus am Fluss", "de", "b", 0, "q"),
        (8, base * 3, "en", "c", 0, "x"), (8, base * 3, "en", "c", 0, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rest string")


def test_language_stage_drops_texts_without_letters(spark, docs):
    out = STAGES["language"](spark, docs, "")
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 2, 3, 7, 8, 8]


def test_language_stage_drops_foreign_texts(spark, sf):
    """Texts in languages that were never learned go, and nearly all others stay."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    foreign = [
        "kaksikymmentäviisi pyöräilijää ylittää jäätyneen järven yöllä hyvin hitaasti eikä kukaan näe heitä",
        "przyszłość źdźbła trzciny szczęśliwie przekształca się w chrząszcza który brzmi wśród gęstych krzewów",
        "xq zvkj wqpx kkzq jjxv qqzw vxzk pqxj zzkq wvxq jkzx qvzp xxkj zqwv kjqx vzqp wxkz qjzv pxqk zvjx",
    ]
    rows = [(10**7 + i, t, None, "web") for i, t in enumerate(foreign)]
    both = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), allowMissingColumns=True)
    kept = {r.doc_id for r in STAGES["language"](spark, both, "").select("doc_id").collect()}
    assert not kept & {r[0] for r in rows}
    clean = {r.doc_id for r in docs.filter("text rlike '[A-Za-z]'").select("doc_id").collect()}
    assert len(clean - kept) <= 0.01 * len(clean)


def test_a_stage_removes_what_earlier_ones_wrote(spark, docs, tmp_path):
    first = STAGES["language"](spark, docs, "")
    held = list(pipeline._SCRATCH[spark.sparkContext.applicationId])
    STAGES["near duplicates"](spark, first, "").write.parquet(str(tmp_path / "out"))
    assert Path(held[-1]).exists(), "the documents were still read from it"
    STAGES["mixing"](spark, spark.read.parquet(str(tmp_path / "out")), "").write.parquet(str(tmp_path / "mixed"))
    assert not Path(held[-1]).exists()
    assert len(pipeline._SCRATCH[spark.sparkContext.applicationId]) == 1


def test_near_duplicate_stage_keeps_one_of_each_group(spark, docs):
    out = STAGES["near duplicates"](spark, docs, "").collect()
    first = docs.dropDuplicates(["doc_id"]).collect()
    groups = brute([r.doc_id for r in first], [r.text for r in first], 5)
    assert sorted(r.doc_id for r in out) == sorted(i for i, (_, root) in groups.items() if i == root)


def test_personal_data_stage(spark, docs):
    out = {r.doc_id: r for r in STAGES["personal data"](spark, docs, "").collect()}
    assert out[3].text == "Write to <EMAIL> or <PHONE> today please" and out[3].n_chars == len(out[3].text)
    assert out[1].text == docs.filter("doc_id = 1").first().text and out[1].rest == "x"


def test_mixing_stage_keeps_rows_whole(spark, docs):
    out = STAGES["mixing"](spark, docs, "")
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}


def test_run_packs_what_the_stages_keep(spark, sf):
    out = pipeline.run(spark, sf)
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    total = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert 0.4 * total < len(ids) < total
    assert out.groupBy("sequence_id").sum("length").filter("`sum(length)` > 2048").isEmpty()


def test_empty_table(spark, docs):
    empty = docs.limit(0)
    for _, stage in pipeline.STAGES:
        out = stage(spark, empty, "")
        assert out.count() == 0

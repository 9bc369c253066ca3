"""Base rules and line frequencies against plain Python, and the query against SQL."""

import random
import re

import pytest

from compare import connect, differences
from demandkit.llm import line_quality
from demandkit.llm.oracle import ORACLE
from demandkit.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, twice = set(), set()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    for w in windows:
        (twice if w in seen else seen).add(w)
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def brute_kept(rows, limit):
    norm = lambda x: re.sub("[0-9]", "0", " ".join(WORD.findall(x)).lower())
    texts = {}
    for _, host, text in rows:
        for x in (text or "").split("\n"):
            if WORD.search(x):
                texts.setdefault((host, norm(x)), set()).add(text)
    out = []
    for doc_id, host, text in rows:
        gone = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if WORD.search(x) and len(texts[host, norm(x)]) > limit)
        n, *_, failed = brute(text)
        out.append((doc_id, not failed and not (gone and (n - gone < 10 or n - gone < 0.3 * n)), gone))
    return out


ROWS = []
_pick = random.Random(5)
for _i in range(120):
    _own = " ".join(_pick.choice("abcdefghij") + str(_pick.randrange(40)) for _ in range(_pick.choice([0, 3, 9, 30, 200])))
    _lines = [_own, *(_pick.choice(["Share this page 12 times", "Sign  in\there", "All # rights | reserved 2024", _own, ""]) for _ in range(_pick.randrange(6)))]
    _pick.shuffle(_lines)
    ROWS.append((_i, _pick.choice(["h1", "h1", "h2", None]), "\n".join(_lines)))
ROWS += [(200, "h1", None), (201, "h1", ""), (202, "h1", " \n\t "), (203, "h1", ROWS[3][2]), (203, "h1", ROWS[3][2]), (None, "h2", "Á b " * 20)]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, source string, text string, lines string")


def test_base_and_verdict(docs):
    out = line_quality.judge(docs, limit=8).collect()
    order = lambda rows: sorted(rows, key=repr)
    assert order((r.doc_id, *(r[b] for b in line_quality.BASE), r.base_failed) for r in out) == order((i, *brute(t)) for i, _, t in ROWS)
    assert order((r.doc_id, r.kept, r.n_removed_words) for r in out) == order(brute_kept(ROWS, 8))
    assert any(r.n_removed_words for r in out)


def test_cleaned_text(docs):
    out = line_quality.judge(docs, limit=8, with_text=True).collect()
    for r in out:
        assert len(WORD.findall(r.text)) == r.n_words - r.n_removed_words


def test_copies_of_one_text_are_documents_each(spark):
    text = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(i, "h", text) for i in range(50)], "doc_id long, source string, text string")
    assert {r.kept for r in line_quality.judge(docs, limit=49).collect()} == {False}
    assert {r.kept for r in line_quality.judge(docs, limit=50).collect()} == {True}


def test_a_document_counts_once_for_a_line_it_repeats(spark):
    line = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(i, "h", f"{line}\n" * 9 + f"own words of number {i} and a few more of them here") for i in range(3)], "doc_id long, source string, text string")
    assert {r.n_removed_lines for r in line_quality.judge(docs, limit=3).collect()} == {0}


def test_empty_table(spark):
    assert line_quality.judge(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0


def test_matches_sql(spark, sf):
    assert differences(QUERIES["op5_line_quality"](spark, sf), connect(sf), ORACLE["op5_line_quality"]) == []

"""Archives: revisits, round trip, header safety, edge rows."""

import gzip
import hashlib

import pytest

from compare import connect, differences
from demandkit.llm import warc
from demandkit.llm.oracle import ORACLE
from demandkit.llm.queries import QUERIES

BIG = "é" * 600
ROWS = [
    (1, "http://a/1", BIG, "x"), (2, "http://a/2", BIG, "x"), (9, None, BIG, None), (None, "http://a/n", BIG, "x"),
    (3, "http://a/3", "small", "x"), (4, "http://a/4", "small", "x"), (5, "a\r\nX-Page: 7", None, "x"),
    (6, "http://ü/ö?q=1", "\r\n\r\nWARC/1.1\r\n\r\n" * 80, "x"), (7, "http://a/7", "", "x"), (7, "http://a/7", "", "x"),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string, payload_digest string")


def test_round_trip(pages):
    out = warc.round_trip(pages).toPandas()
    assert len(out) == len(ROWS)
    by = {(r.page_id if r.page_id == r.page_id else None): r for r in out.itertuples()}
    for page, _, html, _ in ROWS:
        data = (html or "").encode()
        assert (by[page].payload_bytes, by[page].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
    assert {k: (r.record_type, r.refers_to) for k, r in by.items() if r.record_type == "revisit"} == {
        1: ("revisit", 9), 2: ("revisit", 9), None: ("revisit", 9)}
    assert "\r" not in by[5].target_uri and by[3].record_type == by[4].record_type == "response"


def test_repeated_rows_with_the_largest_id_are_responses(spark):
    pages = spark.createDataFrame([(2, "u", BIG), (2, "u", BIG), (1, "u", BIG)], "page_id long, url string, html string")
    assert sorted(r.record_type for r in warc.round_trip(pages).collect()) == ["response", "response", "revisit"]


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_parse_reads_members_and_refuses_damage():
    one = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.parse(gzip.compress(one) + gzip.compress(one))] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(warc.parse(gzip.compress(one[:-3])))


def test_matches_sql(spark, sf):
    assert differences(QUERIES["op3_warc"](spark, sf), connect(sf), ORACLE["op3_warc"]) == []


def test_addresses_are_encoded_where_they_must_be(spark):
    urls = {1: "http://a.de/x y?q=1&b=ü%20#f+g", 2: "https://a.de/%C3%BC?x=[1]~", 3: "http://ü.de/", 4: None, 5: "tab\there"}
    wanted = {1: "http://a.de/x%20y?q=1&b=%C3%BC%20#f+g", 2: urls[2], 3: "http://%C3%BC.de/", 4: None, 5: "tab%09here"}
    pages = spark.createDataFrame([(i, u, "x") for i, u in urls.items()], "page_id long, url string, html string")
    found = {r.page_id: r.target_uri for r in warc.round_trip(pages).collect()}
    assert found == {**wanted, 4: found[4]} and not found[4]


def test_archives_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SMALL_BYTES", 1 << 12)
    rows = [(i, f"http://a/{i}", chr(97 + i % 26) * n) for i, n in enumerate([10, 5000, 5000, 70_000, 300_000, 3000, 60_000] * 8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = str(tmp_path / "warc")
    warc.write_archives(pages, folder, file_bytes=200_000)
    sizes = []
    for path in (tmp_path / "warc").glob("*.gz"):
        records = list(warc.parse(path.read_bytes()))
        sizes.append((len(records), sum(len(b) for _, b in records)))
    assert max(n for n, _ in sizes) > 1 and all(size <= 200_000 or n == 1 for n, size in sizes)
    assert warc.read_archives(spark, folder).count() == len(rows)

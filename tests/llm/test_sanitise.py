"""Personal data: patterns against the plain expressions, disclosure against plain counting, edge rows."""

import hashlib
import math
import re

from hypothesis import example, given, settings, strategies as st

from demandkit.llm import sanitise
from demandkit.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
                if not 13 <= len(digits) <= 19 or sum(x - 9 * (x > 9) for x in twice) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab1.2@-+5 ()_%0é9\n"), max_size=60))
@example("a@b.c_d@e.f a@b@c.d @x.y a.b@c. 4111 1111-1111 1111 1.2.3.4.5.6.7.8 999.1.1.1.1 0255.1.1.1 +1 (234) 555-6789 +49 12")
@example("4111111111111111x5500005555555559 " + "1" * 30)
def test_spans_equal_the_plain_patterns(text):
    assert sanitise.base_spans(text) == brute(text)


def entity_text(i, name, filler):
    return f"{filler} please write to {name} at {name}.person@mail.example about number {i} and so on"


def corpus():
    rows = []
    for i in range(6):
        rows.append((i, f"opening text {'x' * (i + 3)} Zebulon! wrote from zeb@mail.example to us the and", "s"))
    for i in range(6, 60):
        rows.append((i, f"the and us opening text {'y' * (i % 7 + 3)} wrote to nobody", "s"))
    for i in range(60, 64):  # copies of one text prove nothing
        rows.append((i, "Quixotic friend of solo@mail.example", "s"))
    rows += [(64, None, "s"), (65, "", "s"), (66, "Zebulon without the address", None), (None, "ip 10.0.0.1", "s")]
    return rows


def test_disclosure_equals_plain_counts(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string")
    found = sanitise.find(docs.select("doc_id", "text"))
    out = {(r.entity, r.term): r.disclosure for r in sanitise.disclosing_terms(found, docs, 3, -100.0).collect()}
    terms = [{sanitise.term_of(w) for w in (t or "").split()} - {None} for _, t, _ in rows]
    zeb = sanitise._entity("email", "zeb@mail.example")
    own = {"opening", "text", "zebulon", "wrote", "from", "the", "and"}
    assert {t for e, t in out} == own and {e for e, _ in out} == {zeb}
    for t in own:
        n = sum(t in x for x in terms)
        assert math.isclose(out[zeb, t], 1 - math.log(6 / n) / math.log(6 / len(rows)), abs_tol=1e-9)


def test_sanitised_text_and_spans(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, base string")
    out = {r.doc_id: r for r in sanitise.sanitise(docs.select("doc_id", "text"), threshold=0.8).collect()}
    for doc_id, text, _ in corpus():
        base = brute(text)
        r = out[doc_id]
        assert r.base_sha256 == hashlib.sha256(sanitise.written(base).encode()).hexdigest()
        assert r.spans.startswith(sanitise.written(base))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in sanitise.KINDS]
    assert out[0].n_terms == 2 and out[66].n_terms == out[60].n_terms == 0  # Zebulon and from
    kept = sanitise.sanitise(docs, threshold=0.8, with_text=True)
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert "Zebulon" not in texts[0] and "<EMAIL>" in texts[0] and "mail.example" not in texts[0]
    assert texts[60] == "Quixotic friend of <EMAIL>" and texts[None] == "ip <IP>" and texts[64] is None
    assert texts[66] == "Zebulon without the address" and texts[7] == corpus()[7][1]


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sanitise.sanitise(empty).count() == 0
    twice = spark.createDataFrame([(1, "a@b.cd")] * 2, "doc_id long, text string")
    assert [r.spans for r in sanitise.sanitise(twice).collect()] == ["email:0:6"] * 2


def test_query_equals_plain_patterns(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op9_sanitise"](spark, sf).collect()
    assert len(out) == len(docs)
    for r in out:
        base = brute(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(sanitise.written(base).encode()).hexdigest()


def test_terms_anywhere_in_the_document(spark):
    names = ["O'Brien", "Jean-Luc", "Li", "AB1234"]
    far = " and so on" * 20
    rows = [(i, f"Dear {' '.join(names)},{far} {'z' * (i + 3)} write to me@home.example") for i in range(5)]
    rows += [(i, f"Dear all, li{far} {'y' * (i % 9 + 3)}") for i in range(5, 200)]
    out = {r.doc_id: r.spans for r in sanitise.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows[:5]:
        starts = {(text.index(n), text.index(n) + len(n)) for n in names}
        spans = {tuple(map(int, x.split(":")[1:])) for x in out[i].split(",") if x.startswith("term:")}
        assert starts <= spans and (0, 4) not in spans
    assert not any(out[i] for i in range(5, 200))


def test_query_protects_entities_seen_once(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = docs.count()
    once = [(10**6, "Yevgenia lives here. please write to yevgenia@solo.example now")]
    twice = [(10**6 + 1 + i, f"{w} Ozymandias answers at o.{w}@pair.example today") for i, w in enumerate(["first", "second"])]
    rows = [(i, "en", "web", t) for i, t in once + twice]
    planted = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    docs.unionByName(planted, allowMissingColumns=True).write.parquet(str(tmp_path / "documents.parquet"))
    out = {r.doc_id: r for r in QUERIES["op9_sanitise"](spark, str(tmp_path)).collect()}
    assert len(out) == n + 3
    for i, text, name in [(*once[0], "Yevgenia"), *((*r, "Ozymandias") for r in twice)]:
        at = text.index(name)
        assert f"term:{at}:{at + len(name)}" in out[i].spans.split(",")


def test_a_long_list_of_addresses_costs_its_length(spark):
    """Every address with every word would be half a million pairs; all of them stand in one document."""
    words = [f"wort{i}" for i in range(700)]
    listed = " ".join(f"{w} {w}@list.example" for w in words)
    rows = [(1, listed), (2, listed), (3, "wort5 wort6 alone")] + [(10 + i, f"other {'z' * (i % 9 + 3)} text") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sanitise.find(docs)
    pairs, terms = sanitise.met(found, docs, found.count())
    assert terms.count() == 1400 and pairs.count() < 60
    out = {r.doc_id: r for r in sanitise.sanitise(docs).collect()}
    assert out[1].spans == out[2].spans and out[1].n_email == 700 and out[1].n_terms > 600 and out[3].n_terms == 0


def test_groups_of_equal_documents_change_no_disclosure(spark):
    """Against plain counts over all pairs of an entity and a term."""
    import random

    pick = random.Random(8)
    rows = []
    for i in range(120):
        words = [pick.choice("alpha beta gamma delta omega sigma kappa lambda theta".split()) for _ in range(4)]
        mails = [f"{pick.choice('abcdef')}{pick.choice('xy')}@{pick.choice(['one', 'two'])}.example" for _ in range(pick.choice([0, 0, 0, 1, 2]))]
        rows.append((i, " ".join(words + mails)))
    rows += rows[:7]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sanitise.find(docs)
    out = {(r.entity, r.term): r.disclosure for r in sanitise.disclosing_terms(found, docs, 1, -100.0).collect()}
    texts = [({sanitise._entity(k, t[a:b]) for k, a, b in sanitise.base_spans(t)}, sanitise._terms(t, sanitise.base_spans(t)) , {sanitise.term_of(w) for w in t.split()} - {None}) for _, t in rows]
    total, wanted = len(rows), {}
    for e in set().union(*(x[0] for x in texts)):
        n_e = sum(e in x[0] for x in texts)
        for term in set().union(*(x[1] for x in texts if e in x[0])):
            both, n_t = sum(e in x[0] and term in x[1] for x in texts), sum(term in x[2] for x in texts)
            wanted[e, term] = 1 - math.log(both / n_t) / math.log(n_e / total)
    assert set(out) == set(wanted)
    assert all(math.isclose(out[k], wanted[k], abs_tol=1e-9) for k in wanted)

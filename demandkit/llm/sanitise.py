"""Personal data, and the terms that give it away.

Patterns find the protected entities (email, ip, card, phone). Over the corpus, the terms
of a document are counted with its entities, wherever they stand in it. A term discloses the share
``1 - log P(entity | term) / log P(entity)`` of the entity's information: 1 if the term
occurs with that entity only, 0 if it says nothing. In texts that hold the entity, terms
from ``threshold`` on are generalised, and from ``remove_from`` on removed. Probabilities
are shares of documents.

Entities seen once take part: P(entity | term) is smoothed with one text of the corpus's
share, and copies of one text count once in it. Classes of entities (kind, mail domain,
parts of the name before it, prefixes of numbers) are protected like entities. For an exact
entity met in ``min_texts`` different texts or more, the plain shares count as well.

A term of too many documents cannot disclose an entity of few, whatever they share. Such
pairs are left out where terms meet entities, before pairs are counted. Entities that stand in
the same documents have the same shares with every term, and so have terms of the same
documents; each such group meets the others as one. So a long list of addresses, each met
nowhere else, costs its length and not its square.

Defined results: a null or empty text has no spans; repeated rows are treated alike; a
null ``doc_id`` is kept; an empty table gives an empty result; further columns of the
input are ignored unless the text is asked for.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from demandkit.llm.words import coded, filled, slices, split_words
from demandkit.runtime import settle

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
THRESHOLD, REMOVE_FROM, MIN_TEXTS = 0.85, 0.97, 3
#: Shorter words count as well if they have capitals or no case.
MIN_LETTERS = 3

#: Fixed values of the patterns; the quantifiers are possessive where that finds the same.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TERM = re.compile(r"[^\W_]+(?:[-'\u2019\u2010\u2011][^\W_]+)*")
_PUNCTUATION = ".,;:!?()[]{}\"'<>«»„“”"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """kind, start and end (code points), by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m[0].split(".")):
                out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() and 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def written(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def term_of(word: str) -> str | None:
    """The word as a term: lower case, without punctuation around it; hyphens, apostrophes and digits may stand inside."""
    bare = word.strip(_PUNCTUATION)
    if not _TERM.fullmatch(bare) or len(bare) < MIN_LETTERS and (len(bare) < 2 or bare.islower() or bare.isdigit()):
        return None
    return bare.lower()


def _code(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little", signed=True)


def _entity(kind: str, text: str) -> int:
    value = text.lower() if kind == "email" else "".join(_DIGIT.findall(text)) if kind in ("card", "phone") else text
    return _code(f"{kind}:{value}")


def _classes(kind: str, text: str) -> set[int]:
    """The kind, and by it: mail domain and parts of the name, first three numbers of an ip, issuer of a card, first digits of a phone."""
    if kind == "email":
        local, _, domain = text.lower().partition("@")
        names = {f"domain:{domain}", *(f"name:{part}" for part in re.split(r"[._%+-]+", local) if len(part) > 1)}
    elif kind == "ip":
        names = {f"net:{text.rpartition('.')[0]}"}
    else:
        names = {f"prefix:{''.join(_DIGIT.findall(text))[:6 if kind == 'card' else 5]}"}
    return {_code(f"{kind}/{name}") for name in ("kind", *names)}


def _terms(text: str, spans: list[tuple[str, int, int]]) -> set[str]:
    """The terms of the text outside its entities."""
    ends = sorted((a, b) for _, a, b in spans)
    out, at, inside = set(), 0, 0
    for m in _WORD.finditer(text):
        while at < len(ends) and ends[at][0] < m.end():
            inside, at = max(inside, ends[at][1]), at + 1
        if m.start() >= inside and (term := term_of(m[0])):
            out.add(term)
    return out


FOUND = (
    "base array<struct<kind: string, start: int, end: int>>, base_sha256 string, digest binary, "
    "entities array<bigint>, classes array<bigint>, terms array<string>, text string"
)


def find(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Base spans, entities, their classes, terms and a row id beside the other columns; the text only where a span was found, or always."""
    base_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            base, sums, digests, entities, classes, terms, kept = [], [], [], [], [], [], []
            for raw in part.column("text").to_pylist():
                text = raw or ""
                spans = base_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                sums.append(hashlib.sha256(written(spans).encode()).hexdigest())
                digests.append(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest() if spans else None)
                entities.append(sorted({_entity(k, text[a:b]) for k, a, b in spans}))
                classes.append(sorted(set().union(*(_classes(k, text[a:b]) for k, a, b in spans))))
                terms.append(sorted(_terms(text, spans)) if spans else [])
                kept.append(raw if spans or with_text else None)
            part = part.drop_columns(["text"])
            for name, values, kind in (
                ("base", base, base_type), ("base_sha256", sums, pa.string()), ("digest", digests, pa.binary()),
                ("entities", entities, pa.list_(pa.int64())), ("classes", classes, pa.list_(pa.int64())), ("terms", terms, pa.list_(pa.string())), ("text", kept, pa.string()),
            ):
                part = part.append_column(name, pa.array(values, kind))
            yield part

    source = docs.withColumn("text", F.col("text").cast("string"))
    schema = StructType(list(docs.drop("text").schema.fields))
    for field in StructType.fromDDL(FOUND).fields:
        schema = schema.add(field)
    return source.mapInArrow(make, schema).withColumn("row", F.monotonically_increasing_id())


def term_documents(docs: DataFrame) -> DataFrame:
    """In how many documents each term occurs."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words, at = split_words(filled(part.column("text")))
            codes, distinct = coded(words)
            terms = [term_of(w) for w in distinct.to_pylist()]
            names = sorted({t for t in terms if t is not None})
            index = {t: i for i, t in enumerate(names)}
            of = np.asarray([index.get(t, -1) for t in terms], dtype=np.int64)[codes] if terms else np.zeros(0, np.int64)
            owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
            pairs = np.unique((owner * (len(names) + 1) + of)[of >= 0]) % (len(names) + 1)
            n = np.bincount(pairs, minlength=len(names))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(n.astype(np.int64))], ["term", "n"])

    rows = docs.select(F.col("text").cast("string"))
    return rows.mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))


def _same_documents(*counts: Column) -> Column:
    """A number that two sets of documents share if they are equal: by counts and hashes of the rows."""
    return F.xxhash64(*counts, F.bit_xor(F.xxhash64("row")), F.bit_xor(F.xxhash64(F.lit("second"), "row")))


def met(found: DataFrame, docs: DataFrame, total: int, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """row, digest, entity (or class) and term, with their documents, of all pairs that can reach
    ``threshold``, where one number stands for all entities, and one for all terms, of the same documents;
    and the terms of each row with the number that stands for them (``group``)."""
    entities = found.select("row", F.explode(F.concat("entities", "classes")).alias("entity"), F.col("entities").alias("own")).select("row", "entity", F.array_contains("own", F.col("entity")).alias("exact"))
    # They are written, so that the joins can split the rows of a common term or entity.
    n_entity = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"), _same_documents(F.max("exact"), F.count(F.lit(1))).alias("group"))
    n_entity = settle(n_entity, "entity-counts")
    listed = found.select("row", "digest", F.explode("terms").alias("term"))
    alike = listed.groupBy("term").agg(_same_documents(F.count(F.lit(1))).alias("same"))
    n_term = settle(alike.join(term_documents(docs), "term").select("term", "n_term", F.xxhash64("same", "n_term").alias("group")), "term-counts")
    terms = settle(listed.join(n_term, "term"), "terms")
    share = F.col("n_entity") / F.lit(total)
    # An estimate is at most (n_entity + 1) / n_term, as n_both is at most n_entity and adding copies to
    # both sides of a share below 1 raises it; and it has to be share ** (1 - threshold).
    bound = F.col("n_term") <= (F.col("n_entity") + 1) * F.pow(share, F.lit(threshold - 1)) * (1 + 1e-9)
    entities = entities.join(n_entity, "entity").filter(F.col("n_entity") < total).withColumn("share", share)
    entities = entities.repartition("row").select(F.col("row").alias("r"), F.col("group").alias("entity"), "exact", "n_entity", "share").distinct()
    grouped = terms.repartition("row").select("row", "digest", F.col("group").alias("term"), "n_term").distinct()
    pairs = grouped.join(entities, (F.col("row") == F.col("r")) & bound).drop("r")
    return pairs, terms.select("row", "term", "group")


def disclosing_terms(found: DataFrame, docs: DataFrame, min_texts: int = MIN_TEXTS, threshold: float = THRESHOLD) -> DataFrame:
    """entity, term and the share of the entity's information that the term discloses, by plain shares."""
    found = found.withColumn("classes", F.array().cast("array<bigint>"))
    pairs, terms = met(found, docs, found.count(), threshold)
    revealing = _disclosing(pairs, min_texts, threshold).withColumnRenamed("entity", "group_e").withColumnRenamed("term", "group")
    # Back from the groups to their members.
    named = found.select("row", F.explode("entities").alias("entity"))
    groups = named.groupBy("entity").agg(_same_documents(F.lit(True), F.count(F.lit(1))).alias("group_e"))
    return revealing.join(groups, "group_e").join(terms.select("term", "group").distinct(), "group").select("entity", "term", "disclosure")


def _disclosing(pairs: DataFrame, min_texts: int, threshold: float, smooth: bool = False) -> DataFrame:
    key = ["entity", "term"]
    counted = (
        pairs.groupBy(*key, "digest").agg(F.count(F.lit(1)).alias("n"), *(F.first(c).alias(c) for c in ("n_term", "share", "exact")))
        .groupBy(*key).agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("texts"), *(F.first(c).alias(c) for c in ("n_term", "share", "exact")))
    )
    exact = F.when(F.col("texts") >= min_texts, F.col("n_both") / F.col("n_term"))
    # Copies of the texts that hold both count once below as well.
    smoothed = (F.col("texts") + F.col("share")) / (F.col("texts") + F.col("n_term") - F.col("n_both") + 1)
    given = F.greatest(F.when(F.col("exact"), exact), smoothed) if smooth else exact
    return counted.select(*key, (1 - F.log(given) / F.log("share")).alias("disclosure")).filter(F.col("disclosure") >= threshold)


def _term_spans(text: str, base: list[tuple[str, int, int]], terms: dict[str, float]) -> list[tuple[str, int, int, float]]:
    out = []
    for m in _WORD.finditer(text):
        term = term_of(m[0])
        if term in terms:
            a = m.start() + len(m[0]) - len(m[0].lstrip(_PUNCTUATION))
            b = m.start() + len(m[0].rstrip(_PUNCTUATION))
            if all(b <= x or a >= y for _, x, y in base):
                out.append((TERM, a, b, terms[term]))
    return out


def _replaced(text: str, base: list[tuple[str, int, int]], found: list[tuple[str, int, int, float]], remove_from: float) -> str:
    """The text with entities as <KIND>, revealing terms as <TERM> or without them. Of overlapping
    entities, the text from the first to the last becomes the name of the first."""
    parts = sorted([(a, b, f"<{k.upper()}>") for k, a, b in base] + [(a, b, "" if s >= remove_from else "<TERM>") for _, a, b, s in found])
    out, at = [], 0
    for a, b, name in parts:
        if a >= at:
            out += [text[at:a], name]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(
    docs: DataFrame, threshold: float = THRESHOLD, remove_from: float = REMOVE_FROM, min_texts: int = MIN_TEXTS, with_text: bool = False
) -> DataFrame:
    """doc_id, counts by kind, ``base_sha256``, ``spans`` and the number of term spans.

    ``with_text`` returns the columns of the input instead, with the sanitised text.
    """
    # The other columns travel as one, so their names meet no others; the text travels once.
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"] or [F.lit(None).alias("none")]
    row = F.struct(*others) if with_text else F.struct(F.col("doc_id").cast("long").alias("doc_id"))
    kept = docs.select(row.alias("rest"), F.col("text").cast("string").alias("text"))
    found = settle(find(kept, with_text), "entities")
    pairs, terms = met(found.filter(F.size("base") > 0), docs, found.count(), threshold)
    pairs = settle(pairs, "pairs")
    revealing = settle(_disclosing(pairs, min_texts, threshold, smooth=True), "revealing")
    groups = (
        pairs.select("row", "entity", "term").join(revealing, ["entity", "term"])
        .groupBy("row", F.col("term").alias("group")).agg(F.max("disclosure").alias("disclosure"))
    )
    per_row = (
        terms.join(groups, ["row", "group"])
        .groupBy("row").agg(F.collect_list(F.struct("term", "disclosure")).alias("revealed"))
    )
    counts = [f"n_{k}" for k in KINDS]

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows, texts = [], []
            for text, base, revealed in zip(*(part.column(c).to_pylist() for c in ("text", "base", "revealed")), strict=True):
                spans = [(s["kind"], s["start"], s["end"]) for s in base]
                terms = _term_spans(text or "", spans, {r["term"]: r["disclosure"] for r in revealed}) if revealed else []
                rows.append((*(sum(k == kind for k, _, _ in spans) for kind in KINDS), written([*spans, *(t[:3] for t in terms)]), len(terms)))
                texts.append(_replaced(text, spans, terms, remove_from) if spans and with_text else text if with_text else None)
            columns = list(zip(*rows, strict=True))
            out = [part.column("rest"), *(pa.array(c, pa.int64()) for c in columns[:4]), part.column("base_sha256")]
            out += [pa.array(columns[4], pa.string()), pa.array(columns[5], pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(out, ["rest", *counts, "base_sha256", "spans", "n_terms", "text"])

    schema = StructType([found.schema["rest"]])
    for name in [*counts, "base_sha256", "spans", "n_terms", "text"]:
        schema = schema.add(name, "string" if name in ("base_sha256", "spans", "text") else "long")
    # Texts without spans have no terms to find, and stay where they are.
    columns = ["rest", "base", "base_sha256", "text", "revealed"]
    joined = found.filter(F.size("base") > 0).join(per_row, "row", "left").select(*columns)
    plain = found.filter(F.size("base") == 0).withColumn("revealed", F.lit(None).cast(joined.schema["revealed"].dataType)).select(*columns)
    out = joined.unionByName(plain).mapInArrow(apply, schema)
    if with_text:
        return out.select(*(F.col("text") if c == "text" else F.col(f"rest.`{c}`") for c in docs.columns))
    return out.select("rest.doc_id", *counts, "base_sha256", "spans", "n_terms")

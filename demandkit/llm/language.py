"""Language of texts and of their spans.

The script of a word narrows the candidate languages. Each word gets a log probability
from a character model of each candidate (three characters, hashed counts). A Viterbi
path over the words with a penalty for each switch labels the spans; the language with
most letters is that of the text.

The counts cover all labelled texts. They are added up in each task, then by language and
bucket, so the model's size depends on the number of languages only.

Defined results: null or empty texts and texts without letters are ``und`` with score 0;
so is every text if nothing can be learned; a null ``doc_id`` is not held out; rows
without a label are predicted but not learned from; ties go to the first language in
order; repeated rows are predicted alike; further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from demandkit.llm.words import GOLDEN, coded, filled, mix, slices, split_words

UNKNOWN = "und"
#: Bytes of text at a time; scores of its words by language take many times as much.
SLICE = 2 << 20
#: Buckets of each count table.
BUCKETS = 1 << 17
#: Weight of the uniform guess over so many characters.
PRIOR, CHARACTERS = 0.5, 64
#: Nats that a switch of language costs.
SWITCH = 12.0
#: A language is a candidate for a script that at least this share of its letters has.
SCRIPT_SHARE = 0.01
#: More labels than this are an error: the driver holds 2 x BUCKETS counts of each.
MAX_LANGUAGES = 100
#: Share of the labelled texts below the low mark of a language's fit; how many times as far below
#: the median, and how many nats a letter below it at least, a text is foreign.
LOW_SHARE, LOW_TIMES, LOW_NATS = 0.005, 3.0, 1.0
#: Letters below which a text has no fit: too few to call it foreign.
FIT_LETTERS = 20

#: First code points of ranges, and the script of each range (Unicode blocks).
SCRIPT_RANGES = (
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0780, "Thaana"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Cherokee"),
    (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "Other"), (0x3040, "Hiragana"), (0x30A0, "Katakana"), (0x3100, "Bopomofo"), (0x3130, "Hangul"),
    (0x3190, "Other"), (0x3400, "Han"), (0xA000, "Yi"), (0xA4D0, "Other"), (0xAC00, "Hangul"),
    (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"),
    (0xFE00, "Other"), (0xFF21, "Latin"), (0xFF66, "Katakana"), (0xFFA0, "Hangul"), (0xFFE0, "Other"),
    (0x20000, "Han"), (0x32000, "Other"),
)
SCRIPTS = tuple(sorted({name for _, name in SCRIPT_RANGES}))


def held_out(key: Column | str, folds: int, fold: int) -> Column:
    """True for the rows of one fold by the checksum of their id."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


@cache
def _letters() -> np.ndarray:
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


@dataclass
class Grams:
    """Characters of distinct words: bucket of each one with two, and with one before it, and its word."""

    three: np.ndarray
    two: np.ndarray
    word: np.ndarray
    letters: np.ndarray  # by word
    script: np.ndarray  # of each word's first letter, -1 without one


def grams(words: pa.Array) -> Grams:
    n = len(words)
    lower = pc.utf8_lower(words)
    text = "\0".join(lower.to_pylist()) + "\0" if n else ""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    ends = np.flatnonzero(code == 0)
    if len(ends) != n:  # a word holds the separator itself
        lower = pa.array([w.replace("\0", "\x01") for w in lower.to_pylist()], pa.string())
        code = np.frombuffer(("\0".join(lower.to_pylist()) + "\0").encode("utf-32-le"), "<u4").astype(np.int64)
        ends = np.flatnonzero(code == 0)
    word = np.repeat(np.arange(n), np.diff(np.concatenate([[-1], ends])))
    is_letter = _letters()[code]
    symbol = np.where(is_letter, code, 0)
    # What lies before a word's first character counts as the end of a word.
    one = np.concatenate([[0], symbol[:-1]])
    two = np.concatenate([[0], one[:-1]])
    two = np.where(one == 0, 0, two)
    real = is_letter | (one != 0)
    pair = mix((two * 0x110000 + one).astype(np.uint64) + GOLDEN)
    triple = mix(pair ^ (symbol.astype(np.uint64) + np.uint64(1)) * GOLDEN)
    mask = np.uint64(BUCKETS - 1)
    starts = np.asarray([s for s, _ in SCRIPT_RANGES])
    names = np.asarray([SCRIPTS.index(s) for _, s in SCRIPT_RANGES])
    script = np.full(n, -1)
    at = np.flatnonzero(is_letter)[::-1]
    script[word[at]] = names[np.maximum(np.searchsorted(starts, code[at], "right") - 1, 0)]
    return Grams(
        (triple & mask).astype(np.int64)[real], (pair & mask).astype(np.int64)[real], word[real],
        np.bincount(word[is_letter], minlength=n), script,
    )


@dataclass
class Model:
    languages: list[str]
    three: np.ndarray  # (bucket, language) logs
    two: np.ndarray
    scripts: np.ndarray  # (script, language) penalties

    def word_scores(self, g: Grams, n: int) -> np.ndarray:
        """(word, language) log probabilities; 0 for words without letters."""
        out = np.empty((n, len(self.languages)))
        for i in range(len(self.languages)):
            out[:, i] = np.bincount(g.word, self.three[g.three, i] - self.two[g.two, i], minlength=n)
        out += np.where(g.script[:, None] >= 0, self.scripts[g.script], 0)
        out[g.letters == 0] = 0
        return out


def learn(docs: DataFrame, text: str = "text", label: str = "lang") -> Model:
    """Counts over all labelled texts. The counts of one task are added up before they are sent."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, list[np.ndarray]] = {}
        for part in slices(batches, limit=SLICE):
            texts, labels = filled(part.column("text")), part.column("label").to_pylist()
            words, at = split_words(texts)
            codes, distinct = coded(words)
            g = grams(distinct)
            owner = np.repeat(np.arange(len(texts)), np.diff(at))
            names = sorted(set(labels))
            of = np.asarray([names.index(x) for x in labels])[owner]
            for i, name in enumerate(names):
                n = np.bincount(codes[of == i], minlength=len(distinct))
                tables = total.setdefault(name, [np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(len(SCRIPTS))])
                tables[0] += np.bincount(g.three, n[g.word], minlength=BUCKETS)
                tables[1] += np.bincount(g.two, n[g.word], minlength=BUCKETS)
                seen = g.script >= 0
                tables[2] += np.bincount(g.script[seen], (n * g.letters)[seen], minlength=len(SCRIPTS))
        for name, tables in total.items():
            for kind, t in enumerate(tables):
                at = np.flatnonzero(t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at), pa.string()), pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(t[at].astype(np.int64))],
                    ["label", "kind", "bucket", "n"],
                )

    rows = docs.filter(F.col(label).isNotNull()).select(F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("label"))
    counts = rows.mapInArrow(count, "label string, kind int, bucket int, n long").groupBy("label", "kind", "bucket").agg(F.sum("n").alias("n"))
    # At most languages x (2 x BUCKETS + scripts) rows, whatever the number of texts.
    found = counts.toArrow()
    names = sorted(set(found.column("label").to_pylist()))
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"{len(names)} labels; at most {MAX_LANGUAGES} languages are supported")
    tables = [np.zeros((BUCKETS, len(names))), np.zeros((BUCKETS, len(names))), np.zeros((len(SCRIPTS), len(names)))]
    index = pc.index_in(found.column("label"), pa.array(names, pa.string())).to_numpy().astype(np.int64)
    kind, bucket, n = (found.column(c).to_numpy() for c in ("kind", "bucket", "n"))
    for k, t in enumerate(tables):
        own = kind == k
        t[bucket[own], index[own]] = n[own]
    three, two, script = tables
    share = script / np.maximum(script.sum(axis=0), 1)
    fits = share >= SCRIPT_SHARE
    fits |= ~fits.any(axis=1, keepdims=True)
    return Model(
        names,
        np.log(three + PRIOR / CHARACTERS).astype(np.float32),
        np.log(two + PRIOR).astype(np.float32),
        np.where(fits, 0.0, -1e4),
    )


def _path(scores: np.ndarray, switch: float) -> np.ndarray | None:
    """The labels of one text if a single language is best throughout, else None.

    Leaving the best total for a stretch pays only if the stretch gains more than a
    switch, so a largest gain below that proves the constant path.
    """
    total = scores.sum(axis=0)
    best = int(total.argmax())
    gain = np.concatenate([[0.0], np.cumsum(scores.max(axis=1) - scores[:, best])])
    return None if gain[-1] > switch else np.full(len(scores), best)


def viterbi(scores: np.ndarray, at: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of each word of all texts; the steps of all open texts are taken together."""
    labels = np.zeros(len(scores), np.int64)
    open_ = []
    for i in range(len(at) - 1):
        if at[i + 1] > at[i]:
            path = _path(scores[at[i] : at[i + 1]], switch)
            if path is None:
                open_.append(i)
            else:
                labels[at[i] : at[i + 1]] = path
    if not open_:
        return labels
    open_ = np.asarray(open_)
    length = np.diff(at)[open_]
    order = np.argsort(-length, kind="stable")
    start, length = at[open_][order], length[order]
    value = scores[start].copy()
    back = np.zeros(scores.shape, np.int16)
    stay = np.arange(scores.shape[1])
    active = len(start)
    for t in range(1, int(length[0])):
        while length[active - 1] <= t:
            active -= 1
        v = value[:active]
        top = v.argmax(axis=1)
        jump = v[np.arange(active), top] - switch
        better = jump[:, None] > v
        back[start[:active] + t] = np.where(better, top[:, None], stay)
        value[:active] = np.where(better, jump[:, None], v) + scores[start[:active] + t]
    state = value.argmax(axis=1)
    labels[start + length - 1] = state
    for t in range(int(length[0]) - 1, 0, -1):
        while active < len(length) and length[active] > t:
            active += 1
        state[:active] = back[start[:active] + t, state[:active]]
        labels[start[:active] + t - 1] = state[:active]
    return labels


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _spans(text: str, labels: np.ndarray, names: list[str]) -> str:
    """start:end:language in code points; a span ends where the next one begins."""
    cuts = np.flatnonzero(np.diff(labels)) + 1
    starts = [0]
    if len(cuts):
        wanted = set(cuts.tolist())
        starts += [m.start() for k, m in enumerate(_WORD.finditer(text)) if k in wanted]
    ends = [*starts[1:], len(text)]
    return ",".join(f"{a}:{b}:{names[labels[c]]}" for a, b, c in zip(starts, ends, [0, *cuts.tolist()], strict=True))


def identify(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """``lang_pred``, ``score``, ``share`` (of the letters in that language), ``n_spans``, ``spans`` and
    ``fit`` (log probability a letter, along the path; null for very few letters) beside the other
    columns of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = "lang_pred string, score double, share double, n_spans integer, spans string, fit double"

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in slices(batches, limit=SLICE):
            texts = filled(part.column("text"))
            n = len(texts)
            words, at = split_words(texts)
            codes, distinct = coded(words)
            g = grams(distinct)
            result = [(UNKNOWN, 0.0, 0.0, 0, "", None)] * n
            if model.languages:
                scores = model.word_scores(g, len(distinct))[codes]
                labels, letters = viterbi(scores, at, switch), g.letters[codes]
                for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                    by = np.bincount(labels[a:b], letters[a:b], minlength=len(model.languages)) if b > a else np.zeros(1)
                    if by.sum() == 0:
                        continue
                    best = int(by.argmax())
                    total = scores[a:b].sum(axis=0)
                    own = scores[a:b][labels[a:b] == best].sum(axis=0) if by[best] < by.sum() else total
                    odds = 1 / np.exp(np.minimum(own - own[best], 500)).sum()
                    share = by[best] / by.sum()
                    spans = _spans(texts[i].as_py(), labels[a:b], model.languages) if (labels[a:b] != labels[a]).any() else f"0:{len(texts[i].as_py())}:{model.languages[best]}"
                    fit = float(scores[np.arange(a, b), labels[a:b]].sum() / by.sum()) if by.sum() >= FIT_LETTERS else None
                    result[i] = (model.languages[best], float(share * odds), float(share), spans.count(",") + 1, spans, fit)
            columns = list(zip(*result, strict=True)) or [()] * 6
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.float64())
            for name, values, kind in zip(added.split(", "), columns, kinds, strict=True):
                part = part.append_column(name.split()[0], pa.array(values, kind))
            yield part

    rest = docs.drop(*(x.split()[0] for x in added.split(", ")))
    schema = StructType(list(rest.schema.fields))
    for x in added.split(", "):
        schema = schema.add(*x.split())
    return rest.mapInArrow(label, schema)


def fit_levels(found: DataFrame, label: str = "lang") -> DataFrame:
    """lang_pred and the ``level`` of fit below which a text is foreign to that language, from
    the texts whose label is the language predicted. One row a language."""
    own = found.filter(F.col("lang_pred") == F.col(label).cast("string"))
    marks = own.groupBy("lang_pred").agg(F.percentile_approx("fit", [LOW_SHARE, 0.5], 10_000).alias("m"))
    low, median = F.col("m")[0], F.col("m")[1]
    return marks.select("lang_pred", (median - F.greatest(LOW_TIMES * (median - low), F.lit(LOW_NATS))).alias("level"))

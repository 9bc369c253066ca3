"""Fingerprints of documents as invertible Bloom lookup tables of paragraph digests.

A paragraph is a sentence or a line. Each digest falls into one cell of each of three
subtables; a cell holds a signed count, and the exclusive or of its digests and of their
check sums. Subtracting two tables cell by cell cancels what the versions share. Peeling
takes the cells that hold one digest, removes it from its other cells, and goes on until
the table is empty. Where it gets stuck, the digests are dealt by their hash over sixteen
times as many tables, and only the tables that fail go on, so the work stays in proportion
to the paragraphs.

Everything is DataFrame and SQL functions; no Python runs on the executors.

Defined results: a null text is empty; texts without paragraphs are alike (1); repeated
paragraphs count once; documents follow each other by ``doc_id``, null first, equal ids by
text, and the last one is followed by the first; a single document follows itself; an
empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from demandkit.runtime import settle

#: Cells of a subtable (at most 16), three of which make a table; smaller below the first level.
WIDTH, SMALL_WIDTH = 8, 4
#: Rounds of peeling; a table that needs more counts as stuck.
ROUNDS = 12
#: Tables that a stuck one is dealt over.
FANOUT_BITS = 4
#: Documents of a range on average, and ranges at most.
RANGE_DOCUMENTS, MAX_RANGES = 2000, 2048

_NO_DIGESTS = "cast(array() AS array<struct<k: bigint, n: int>>)"


def paragraphs(text: str) -> str:
    """SQL: the distinct digests of a text's sentences and lines."""
    # Plain replacements, as a pattern with look-behind costs several times as much.
    for mark in ".!?":
        text = f"replace({text}, '{mark} ', '{mark}\\n')"
    parts = rf"filter(split({text}, '\\n'), p -> p != '')"
    return f"array_distinct(transform({parts}, p -> xxhash64(p)))"


def _let(value: str, name: str, body: str) -> str:
    """SQL: the body with the value under a name, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _elements(digests: str, level: int, width: int, sign: int = 1) -> str:
    """SQL: digests with their sign, check sum, cells (one of each subtable) and part at a level."""
    cells = ", ".join(
        f"'{name}', cast({at * width} + (shiftright(g, {4 * at}) & {width - 1}) AS int)" for at, name in enumerate("xyz")
    )
    part = f"'part', cast(shiftrightunsigned(g, {64 - FANOUT_BITS}) AS int)"
    made = f"named_struct('k', k, 'n', {sign}, 'c', xxhash64(k, -1L), {cells}, {part})"
    return f"transform({digests}, k -> {_let(f'xxhash64(k, {level}L)', 'g', made)})"


def _cells(elements: str, width: int) -> str:
    """SQL: the cells of an array of elements."""
    sums = (
        "named_struct('n', aggregate(f, 0, (s, d) -> s + d.n), 'k', aggregate(f, 0L, (s, d) -> s ^ d.k), "
        "'c', aggregate(f, 0L, (s, d) -> s ^ d.c))"
    )
    parts = [
        f"transform(sequence({at * width}, {(at + 1) * width - 1}), i -> {_let(f'filter(e, d -> d.{name} = i)', 'f', sums)})"
        for at, name in enumerate("xyz")
    ]
    return _let(elements, "e", f"concat({', '.join(parts)})")


def table(digests: str, level: int = 0, width: int = WIDTH) -> str:
    """SQL: the cells of an array of digests."""
    return _cells(_elements(digests, level, width), width)


def subtract(left: str, right: str) -> str:
    return f"zip_with({left}, {right}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'c', x.c ^ y.c))"


def peel(cells: str, level: int = 0, width: int = WIDTH) -> str:
    """SQL: ``ok``, and ``got``: the differing digests with 1 (left only) or -1 (right only)."""
    pure = "array_distinct(transform(filter(s.t, x -> abs(x.n) = 1 AND x.c = xxhash64(x.k, -1L)), x -> named_struct('k', x.k, 'n', x.n)))"
    cells_of = ", ".join(
        f"'{name}', cast({at * width} + (shiftright(g, {4 * at}) & {width - 1}) AS int)" for at, name in enumerate("xyz")
    )
    placed = _let(f"xxhash64(q.k, {level}L)", "g", f"named_struct('k', q.k, 'n', q.n, 'c', xxhash64(q.k, -1L), {cells_of})")
    less = (
        "named_struct('n', x.n - aggregate(f, 0, (a, q) -> a + q.n), 'k', x.k ^ aggregate(f, 0L, (a, q) -> a ^ q.k), "
        "'c', x.c ^ aggregate(f, 0L, (a, q) -> a ^ q.c))"
    )
    mine = "filter(w, q -> q.x = i OR q.y = i OR q.z = i)"
    removed = f"transform(s.t, (x, i) -> {_let(mine, 'f', f'if(size(f) = 0, x, {less})')})"
    step = (
        "if(size(p) = 0, named_struct('t', s.t, 'got', s.got, 'done', true), "
        + _let(f"transform(p, q -> {placed})", "w", f"named_struct('t', {removed}, 'got', concat(s.got, p), 'done', false)")
        + ")"
    )
    return (
        f"aggregate(sequence(1, {ROUNDS}), named_struct('t', {cells}, 'got', {_NO_DIGESTS}, 'done', false), "
        f"(s, r) -> if(s.done, s, {_let(pure, 'p', step)}), "
        "s -> named_struct('ok', forall(s.t, x -> x.n = 0 AND x.k = 0 AND x.c = 0), 'got', s.got))"
    )


def written(cells: str) -> Column:
    """A table as text: each cell's count, digests and check sums in hexadecimal."""
    return F.expr(f"array_join(transform({cells}, x -> concat(hex(x.n), '.', lpad(hex(x.k), 16, '0'), lpad(hex(x.c), 16, '0'))), ',')")


def _dealt(level: int) -> str:
    """SQL: the tables of one level below a stuck one (columns a and b), peeled; stuck ones keep their digests.

    Adding the left digests with 1 and the right ones with -1 is the difference of two tables.
    """
    both = f"concat({_elements('a', level, SMALL_WIDTH)}, {_elements('b', level, SMALL_WIDTH, -1)})"
    peeled = peel(_cells("y", SMALL_WIDTH), level, SMALL_WIDTH)
    side = lambda sign: f"transform(filter(y, d -> d.n = {sign}), d -> d.k)"
    none = "cast(array() AS array<bigint>)"
    kept = f"named_struct('ok', v.ok, 'got', v.got, 'a', if(v.ok, {none}, {side(1)}), 'b', if(v.ok, {none}, {side(-1)}))"
    empty = f"named_struct('ok', true, 'got', {_NO_DIGESTS}, 'a', {none}, 'b', {none})"
    one = f"if(size(y) = 0, {empty}, {_let(peeled, 'v', kept)})"
    return _let(both, "l", f"transform(sequence(0, {(1 << FANOUT_BITS) - 1}), m -> {_let('filter(l, d -> d.part = m)', 'y', one)})")


def larger(stuck: DataFrame, level: int = 1) -> DataFrame | None:
    """``row``, ``pair``, and all differing digests ``got`` (with signs) of the pairs (arrays a and b) whose first table was stuck."""
    levels = []
    while not stuck.isEmpty():
        tried = stuck.select("row", "pair", F.expr(_dealt(level)).alias("tables"))
        tried = tried.select(
            "row", "pair",
            F.expr("flatten(transform(filter(tables, t -> t.ok), t -> t.got))").alias("got"),
            F.expr("transform(filter(tables, t -> NOT t.ok), t -> named_struct('a', t.a, 'b', t.b))").alias("open"),
        )
        tried = settle(tried, "peeled")
        levels.append(tried.select("row", "pair", "got"))
        stuck = tried.select("row", "pair", F.explode("open").alias("o")).select("row", "pair", "o.a", "o.b")
        level += 1
    out = None
    for frame in levels:
        out = frame if out is None else out.unionByName(frame)
    return out


def following(docs: DataFrame) -> DataFrame:
    """doc_id, text and the next document's text, without one task seeing all documents.

    Ranges of ids begin at ids of the table; the first document of each range also goes
    to the end of the range before it.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    ranges = max(1, min(MAX_RANGES, facts.n // RANGE_DOCUMENTS))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] if ranges > 1 else []
    starts = sorted({c for c in cuts if c > facts.least} if facts.least is not None else set())
    # At most MAX_RANGES numbers, compared by a binary choice.
    def place(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(F.col("doc_id") >= starts[middle - 1], place(middle, high)).otherwise(place(low, middle - 1))

    own = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(place(0, len(starts)))
    first = F.col("doc_id").isNull() if facts.nulls else F.col("doc_id").eqNullSafe(F.lit(facts.least))
    at_start = F.when(first, F.lit(len(starts))).when(F.col("doc_id").isin(starts), F.col("range") - 1) if starts else F.when(first, F.lit(0))
    placed = rows.withColumn("range", own).select(
        "doc_id", "text",
        F.explode(F.array_compact(F.array(F.struct(F.col("range"), F.lit(0).alias("guest")), F.when(at_start.isNotNull(), F.struct(at_start.alias("range"), F.lit(1).alias("guest")))))).alias("p"),
    )
    placed = placed.select("doc_id", "text", "p.range", "p.guest").repartition("range")
    # What is made of a text is made after the shuffle, and once.
    made = placed.withColumn("digests", F.expr(paragraphs("text"))).withColumn("cells", F.expr(table("digests")))
    order = Window.partitionBy("range").orderBy("guest", F.asc_nulls_first("doc_id"), "text")
    nexts = {f"next_{c}": F.lead(c).over(order) for c in ("text", "digests", "cells")}
    return made.withColumns(nexts).filter("guest = 0").drop("range", "guest")


def likeness(left: Column, right: Column, differing: Column) -> Column:
    """Shared paragraphs among all paragraphs, from the sizes of both sides and of their difference."""
    both = left + right
    return F.when(both == 0, F.lit(1.0)).otherwise((both - differing) / (both + differing))


def fingerprints(docs: DataFrame, keep_digests: bool = False) -> DataFrame:
    """Each document with its fingerprint, that of its edited text, and both likenesses.

    The edited text ends with the beginning of the next document in place of its last
    quarter. ``keep_digests`` adds the recovered digests of both comparisons.
    """
    n, quarter = F.length("text"), F.expr("length(text) div 4")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(length(text) div 4 AS int))"), F.expr("substring(next_text, 1, cast(length(text) div 4 AS int))"))
    rows = following(docs).withColumn("edited", F.when(quarter > 0, edited).otherwise(F.col("text")))
    rows = rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "digests", "cells",
        "next_digests", "next_cells", F.expr(paragraphs("edited")).alias("edited_digests"),
    )
    rows = rows.withColumn("edited_cells", F.expr(table("edited_digests")))
    rows = rows.withColumns({p: F.expr(peel(subtract("cells", f"{p}_cells"))) for p in ("edited", "next")})
    first = rows.select(
        "doc_id", "n_chars", "edited_sha256", written("cells").alias("fingerprint"), written("edited_cells").alias("edited_fingerprint"),
        F.size("digests").alias("n"), F.size("edited_digests").alias("n_edited"), F.size("next_digests").alias("n_next"),
        *(F.expr(f"if({p}.ok, {'size(' * (not keep_digests)}{p}.got{')' * (not keep_digests)}, NULL)").alias(f"{p}_got") for p in ("edited", "next")),
        F.expr("if(edited.ok AND next.ok, NULL, digests)").alias("digests"),
        F.expr("if(edited.ok, NULL, edited_digests)").alias("edited_digests"),
        F.expr("if(next.ok, NULL, next_digests)").alias("next_digests"),
        F.monotonically_increasing_id().alias("row"),
    )
    first = settle(first, "fingerprints")
    stuck = None
    for p in ("edited", "next"):
        own = first.filter(f"{p}_digests IS NOT NULL").select("row", F.lit(p).alias("pair"), F.col("digests").alias("a"), F.col(f"{p}_digests").alias("b"))
        stuck = own if stuck is None else stuck.unionByName(own)
    found = larger(stuck)
    if found is None:
        more = first.select("row").limit(0).withColumns({f"{p}_more": F.lit(None).cast(first.schema["edited_got"].dataType) for p in ("edited", "next")})
    elif keep_digests:
        whole = found.groupBy("row", "pair").agg(F.flatten(F.collect_list("got")).alias("got"))
        more = whole.groupBy("row").agg(*(F.max(F.when(F.col("pair") == p, F.col("got"))).alias(f"{p}_more") for p in ("edited", "next")))
    else:
        more = found.groupBy("row").agg(*(F.sum(F.when(F.col("pair") == p, F.size("got"))).alias(f"{p}_more") for p in ("edited", "next")))
    out = first.join(more, "row", "left")
    got = {p: F.coalesce(f"{p}_got", f"{p}_more") for p in ("edited", "next")}
    size = {p: F.size(g) if keep_digests else g for p, g in got.items()}
    return out.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        *(likeness(F.col("n"), F.col(f"n_{p}"), size[p]).alias(f"near_{p}") for p in ("edited", "next")),
        *((got[p].alias(f"{p}_digests") for p in ("edited", "next")) if keep_digests else ()),
    )

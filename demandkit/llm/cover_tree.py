"""Exact links between embeddings by a dual traversal of cover trees.

Unit vectors are compared by chord length, a metric: cosine c is chord ``sqrt(2 - 2 c)``.
The top of the tree is a net of a bounded sample; its centers are the leaves to which all
vectors are dealt. Blocks of leaves, or parts of a large leaf, hold a bounded number of
vectors. Below, each block has nested levels of centers: a level's centers lie more than its
radius apart, cover their vectors within it, and include the centers of the level above;
the radius is halved from level to level. Every node knows the true covering radius and
the number of vectors of its part.

Two nodes are compared by their centers. If the chord less both radii exceeds the
threshold, no pair below them links and all are pruned; if the chord plus both radii stays
below, all pairs link and are counted at once; else their children meet. Only vectors under
nodes that stay open are compared one by one, so that links are exact, and a dense
group costs its nodes instead of the square of its vectors. The same bounds decide between
leaves before any vectors are moved. A task holds two blocks and reports a row for each of
their vectors: its number of links and one vector that it is connected with.

Defined results: a vector that is null, empty or zero, or that holds null or non-finite
entries, links with nothing; equal vectors are linked and stand for each other in the
search; rows with one id count as different vectors; a null id is never the smallest of a
component unless all its ids are null; an empty table gives an empty result; vectors of different
lengths are an error; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from demandkit.llm.components import components
from demandkit.runtime import settle, small_side

LEAST_COSINE = 0.95
#: Vectors of the sample whose net is the top of the tree; bytes of the vectors of a block.
SAMPLE, BLOCK_BYTES = 512, 4 << 20
#: Radius of the net at the top; the levels below it start with it too.
TOP = 0.5
#: Room for rounding in all bounds: chords of nearly equal vectors are exact to 1e-8.
SLACK = 1e-7
#: Elements of the distance tables that a step of a task holds.
TILE = 1 << 20
#: Tasks that the pairs of blocks are dealt to at most; more pairs than that share tasks.
MOST_TASKS = 20_000
PRUNED, LINKED, OPEN = 0, 1, 2


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda c: c != 0), F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    """The unit vectors of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(np.float64)
    # Scaling first keeps squares of very large and very small entries in range.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def chord(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosines, 0))


def net(unit: np.ndarray, radius: float) -> np.ndarray:
    """Positions of centers, greedily in order: more than ``radius`` apart, and covering all."""
    centers: list[int] = []
    step = 256
    for begin in range(0, len(unit), step):
        part = unit[begin : begin + step]
        free = np.ones(len(part), bool)
        for at in range(0, len(centers), 4 * step):
            free &= (chord(part @ unit[centers[at : at + 4 * step]].T) > radius).all(axis=1)
        own = chord(part @ part.T)
        while free.any():
            i = int(free.argmax())
            centers.append(begin + i)
            free &= own[i] > radius
            free[i] = False
    return np.asarray(centers, dtype=np.int64)


def nearest(unit: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest center of each vector, and the chord to it."""
    of, far = np.zeros(len(unit), np.int64), np.zeros(len(unit))
    step = max(1, TILE // max(1, len(centers)))
    for begin in range(0, len(unit), step):
        cosines = unit[begin : begin + step] @ centers.T
        best = cosines.argmax(axis=1)
        of[begin : begin + step] = best
        far[begin : begin + step] = chord(cosines[np.arange(len(best)), best])
    return of, far


def radii(threshold: float) -> list[float]:
    """The radii of the levels below the leaves; beyond them, vectors are compared."""
    out = [TOP]
    while out[-1] > threshold / 8:
        out.append(out[-1] / 2)
    return out


def paths(unit: np.ndarray, leaf: np.ndarray, far: np.ndarray, levels: list[float]) -> np.ndarray:
    """(vectors, levels): the position of each vector's center on each level.

    A node's first center is its own, so that centers stay centers below; a leaf starts
    with the vector that is nearest to it.
    """
    out = np.zeros((len(unit), len(levels)), np.int64)
    order = np.lexsort((far, leaf))
    bounds = np.flatnonzero(np.diff(leaf[order], prepend=-1))
    nodes = [order[a:b] for a, b in zip(bounds, [*bounds[1:], len(order)], strict=True)]
    for level, radius in enumerate(levels):
        below = []
        for rows in nodes:
            if len(rows) == 1:
                out[rows[0], level:] = rows[0]
                continue
            own = unit[rows]
            centers = net(own, radius)
            of, _ = nearest(own, own[centers])
            of[centers] = np.arange(len(centers))
            out[rows, level] = rows[centers[of]]
            sort = np.argsort(of, kind="stable")
            cuts = np.flatnonzero(np.diff(of[sort], prepend=-1))
            for a, b, c in zip(cuts, [*cuts[1:], len(sort)], centers, strict=True):
                part = rows[sort[a:b]]
                # The center leads its node.
                below.append(np.concatenate([rows[c : c + 1], part[part != rows[c]]]))
        nodes = below
    return out


class Tree:
    """The nodes of a block by level: ``start`` and ``end`` of their vectors (which are sorted by path),
    ``center``, ``radius``, ``weight`` and the range of their children on the next level."""

    def __init__(self, unit: np.ndarray, weight: np.ndarray, leaf: np.ndarray, path: np.ndarray, leaves: np.ndarray) -> None:
        keys = np.column_stack([leaf, path])
        self.order = np.lexsort(keys.T[::-1])
        place = np.empty(len(unit), np.int64)
        place[self.order] = np.arange(len(unit))
        self.unit, self.weight, self.leaf, keys = unit[self.order], weight[self.order], leaf[self.order], keys[self.order]
        self.start, self.end, self.center, self.lead, self.radius, self.heavy = [], [], [], [], [], []
        for level in range(keys.shape[1]):
            new = np.ones(len(unit), bool)
            new[1:] = (keys[1:, : level + 1] != keys[:-1, : level + 1]).any(axis=1)
            start = np.flatnonzero(new)
            end = np.append(start[1:], len(unit))
            at = start if level == 0 else place[keys[start, level]]
            center = leaves[keys[start, 0]] if level == 0 else self.unit[at]
            node = np.cumsum(new) - 1
            far = chord(np.einsum("ij,ij->i", self.unit, center[node]))
            self.start.append(start)
            self.end.append(end)
            self.center.append(center)
            self.lead.append(at)
            self.radius.append(np.maximum.reduceat(far, start))
            self.heavy.append(np.add.reduceat(self.weight, start))
        # Single vectors are the last level.
        rows = np.arange(len(unit))
        self.start.append(rows)
        self.end.append(rows + 1)
        self.center.append(self.unit)
        self.lead.append(rows)
        self.radius.append(np.zeros(len(unit)))
        self.heavy.append(self.weight)
        self.first = [np.searchsorted(self.start[i + 1], self.start[i]) for i in range(len(self.start) - 1)]
        self.last = [np.searchsorted(self.start[i + 1], self.end[i]) for i in range(len(self.start) - 1)]


class Links:
    """Links and connections of the vectors of one or two trees."""

    def __init__(self, a: Tree, b: Tree, least: float) -> None:
        self.a, self.b, self.same, self.least = a, b, a is b, least
        self.threshold = float(chord(np.asarray(least)))
        self.shift = 0 if self.same else len(a.unit)
        self.count = np.zeros(self.shift + len(b.unit), np.int64)
        self.root = np.arange(len(self.count))

    def _join(self, u: np.ndarray, v: np.ndarray) -> None:
        """Unite the vectors u[i] and v[i]."""
        while True:
            x, y = self.root[u], self.root[v]
            apart = x != y
            if not apart.any():
                return
            u, v = u[apart], v[apart]
            self.root[np.maximum(x[apart], y[apart])] = np.minimum(x[apart], y[apart])
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up

    @staticmethod
    def _spread(tree: Tree, level: int, nodes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The vectors below the nodes, each node once, and the sum of the node's values."""
        size = len(tree.start[level])
        total = np.bincount(nodes, weights=values.astype(float), minlength=size)
        hit = np.flatnonzero(np.bincount(nodes, minlength=size))
        n = tree.end[level][hit] - tree.start[level][hit]
        rows = np.repeat(tree.start[level][hit] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return rows, np.repeat(np.rint(total[hit]).astype(np.int64), n)

    def _all_link(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        """All vectors of the nodes i and j link."""
        a, b = self.a, self.b
        rows, add = self._spread(a, level, i, b.heavy[level][j])
        self.count[rows] += add
        lead = a.lead[level][np.searchsorted(a.start[level], rows, "right") - 1]
        self._join(rows, lead)
        own = i == j if self.same else np.zeros(len(i), bool)
        if own.any():
            rows, _ = self._spread(a, level, i[own], i[own])
            self.count[rows] -= a.weight[rows]
        i, j = i[~own], j[~own]
        if len(i):
            rows, add = self._spread(b, level, j, a.heavy[level][i])
            self.count[rows + self.shift] += add
            lead = b.lead[level][np.searchsorted(b.start[level], rows, "right") - 1]
            self._join(rows + self.shift, lead + self.shift)
            self._join(a.lead[level][i], b.lead[level][j] + self.shift)

    def _decide(self, level: int, i: np.ndarray, j: np.ndarray, cosines: np.ndarray) -> None:
        """Prune, link or open the pairs of nodes."""
        a, b = self.a, self.b
        if level == len(a.start) - 1:
            link = cosines >= self.least
            if self.same:
                link |= i == j
            if link.any():
                self._all_link(level, i[link], j[link])
            return
        far, both = chord(cosines), a.radius[level][i] + b.radius[level][j]
        if self.same:
            far = np.where(i == j, 0.0, far)
        link = far + both <= self.threshold - SLACK
        if link.any():
            self._all_link(level, i[link], j[link])
        still = ~link & (far - both <= self.threshold + SLACK)
        if still.any():
            self.open(level, i[still], j[still])

    def open(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        """The children of the nodes i and j meet."""
        a, b = self.a, self.b
        n, m = a.last[level][i] - a.first[level][i], b.last[level][j] - b.first[level][j]
        large = n * m > TILE // 64
        for x, y in zip(i[large].tolist(), j[large].tolist(), strict=True):
            self._meet_tables(level + 1, np.arange(a.first[level][x], a.last[level][x]), np.arange(b.first[level][y], b.last[level][y]))
        i, j, n, m = i[~large], j[~large], n[~large], m[~large]
        cut = np.searchsorted(np.cumsum(n * m), np.arange(1, 1 + (n * m).sum() // (TILE // 8)) * (TILE // 8))
        for part in np.split(np.arange(len(i)), np.unique(cut)):
            if not len(part):
                continue
            pairs = n[part] * m[part]
            of = np.repeat(np.arange(len(part)), pairs)
            k = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            x = a.first[level][i[part]][of] + k // m[part][of]
            y = b.first[level][j[part]][of] + k % m[part][of]
            if self.same:
                half = x <= y
                x, y = x[half], y[half]
            cosines = np.einsum("ij,ij->i", a.center[level + 1][x], b.center[level + 1][y])
            self._decide(level + 1, x, y, cosines)

    def _meet_tables(self, level: int, x: np.ndarray, y: np.ndarray, state: np.ndarray | None = None) -> None:
        """The nodes x and y of a level meet, all with all; ``state`` tells which leaves are open."""
        a, b = self.a, self.b
        step = max(1, TILE // len(y))
        wide = b.radius[level][y]
        # A pair stays if cosine >= 1 - (threshold + both radii) ** 2 / 2. With the radii as three more
        # entries this is one product in single precision, whose error the margin covers.
        right = np.column_stack([b.center[level][y], wide, wide**2 / 2, np.ones(len(y))]).astype(np.float32).T
        margin = -np.float32(16 * len(right) * np.finfo(np.float32).eps)
        for at in range(0, len(x), step):
            own = x[at : at + step]
            reach = self.threshold + SLACK + a.radius[level][own]
            left = np.column_stack([a.center[level][own], reach, np.ones(len(own)), reach**2 / 2 - 1]).astype(np.float32)
            p, q = np.divmod(np.flatnonzero((left @ right).reshape(-1) >= margin), len(y))
            p, q = own[p], y[q]
            if self.same:
                p, q = p[p <= q], q[p <= q]
            if state is not None:
                met = state[a.leaf[a.start[level][p]], b.leaf[b.start[level][q]]] == OPEN
                p, q = p[met], q[met]
            for part in np.array_split(np.arange(len(p)), max(1, len(p) * 8 // TILE)):
                if len(part):
                    i, j = p[part], q[part]
                    self._decide(level, i, j, np.einsum("ij,ij->i", a.center[level][i], b.center[level][j]))

    def run(self, state: np.ndarray) -> None:
        """All pairs of leaves that ``state`` (leaves, leaves) leaves open; leaves that are next to each other go together."""
        a, b = self.a, self.b
        met = state[np.ix_(a.leaf[a.start[0]], b.leaf[b.start[0]])] == OPEN
        size = b.last[0] - b.first[0]
        for part in np.array_split(np.arange(len(met)), max(1, len(a.start[1]) // 512)):
            if not len(part):
                continue
            partners = np.flatnonzero(met[part].any(axis=0))
            if len(partners):
                n = size[partners]
                y = np.repeat(b.first[0][partners] - np.cumsum(n) + n, n) + np.arange(n.sum())
                self._meet_tables(1, np.arange(a.first[0][part[0]], a.last[0][part[-1]]), y, state)


def leaf_states(leaves: np.ndarray, radius: np.ndarray, threshold: float) -> np.ndarray:
    """(leaves, leaves): what the bounds say about all pairs of vectors of two leaves."""
    far = chord(leaves @ leaves.T)
    np.fill_diagonal(far, 0.0)
    both = radius[:, None] + radius[None, :]
    state = np.full(far.shape, OPEN, np.int8)
    state[far - both > threshold + SLACK] = PRUNED
    state[far + both <= threshold - SLACK] = LINKED
    state[(radius[:, None] < 0) | (radius[None, :] < 0)] = PRUNED
    return state


def _placed(classes: DataFrame, leaves: np.ndarray, levels: list[float], block_bytes: int) -> tuple[DataFrame, np.ndarray, np.ndarray, DataFrame]:
    """Every vector with its block, leaf and path; the radius and weight of each leaf; the blocks of each leaf."""
    spark = classes.sparkSession

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                of, far = nearest(_matrix(batch.column("v"), batch.num_rows), leaves)
                yield batch.append_column("leaf", pa.array(of.astype(np.int32))).append_column("far", pa.array(far))

    kind = classes.schema["v"].dataType.simpleString()
    dealt = settle(classes.select("node", "n", "v").mapInArrow(deal, f"node long, n long, v {kind}, leaf int, far double"), "dealt")
    # At most SAMPLE rows.
    sizes = {r.leaf: r for r in dealt.groupBy("leaf").agg(F.count(F.lit(1)).alias("vectors"), F.sum("n").alias("n"), F.max("far").alias("far")).collect()}
    radius = np.asarray([sizes[i].far if i in sizes else -1.0 for i in range(len(leaves))])
    weight = np.asarray([sizes[i].n if i in sizes else 0 for i in range(len(leaves))])
    # Small leaves share a block with those near them; large ones are spread over several.
    most = max(64, block_bytes // (8 * leaves.shape[1]))
    coarse, _ = nearest(leaves, leaves[net(leaves, 2 * TOP)])
    first, parts, block, filled = [0] * len(leaves), [1] * len(leaves), -1, most
    for i in sorted(sizes, key=lambda i: (coarse[i], i)):
        n = sizes[i].vectors
        if n > most:
            first[i], parts[i] = block + 1, -(-n // most)
            block, filled = block + parts[i], most
        else:
            if filled + n > most:
                block, filled = block + 1, 0
            first[i], filled = block, filled + n
    where = spark.createDataFrame([(i, first[i], parts[i]) for i in sizes], "leaf int, first int, parts int")
    own = F.col("first") + F.pmod(F.xxhash64("node"), "parts").cast("int")
    rows = dealt.join(F.broadcast(where), "leaf").select(own.alias("block"), "leaf", "far", "node", "n", "v")

    def grow(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        unit = _matrix(table.column("v"), len(table))
        path = paths(unit, table.column("leaf").to_numpy(), table.column("far").to_numpy(), levels)
        return table.drop_columns(["far"]).append_column("path", pa.array(path.astype(np.int32).tolist(), pa.list_(pa.int32())))

    schema = f"block int, leaf int, node long, n long, v {kind}, path array<int>"
    placed = settle(rows.groupBy("block").applyInArrow(grow, schema), "placed")
    blocks = where.select("leaf", F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1)).alias("block"))
    return placed, radius, weight, blocks


def _pair_links(placed: DataFrame, blocks: DataFrame, state: np.ndarray, leaves: np.ndarray, least: float) -> DataFrame:
    """node, links and other (a node it is connected with), for each pair of blocks that the leaves leave open."""
    spark = placed.sparkSession
    i, j = np.nonzero(np.triu(state == OPEN))
    # At most SAMPLE ** 2 rows.
    open_ = spark.createDataFrame(pa.table({"p": pa.array(i.astype(np.int32)), "q": pa.array(j.astype(np.int32))}))
    pairs = (
        open_.join(blocks.select(F.col("leaf").alias("p"), F.col("block").alias("x")), "p")
        .join(blocks.select(F.col("leaf").alias("q"), F.col("block").alias("y")), "q")
        .select(F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j")).distinct()
    )
    pairs = settle(pairs, "block-pairs")
    sides = pairs.select(F.col("i").alias("block"), "i", "j").unionByName(pairs.filter("i < j").select(F.col("j").alias("block"), "i", "j"))

    def tree(table: pa.Table) -> tuple[Tree, np.ndarray]:
        table = table.sort_by("node")
        unit = _matrix(table.column("v"), len(table))
        path = np.asarray(table.column("path").combine_chunks().flatten()).reshape(len(table), -1)
        found = Tree(unit, table.column("n").to_numpy(), table.column("leaf").to_numpy(), path, leaves)
        return found, table.column("node").to_numpy()[found.order]

    def meet(table: pa.Table) -> pa.Table:
        p, q = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        block = table.column("block").to_numpy()
        a, nodes = tree(table.filter(pa.array(block == p)))
        b = a
        if p != q:
            b, more = tree(table.filter(pa.array(block == q)))
            nodes = np.concatenate([nodes, more])
        links = Links(a, b, least)
        links.run(state)
        told = (links.count > 0) | (links.root != np.arange(len(nodes)))
        return pa.table({"node": nodes[told], "links": links.count[told], "other": nodes[links.root[told]]})

    # A task for each pair: their work is in proportion to products of sizes, not to bytes.
    dealt = placed.join(small_side(sides), "block").repartition(max(1, min(pairs.count(), MOST_TASKS)), "i", "j")
    return settle(dealt.groupBy("i", "j").applyInArrow(meet, "node long, links long, other long"), "block-links")


def _leaf_links(placed: DataFrame, state: np.ndarray, weight: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """Links and connections of leaves that link as a whole."""
    spark = placed.sparkSession
    linked = state == LINKED
    total = linked @ weight
    rows = [(int(i), int(total[i]), bool(linked[i, i])) for i in np.flatnonzero(linked.any(axis=1))]
    whole = placed.select("node", "n", "leaf").join(F.broadcast(spark.createDataFrame(rows, "leaf int, total long, own boolean")), "leaf")
    links = whole.select("node", (F.col("total") - F.when(F.col("own"), F.col("n")).otherwise(0)).alias("links"))
    # Every vector of a leaf that links with itself or another leaf is connected with the others of its leaf.
    leads = settle(placed.groupBy("leaf").agg(F.min("node").alias("lead")), "leads")
    edges = whole.join(F.broadcast(leads), "leaf").select(F.col("node").alias("u"), F.col("lead").alias("v"))
    i, j = np.nonzero(np.triu(linked, 1))
    across = spark.createDataFrame(pa.table({"p": pa.array(i.astype(np.int32)), "q": pa.array(j.astype(np.int32))}))
    named = (
        across.join(leads.select(F.col("leaf").alias("p"), F.col("lead").alias("u")), "p")
        .join(leads.select(F.col("leaf").alias("q"), F.col("lead").alias("v")), "q").select("u", "v")
    )
    return links, edges.unionByName(named)


def linked(classes: DataFrame, least: float = LEAST_COSINE, sample: int = SAMPLE, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """node and links, and edges u, v that connect what is linked, of ``classes`` (node, n copies, vector v)."""
    top = classes.orderBy(F.xxhash64("node"), "node").limit(sample).select("v").toArrow()
    unit = _matrix(top.column("v"), len(top))
    leaves = unit[net(unit, TOP)]
    threshold = float(chord(np.asarray(least)))
    placed, radius, weight, blocks = _placed(classes, leaves, radii(threshold), block_bytes)
    state = leaf_states(leaves, radius, threshold)
    found = _pair_links(placed, blocks, state, leaves, least)
    links = found.select("node", "links")
    edges = found.select(F.col("node").alias("u"), F.col("other").alias("v"))
    if (state == LINKED).any():
        more, across = _leaf_links(placed, state, weight)
        links, edges = links.unionByName(more), edges.unionByName(across)
    return links.groupBy("node").agg(F.sum("links").alias("links")), edges.filter("u <> v")


def link_embeddings(
    embeddings: DataFrame, least: float = LEAST_COSINE, vector: str = "embedding", sample: int = SAMPLE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    v = F.col(vector)
    if embeddings.schema[vector].dataType.elementType.simpleString() != "float":
        v = v.cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long"), v.alias("v"), usable(v).alias("usable"))
    # Equal vectors are one class; two hashes of 64 bits tell vectors apart.
    rows = rows.select(
        "vec_id", "usable", F.when(F.col("usable"), F.xxhash64("v")).alias("h1"),
        F.when(F.col("usable"), F.xxhash64(F.lit("second"), "v")).alias("h2"), F.when(F.col("usable"), F.col("v")).alias("v"),
    )
    grouped = rows.filter("usable").groupBy("h1", "h2").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    classes = settle(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")
    shortest, longest = classes.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if shortest is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if shortest != longest:
        raise ValueError(f"vectors of {shortest} to {longest} entries: all must have one length")
    links, edges = linked(classes, least, sample, block_bytes)
    of_node = settle(components(edges), "components")
    member = classes.select("node", "least").join(of_node, "node")
    smallest = settle(member.groupBy("component").agg(F.min("least").alias("smallest")), "smallest")
    per_class = (
        classes.select("h1", "h2", "node", "least", "n").join(links, "node", "left").join(of_node, "node", "left").join(smallest, "component", "left")
        .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("smallest", "least").alias("component_id"))
    )
    per_class = settle(per_class, "per-class")
    # Copies of one vector may hold most rows: written first, so that the join can split them.
    out = settle(rows.drop("v"), "vectors").join(per_class, ["h1", "h2"], "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))

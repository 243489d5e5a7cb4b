"""Near-duplicate vectors: spherical k-means cells, blocked cosine products.

k-means on a bounded sample gives unit centroids; every vector has the nearest
one's cell as its home. Two linked vectors x and y of different cells c and d
have a midpoint on or across the plane between the centroids, so one of them
lies within half their distance of it: each vector is also a guest of every
cell whose plane is that near (with an absolute slack over rounding), and a
pair is compared where one is at home and the other is at home or a guest. So
no link of the threshold or above is lost. A pair that two cells could compare
is left to the lower one: a vector at home carries one bit for each cell that
it visits. Equal vectors are collapsed before.

A task holds a block of a cell's home vectors and streams the others past it in
batches: a vector moves once for each cell it visits and block there, never for
each pair. A task gives counts and a spanning forest, not the pairs. With
``probes``, a vector visits only so many of the nearest cells; that bounds what
moves, and links may then be missed (README: measured recall).

Cosines are in double precision. Defined results: a null vector, a zero one, or
one with null or non-finite components links with nothing, as do vectors of
different lengths; repeated rows count as other vectors; a row without id
counts as another vector, but has a null component unless linked to one with
id; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import StageTables, partitions, ship
from .components import components

#: k-means sees at most SAMPLE vectors, and makes CELLS centroids at most and no more than FLOATS numbers in all: the bound of what is sent to tasks.
SAMPLE, CELLS, FLOATS, ROUNDS = 16_384, 2_048, 4_000_000, 8
#: Home vectors that a task holds (and no more than FLOATS numbers), rows that it streams past them, about, and rows of one product.
BLOCK, STREAM, TILE = 8_192, 65_536, 512
#: Above any rounding of a dot product of unit vectors.
SLACK = 1e-9
#: Stands for a missing id where ids are ordered.
NO_ID = (1 << 63) - 1


def _unit(x: np.ndarray) -> np.ndarray:
    # by a power of two first, which is exact, so that no square leaves the range of a double
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _distances(c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * c @ c.T))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Unit centroids of the unit vectors ``x``, k at most; a cell left empty takes the vector farthest from its own, and of centroids that coincide one stays."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        sims = x @ c.T
        home, best = sims.argmax(1), sims.max(1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        empty = np.linalg.norm(sums, axis=1) < 1e-9
        sums[empty] = x[np.argsort(best)[: empty.sum()]]
        c = _unit(sums)
    return c[~np.tril(_distances(c) < 1e-6, -1).any(axis=1)]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _assign(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, threshold: float, probes: int | None) -> Iterator[pa.RecordBatch]:
    """Rows (rep, first, copies, v) with a home cell, and again for each cell visited; ``seen``, at home only: a bit for each of those."""
    planes = np.sqrt(2 - 2 * threshold) / 2 * _distances(centroids) + SLACK
    for b in batches:
        for at in range(0, b.num_rows, 2048):
            part = b.slice(at, 2048)
            sims = _unit(_matrix(part.column("v"))) @ centroids.T
            each, home = np.arange(len(sims)), sims.argmax(1)
            near = sims[each, home][:, None] - sims <= planes[home]
            if probes is not None and probes + 1 < len(centroids):
                near &= sims >= -np.partition(-sims, probes, axis=1)[:, probes : probes + 1]
            near[each, home] = False
            seen = pa.array([r.tobytes() for r in np.packbits(near, axis=1, bitorder="little")], pa.binary())
            row, cell = np.nonzero(near)
            row, cell = np.concatenate([each, row]), np.concatenate([home, cell])
            take = pa.array(row)
            columns = [part.column(k).take(take) for k in range(4)]
            columns += [pa.array(cell.astype(np.int32)), pa.array(home[row].astype(np.int32)), pa.concat_arrays([seen, pa.nulls(len(row) - len(each), pa.binary())])]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "first", "copies", "v", "cell", "home", "seen"])


class _Block:
    """A cell's home vectors, as far as one task holds them, with what was found about them."""

    def __init__(self, cell: int, rows: pa.Table, threshold: float):
        self.cell, self.threshold = cell, threshold
        self.rep, self.first, self.copies = (rows.column(k).to_numpy() for k in ("rep", "first", "copies"))
        self.x = _unit(_matrix(rows.column("v")))
        self.seen = np.frombuffer(b"".join(rows.column("seen").to_pylist()), np.uint8).reshape(len(self.rep), -1)
        self.n, self.label = np.zeros(len(self.rep), np.int64), np.arange(len(self.rep))
        self.out: list[tuple] = []

    def edge(self, rep: int, first: int, row: int) -> None:
        self.out.append((rep, first, 0, self.rep[row], self.first[row]))

    def _join(self, rows: np.ndarray, rep: int, first: int, known: bool) -> None:
        """A vector that links to ``rows``: an edge for each group of them that it joins up. ``known``: the vector is itself of the first row's group."""
        labels, at = np.unique(self.label[rows], return_index=True)
        mine = self.label[rows[0]]
        for row in rows[at][labels != mine] if known else rows[at]:
            self.edge(rep, first, row)
        if len(labels) > 1:
            self.label[np.isin(self.label, labels)] = labels[0]

    def inside(self) -> None:
        for at in range(0, len(self.x), TILE):
            hit = self.x @ self.x[at : at + TILE].T >= self.threshold
            tile = np.arange(at, at + hit.shape[1])
            hit[tile, tile - at] = False
            self.n += hit @ self.copies[tile]
            for j in np.flatnonzero(hit.any(axis=0)):
                self._join(np.append(at + j, np.flatnonzero(hit[:, j])), self.rep[at + j], self.first[at + j], True)

    def passing(self, t: pa.Table) -> None:
        rep, first, copies, home = (t.column(k).to_numpy() for k in ("rep", "first", "copies", "home"))
        hit = self.x @ _unit(_matrix(t.column("v"))).T >= self.threshold
        # a pair that the lower of two cells compares as well is left to it
        lower = np.flatnonzero((home < self.cell) & hit.any(axis=0))
        if len(lower):
            c = home[lower]
            hit[:, lower] &= (self.seen[:, c >> 3] >> (c & 7).astype(np.uint8) & 1) == 0
        some = np.flatnonzero(hit.any(axis=0))
        if len(some):
            hit = hit[:, some]
            self.n += hit @ copies[some]
            for k, n in enumerate(self.copies @ hit):
                j = some[k]
                self.out.append((rep[j], first[j], n, None, None))
                self._join(np.flatnonzero(hit[:, k]), rep[j], first[j], False)

    def result(self) -> pa.RecordBatch:
        counted = np.flatnonzero(self.n)
        rows = [*self.out, *((self.rep[i], self.first[i], self.n[i], None, None) for i in counted)]
        self.out, self.n = [], np.zeros_like(self.n)
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(5)], ["a", "fa", "n", "b", "fb"])


def _compare(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Batches sorted by (cell, i, salt, side) as rows (a, fa, n, b, fb): n more links for a where b is null, else a link of the forest."""
    group, waiting, block = None, [], None

    def begun() -> _Block:
        made = _Block(group[0], pa.Table.from_batches(waiting), threshold)
        if group[2] == 0:  # of the salts, one compares the block with itself
            made.inside()
        return made

    for b in batches:
        keys = np.stack([b.column(k).to_numpy() for k in ("cell", "i", "salt", "side")], 1)
        new = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for s, e in zip([0, *new], [*new, len(keys)], strict=True):
            if s == e:
                continue
            *at, side = keys[s].tolist()
            if at != group:
                if waiting and block is None:
                    block = begun()
                if block is not None:
                    yield block.result()
                group, waiting, block = at, [], None
            part = b.slice(s, e - s)
            if side == 0:
                waiting.append(part)
                continue
            if not waiting:
                continue  # nobody is at home here
            block = block or begun()
            for k in range(0, part.num_rows, TILE):
                block.passing(pa.Table.from_batches([part.slice(k, TILE)]))
            yield block.result()
    if waiting and block is None:
        block = begun()
    if block is not None:
        yield block.result()


def _links(nodes: DataFrame, d: int, n: int, kind: str, threshold: float, probes: int | None, stages: StageTables) -> DataFrame:
    """What ``_compare`` finds among the vectors of ``d`` components, of which there are ``n``."""
    spark = nodes.sparkSession
    sample = nodes.select("v").orderBy(F.xxhash64("v")).limit(SAMPLE).toPandas()["v"]
    k = max(1, min(CELLS, FLOATS // d, len(sample), int(np.sqrt(n) / 3)))  # more cells mean fewer comparisons, but more visits
    centroids = spherical_kmeans(_unit(np.stack(sample.to_numpy()).astype(np.float64)), k)
    schema = f"rep long, first long, copies long, v {kind}, cell int, home int, seen binary"
    dealt = stages.put(nodes.select("rep", "first", "copies", "v").repartition(partitions(spark)).mapInArrow(lambda it: _assign(it, centroids, threshold, probes), schema))
    block, at_home = min(BLOCK, max(1, FLOATS // d)), F.col("home") == F.col("cell")
    sizes = dealt.groupBy("cell").agg(F.ceil(F.count_if(at_home) / block).cast("int").alias("blocks"), F.ceil(F.count("*") / STREAM).cast("int").alias("salts")).where("blocks > 0")  # a row for each cell
    own, salt = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64(F.lit(1), "rep"), F.col("salts")).cast("int")
    task = lambda i, s, side: F.struct(i.alias("i"), s.alias("salt"), F.lit(side).alias("side"))
    holds = F.transform(F.sequence(F.lit(0), F.col("salts") - 1), lambda s: task(own, s, 0))
    passes = lambda upto: F.when(upto > 0, F.transform(F.sequence(F.lit(0), upto - 1), lambda i: task(i, salt, 1))).otherwise(F.array())
    tasks = F.when(at_home, F.concat(holds, passes(own))).otherwise(passes(F.col("blocks")))
    spread = dealt.join(F.broadcast(sizes), "cell").withColumn("task", F.explode(tasks)).select("rep", "first", "copies", "v", "home", "seen", "cell", "task.i", "task.salt", "task.side")
    sorted_ = spread.repartition(partitions(spark), "cell", "i", "salt").sortWithinPartitions("cell", "i", "salt", "side")
    found = stages.put(sorted_.mapInArrow(lambda it: _compare(it, threshold), "a long, fa long, n long, b long, fb long"))
    stages.drop(dealt)
    return found


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", probes: int | None = None) -> DataFrame:
    """(id, n_links, component_id, kept) for every row. ``probes``: cells that a vector visits beside its own at most; by default as many as it takes to lose no link."""
    spark, stages = vectors.sparkSession, StageTables(vectors.sparkSession)
    ship(spark)
    kind = "array<float>" if dict(vectors.dtypes)[vector_col] == "array<float>" else "array<double>"  # moved as it came, compared in double precision
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("v"))
    fine = F.coalesce((F.size("v") > 0) & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists("v", lambda c: c != 0), F.lit(False))
    distinct = stages.put(rows.where(fine).groupBy("v").agg(F.coalesce(F.min("id"), F.lit(NO_ID)).alias("first"), F.count("*").alias("copies")))
    # a node for each distinct vector, whatever ids repeat or are missing
    nodes = stages.put(distinct.select(F.monotonically_increasing_id().alias("rep"), "*", F.size("v").alias("d")))
    stages.drop(distinct)
    found = [_links(nodes.where(F.col("d") == r["d"]), r["d"], r["count"], kind, threshold, probes, stages) for r in sorted(nodes.groupBy("d").count().collect())]  # a row for each vector length
    node = lambda first, rep: F.struct(F.col(first).alias("first"), F.col(rep).alias("rep"))
    if not found:
        return vectors.select(F.col(id_col).cast("long").alias("id"), F.lit(0).cast("long").alias("n_links"), F.col(id_col).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    counts = links.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    # nodes are ordered by their smallest id, so a component's smallest node names it
    group = components(links.where("b is not null").select(node("fa", "a").alias("a"), node("fb", "b").alias("b")), stages)
    named = group.select(F.col("node.rep").alias("node"), F.col("component.first").alias("smallest"))
    facts = nodes.join(counts, F.col("rep") == F.col("a"), "left").join(named, F.col("rep") == F.col("node"), "left")
    of = facts.select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.nullif(F.coalesce("smallest", "first"), F.lit(NO_ID)).alias("component_id"))
    fit = rows.where(fine).join(of, "v").select("id", "n_links", F.coalesce("component_id", "id").alias("component_id"))
    unfit = rows.where(~fine).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return fit.unionByName(unfit).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))

"""Connected components of a link table, by alternating large and small stars.

Each round is two aggregations (the smallest neighbour of every node, combined
map-side) joined back to the links; rounds end when all that is left is stars.
Links stay distributed throughout; each round's links are written to a stage
table and the round before them deleted, so lineage and disk stay short. A hub
is a skewed join key, which Spark splits at run time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import StageTables


def components(links: DataFrame, stages: StageTables) -> DataFrame:
    """``links``: (a, b) of any one type that has an order. Returns (node, component) for every linked node; component is its smallest node.

    A node that begins with what is to name its component (a struct of id and number, say) saves a join on the component. Loops and repeated links do no harm; nodes without links don't appear; an empty table gives an empty result.
    """
    now = stages.put(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not now.isEmpty():
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        roots = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(roots, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(roots.select("a", F.col("m").alias("b"))).distinct()
        before, now = now, stages.put(small)
        stages.drop(before)
        facts = now.agg(F.count("*").alias("n"), F.count_distinct("a").alias("nodes")).first()
        if facts["n"] == facts["nodes"] and now.select(F.col("b").alias("a")).join(now.select("a"), "a", "left_semi").isEmpty():
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Record batches sorted by ``keys`` as tables that hold whole groups only, with the groups' first rows and the row count after the last.

    The last group of a batch waits for the next batch, so memory holds a batch and a group.
    """
    held: pa.Table | None = None

    def starts(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[:1] = True
        for k in keys:
            v = t.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.append(np.nonzero(new)[0], t.num_rows)

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = t if held is None else pa.concat_tables([held, t])
        at = starts(t)
        if len(at) > 2:
            yield t.slice(0, at[-2]), at[:-1]
        held = t.slice(at[-2])
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


def forest(n: int, linked) -> list[tuple[int, int]]:
    """A spanning forest of n nodes. ``linked(i, rest)``: which of the nodes ``rest`` node i links to, as a boolean array."""
    rest, edges = np.arange(n), []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = linked(i, rest)
            if hit.any():
                new = rest[hit]
                edges += [(i, j) for j in new]
                queue += list(new)
                rest = rest[~hit]
    return edges

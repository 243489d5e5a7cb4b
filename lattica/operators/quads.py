"""The quad table: schema, sets and bags, parts and their statistics.

``o`` holds an object's lexical form; ``o_kind`` is iri, blank or literal and ``o_dt``
a literal's datatype, or its language as @tag. Files hold bags of quads, graphs are sets of them.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TERMS = ("s", "p", "o", "o_kind", "o_dt", "g")
QUAD = "s string, p string, o string, o_kind string, o_dt string, g string"
DEFAULT_GRAPH = "urn:x-rdflib:default"


def distinct_quads(quads: DataFrame, *keep: str) -> DataFrame:
    """The set of a bag of quads; ``keep``: bookkeeping columns that tell quads apart too."""
    return quads.select(*TERMS, *keep).distinct()


def union_graphs(*graphs: DataFrame) -> DataFrame:
    out = graphs[0].select(*TERMS)
    for g in graphs[1:]:
        out = out.unionByName(g.select(*TERMS))
    return out.distinct()


def without_default(quads: DataFrame) -> DataFrame:
    return quads.where(F.col("g").isNotNull() & (F.col("g") != DEFAULT_GRAPH))


def with_predicate(quads: DataFrame, *predicates: str) -> DataFrame:
    return quads.where(F.col("p").isin(*predicates)) if len(predicates) > 1 else quads.where(F.col("p") == predicates[0])


def subject_kind(s: Column) -> Column:
    """A subject is an IRI or, as its ``_:`` tells, a blank node."""
    return F.when(s.startswith("_:"), "blank").otherwise("iri")


def settle(df: DataFrame) -> DataFrame:
    """The same rows, stored: read again instead of computed again, by whichever executor, and with a lineage of their own.

    They go to the session's checkpoint folder, which a cluster shares
    (``spark.checkpoint.dir``). Where none is set, one machine uses a temporary
    folder; on a cluster that is an error.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lattica-checkpoint-"))
    return df.checkpoint()


_LOCAL = (1 << 33) - 1


def _dense(placed: DataFrame, name: str) -> DataFrame:
    """Dense ordinals from the column ``_mid`` of monotonically_increasing_id: a partition's rows are shifted by the sizes of those before it (one row a partition)."""
    sizes = placed.groupBy(F.shiftrightunsigned("_mid", 33).alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    joined = placed.withColumn("_part", F.shiftrightunsigned("_mid", 33)).join(F.broadcast(before), "_part")
    return joined.withColumn(name, F.col("_mid").bitwiseAND(F.lit(_LOCAL)) + F.col("_before")).drop("_part", "_mid", "_before")


def with_ordinal(rows: DataFrame, *keys: Column | str, name: str = "row_ord") -> DataFrame:
    """Dense ordinals from 0 by ``keys``, without ordering all rows in one task.

    Rows are range-partitioned, sorted and numbered where they are. The placed
    rows are stored: the borders come from a sample, and the sizes must be those
    of the same partitions, an executor's loss notwithstanding.
    """
    order = [F.col(k) if isinstance(k, str) else k for k in keys]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
    return _dense(settle(placed), name)


def in_scan_order(rows: DataFrame, name: str = "row_ord") -> DataFrame:
    """Dense ordinals in the order of a scan: file order where a file is one partition (as gzip files are) or is split in order."""
    placed = rows.withColumn("_mid", F.monotonically_increasing_id())
    if rows.rdd.getNumPartitions() == 1:
        return placed.withColumnRenamed("_mid", name)
    return _dense(placed, name)


def part_of(ordinal: Column, chunk_rows: int) -> Column:
    return F.floor(ordinal / chunk_rows).cast("int")


def part_stats(rows: DataFrame, quads: DataFrame) -> DataFrame:
    """(part_index, rows, triples): parts of ``rows``, those without a triple too."""
    counted = rows.groupBy("part_index").agg(F.count("*").alias("rows"))
    return counted.join(quads.groupBy("part_index").agg(F.count("*").alias("triples")), "part_index", "left").select("part_index", "rows", F.coalesce("triples", F.lit(0)).cast("long").alias("triples"))


def totals(stats: DataFrame) -> DataFrame:
    return stats.agg(F.count("*").alias("parts"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("triples"), F.lit(0)).alias("triples"))

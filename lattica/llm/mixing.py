"""Mixing sources to target weights by subset-sum budget fitting.

Targets come from water-filling over the sources' totals. A target is so many
whole passes over its source and a remaining budget, which documents counted by
exact length fill: from the longest length to the shortest each gives its share
of the budget so far, less what was taken before, so that what is left at the
end is under two of the longest document; a bounded knapsack over the counts
left fills that, to the word where the lengths allow it. Which documents of a length go in
is settled by a seeded ticket: a length's quota becomes a cut-off ticket, found
from tickets alone, and each row is decided in place. Texts are never moved.

Counts are kept by (source, length, ticket range), so even a third of all rows
of one source and length is many small groups; only tickets of the range in
which a quota runs out are ranked. One row a source stays in the cluster, and a
source's lengths (no more than its longest document has words) meet in one task.

Defined results: a null text has size 0; a null source is a source of its own,
the last; documents of size 0 take nothing beyond whole passes; repeated rows
are documents of their own, and where a quota ends among rows that are the same
in every column, so many of them are taken; rows without id or that share one
are told apart by their other columns, so the order of rows never matters; an
empty table gives an empty result; extra columns travel in a struct.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import StageTables, row_hash, ship, words_of

RANGES = 10


def _knapsack(sizes: list[int], free: list[int], budget: int) -> list[int]:
    """How many of each size make the greatest sum up to ``budget``, with ``free`` of each at hand.

    Bit b of ``reach`` is set if a sum of b can be made; counts go in as powers
    of two. A sum remembers only the step that first made it, so memory follows the budget.
    """
    reach, full, steps = 1, (1 << (budget + 1)) - 1, []
    made = np.zeros(budget + 1, np.int32)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        left, power = min(free[i], budget // sizes[i]), 1
        while left > 0 and not reach >> budget & 1:
            many = min(power, left)
            steps.append((i, many))
            new = (reach << many * sizes[i]) & full & ~reach
            bits = np.unpackbits(np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), np.uint8), bitorder="little")
            made[np.flatnonzero(bits)] = len(steps)
            reach |= new
            left, power = left - many, power * 2
    take, at = [0] * len(sizes), reach.bit_length() - 1
    while at:
        i, many = steps[made[at] - 1]
        take[i] += many
        at -= many * sizes[i]
    return take


def shares(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """So many of each size, from the longest down, that the sum so far follows the budget's share of it.

    What is left of the budget is less than the longest: a length leaves less
    than itself, or gives all it has, which is more than its share.
    """
    total, take, passed, taken = sum(s * c for s, c in zip(sizes, counts, strict=True)), [0] * len(sizes), 0, 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        passed += sizes[i] * counts[i]
        take[i] = min(counts[i], (passed * budget // total - taken) // sizes[i]) if counts[i] else 0
        taken += take[i] * sizes[i]
    return take


def fit_budget(sizes: Sequence[int], counts: Sequence[int], budget: int) -> list[int]:
    """How many documents of each size to take, for a sum near ``budget`` and not above it; ``sizes`` positive and distinct."""
    sizes, counts = [int(s) for s in sizes], [int(c) for c in counts]
    if budget >= sum(s * c for s, c in zip(sizes, counts, strict=True)):
        return counts
    if budget <= 0:
        return [0] * len(sizes)
    # a longest document's worth is held back, so that the knapsack has something to choose from
    take = shares(sizes, counts, max(0, budget - max(s for s, c in zip(sizes, counts, strict=True) if c)))
    rest = budget - sum(s * k for s, k in zip(sizes, take, strict=True))
    return [k + m for k, m in zip(take, _knapsack(sizes, [c - k for c, k in zip(counts, take, strict=True)], rest), strict=True)]


def _targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """(skey, source_size, target) by water-filling: weight * level, up to ``most`` times the size."""
    words = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * level > F.col("source_size") * most if capped >= 0 else F.lit(False)
        s = sources.agg(F.count_if(over).alias("n"), F.sum(F.when(over, F.col("source_size") * most).otherwise(0.0)).alias("held"), F.sum(F.when(over, 0.0).otherwise(F.col("weight").cast("double"))).alias("free")).first()
        if s["n"] == capped or not s["free"]:
            break
        level, capped = (share * words - s["held"]) / s["free"], s["n"]
    return sources.select("skey", "source_size", F.least(F.col("weight") * F.lit(level), F.col("source_size") * F.lit(most)).alias("target"))


def _place(ticket: str = "ticket") -> Column:
    """Tickets in the order of their ranges, which are of unsigned numbers."""
    return F.col(ticket).bitwiseXOR(F.lit(-(1 << 63)))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with size, source_size, target and ``copies``: how often the mix takes it (0 to ``most``).

    Sources by code point, null last, weigh ``weights``, repeating; they share ``share`` times all words.
    """
    stages = StageTables(docs.sparkSession)
    ship(docs.sparkSession)
    named = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n"))  # never null, and as distinct as the sources
    size = F.size(words_of(F.col(text_col))).cast("long")
    sized = docs.select(F.struct("*").alias("row"), named.alias("skey"), size.alias("size"), F.xxhash64(F.lit(seed), row_hash(docs)).alias("ticket"))
    tickets = stages.put(sized.select("skey", "size", "ticket").withColumn("range", F.shiftrightunsigned("ticket", 64 - RANGES).cast("int")))
    counts = stages.put(tickets.groupBy("skey", "size", "range").agg(F.count("*").alias("n")))
    order = Window.orderBy(F.col("skey") == "n", "skey")  # over one row a source
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    sources = stages.put(counts.groupBy("skey").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")).withColumn("weight", weigh))
    targets = stages.put(_targets(sources, share, most))

    def plan(group: pd.DataFrame) -> pd.DataFrame:
        size, n = int(group["source_size"].iloc[0]), group["n"].to_numpy()
        target = float(group["target"].iloc[0])
        passes = min(most, int(target // size)) if size else 0
        rest = 0 if passes == most else round(target - passes * size)
        some = (group["size"] > 0).to_numpy()
        take = np.zeros(len(group), np.int64)
        take[some] = fit_budget(group["size"][some].tolist(), n[some].tolist(), rest)
        return pd.DataFrame({"skey": group["skey"], "size": group["size"], "passes": passes, "take": take})

    by_size = counts.groupBy("skey", "size").agg(F.sum("n").alias("n")).join(targets, "skey")
    planned = stages.put(by_size.groupBy("skey").applyInPandas(plan, "skey string, size long, passes int, take long"))
    # the range in which a length's quota runs out, and in it the ticket
    before = lambda key: F.coalesce(F.sum("n").over(Window.partitionBy("skey", "size").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = lambda df, key: df.withColumn("before", before(key)).where((F.col("before") <= F.col("take")) & (F.col("take") < F.col("before") + F.col("n")))
    last = ends(counts.join(planned, ["skey", "size"]), "range").select("skey", "size", "range", (F.col("take") - F.col("before")).alias("take"))
    near = tickets.join(last, ["skey", "size", "range"]).groupBy("skey", "size", _place().alias("place"), "take").agg(F.count("*").alias("n"), F.first("ticket").alias("cut"))
    cuts = ends(near, "place").select("skey", "size", "cut", (F.col("take") - F.col("before")).alias("some"))
    # without a cut, all are taken
    decided = stages.put(planned.select("skey", "size", "passes").join(cuts, ["skey", "size"], "left").join(targets, "skey").select("skey", "size", "passes", "cut", "some", "source_size", "target"))
    stages.drop(tickets, counts)
    put = sized.join(decided, ["skey", "size"])
    taken = F.when(F.col("cut").isNull(), 1).when(_place() < _place("cut"), 1).otherwise(0)
    out = ["row", "size", "source_size", "target"]
    if decided.where("some > 0").isEmpty():
        return put.select(*out, (F.col("passes") + taken).alias("copies"))
    # a quota that ends among equal rows: they fall together, and come apart again as so many that are taken and the rest
    tied = (F.coalesce("some", F.lit(0)) > 0) & (F.col("ticket") == F.col("cut"))
    equal = put.where(tied).groupBy("ticket", "skey", "size").agg(F.first("row").alias("row"), *[F.first(c).alias(c) for c in ("source_size", "target", "passes", "some")], F.count("*").alias("n"))
    apart = equal.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(*out, (F.col("passes") + (F.col("k") <= F.col("some")).cast("int")).alias("copies"))
    return put.where(~tied).select(*out, (F.col("passes") + taken).alias("copies")).unionByName(apart)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    found = mix(docs, **options).where("copies > 0")
    return found.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")

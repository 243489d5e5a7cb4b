"""Derived facts and closures as relational plans. Results go to a graph of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.shapes import Shape
from ..plans.vocabulary import RDF, RDFS
from . import bgp, shacl
from .quads import settle


def _facts(quads: DataFrame, predicate: str) -> DataFrame:
    return quads.where((F.col("p") == predicate) & (F.col("o_kind") == "iri")).select("s", "o").distinct()


def _as_quads(df: DataFrame, s: Column, p: str, o: Column, graph: str) -> DataFrame:
    return df.select(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_dt"), F.lit(graph).alias("g")).distinct()


def apply_rules(quads: DataFrame, shapes: list[Shape], graph: str, ontology: list[tuple] | None = None) -> DataFrame | None:
    """What the shapes' CONSTRUCT rules derive about the nodes that each shape targets."""
    found = shacl.Validator(quads, ontology or [], parts=())
    out = None
    for shape in (s for s in shapes if s.rules):
        focus = found.focus(shape).select("focus")
        for rule in shape.rules:
            made = bgp.construct(quads, rule, graph, focus)
            out = made if out is None else out.unionByName(made).distinct()
    return out


def inverse(quads: DataFrame, predicate: str, inverse_of: str, graph: str) -> DataFrame:
    return _as_quads(_facts(quads, inverse_of), F.col("o"), predicate, F.col("s"), graph)


def symmetric_pairs(quads: DataFrame, predicate: str, link: str, graph: str) -> DataFrame:
    """s and t are linked where both reach the same object over ``link``: each unordered pair is joined once, then mirrored."""
    a = _facts(quads, link)
    b = a.select(F.col("s").alias("t"), "o")
    pairs = a.join(b, "o").where("s < t").select("s", "t").distinct()
    both = pairs.unionByName(pairs.select(F.col("t").alias("s"), F.col("s").alias("t")))
    return both.select("s", F.lit(predicate).alias("p"), F.col("t").alias("o"), F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_dt"), F.lit(graph).alias("g"))


def chain(quads: DataFrame, predicate: str, first: str, second: str, graph: str) -> DataFrame:
    a, b = _facts(quads, first), _facts(quads, second)
    joined = a.join(b.select(F.col("s").alias("o"), F.col("o").alias("end")), "o")
    return _as_quads(joined, F.col("s"), predicate, F.col("end"), graph)


def at_least(quads: DataFrame, link: str, n: int, type_: str, class_: str, graph: str) -> DataFrame:
    """Objects that ``n`` subjects or more link to are of a class."""
    found = _facts(quads, link).groupBy("o").agg(F.count("*").alias("n")).where(F.col("n") >= n)
    return _as_quads(found, F.col("o"), type_, F.lit(class_), graph)


def typed_by_ends(quads: DataFrame, ontology: list[tuple[str, str, str]], graph: str) -> DataFrame:
    """The classes that domains and ranges give to subjects and to objects that aren't literals: one pass, no join, as an ontology is configuration."""
    ends = {RDFS + "domain": {}, RDFS + "range": {}}
    for s, p, o in ontology:
        if p in ends:
            ends[p].setdefault(s, []).append(o)
    told = sorted({p for named in ends.values() for p in named})
    if not told:
        return _as_quads(quads.where(F.lit(False)), F.col("s"), RDF + "type", F.col("o"), graph)

    def typings(node: Column, named: dict[str, list[str]], wanted: Column) -> Column:
        none = F.array().cast("array<struct<s:string,o:string>>")
        out = F.when(F.lit(False), none)
        for p, classes in sorted(named.items()):
            out = out.when(wanted & (F.col("p") == p), F.array(*[F.struct(node.alias("s"), F.lit(c).alias("o")) for c in sorted(set(classes))]))
        return out.otherwise(none)

    both = F.concat(typings(F.col("s"), ends[RDFS + "domain"], F.lit(True)), typings(F.col("o"), ends[RDFS + "range"], F.col("o_kind") != "literal"))
    found = quads.where(F.col("p").isin(told)).select(F.explode(both).alias("t")).select("t.*")
    return _as_quads(found, F.col("s"), RDF + "type", F.col("o"), graph)


def closure(edges: DataFrame, rounds: int = 30) -> DataFrame:
    """The transitive closure of (sub, sup), not reflexive, for class-sized graphs: paths double in each round until none is new. Each round is stored, so none computes an earlier one again."""
    now = settle(edges.select("sub", "sup").distinct())
    n = now.count()
    for _ in range(rounds):
        step = now.join(now.select(F.col("sub").alias("sup"), F.col("sup").alias("far")), "sup").select("sub", F.col("far").alias("sup"))
        now = settle(now.unionByName(step).distinct())
        before, n = n, now.count()
        if n == before:
            return now
    raise ValueError("the graph is deeper than the rounds allow")


def close_pairs(edges: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The same for edges on the driver: a walk from each node over what it points to."""
    to: dict[str, set[str]] = {}
    for sub, sup in edges:
        to.setdefault(sub, set()).add(sup)
    out = []
    for start in to:
        seen, ahead = set(), list(to[start])
        while ahead:
            node = ahead.pop()
            if node not in seen:
                seen.add(node)
                ahead.extend(to.get(node, ()))
        out += [(start, end) for end in seen]
    return sorted(out)


def with_subproperties(quads: DataFrame, predicate: str, edges: list[tuple[str, str]]) -> DataFrame:
    """Quads of a predicate and of all below it."""
    below = [predicate, *[sub for sub, sup in close_pairs(edges) if sup == predicate]]
    return quads.where(F.col("p").isin(below))

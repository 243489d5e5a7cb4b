"""Shape validation as joins, anti-joins and aggregations over quads.

Results have one schema, (part columns, focus, shape, path, component,
severity, value, message). With part columns every check sees its own part
only; class membership may also see further quads (``context``). Counts of
values and datatypes of all properties of a shape share one aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import escape, well_typed
from ..plans.shapes import Shape
from ..plans.vocabulary import RDF, RDFS, SH
from . import bgp
from .quads import subject_kind

RESULT = ("focus", "shape", "path", "component", "severity", "value", "message")
#: Sources whose closure is this small are closed on the driver.
TBOX = 10_000


def subclasses_of(top: str, edges: list[tuple[str, str]]) -> list[str]:
    """A class and all below it; the class graph is configuration-sized and may have cycles."""
    below, queue = {top}, [top]
    while queue:
        c = queue.pop()
        for sub, sup in edges:
            if sup == c and sub not in below:
                below.add(sub)
                queue.append(sub)
    return sorted(below)


class Validator:
    """``quads``: the graph to check. ``parts``: columns that divide it. ``ontology``: IRI triples; ``context``: more quads in which classes are looked up."""

    def __init__(self, quads: DataFrame, ontology: list[tuple[str, str, str]], parts: tuple[str, ...] = ("part_index",), context: DataFrame | None = None):
        if len(ontology) > TBOX:
            raise ValueError("an ontology is configuration: give large ones as context")
        self.parts = tuple(parts)
        # a graph is a set: each check takes what it needs of the bag and makes that distinct
        self.quads = quads.select("s", "p", "o", "o_kind", "o_dt", *self.parts)
        self.ontology, self.context = ontology, context
        self.edges = [(s, o) for s, p, o in ontology if p == RDFS + "subClassOf"]

    def _types(self, class_: str) -> DataFrame:
        """(node, part columns) of the class's instances in the data."""
        typed = self.quads.where((F.col("p") == RDF + "type") & F.col("o").isin(subclasses_of(class_, self.edges)))
        return typed.select(F.col("s").alias("node"), *self.parts).distinct()

    def focus(self, shape: Shape) -> DataFrame:
        """(focus, focus_kind, part columns): distinct nodes that the target selects."""
        kind, name = shape.target
        if kind == "class":
            return self._types(name).select(F.col("node").alias("focus"), subject_kind(F.col("node")).alias("focus_kind"), *self.parts)
        end = "s" if kind == "subjects" else "o"
        rows = self.quads.where(F.col("p") == name)
        return rows.select(F.col(end).alias("focus"), (subject_kind(F.col("s")) if end == "s" else F.col("o_kind")).alias("focus_kind"), *self.parts).distinct()

    def _result(self, df: DataFrame, shape: Shape, component: str, severity: str, message: str, path: str | None = None, value: Column | None = None) -> DataFrame:
        text = lambda x: F.lit(x).cast("string")
        return df.select(*self.parts, "focus", text(shape.iri).alias("shape"), text(path).alias("path"), text(component).alias("component"), text(severity).alias("severity"), (text(None) if value is None else value).alias("value"), text(message).alias("message"))

    def _outside(self, values: DataFrame, class_: str) -> DataFrame:
        """Rows (focus, value, ...) whose value isn't an instance of a class, in the part, the ontology or the context."""
        classes = subclasses_of(class_, self.edges)
        known = [s for s, p, o in self.ontology if p == RDF + "type" and o in classes]
        out = values.where(~F.col("value").isin(known)) if known else values
        out = out.join(self._types(class_).withColumnRenamed("node", "value"), ["value", *self.parts], "left_anti")
        if self.context is not None:
            there = self.context.where((F.col("p") == RDF + "type") & F.col("o").isin(classes)).select(F.col("s").alias("value")).distinct()
            out = out.join(there, "value", "left_anti")
        return out

    def _check(self, shape: Shape) -> list[DataFrame]:
        focus, out, key = self.focus(shape), [], ["focus", *self.parts]
        if shape.node_kind:
            out.append(self._result(focus.where(F.col("focus_kind") != shape.node_kind), shape, "nodeKind", shape.severity, shape.message, value=F.col("focus")))
        if shape.class_:
            out.append(self._result(self._outside(focus.withColumn("value", F.col("focus")), shape.class_), shape, "class", shape.severity, shape.message, value=F.col("value")))
        paths = sorted({p.path for p in shape.properties})
        values = self.quads.where(F.col("p").isin(paths)).select(F.col("s").alias("focus"), "p", F.col("o").alias("value"), "o_kind", "o_dt", *self.parts) if paths else None
        required = [p for p in shape.properties if p.min_count > 0]
        if required:
            # one aggregation for all paths, kept by the focus nodes that lack something
            needed = values.where(F.col("p").isin(sorted({p.path for p in required}))).distinct()
            counts = needed.groupBy(*key).agg(*[F.count_if(F.col("p") == p.path).alias(f"n{i}") for i, p in enumerate(required)])
            short = focus.join(counts, key, "left").fillna(0, [f"n{i}" for i in range(len(required))])
            lacking = F.filter(
                F.array(*[F.when(F.col(f"n{i}") < p.min_count, F.struct(F.lit(p.path).alias("path"), F.lit(p.severity).alias("severity"), F.lit(p.message).alias("message"))) for i, p in enumerate(required)]),
                lambda x: x.isNotNull(),
            )
            found = short.select(*key, F.explode(lacking).alias("x"))
            out.append(found.select(*self.parts, "focus", F.lit(shape.iri).alias("shape"), "x.path", F.lit("minCount").alias("component"), "x.severity", F.lit(None).cast("string").alias("value"), "x.message"))
        # what a value shows by itself: one pass over the values of all properties, and only faulty ones are shuffled
        faults = []
        for p in shape.properties:
            mine = F.col("p") == p.path
            said = lambda c, p=p: F.struct(F.lit(p.path).alias("path"), F.lit(c).alias("component"), F.lit(p.severity).cast("string").alias("severity"), F.lit(p.message).cast("string").alias("message"))
            if p.datatype:
                bad = (F.col("o_kind") != "literal") | ~F.col("o_dt").eqNullSafe(F.lit(p.datatype)) | ~well_typed(F.col("value"), p.datatype)
                faults.append(F.when(mine & bad, said("datatype")))
            if p.node_kind:
                faults.append(F.when(mine & (F.col("o_kind") != p.node_kind), said("nodeKind")))
        if faults:
            wrong = values.select(*key, "value", "o_kind", "o_dt", F.explode(F.array(*faults)).alias("x")).where("x is not null").distinct()
            wrong = wrong.join(focus.select(*key), key, "left_semi")
            out.append(wrong.select(*self.parts, "focus", F.lit(shape.iri).cast("string").alias("shape"), "x.path", "x.component", "x.severity", "value", "x.message"))
        for p in shape.properties:
            if p.class_:
                own = values.where(F.col("p") == p.path).distinct()
                out.append(self._result(self._outside(own, p.class_).join(focus.select(*key), key, "left_semi"), shape, "class", p.severity, p.message, p.path, F.col("value")))
        for q in shape.queries:
            out.append(self._result(self._solutions(focus, q.query), shape, "sparql", q.severity, q.message, value=F.col("focus")))
        return out

    def _solutions(self, focus: DataFrame, query) -> DataFrame:
        """Focus nodes for which a query has a solution. Inside a part the pattern is matched part by part: the part is folded into the terms.

        What a NOT EXISTS asks for may be in the part or, as a whole, in the ontology.
        """
        tag = lambda c: F.concat_ws("\u0000", *[F.col(p).cast("string") for p in self.parts], c) if self.parts else c
        nodes = focus.where("focus_kind <> 'literal'")
        joined = (F.col("o_kind") != "literal") & F.col("p").isin(sorted(_joined(query.where))) & F.lit(bool(self.parts))
        # a tagged term no longer shows that it is a blank node, as subject or as object
        quads = self.quads.withColumns({"s": tag(F.col("s")), "o": F.when(joined, tag(F.col("o"))).otherwise(F.col("o")), "o_kind": F.when(joined, "iri").otherwise(F.col("o_kind"))})
        found = bgp.select(quads, query, nodes.select(tag(F.col("focus")).alias("s"))).select(F.col("this").alias("s")).distinct()
        out = focus.withColumn("s", tag(F.col("focus"))).join(found, "s", "left_semi").drop("s")
        for group in query.where.absent:
            facts = [(s, p, o, "iri", None) for s, p, o in self.ontology if p in _predicates(group)]
            if facts:
                there = bgp.solve(focus.sparkSession.createDataFrame(facts, "s string, p string, o string, o_kind string, o_dt string"), group)
                out = out.join(there.select(F.col("`?this`").alias("focus")).distinct(), "focus", "left_anti")
        return out.select("focus", "focus_kind", *self.parts)

    def results(self, shapes: list[Shape]) -> DataFrame:
        all_ = [df for s in shapes for df in self._check(s)]
        if not all_:
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.quads.schema if f.name in self.parts)
            return self.quads.sparkSession.createDataFrame([], ", ".join(filter(None, [schema, *[f"{c} string" for c in RESULT]])))
        out = all_[0]
        for df in all_[1:]:
            out = out.unionByName(df)
        return out


def _predicates(group) -> set[str]:
    return {p.p for p in group.patterns} | {x for g in group.absent for x in _predicates(g)}


def _joined(group) -> set[str]:
    """Predicates whose object is a variable that is also a subject: such objects must carry the part as subjects do."""
    subjects = {p.s for p in group.patterns if isinstance(p.s, str)} | {p.s for g in group.absent for p in g.patterns if isinstance(p.s, str)}
    return {p.p for g in (group, *group.absent) for p in g.patterns if p.o in subjects}


def report_lines(results: DataFrame) -> DataFrame:
    """A Turtle statement for each result, for a text sink; what is null in a result, or an empty message, isn't said."""
    iri = lambda c: F.concat(F.lit("<"), F.col(c), F.lit(">"))
    text = lambda c: F.concat(F.lit('"'), escape(F.col(c)), F.lit('"'))
    component = F.when(F.col("component") == "sparql", "SPARQL").otherwise(F.concat(F.upper(F.substring("component", 1, 1)), F.substring("component", 2, 100)))
    said = [("focusNode", iri("focus")), ("sourceShape", iri("shape")), ("resultPath", iri("path")), ("sourceConstraintComponent", F.concat(F.lit(f"<{SH}"), component, F.lit("ConstraintComponent>"))), ("resultSeverity", F.concat(F.lit(f"<{SH}"), F.col("severity"), F.lit(">"))), ("value", text("value")), ("resultMessage", F.when(F.col("message") != "", text("message")))]
    body = F.concat_ws(" ; ", F.lit(f"[] a <{SH}ValidationResult>"), *[F.concat(F.lit(f"<{SH}{p}> "), c) for p, c in said])
    return results.select(F.concat(body, F.lit(" .")).alias("line"))


def severity_counts(results: DataFrame, *by: str) -> DataFrame:
    return results.groupBy(*by).agg(F.count_if(F.col("severity") == "Violation").alias("violations"), F.count_if(F.col("severity") == "Warning").alias("warnings"))


def gate(parts: DataFrame, results: DataFrame, key: tuple[str, ...] = ("part_index",), allow_warnings: bool = False) -> DataFrame:
    """Every part with its counts, whether it conforms, and the zone it goes to: whole parts move. A warning counts against a part unless allowed."""
    counted = parts.select(*key).distinct().join(severity_counts(results, *key), list(key), "left").fillna(0, ["violations", "warnings"])
    conforms = F.col("violations") == 0 if allow_warnings else (F.col("violations") + F.col("warnings")) == 0
    return counted.withColumn("conforms", conforms).withColumn("zone", F.when(F.col("conforms"), "asserted").otherwise("quarantine"))


def status(gated: DataFrame, transforms: DataFrame) -> DataFrame:
    """``transforms``: (transform, has_shapes); ``gated``: (transform, conforms, ...). One row a transform, those without parts too."""
    sums = gated.groupBy("transform").agg(F.count("*").alias("parts_total"), F.count_if("conforms").alias("conformant"))
    out = transforms.join(sums, "transform", "left").fillna(0, ["parts_total", "conformant"]).withColumn("quarantined", F.col("parts_total") - F.col("conformant"))
    word = (
        F.when(F.col("parts_total") == 0, "skipped-no-parts")
        .when(F.col("quarantined") == 0, F.when(F.col("has_shapes"), "passed").otherwise("passed-no-shapes"))
        .when(F.col("conformant") == 0, "failed")
        .otherwise("failed-partial")
    )
    return out.select("transform", word.alias("status"), "parts_total", "conformant", "quarantined")

"""Lineage in the W3C PROV vocabulary: steps to quads, consolidation, tracing, and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.turtle import Quad, trig
from ..plans.vocabulary import BASE, PIPELINE, PROV, RDF, RDFS, XSD
from .quads import settle, union_graphs, without_default

STEP = "slug string, activity string, agent string, input string, output string, transform_spec string, started_at timestamp, ended_at timestamp, record_count bigint, input_type string, output_type string"


def graph_of(source: str, batch: str) -> str:
    return f"{BASE}graph/provenance/{source}/{batch}"


def time_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


# The triples of a step and of a batch. A word with a colon is an IRI, any other a column; a third
# word with ^^ is a literal of that datatype, one with | the IRI to take where the column is null.
STEP_TRIPLES = """
activity    rdf:type                 prov:Activity
activity    prov:wasAssociatedWith   agent
activity    prov:used                input
activity    prov:generated           output
activity    prov:startedAtTime       started_at^^xsd:dateTime
activity    prov:endedAtTime         ended_at^^xsd:dateTime
input       rdf:type                 prov:Entity
input       rdf:type                 input_type|prov:Entity
output      rdf:type                 prov:Entity
output      rdf:type                 output_type|prov:Entity
output      prov:wasDerivedFrom      input
output      prov:wasGeneratedBy      activity
output      prov:qualifiedGeneration generation
generation  rdf:type                 prov:Generation
generation  prov:activity            activity
generation  prov:entity              output
generation  pipeline:transformSpec   transform_spec^^xsd:string
generation  pipeline:recordCount     record_count^^xsd:integer
"""
BATCH_TRIPLES = """
activity    rdf:type                 prov:Activity
activity    prov:wasAssociatedWith   agent
activity    prov:generated           batch
activity    prov:startedAtTime       started_at^^xsd:dateTime
agent       rdf:type                 prov:SoftwareAgent
agent       rdfs:label               agent_label^^xsd:string
batch       rdf:type                 prov:Entity
batch       rdf:type                 pipeline:IngestBatch
batch       prov:wasDerivedFrom      source
batch       prov:wasGeneratedBy      activity
batch       pipeline:batchId         batch_id^^xsd:string
batch       pipeline:sourceFingerprint fingerprint^^xsd:string
source      rdf:type                 prov:Entity
source      rdf:type                 pipeline:DataSource
source      pipeline:sourceId        source_id^^xsd:string
source      rdfs:label               label^^xsd:string
"""
_NAMES = {"rdf": RDF, "rdfs": RDFS, "prov": PROV, "pipeline": PIPELINE, "xsd": XSD}


def _iri(word: str) -> str:
    prefix, _, local = word.partition(":")
    return _NAMES[prefix] + local


def _triple(line: str, rows: DataFrame) -> Column:
    """A line of such a table over the columns of ``rows``; null where the object is."""
    subject, predicate, object_ = line.split()
    name, _, datatype = object_.partition("^^")
    column, _, otherwise = name.partition("|")
    if ":" in name and not otherwise:
        value = F.lit(_iri(name))
    elif dict(rows.dtypes)[column] == "timestamp":
        value = time_text(F.col(column))
    else:
        value = F.coalesce(F.col(column).cast("string"), F.lit(_iri(otherwise) if otherwise else None))
    facts = {"s": F.col(subject), "p": F.lit(_iri(predicate)), "o": value, "o_kind": F.lit("literal" if datatype else "iri"), "o_dt": F.lit(_iri(datatype) if datatype else None).cast("string")}
    return F.when(value.isNotNull(), F.struct(*[c.alias(k) for k, c in facts.items()]))


def _emit(rows: DataFrame, table: str, graph: str) -> DataFrame:
    triples = [_triple(line, rows) for line in table.strip().splitlines()]
    return rows.select(F.explode(F.array(*triples)).alias("t")).where("t is not null").select("t.*", F.lit(graph).alias("g")).distinct()


def derivations(steps: DataFrame, graph: str) -> DataFrame:
    """Each step of schema STEP as an activity that used its input and generated its output."""
    return _emit(steps.withColumn("generation", F.concat("output", F.lit("/generation"))), STEP_TRIPLES, graph)


def batch_start(batches: DataFrame, graph: str) -> DataFrame:
    """(batch, source, agent, activity, source_id, batch_id, label, fingerprint, started_at): a batch, its source and who began it. The fingerprint is the whole digest, beside the batch id."""
    return _emit(batches.withColumn("agent_label", F.concat(F.lit("flow:"), "source_id")), BATCH_TRIPLES, graph)


def consolidate(graph: str, *fragments: DataFrame) -> DataFrame:
    """All named graphs' quads as one set in one graph; default graphs stay out."""
    return union_graphs(*[without_default(f).withColumn("g", F.lit(graph)) for f in fragments])


def trace(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``edges``: (start, parent). Returns (start, ancestor, depth): everything upstream, nearest depth.

    A frontier walks up one step a round and is stored, so each round joins only what was new in the last.
    """
    steps = edges.select("start", "parent").distinct()
    front = steps.select("start", F.col("parent").alias("ancestor"), F.lit(1).cast("long").alias("depth"))
    out = front
    for depth in range(2, rounds + 2):
        front = front.join(steps.select(F.col("start").alias("ancestor"), F.col("parent").alias("next")), "ancestor").select("start", F.col("next").alias("ancestor"), F.lit(depth).cast("long").alias("depth")).distinct()
        front = front.join(out.select("start", "ancestor"), ["start", "ancestor"], "left_anti")
        front = settle(front)
        if front.isEmpty():
            return out
        out = out.unionByName(front)
    raise ValueError("lineage is deeper than the rounds allow")


def to_trig(quads: DataFrame) -> str:
    """A batch's lineage as TriG; a few quads a step, so it fits the driver."""
    rows: list[Quad] = [(("iri", r["s"]), ("iri", r["p"]), ("iri", r["o"]) if r["o_kind"] == "iri" else ("literal", r["o"], r["o_dt"]), r["g"] or "") for r in quads.collect()]
    return trig(rows)

"""The engine's model over the retail tables: templates, ontology, shapes.

Customers stand for persons, orders for titles, line items for episodes of an
order, parts for rated things.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.mapping import map_rows
from .plans import templates
from .plans.templates import Field, Mapping
from .plans.vocabulary import RDFS, SKOS

N = "http://example.org/retail/"
NS = N + "ontology#"
VOCAB = N + "vocab#"
GRAPH = N + "graph/"
STATUS = (("O", "OpenOrder"), ("F", "FilledOrder"), ("P", "PartialOrder"))

_HEAD = f"@prefix ottr: <http://ns.ottr.xyz/0.4/>.\n@prefix rdf: <http://www.w3.org/1999/02/22-rdf-syntax-ns#>.\n@prefix r: <{NS}>.\n"


def _mapping(name: str, text: str, /, **fields: Field) -> Mapping:
    return Mapping(name, tuple(templates.parse(_HEAD + text)), {"?" + k: f for k, f in fields.items()})


RATINGS = _mapping("ratings", "r:Rating [ ottr:IRI ?part, ??price, ??size ] :: { ottr:Triple(?part, r:price, ?price), ottr:Triple(?part, r:size, ?size) } .", part=Field("p_partkey", "iri", N + "part/"), price=Field("p_retailprice", "float", digits=2, required=True), size=Field("p_size", "integer", required=True))
ALIAS = _mapping("alias", "r:Alias [ ottr:IRI ?doc, ??text ] :: { ottr:Triple(?doc, r:alias, ?text) } .", doc=Field("doc_id", "iri", N + "doc/"), text=Field("text"))
CHILD = _mapping(
    "child",
    "r:Line [ ottr:IRI ?line, ottr:IRI ??order, ??quantity, ??number ] :: { ottr:Triple(?line, r:partOf, ?order), ottr:Triple(?line, r:quantity, ?quantity), ottr:Triple(?line, r:lineNumber, ?number) } .",
    line=Field("line_id", "iri", N + "lineitem/"),
    order=Field("l_orderkey", "iri", N + "order/", required=True),
    quantity=Field("quantity", "integer"),
    number=Field("l_linenumber", "integer"),
)
WIDE = _mapping(
    "wide",
    "r:OrderT [ ottr:IRI ?order, ??status, ??year, ??price ] :: { ottr:Triple(?order, rdf:type, r:Order), ottr:Triple(?order, rdf:type, ?status), ottr:Triple(?order, r:year, ?year), ottr:Triple(?order, r:totalPrice, ?price) } .\n"
    "r:PriorityT [ ottr:IRI ?order, ottr:IRI ??priority ] :: { ottr:Triple(?order, r:priority, ?priority) } .",
    order=Field("o_orderkey", "iri", N + "order/"),
    status=Field("o_orderstatus", "class", NS, classes=STATUS),
    year=Field("year", "gYear"),
    price=Field("o_totalprice", "float", digits=2),
    priority=Field("o_orderpriority", "concept", VOCAB),
)
MULTI = _mapping("multi", "r:NameT [ ottr:IRI ?part, ottr:IRI ??words ] :: { ottr:Triple(?part, r:word, ?words) } .", part=Field("p_partkey", "iri", N + "part/"), words=Field("words", "concept", VOCAB, many=True))
CREW = _mapping("crew", "r:CrewT [ ottr:IRI ?part, ottr:IRI ??makers, ottr:IRI ??types ] :: { ottr:Triple(?part, r:madeBy, ?makers), ottr:Triple(?part, r:ofType, ?types) } .", part=Field("p_partkey", "iri", N + "part/"), makers=Field("makers", "iri", N + "brand/", many=True), types=Field("types", "iri", N + "type/", many=True))
CUSTOMER = _mapping("customer", "r:CustomerT [ ottr:IRI ?customer, ??name, ottr:IRI ??segment ] :: { ottr:Triple(?customer, rdf:type, r:Customer), ottr:Triple(?customer, r:name, ?name), ottr:Triple(?customer, r:segment, ?segment) } .", customer=Field("c_custkey", "iri", N + "customer/"), name=Field("c_name"), segment=Field("c_mktsegment", "concept", VOCAB))
PLACED = _mapping("placed", "r:PlacedT [ ottr:IRI ?customer, ottr:IRI ??order ] :: { ottr:Triple(?customer, r:placed, ?order) } .", customer=Field("o_custkey", "iri", N + "customer/"), order=Field("o_orderkey", "iri", N + "order/"))
SOLD = _mapping("sold", "r:SoldT [ ottr:IRI ?part, ottr:IRI ??order ] :: { ottr:Triple(?part, r:soldIn, ?order) } .", part=Field("l_partkey", "iri", N + "part/"), order=Field("l_orderkey", "iri", N + "order/"))

SUBCLASSES = [(NS + c, NS + "Order") for _, c in STATUS] + [(NS + "Order", NS + "Document"), (NS + "Customer", NS + "Agent")]
SUBPROPERTIES = [(NS + "year", NS + "time"), (NS + "lineNumber", NS + "number"), (NS + "quantity", NS + "number"), (NS + "number", NS + "value"), (NS + "time", NS + "value")]
#: The scheme omits one segment, so that there is something to find.
SEGMENTS = ("automobile", "building", "household", "machinery")
ONTOLOGY = [(a, RDFS + "subClassOf", b) for a, b in SUBCLASSES] + [t for s in SEGMENTS for t in ((VOCAB + s, "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", SKOS + "Concept"), (VOCAB + s, SKOS + "inScheme", VOCAB + "SegmentScheme"))]


class Tables:
    """The tables of a folder, and the quads that their mappings make."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def rows(self, name: str) -> DataFrame:
        """A mapping's source, with the columns it adds to its table."""
        if name == "child":
            # the key isn't unique: repeated lines become the same subject
            return self.lineitem.withColumns({"line_id": F.concat_ws("-", "l_orderkey", "l_linenumber"), "quantity": F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity").cast("int"))})
        if name in ("wide", "placed"):
            return self.orders.withColumn("year", F.year("o_orderdate"))
        if name == "multi":
            return self.part.withColumn("words", F.replace("p_name", F.lit(" "), F.lit(" , ")))
        if name == "crew":
            return self.part.withColumns({"makers": F.replace("p_brand", F.lit("#"), F.lit("-")), "types": F.when(F.col("p_partkey") % 5 != 0, F.replace("p_type", F.lit(" "), F.lit(",")))})
        return {"ratings": self.part, "alias": self.documents, "customer": self.customer, "sold": self.lineitem}[name] if name in ("ratings", "alias", "customer", "sold") else None

    def quads(self, *names: str, keep: tuple[str, ...] = ()) -> DataFrame:
        out = None
        for name in names:
            mapping = {m.name: m for m in (RATINGS, ALIAS, CHILD, WIDE, MULTI, CREW, CUSTOMER, PLACED, SOLD)}[name]
            made = map_rows(self.rows(name), mapping, GRAPH + name, *keep)
            out = made if out is None else out.unionByName(made)
        return out

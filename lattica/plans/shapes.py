"""Shapes: an AST, a reader from Turtle, the built-in shapes and their bindings to transforms."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from . import sparql, turtle
from .vocabulary import PIPELINE, RDF, SH


@dataclass(frozen=True)
class PropertyShape:
    path: str
    min_count: int = 0
    datatype: str | None = None
    node_kind: str | None = None
    class_: str | None = None
    severity: str = "Violation"
    message: str = ""


@dataclass(frozen=True)
class QueryConstraint:
    query: sparql.Query
    message: str = ""
    severity: str = "Violation"


@dataclass(frozen=True)
class Shape:
    """``target``: ("class", iri), ("subjects", predicate) or ("objects", predicate). ``node_kind`` and ``class_`` constrain the focus itself."""

    iri: str
    target: tuple[str, str]
    properties: tuple[PropertyShape, ...] = ()
    queries: tuple[QueryConstraint, ...] = ()
    rules: tuple[sparql.Query, ...] = ()
    node_kind: str | None = None
    class_: str | None = None
    severity: str = "Violation"
    message: str = ""


_TARGETS = {SH + "targetClass": "class", SH + "targetSubjectsOf": "subjects", SH + "targetObjectsOf": "objects"}


def read(text: str) -> list[Shape]:
    """The node shapes of a Turtle text; one per target."""
    about: dict[tuple, dict[str, list[tuple]]] = {}
    for s, p, o, _ in turtle.parse(text):
        about.setdefault(s, {}).setdefault(p[1], []).append(o)

    def one(node: tuple, name: str, default=None):
        found = about.get(node, {}).get(SH + name)
        return found[0][1] if found else default

    severity = lambda node: (one(node, "severity") or SH + "Violation").removeprefix(SH)
    kind = lambda node: {SH + "IRI": "iri", SH + "BlankNode": "blank", SH + "Literal": "literal", None: None}[one(node, "nodeKind")]
    out = []
    for node, facts in about.items():
        if ("iri", SH + "NodeShape") not in facts.get(RDF + "type", []):
            continue
        properties = tuple(PropertyShape(one(n, "path"), int(one(n, "minCount", 0)), one(n, "datatype"), kind(n), one(n, "class"), severity(n), one(n, "message", "")) for n in facts.get(SH + "property", []))
        queries = tuple(QueryConstraint(sparql.parse(one(n, "select")), one(n, "message", ""), severity(n)) for n in facts.get(SH + "sparql", []))
        rules = tuple(sparql.parse(one(n, "construct")) for n in facts.get(SH + "rule", []))
        for name, target in _TARGETS.items():
            for o in facts.get(name, []):
                out.append(Shape(node[1], (target, o[1]), properties, queries, rules, kind(node), one(node, "class"), severity(node), one(node, "message", "")))
    return out


def annotated(text: str) -> set[str]:
    """Transforms that a shape text says it applies to."""
    return {o[1] for _, p, o, _ in turtle.parse(text) if p[1] == PIPELINE + "appliesToTransform"}


# Targets, paths, datatypes, classes, least counts and severities that validation must agree on.
# (path, datatype or class, least count, severity); a class is checked together with being an IRI.
_PERSON = (("core:name", "xsd:string", 1, ""), ("core:birthYear", "xsd:gYear", 0, "Warning"), ("core:deathYear", "xsd:gYear", 0, ""))
_TITLE = (
    ("imdb:primaryTitle", "xsd:string", 1, ""),
    ("imdb:originalTitle", "xsd:string", 1, ""),
    ("imdb:isAdult", "xsd:boolean", 0, ""),
    ("imdb:startYear", "xsd:gYear", 0, ""),
    ("imdb:endYear", "xsd:gYear", 0, ""),
    ("imdb:runtimeMinutes", "xsd:integer", 0, ""),
    ("imdb:hasGenre", "skos:Concept", 0, "Warning"),
)
_EPISODE = (("imdb:partOfSeries", "imdb:Title", 1, ""), ("imdb:seasonNumber", "xsd:integer", 1, ""), ("imdb:episodeNumber", "xsd:integer", 1, ""))
_SCHEMES = {"core:hasProfession": "vocab:ProfessionScheme", "imdb:hasGenre": "vocab:GenreScheme"}
_CLASSIC = (8.0, 1000)


def _property(path: str, of: str, least: int, severity: str) -> str:
    typed = of.startswith("xsd:")
    facts = [f"sh:path {path}", f"sh:datatype {of}" if typed else f"sh:nodeKind sh:IRI ; sh:class {of}"]
    facts += [f"sh:minCount {least}"] * bool(least) + [f"sh:severity sh:{severity}"] * bool(severity)
    words = f"{path.partition(':')[2]} is {'a value' if typed else 'a node'} of {of}" + (f", {least} at least" if least else "")
    return f'[ {" ; ".join(facts)} ; sh:message "{words}" ]'


def _query(where: str, message: str) -> str:
    return f'sh:sparql [ a sh:SPARQLConstraint ; sh:select "SELECT $this WHERE {{ {where} }}" ; sh:message "{message}" ]'


def _shape(name: str, target: str, properties: tuple = (), *more: str) -> str:
    facts = [f"imdb:{name} a sh:NodeShape", target]
    facts += ["sh:property " + " , ".join(_property(*p) for p in properties)] if properties else []
    return " ; ".join([*facts, *more]) + " .\n"


DATA_QUALITY = (
    _shape("PersonShape", "sh:targetClass core:Person", _PERSON, _query("$this core:deathYear ?last . $this core:birthYear ?first . FILTER (?last < ?first)", "death comes after birth"))
    + _shape("TitleShape", "sh:targetClass imdb:Title", _TITLE, _query("$this imdb:endYear ?last . FILTER NOT EXISTS { $this imdb:startYear ?first . }", "what has an end has a start"))
    + _shape("EpisodeShape", "sh:targetSubjectsOf imdb:episodeNumber", _EPISODE)
)
VOCAB_SCHEMES = "".join(
    _shape(path.partition(":")[2] + "ValueShape", f"sh:targetObjectsOf {path} ; sh:nodeKind sh:IRI ; sh:class skos:Concept", (), _query(f"FILTER NOT EXISTS {{ $this skos:inScheme {scheme} . }}", f"a value of {path.partition(':')[2]} is in {scheme.partition(':')[2]}"))
    for path, scheme in _SCHEMES.items()
)
RULES = f"""imdb:ClassicTitleRule a sh:NodeShape ; sh:targetClass imdb:Title ; sh:rule [ a sh:SPARQLRule ;
  sh:construct "CONSTRUCT {{ $this rdf:type imdb:ClassicTitle . }} WHERE {{ $this imdb:numVotes ?n . $this imdb:averageRating ?mean . FILTER (?mean >= {_CLASSIC[0]} && ?n >= {_CLASSIC[1]}) }}" ] .
"""

FILES = {"data-quality": DATA_QUALITY, "vocab-schemes": VOCAB_SCHEMES}


@dataclass(frozen=True)
class Bindings:
    """Which shape files apply to a transform: those listed, then those whose annotation names it."""

    listed: Mapping[str, tuple[str, ...]]
    files: Mapping[str, str] = field(default_factory=lambda: FILES)
    discover: bool = True

    def names(self, transform: str) -> list[str]:
        found = [name for name, text in sorted(self.files.items()) if transform in annotated(text)] if self.discover else []
        return list(dict.fromkeys([*self.listed.get(transform, ()), *found]))

    def shapes(self, transform: str) -> list[Shape]:
        return [s for name in self.names(transform) for s in read(self.files[name])]


BINDINGS = Bindings({"name-basics": ("data-quality", "vocab-schemes"), "title-basics": ("data-quality", "vocab-schemes"), "title-episode": ("data-quality",), "title-akas": (), "title-ratings": ()})


def shapes_of(files: Iterable[str]) -> list[Shape]:
    return [s for text in files for s in read(text)]

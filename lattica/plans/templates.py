"""Mapping templates: a reader for the stOTTR part in use, and field bindings.

A template's triples are the single source of what a row becomes; a binding
says which column fills a parameter and how (IRI, typed literal, list). The
mapping operator compiles both to one projection.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from . import vocabulary as v


@dataclass(frozen=True)
class Parameter:
    name: str
    optional: bool = False
    type: str | None = None


@dataclass(frozen=True)
class Template:
    """``triples``: (subject, predicate, object); a name that starts with ``?`` is a parameter, anything else an IRI."""

    iri: str
    parameters: tuple[Parameter, ...]
    triples: tuple[tuple[str, str, str], ...]


_TEMPLATE = re.compile(r"(\S+)\s*\[(.*?)\]\s*::\s*\{(.*?)\}\s*\.", re.S)
_TRIPLE = re.compile(r"ottr:Triple\s*\(\s*([^,\s]+)\s*,\s*([^,\s]+)\s*,\s*([^)\s]+)\s*\)")


def parse(text: str) -> list[Template]:
    prefixes = {m[1]: m[2] for m in re.finditer(r"@prefix\s+([\w-]*):\s*<([^>]*)>\s*\.", text)}

    def name(token: str) -> str:
        if token.startswith("?"):
            return token
        if token.startswith("<"):
            return token[1:-1]
        prefix, _, local = token.partition(":")
        if prefix not in prefixes:
            raise ValueError(f"unknown prefix in {token!r}")
        return prefixes[prefix] + local

    out = []
    body = re.sub(r"@prefix[^\n]*", "", text)
    for head, parameters, triples in _TEMPLATE.findall(body):
        found = []
        for part in filter(None, (x.strip() for x in parameters.split(","))):
            *types, variable = part.split()
            found.append(Parameter("?" + variable.lstrip("?"), variable.startswith("??"), types[0] if types else None))
        made = tuple(tuple(map(name, t)) for t in _TRIPLE.findall(triples))
        known = {p.name for p in found}
        unknown = {x for t in made for x in t if x.startswith("?")} - known
        if unknown:
            raise ValueError(f"{head}: {sorted(unknown)} aren't parameters")
        out.append(Template(name(head), tuple(found), made))
    if not out:
        raise ValueError("no template found")
    return out


def catalog(templates: list[Template]) -> dict:
    """Names, parameters and triple counts, as the side-car file lists them."""
    rows = [{"iri": t.iri, "parameters": [p.name.lstrip("?") for p in t.parameters], "triples": len(t.triples)} for t in sorted(templates, key=lambda t: t.iri)]
    return {"template_count": len(rows), "templates": rows}


@dataclass(frozen=True)
class Field:
    """What fills a parameter. ``kind``: iri, concept, class, string, integer, float, gYear, boolean. ``many``: a list field split at ``separator``, one triple an item. ``digits``: of a float, after the point."""

    column: str
    kind: str = "string"
    namespace: str = ""
    many: bool = False
    separators: str = "_ "
    required: bool = False
    separator: str = ","
    digits: int | None = None
    classes: tuple[tuple[str, str], ...] = tuple(v.TITLE_CLASSES.items())


@dataclass(frozen=True)
class Mapping:
    """A source's templates and bindings, in the order in which its quads are listed."""

    name: str
    templates: tuple[Template, ...]
    fields: dict[str, Field] = field(default_factory=dict)


_TITLE, _PERSON = v.ENTITY + "title/", v.ENTITY + "person/"
_FIELDS = {
    "title-ratings": {"tconst": Field("tconst", "iri", _TITLE), "averageRating": Field("averageRating", "float", required=True), "numVotes": Field("numVotes", "integer", required=True)},
    "title-akas": {"titleId": Field("titleId", "iri", _TITLE), "title": Field("title")},
    "title-episode": {"tconst": Field("tconst", "iri", _TITLE), "parentTconst": Field("parentTconst", "iri", _TITLE, required=True), "seasonNumber": Field("seasonNumber", "integer"), "episodeNumber": Field("episodeNumber", "integer")},
    "title-basics": {
        "tconst": Field("tconst", "iri", _TITLE),
        "titleType": Field("titleType", "class", v.IMDB),
        "primaryTitle": Field("primaryTitle"),
        "originalTitle": Field("originalTitle"),
        "isAdult": Field("isAdult", "boolean"),
        "startYear": Field("startYear", "gYear"),
        "endYear": Field("endYear", "gYear"),
        "runtimeMinutes": Field("runtimeMinutes", "integer"),
        "genres": Field("genres", "concept", v.VOCAB, many=True),
    },
    "name-basics": {
        "nconst": Field("nconst", "iri", _PERSON),
        "primaryName": Field("primaryName"),
        "birthYear": Field("birthYear", "gYear"),
        "deathYear": Field("deathYear", "gYear"),
        "primaryProfession": Field("primaryProfession", "concept", v.VOCAB, many=True),
        "knownForTitles": Field("knownForTitles", "iri", _TITLE, many=True),
    },
    "title-crew": {"tconst": Field("tconst", "iri", _TITLE), "directors": Field("directors", "iri", _PERSON, many=True), "writers": Field("writers", "iri", _PERSON, many=True)},
}


# The predicate of each column, and the class of what a file describes. A list column is a template of its own.
_PREFIXES = {"ottr": "http://ns.ottr.xyz/0.4/", "rdf": v.RDF, "imdb": v.IMDB, "core": v.CORE}
_CLASSES = {"title-basics": "imdb:Title", "name-basics": "core:Person"}
_PREDICATES = {
    "title-ratings": {"averageRating": "imdb:averageRating", "numVotes": "imdb:numVotes"},
    "title-akas": {"title": "imdb:alternateTitle"},
    "title-episode": {"parentTconst": "imdb:partOfSeries", "seasonNumber": "imdb:seasonNumber", "episodeNumber": "imdb:episodeNumber"},
    "title-basics": {
        "titleType": "rdf:type",
        "primaryTitle": "imdb:primaryTitle",
        "originalTitle": "imdb:originalTitle",
        "isAdult": "imdb:isAdult",
        "startYear": "imdb:startYear",
        "endYear": "imdb:endYear",
        "runtimeMinutes": "imdb:runtimeMinutes",
        "genres": "imdb:hasGenre",
    },
    "name-basics": {
        "primaryName": "core:name",
        "birthYear": "core:birthYear",
        "deathYear": "core:deathYear",
        "primaryProfession": "core:hasProfession",
        "knownForTitles": "imdb:knownForTitle",
    },
    # an extension: the crew file, which declares its two properties but has no published mapping
    "title-crew": {"directors": "imdb:directedBy", "writers": "imdb:writtenBy"},
}


def text(name: str) -> str:
    """A built-in mapping's templates in stOTTR, written from its fields and predicates."""
    fields, predicates = _FIELDS[name], _PREDICATES[name]
    subject = next(iter(fields))
    single = [c for c in predicates if not fields[c].many]
    groups = [single] * bool(single) + [[c] for c in predicates if fields[c].many]

    def template(columns: list[str], first: bool) -> str:
        kinds = ["ottr:IRI " * (fields[c].kind in ("iri", "concept")) + "??" + c for c in columns]
        triples = [("rdf:type", _CLASSES[name])] if first and name in _CLASSES else []
        triples += [(predicates[c], "?" + c) for c in columns]
        body = ", ".join(f"ottr:Triple(?{subject}, {p}, {o})" for p, o in triples)
        label = "".join(x.capitalize() for x in name.split("-")) + ("" if first else columns[0][0].upper() + columns[0][1:])
        return f"imdb:{label}Template [ ottr:IRI ?{subject}, {', '.join(kinds)} ] :: {{ {body} }} ."

    head = [f"@prefix {k}: <{iri}>." for k, iri in _PREFIXES.items()]
    return "\n".join(head + [template(columns, i == 0) for i, columns in enumerate(groups)])


TEXTS = {name: text(name) for name in _FIELDS}


def builtin(name: str) -> Mapping:
    if name not in TEXTS:
        raise KeyError(f"no mapping named {name!r}; there are {sorted(TEXTS)}")
    return Mapping(name, tuple(parse(TEXTS[name])), {"?" + k: f for k, f in _FIELDS[name].items()})

"""Namespaces, classes, properties and controlled vocabularies of the film domain."""

from __future__ import annotations

# These must equal the published data's for right results.
BASE = "http://example.org/"
CORE = BASE + "ontology/core#"
IMDB = BASE + "ontology/domain/imdb#"
VOCAB = BASE + "ontology/domain/imdb/vocab#"
ENTITY = BASE + "imdb/"
PIPELINE = BASE + "ontology/platform/pipeline#"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
PROV = "http://www.w3.org/ns/prov#"
SH = "http://www.w3.org/ns/shacl#"
SCHEMA = "http://schema.org/"

PREFIXES = {"core": CORE, "imdb": IMDB, "vocab": VOCAB, "pipeline": PIPELINE, "rdf": RDF, "rdfs": RDFS, "owl": OWL, "xsd": XSD, "skos": SKOS, "prov": PROV, "sh": SH, "schema": SCHEMA}

# Title types of the source and their classes.
TITLE_CLASSES = {
    "movie": "Movie",
    "short": "Short",
    "tvEpisode": "TVEpisode",
    "tvMiniSeries": "TVMiniSeries",
    "tvMovie": "TVMovie",
    "tvPilot": "TVPilot",
    "tvSeries": "TVSeries",
    "tvShort": "TVShort",
    "tvSpecial": "TVSpecial",
    "video": "Video",
    "videoGame": "VideoGame",
}

# The schema.org class beside each title class.
SCHEMA_CLASSES = {
    "Movie": "Movie",
    "Short": "Movie",
    "TVEpisode": "TVEpisode",
    "TVMiniSeries": "TVSeries",
    "TVMovie": "Movie",
    "TVPilot": "TVEpisode",
    "TVSeries": "TVSeries",
    "TVShort": "Movie",
    "TVSpecial": "TVEpisode",
    "Video": "VideoObject",
    "VideoGame": "VideoGame",
}

#: Classes that only rules derive.
INFERRED_CLASSES = ("ClassicTitle", "CrossoverTitle")

# Concepts of the two schemes.
GENRES = tuple("action adult adventure animation biography comedy crime documentary drama family fantasy film-noir game-show history horror music musical mystery news reality-tv romance sci-fi short sport talk-show thriller war western".split())
PROFESSIONS = tuple(
    "accountant actor actress animation_department archive_footage archive_sound art_department art_director assistant assistant_director camera_department casting_department casting_director choreographer cinematographer composer costume_department costume_designer director editor editorial_department electrical_department executive legal location_management make_up_department manager miscellaneous music_artist music_department podcaster producer production_department production_designer production_manager publicist script_department set_decorator sound_department soundtrack special_effects stunts talent_agent transportation_department visual_effects writer".split()
)

# Property, its superproperty, domain and range (empty: none).
PROPERTIES = (
    (CORE + "name", SCHEMA + "name", CORE + "Person", XSD + "string"),
    (CORE + "hasProfession", SCHEMA + "hasOccupation", CORE + "Person", SKOS + "Concept"),
    (CORE + "year", "", "", XSD + "gYear"),
    (CORE + "startYear", CORE + "year", "", XSD + "gYear"),
    (CORE + "endYear", CORE + "year", "", XSD + "gYear"),
    (CORE + "birthYear", CORE + "startYear", CORE + "Person", XSD + "gYear"),
    (CORE + "deathYear", CORE + "endYear", CORE + "Person", XSD + "gYear"),
    (IMDB + "knownForTitle", SCHEMA + "knowsAbout", CORE + "Person", IMDB + "Title"),
    (IMDB + "primaryTitle", SCHEMA + "name", IMDB + "Title", XSD + "string"),
    (IMDB + "originalTitle", SCHEMA + "name", IMDB + "Title", XSD + "string"),
    (IMDB + "alternateTitle", SCHEMA + "alternateName", IMDB + "Title", XSD + "string"),
    (IMDB + "isAdult", "", IMDB + "Title", XSD + "boolean"),
    (IMDB + "startYear", CORE + "startYear", IMDB + "Title", XSD + "gYear"),
    (IMDB + "endYear", CORE + "endYear", IMDB + "Title", XSD + "gYear"),
    (IMDB + "runtimeMinutes", SCHEMA + "duration", IMDB + "Title", XSD + "integer"),
    (IMDB + "numVotes", SCHEMA + "ratingCount", IMDB + "Title", XSD + "integer"),
    (IMDB + "averageRating", SCHEMA + "ratingValue", IMDB + "Title", XSD + "float"),
    (IMDB + "releasedInRegion", SCHEMA + "locationCreated", IMDB + "Title", SCHEMA + "Country"),
    (IMDB + "hasGenre", SCHEMA + "genre", IMDB + "Title", SKOS + "Concept"),
    (IMDB + "episodeNumber", SCHEMA + "episodeNumber", IMDB + "TVEpisode", XSD + "integer"),
    (IMDB + "seasonNumber", SCHEMA + "seasonNumber", IMDB + "TVEpisode", XSD + "integer"),
    (IMDB + "partOfSeries", SCHEMA + "partOfSeries", IMDB + "TVEpisode", IMDB + "TVSeries"),
    (IMDB + "hasEpisode", SCHEMA + "episode", "", ""),
    (IMDB + "directedBy", SCHEMA + "director", IMDB + "Title", CORE + "Person"),
    (IMDB + "writtenBy", SCHEMA + "writer", IMDB + "Title", CORE + "Person"),
    (IMDB + "coActorWith", "", CORE + "Person", CORE + "Person"),
    (IMDB + "workedOnGenre", "", CORE + "Person", SKOS + "Concept"),
)
INVERSES = ((IMDB + "hasEpisode", IMDB + "partOfSeries"),)
SYMMETRIC = (IMDB + "coActorWith",)


def subclass_edges() -> list[tuple[str, str]]:
    """(class, direct superclass)."""
    edges = [(CORE + "CreativeWork", SCHEMA + "CreativeWork"), (CORE + "Person", SCHEMA + "Person"), (IMDB + "Title", CORE + "CreativeWork")]
    for name, other in SCHEMA_CLASSES.items():
        edges += [(IMDB + name, IMDB + "Title"), (IMDB + name, SCHEMA + other)]
    return edges + [(IMDB + name, IMDB + "Title") for name in INFERRED_CLASSES]


def subproperty_edges() -> list[tuple[str, str]]:
    return [(p, over) for p, over, _, _ in PROPERTIES if over]


def concept_rows() -> list[tuple[str, str, str]]:
    """(concept, label, scheme)."""
    label = lambda name: name.replace("_", " ").replace("-", " ").title()
    return [(VOCAB + g, label(g), VOCAB + "GenreScheme") for g in GENRES] + [(VOCAB + p, label(p), VOCAB + "ProfessionScheme") for p in PROFESSIONS]


def ontology_triples() -> list[tuple[str, str, str]]:
    """Classes, properties and concepts as IRI triples."""
    out = [(c, RDFS + "subClassOf", s) for c, s in subclass_edges()] + [(p, RDFS + "subPropertyOf", s) for p, s in subproperty_edges()]
    for p, _, domain, range_ in PROPERTIES:
        out += [(p, RDFS + "domain", domain)] * bool(domain) + [(p, RDFS + "range", range_)] * bool(range_)
    out += [(a, OWL + "inverseOf", b) for a, b in INVERSES] + [(p, RDF + "type", OWL + "SymmetricProperty") for p in SYMMETRIC]
    for c, _, scheme in concept_rows():
        out += [(c, RDF + "type", SKOS + "Concept"), (c, SKOS + "inScheme", scheme)]
    return out

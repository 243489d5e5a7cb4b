"""Columns that build IRIs and names. A null part gives a null term, never the text "None"."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans import vocabulary as v

ZONES = ("work", "asserted", "quarantine", "reports")


def entity_iri(namespace: str, *parts: Column | str) -> Column:
    """``namespace`` followed by the parts; nothing is percent-encoded."""
    return F.concat(F.lit(namespace), *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def title_iri(tconst: Column) -> Column:
    return entity_iri(v.ENTITY + "title/", tconst)


def person_iri(nconst: Column) -> Column:
    return entity_iri(v.ENTITY + "person/", nconst)


def class_iri(value: Column, classes: Mapping[str, str], namespace: str = v.IMDB, strict: bool = False) -> Column:
    """The class of a type name: null for an unknown one, or an error if ``strict``."""
    table = F.create_map(*[F.lit(x) for k, c in classes.items() for x in (k, namespace + c)])
    found = F.try_element_at(table, value)
    return F.when(value.isNull(), F.lit(None)).otherwise(F.coalesce(found, F.raise_error(F.concat(F.lit("unknown type: "), value)))) if strict else found


def slug(label: Column, separators: str = "_ ") -> Column:
    """Trimmed, lower-cased, ``separators`` to hyphens. Vocabularies that keep underscores bind ``separators=" "``."""
    return F.translate(F.lower(F.trim(label)), separators, "-" * len(separators))


def concept_iri(label: Column, namespace: str = v.VOCAB, separators: str = "_ ") -> Column:
    return F.concat(F.lit(namespace), slug(label, separators))


def tsv_stem(name: Column) -> Column:
    """Without ``.gz``, then without ``.tsv``."""
    return F.regexp_replace(F.regexp_replace(name, r"\.gz$", ""), r"\.tsv$", "")


def graph_iri(zone: Column | str, source: Column | str, batch: Column | str, name: Column) -> Column:
    return F.concat_ws("/", F.lit(v.BASE + "graph"), *[F.lit(x) if isinstance(x, str) else x for x in (zone, source, batch)], tsv_stem(name))


def fragment_slug(text: Column) -> Column:
    """Letters, digits and ``._-`` stay, all else becomes a hyphen; no hyphen at either end; 80 characters; never empty."""
    clean = F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\p{N}._-]", "-"), r"^-+|-+$", "")
    return F.coalesce(F.nullif(F.substring(clean, 1, 80), F.lit("")), F.lit("artifact"))


def compact(line: Column) -> Column:
    """Absolute instance IRIs relative to the base, as the TriG writer shows them."""
    for part in ("activities/", "agents/", "graph/", "data/"):
        line = F.replace(line, F.lit(f"<{v.BASE}{part}"), F.lit(f"<{part}"))
    return line

"""Rows to quads: a mapping compiled to one projection and one explode.

Every triple of every template is a struct of an array, dropped where an argument
isn't set; list fields add a transformed array. One pass over the source, no
shuffle, no row loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import terms, text
from ..plans import vocabulary as v
from ..plans.templates import Field, Mapping

_LITERALS = {"string": "string", "integer": "integer", "float": "float", "gYear": "gYear", "boolean": "boolean"}


def _value(field: Field, c: Column, strict: bool) -> Column:
    """The lexical form or IRI of a single value; null where it isn't set or can't be read."""
    if field.kind == "iri":
        made = F.concat(F.lit(field.namespace), c)
    elif field.kind == "concept":
        made = terms.concept_iri(c, field.namespace, field.separators)
    elif field.kind == "class":
        made = terms.class_iri(c, dict(field.classes), field.namespace, strict)
    elif field.kind in ("integer", "gYear"):
        made = text.integer_text(c)
    elif field.kind == "float":
        made = text.float_text(c, field.digits)
    elif field.kind == "boolean":
        made = text.flag(c)
    else:
        made = c
    set_ = F.when(text.is_set(c), made)
    return F.coalesce(set_, F.raise_error(F.lit(f"{field.column} isn't set"))) if strict and field.required else set_


def _struct(s: Column, p: Column, o: Column, datatype: str | None) -> Column:
    return F.struct(s.alias("s"), p.alias("p"), o.alias("o"), F.lit("literal" if datatype else "iri").alias("o_kind"), F.lit(datatype).cast("string").alias("o_dt"))


def map_rows(rows: DataFrame, mapping: Mapping, graph: Column | str, *keep: str, strict: bool = False) -> DataFrame:
    """Quads of ``rows`` in graph ``graph``, with the bookkeeping columns ``keep`` of their row.

    A triple without one of its arguments is dropped; ``strict`` raises where a
    required field isn't set or a type is unknown. Each field in use is made
    once, in a projection below the explode: inlined into every triple, the
    generated method outgrows what the JVM compiles and runs interpreted.
    """
    g = F.lit(graph) if isinstance(graph, str) else graph
    made: dict[str, Column] = {}

    def term(token: str) -> Column:
        if not token.startswith("?"):
            return F.lit(token)
        field = mapping.fields[token]
        made.setdefault(f"_{token[1:]}", _value(field, F.col(field.column).cast("string"), strict))
        return F.col(f"_{token[1:]}")

    def items(s: str, p: str, o: str, field: Field, datatype: str | None) -> Column:
        made.setdefault(f"_{o[1:]}", text.split_clean(F.col(field.column).cast("string"), field.separator))
        subject, predicate = term(s), term(p)
        return F.transform(F.col(f"_{o[1:]}"), lambda x: _struct(subject, predicate, _value(field, x, strict), datatype))

    single, lists = [], []
    for s, p, o in (x for t in mapping.templates for x in t.triples):
        field = mapping.fields.get(o)
        datatype = v.XSD + _LITERALS[field.kind] if field is not None and field.kind in _LITERALS else None
        if field is not None and field.many:
            lists.append(items(s, p, o, field, datatype))
        else:
            single.append(_struct(term(s), term(p), term(o), datatype))
    all_ = F.concat(F.array(*single), *lists) if single and lists else F.array(*single) if single else F.concat(*lists)
    flat = rows.select(*keep, g.alias("g"), *[c.alias(n) for n, c in made.items()])
    whole = F.col("t.s").isNotNull() & F.col("t.p").isNotNull() & F.col("t.o").isNotNull()
    return flat.select(*keep, "g", F.explode(all_).alias("t")).where(whole).select("t.*", "g", *keep)


def dropped(rows: DataFrame, mapping: Mapping) -> DataFrame:
    """How many rows lack each required field: (field, dropped_null)."""
    required = [f for f in mapping.fields.values() if f.required]
    if not required:
        return rows.sparkSession.createDataFrame([], "field string, dropped_null long")
    lacking = F.explode(F.array(*[F.struct(F.lit(f.column).alias("field"), _value(f, F.col(f.column).cast("string"), False).isNull().cast("long").alias("n")) for f in required]))
    return rows.select(lacking.alias("x")).groupBy("x.field").agg(F.sum("x.n").alias("dropped_null"))


def rejected_types(rows: DataFrame, mapping: Mapping) -> DataFrame:
    """Rows whose type name is unknown, for a lenient run to set aside."""
    named = [f for f in mapping.fields.values() if f.kind == "class"]
    bad = F.lit(False)
    for f in named:
        bad = bad | (text.is_set(F.col(f.column)) & _value(f, F.col(f.column), False).isNull())
    return rows.where(bad)


def losses(rows: DataFrame, mapping: Mapping) -> dict[str, dict[str, int]]:
    """What a lenient run leaves out, from one aggregation: rows that lack each required field, and rows whose type name is unknown, by field."""
    value = lambda f: _value(f, F.col(f.column).cast("string"), False)
    lacking = {f.column: value(f).isNull() for f in mapping.fields.values() if f.required}
    unknown = {f.column: text.is_set(F.col(f.column)) & value(f).isNull() for f in mapping.fields.values() if f.kind == "class"}
    counted = [("dropped_null", c, bad) for c, bad in lacking.items()] + [("unknown_type", c, bad) for c, bad in unknown.items()]
    out: dict[str, dict[str, int]] = {"dropped_null": {}, "unknown_type": {}}
    if counted:
        found = rows.agg(*[F.count_if(bad).alias(f"n{i}") for i, (_, _, bad) in enumerate(counted)]).first()
        for (kind, column, _), n in zip(counted, found, strict=True):
            out[kind][column] = n
    return out

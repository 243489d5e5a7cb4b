"""Null model, list fields, lexical forms, and the N-Quads line format, all as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.vocabulary import XSD

NULL = "\\N"


def is_set(c: Column) -> Column:
    """Not null, not blank, not the null mark."""
    return c.isNotNull() & ~F.trim(c).isin("", NULL)


def split_clean(c: Column, separator: str = ",") -> Column:
    """The trimmed non-empty items of a list field, in order, repeats included; none if the field isn't set."""
    items = F.filter(F.transform(F.split(c, separator), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(is_set(c), items).otherwise(F.array().cast("array<string>"))


def flag(c: Column) -> Column:
    """"1" is true, any other set value false."""
    return F.when(c.cast("string") == "1", F.lit("true")).otherwise(F.lit("false"))


def integer_text(c: Column) -> Column:
    return c.try_cast("bigint").cast("string")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once; it is also kept out of the generated method, which a rare case mustn't swell."""
    return F.transform(F.array(value), body)[0]


def _without_exponent(raw: Column) -> Column:
    """A double's text as Spark writes it, one figure before the point and an exponent, as a plain decimal."""
    sign, power = F.regexp_extract(raw, "^-", 0), F.regexp_extract(raw, r"E(-?\d+)$", 1).try_cast("int")
    figures = F.regexp_replace(F.regexp_replace(raw, r"^-|E.*$", ""), r"\.(0$)?", "")
    large = F.concat(F.rpad(figures, F.greatest(power + 1, F.length(figures)), "0"))
    split = F.concat(F.substring(large, F.lit(1), power + 1), F.lit("."), F.when(F.length(large) > power + 1, F.substring(large, power + 2, F.length(large))).otherwise("0"))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), figures)
    return F.concat(sign, F.when(power >= 0, split).otherwise(small))


def float_text(c: Column, digits: int | None = None) -> Column:
    """A decimal without exponent, of any size. ``digits``: with that many after the point, else as few as the value needs (one at least); not a number and infinity as the datatype writes them."""
    d = c.try_cast("double")
    raw = d.cast("string")
    special = F.when(raw == "Infinity", "INF").when(raw == "-Infinity", "-INF").when(raw.contains("E"), let(raw, _without_exponent)).otherwise(raw)
    return special if digits is None else F.coalesce(d.try_cast(f"decimal(38,{digits})").cast("string"), special)


# In this order: the backslash first, or it would escape the escapes.
_ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))


def escape(c: Column) -> Column:
    for plain, escaped in _ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


_HEX = "[0-9A-Fa-f]"
#: A numbered character as the standard lets it be written: no half of a surrogate pair alone, none beyond the last.
_NUMBERED = rf"u(?:(?![dD][89A-Fa-f]){_HEX}{{4}}|[dD][89ABab]{_HEX}{{2}}\\u[dD][C-Fc-f]{_HEX}{{2}})|U00(?:00(?![dD][89A-Fa-f]){_HEX}{{4}}|0[1-9A-Fa-f]{_HEX}{{4}}|10{_HEX}{{4}})"
_PIECES = rf"(?:\\u{_HEX}{{4}})++|\\U{_HEX}{{8}}|\\.|[^\\]++"
_MARKS = {"\\t": "\t", "\\b": "\b", "\\n": "\n", "\\r": "\r", "\\f": "\f", '\\"': '"', "\\'": "'", "\\\\": "\\"}


def _piece(x: Column) -> Column:
    said = F.when(x.startswith("\\u"), F.decode(F.unhex(F.replace(x, F.lit("\\u"), F.lit(""))), "UTF-16BE"))
    said = said.when(x.startswith("\\U"), F.decode(F.unhex(F.substring(x, 3, 8)), "UTF-32"))
    for written, meant in _MARKS.items():
        said = said.when(x == written, F.lit(meant))
    return said.otherwise(x)


def unescape(c: Column) -> Column:
    """What a term stands for: its escapes read from left to right. Only well-formed escapes may be given."""
    return F.when(c.contains("\\"), F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_PIECES), F.lit(0)), _piece), "")).otherwise(c)


def node(c: Column) -> Column:
    """An IRI in its brackets, or a blank node as it is (``_:`` begins no IRI)."""
    return F.when(c.startswith("_:"), c).otherwise(F.concat(F.lit("<"), c, F.lit(">")))


def term(lexical: Column, kind: Column, datatype: Column) -> Column:
    typed = F.when(datatype.startswith("@"), datatype).otherwise(F.concat(F.lit("^^<"), datatype, F.lit(">")))
    return F.when(kind == "literal", F.concat(F.lit('"'), escape(lexical), F.lit('"'), typed)).otherwise(node(lexical))


def nquad_line(s: Column, p: Column, o: Column, kind: Column, datatype: Column, g: Column) -> Column:
    """A quad as a line; without its graph where ``g`` is null (the default graph)."""
    graph = F.coalesce(F.concat(node(g), F.lit(" ")), F.lit(""))
    return F.concat(node(s), F.lit(" "), node(p), F.lit(" "), term(o, kind, datatype), F.lit(" "), graph, F.lit("."))


# Possessive groups: a long literal must neither backtrack nor recurse.
_IRI = rf"<([^>\\\x00-\x20]*+(?:\\(?:{_NUMBERED})[^>\\\x00-\x20]*+)*+)>"
_BLANK = r"(_:[\w\u00B7.\-:]*[\w\u00B7\-:])"
_LITERAL = rf"""("[^"\\\n\r]*+(?:\\(?:[tbnrf"'\\]|{_NUMBERED})[^"\\\n\r]*+)*+")(?:\^\^{_IRI}|(@[A-Za-z]++(?:-[A-Za-z0-9]++)*+))?"""
_SPACE = r"[ \t]*+"
#: Groups: subject IRI, subject blank node, predicate, object IRI, object blank node, literal in its quotes, datatype, language, graph IRI, graph blank node.
NQUAD = rf"(?U)^{_SPACE}(?:{_IRI}|{_BLANK}){_SPACE}{_IRI}{_SPACE}(?:{_IRI}|{_BLANK}|{_LITERAL}){_SPACE}(?:{_IRI}|{_BLANK})?{_SPACE}\.{_SPACE}(?:#.*)?$"
_GROUPS = 10


def parse_nquad(line: Column) -> Column:
    """An array with one struct (s, p, o, o_kind, o_dt, g, ok), or none for a blank line or a comment.

    ``ok`` is false, and all else null, for a line that can't be read. The
    pattern runs once a line: it is replaced by its groups, one to a line. A
    language stands in ``o_dt`` with its @, in lower case, as languages compare;
    a literal with neither is an xsd:string; a blank node's ``o_kind`` is blank.
    """
    text = F.regexp_replace(line, r"[\r\n]+$", "")
    groups = F.when(text.rlike(r"[\r\n]"), F.array(F.lit(""))).otherwise(F.split(F.regexp_replace(text, NQUAD, "\n".join(f"${i}" for i in range(1, _GROUPS + 1))), "\n", -1))

    def quad(f: Column) -> Column:
        part = lambda i: F.when(F.size(f) == _GROUPS, F.nullif(F.get(f, F.lit(i - 1)), F.lit("")))
        iri = lambda i: unescape(part(i))
        written = part(6)
        return F.struct(
            F.coalesce(iri(1), part(2)).alias("s"),
            iri(3).alias("p"),
            F.coalesce(unescape(F.substring(written, F.lit(2), F.length(written) - 2)), iri(4), part(5)).alias("o"),
            F.when(written.isNotNull(), "literal").when(part(5).isNotNull(), "blank").when(F.size(f) == _GROUPS, "iri").alias("o_kind"),
            F.when(written.isNotNull(), F.coalesce(iri(7), F.lower(part(8)), F.lit(XSD + "string"))).alias("o_dt"),
            F.coalesce(iri(9), part(10)).alias("g"),
            (F.size(f) == _GROUPS).alias("ok"),
        )

    return F.when(~text.rlike(r"^\s*+(#.*)?$"), F.transform(F.array(groups), quad))


#: What a datatype's lexical form looks like; a datatype that isn't listed takes any.
LEXICAL = {
    XSD + "boolean": r"^(true|false|1|0)$",
    XSD + "integer": r"^[+-]?\d+$",
    XSD + "float": r"^([+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|[+-]?INF|NaN)$",
    XSD + "gYear": r"^-?(\d{4}|[1-9]\d{4,})(Z|[+-]\d\d:\d\d)?$",
}


def well_typed(lexical: Column, datatype: str) -> Column:
    return lexical.rlike(LEXICAL[datatype]) if datatype in LEXICAL else F.lit(True)

"""Graph patterns as joins.

A pattern is a filtered projection of the quads (the predicate reaches the
scan), patterns that share variables are joined on them, NOT EXISTS is an
anti-join, a filter a predicate. Catalyst orders and picks the joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.sparql import Group, Pattern, Query
from ..plans.vocabulary import XSD
from .quads import subject_kind

_NUMERIC = tuple(XSD + t for t in ("integer", "decimal", "float", "double"))


def _scan(quads: DataFrame, p: Pattern) -> DataFrame:
    rows = quads.where(F.col("p") == p.p)
    out: list[Column] = []
    if isinstance(p.s, tuple):
        rows = rows.where(F.col("s") == p.s[1])
    else:
        out += [F.col("s").alias(p.s), subject_kind(F.col("s")).alias(p.s + ".kind"), F.lit(None).cast("string").alias(p.s + ".dt")]
    if isinstance(p.o, tuple):
        rows = rows.where((F.col("o") == p.o[1]) & (F.col("o_kind") == p.o[0]))
        if p.o[0] == "literal":
            rows = rows.where(F.col("o_dt") == p.o[2])
    elif p.o == p.s:
        rows = rows.where((F.col("s") == F.col("o")) & (F.col("o_kind") != "literal"))
    else:
        out += [F.col("o").alias(p.o), F.col("o_kind").alias(p.o + ".kind"), F.col("o_dt").alias(p.o + ".dt")]
    return rows.select(*out or [F.lit(1).alias("_")]).distinct()


def _variables(df: DataFrame) -> set[str]:
    return {c for c in df.columns if c.startswith("?") and "." not in c}


def _join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    shared = sorted(_variables(a) & _variables(b))
    if not shared:
        raise ValueError("patterns must share a variable")
    q = lambda df, c: df[f"`{c}`"]
    b = b.select(*[F.col(f"`{c}`").alias("_b" + c) if c.split(".")[0] in shared else F.col(f"`{c}`") for c in b.columns])
    # a term is its lexical form, its kind and its datatype
    on = [(q(a, c) == q(b, "_b" + c)) & (q(a, c + ".kind") == q(b, "_b" + c + ".kind")) & q(a, c + ".dt").eqNullSafe(q(b, "_b" + c + ".dt")) for c in shared]
    joined = a.join(b, on, how)
    return joined if how != "inner" else joined.select(*[F.col(f"`{c}`") for c in joined.columns if not c.startswith("_b")])


def _operand(t, number: bool) -> Column:
    if isinstance(t, tuple):
        return F.lit(float(t[1])) if number else F.lit(t[1])
    value = F.col(f"`{t}`")
    if not number:
        return value
    typed = F.col(f"`{t}.dt`")
    return F.when(typed.isin(*_NUMERIC), value.try_cast("double")).when(typed == XSD + "gYear", value.try_cast("int").cast("double"))


def _condition(e) -> Column:
    """Comparisons are of numbers (years count as such) and false for what isn't one; = and != of anything else compare terms."""
    if e[0] in ("&&", "||"):
        a, b = _condition(e[1]), _condition(e[2])
        return a & b if e[0] == "&&" else a | b
    if e[0] == "!":
        return ~_condition(e[1])
    number = e[0] not in ("=", "!=") or any(isinstance(t, tuple) and t[0] == "literal" and t[2] in _NUMERIC for t in e[1:])
    a, b = (_operand(t, number) for t in e[1:])
    made = {"<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b, "=": a == b, "!=": a != b}[e[0]]
    return F.coalesce(made, F.lit(False))


def solve(quads: DataFrame, group: Group, focus: DataFrame | None = None) -> DataFrame:
    """Solutions of a group: columns ``?x``, with ``?x.kind`` and ``?x.dt``. ``focus``: a column s (and part columns) to which ``?this`` is bound beforehand; it drives the plan where no pattern does."""
    now = None
    if focus is not None:
        now = focus.select(F.col("s").alias("?this"), subject_kind(F.col("s")).alias("?this.kind"), F.lit(None).cast("string").alias("?this.dt"), *[c for c in focus.columns if c != "s"]).distinct()
    rest = list(group.patterns)
    while rest:
        k = next((i for i, p in enumerate(rest) if now is None or _variables(now) & {x for x in (p.s, p.o) if isinstance(x, str)}), None)
        if k is None:
            raise ValueError("patterns must be connected")
        found = _scan(quads, rest.pop(k))
        now = found if now is None else _join(now, found)
    if now is None:
        raise ValueError("a group needs a pattern or a focus")
    for e in group.filters:
        now = now.where(_condition(e))
    for inner in group.absent:
        now = _join(now, solve(quads, inner), "left_anti")
    return now


def select(quads: DataFrame, query: Query, focus: DataFrame | None = None) -> DataFrame:
    """The chosen variables of each solution, as columns without question marks."""
    found = solve(quads, query.where, focus)
    return found.select(*[F.col(f"`{x}`").alias(x[1:]) for x in query.select]).distinct()


def construct(quads: DataFrame, query: Query, graph: str, focus: DataFrame | None = None) -> DataFrame:
    """The distinct quads that a CONSTRUCT makes, in ``graph``; ``focus`` (focus): the nodes that ``$this`` may be."""
    found = solve(quads, query.where)
    if focus is not None:
        found = found.join(focus, F.col("`?this`") == F.col("focus"), "left_semi")

    def term(t) -> tuple[Column, Column, Column]:
        if isinstance(t, tuple):
            return F.lit(t[1]), F.lit(t[0]), F.lit(t[2] if t[0] == "literal" else None).cast("string")
        return F.col(f"`{t}`"), F.col(f"`{t}.kind`"), F.col(f"`{t}.dt`")

    made = [F.struct(term(t.s)[0].alias("s"), F.lit(t.p).alias("p"), term(t.o)[0].alias("o"), term(t.o)[1].alias("o_kind"), term(t.o)[2].alias("o_dt"), F.lit(graph).alias("g")) for t in query.construct]
    return found.select(F.explode(F.array(*made)).alias("q")).select("q.*").distinct()

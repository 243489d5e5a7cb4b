"""Secret spans: fixed patterns, and sliding-window entropy over candidate strings.

Three fixed kinds come from patterns. A fourth and fifth come from strings of
one character class in which a window of fixed width reaches a Shannon entropy
that prose doesn't: the window's counts, packed into a few numbers, are carried
from character to character (one in, one out), and only the sum of n*log2(n) is
adjusted. Long strings are cut into overlapping chunks, and running places go
by blocks, so a text costs its length, whatever it holds. Strings on the allow list, and strings that a fixed
pattern already covers, give no span. Not looked at: strings under 24
characters, and under CLASSES those of one case and digits that are no hex, and
base64 with fewer than two digits (9 % of random strings of 24); WIDE has
classes for both. DataFrame expressions only, one row at a
time: no shuffle.

A text of two megabytes takes seconds, be it one string or 100,000 secrets.

Offsets are code points, ends exclusive. Defined results: a null text counts as
empty and has no span; repeated rows are judged row by row; an empty table gives
an empty result; extra columns never clash, as input columns travel in a struct.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: Kinds in the order in which they are listed for spans that start together.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
_SPAN = "struct<start:int,rank:int,stop:int>"
_SPANS = f"array<{_SPAN}>"


@dataclass(frozen=True)
class CharacterClass:
    """Strings of ``alphabet`` of ``least`` characters or more that match every pattern of ``needs``; flagged where a window of ``width`` reaches ``bits`` of entropy a character."""

    kind: str
    alphabet: str
    least: int
    width: int
    bits: float
    needs: tuple[str, ...]


_DIGITS, _UP, _LOW = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharacterClass("entropy_hex", _DIGITS + "abcdefABCDEF", 32, 32, 3.0, ("[0-9]", "[a-fA-F]")),
    CharacterClass("entropy_base64", _UP + _LOW + _DIGITS + "+/_-", 24, 24, 3.7, ("[0-9].*[0-9]", "[a-z].*[a-z]", "[A-Z].*[A-Z]")),
)
#: What the pipeline redacts: also strings of one case and digits, and base64 with few digits. The query keeps to CLASSES, from which its SQL is made.
WIDE = (
    CLASSES[0],
    CharacterClass("entropy_base64", CLASSES[1].alphabet, 24, 24, 3.7, ("[0-9]|[A-Z][a-z][A-Z]", *CLASSES[1].needs[1:])),
    CharacterClass("entropy_base36", _LOW + _DIGITS, 24, 24, 3.5, ("[0-9]", "[a-z]")),
    CharacterClass("entropy_base32", _UP + _DIGITS, 24, 24, 3.0, ("[0-9]", "[A-Z]")),
)
_RANKS = (*KINDS, "entropy_base36", "entropy_base32")
#: Identifiers that look random and give nothing away: UUIDs, checksums that name their algorithm, alphabets, placeholders.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(?i:sha(1|256|384|512)|md5)[-_/]",
    r"(?i:abcdefgh|01234567|example|placeholder|xxxxxx)",
)


def _pieces(text: Column, pattern: str) -> tuple[Column, Column]:
    """Matches and the texts between them, from the same leftmost non-overlapping scan."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


#: Spans up to which a text is cut by substring.
FEW = 64
#: Elements that a running value is carried over before its results are laid aside; characters of a string whose windows are looked at together.
BLOCK, CHUNK = 64, 4_096


def _scan(items: Column, zero: Column, step: Callable[[Column, Column], Column], out: str) -> Column:
    """What ``step(state, item)``, a struct (state, out), gives out for each item in turn; the state is an int, ``out`` the type of what comes out.

    Arrays only grow by copying, so the items go by blocks: once for the state at
    the start of each, and once more for what each gives out.
    """
    typed = lambda kind: F.array().cast(f"array<{kind}>")

    def outs(state: Column, block: Column) -> Column:
        add = lambda acc, x: let(step(acc["state"], x), lambda r: F.struct(r["state"].alias("state"), F.concat(acc["outs"], F.array(r["out"])).alias("outs")))
        return F.aggregate(block, F.struct(state.alias("state"), typed(out).alias("outs")), add, lambda acc: acc["outs"])

    def starts(blocks: Column) -> Column:
        end = lambda state, block: F.aggregate(block, state, lambda s, x: step(s, x)["state"])
        add = lambda acc, block: F.struct(end(acc["state"], block).alias("state"), F.concat(acc["starts"], F.array(acc["state"])).alias("starts"))
        return F.aggregate(blocks, F.struct(zero.alias("state"), typed("int").alias("starts")), add, lambda acc: acc["starts"])

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")), lambda k: F.slice(items, k * BLOCK + 1, BLOCK))
    each = let(blocks, lambda b: let(starts(b), lambda s: F.flatten(F.transform(b, lambda block, k: outs(s[k], block)))))
    return F.when(F.size(items) > 0, each).otherwise(typed(out))


def _spans(text: Column, pattern: str, rank: int, keep: Column | None = None) -> Column:
    """Spans of a pattern's matches; ``keep``: an array of booleans, one a match."""
    found, between = _pieces(text, pattern)

    def step(at: Column, i: Column) -> Column:
        span = lambda start: F.struct((start + i["long"]).alias("state"), F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + i["long"]).alias("stop")).alias("out"))
        return let(at + i["gap"], span)

    lengths = let(between, lambda b: F.transform(found, lambda m, i: F.struct(F.length(b[i]).alias("gap"), F.length(m).alias("long"))))
    spans = let(lengths, lambda x: _scan(x, F.lit(0), step, _SPAN))
    return spans if keep is None else let(keep, lambda k: F.filter(spans, lambda _, i: k[i]))


def _window_entropy(s: Column, c: CharacterClass) -> Column:
    """The highest entropy of a window of ``c.width`` over a string of ``c.alphabet``, by incremental counts."""
    table = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(c.width + 2)])
    bits = (c.width + 1).bit_length()
    each = 63 // bits
    shift = lambda how, value, by: F.call_function(how, value, by)
    # of each character: which number holds its count, and where in it
    at = F.transform(F.split(s, ""), lambda x: let(F.position(x, F.lit(c.alphabet)) - F.lit(1), lambda k: F.struct(k.alias("k"), F.floor(k / each).cast("int").alias("part"), ((k % each) * bits).alias("by"))))

    def slide(x: Column, f: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            enter, leave = x[i], F.when(i >= c.width, x[i - F.lit(c.width)])
            count = lambda e: shift("shiftright", acc["n"][e["part"]], e["by"]).bitwiseAND(F.lit((1 << bits) - 1).cast("long")).cast("int")
            same = F.coalesce(enter["k"] == leave["k"], F.lit(False))
            plus = let(count(enter), lambda n: f[n + F.lit(1)] - f[n])
            minus = F.when(leave.isNotNull(), let(count(leave), lambda n: f[n - F.lit(1)] - f[n])).otherwise(F.lit(0.0))
            unit = lambda e: shift("shiftleft", F.lit(1).cast("long"), e["by"])
            counts = F.transform(acc["n"], lambda v, p: v + F.when(p == enter["part"], unit(enter)).otherwise(F.lit(0).cast("long")) - F.when(F.coalesce(p == leave["part"], F.lit(False)), unit(leave)).otherwise(F.lit(0).cast("long")))
            total = F.when(same, acc["sum"]).otherwise(acc["sum"] + minus + plus)
            grown = lambda t: F.struct(F.when(same, acc["n"]).otherwise(counts).alias("n"), t.alias("sum"), F.when(i >= c.width - 1, F.greatest(acc["best"], F.lit(math.log2(c.width)) - t / F.lit(float(c.width)))).otherwise(acc["best"]).alias("best"))
            return let(total, grown)

        start = F.struct(F.array_repeat(F.lit(0).cast("long"), -(-len(c.alphabet) // each)).alias("n"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
        return F.aggregate(F.sequence(F.lit(0), F.size(x) - 1), start, step, lambda acc: acc["best"])

    return let(at, lambda x: let(table, lambda f: slide(x, f)))


def _reaches(s: Column, c: CharacterClass) -> Column:
    """Whether a window of a string reaches the class's entropy, chunk by chunk up to the first that does."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.length(s) - c.width) / CHUNK).cast("int")), lambda k: F.substring(s, k * CHUNK + 1, F.lit(CHUNK + c.width - 1)))
    return F.exists(chunks, lambda x: _window_entropy(x, c) >= c.bits)


def _entropy_spans(text: Column, c: CharacterClass, allowed: tuple[str, ...]) -> Column:
    run = f"[{c.alphabet.replace('-', '')}{'-' if '-' in c.alphabet else ''}]{{{c.least},}}"
    found, _ = _pieces(text, run)

    def flagged(s: Column) -> Column:
        needed = F.lit(True)
        for need in c.needs:
            needed = needed & s.rlike(need)
        for allow in allowed:
            needed = needed & ~s.rlike(allow)
        return F.when(needed, _reaches(s, c)).otherwise(False)

    return F.when(text.rlike(run), _spans(text, run, _RANKS.index(c.kind), F.transform(found, flagged))).otherwise(F.array().cast(_SPANS))


def scan(docs: DataFrame, text: str = "text", classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` as one struct column ``row``, the text, and ``spans``: structs (start, rank, stop) by start, rank being the kind's place in KINDS."""
    t, none = F.col("body"), F.array().cast(_SPANS)
    long_enough = F.transform(F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= 6)
    fixed = F.concat(
        F.when(t.rlike(ASSIGN), _spans(t, ASSIGN, 0, long_enough)).otherwise(none),
        F.when(F.contains(t, F.lit("AKIA")), _spans(t, "AKIA[A-Z0-9]{16,}", 1)).otherwise(none),
        F.when(t.rlike("[0-9a-f]{24}"), _spans(t, "[0-9a-f]{24,}", 2)).otherwise(none),
    )
    found = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("body")).select("row", "body", fixed.alias("fixed"), F.concat(*[_entropy_spans(t, c, allowed) for c in classes]).alias("more"))
    return found.select("row", "body", F.when(F.size("more") == 0, F.array_sort("fixed")).otherwise(_apart(F.array_sort(F.concat("fixed", "more")))).alias("spans"))


def _apart(spans: Column) -> Column:
    """Sorted spans without those of no fixed kind that a fixed one overlaps: one pass for the fixed ones behind, one for those ahead."""
    fixed = lambda x: x["rank"] < 3
    behind = lambda far, x: F.struct(F.when(fixed(x), F.greatest(far, x["stop"])).otherwise(far).alias("state"), F.struct(x.alias("x"), far.alias("far")).alias("out"))
    ahead = lambda near, y: F.struct(F.when(fixed(y["x"]), y["x"]["start"]).otherwise(near).alias("state"), F.struct(y["x"].alias("x"), y["far"].alias("far"), near.alias("near")).alias("out"))
    first = let(spans, lambda s: _scan(s, F.lit(0), behind, f"struct<x:{_SPAN},far:int>"))
    both = let(F.reverse(first), lambda s: _scan(s, F.lit((1 << 31) - 1), ahead, f"struct<x:{_SPAN},far:int,near:int>"))
    free = F.filter(both, lambda y: fixed(y["x"]) | ((y["far"] <= y["x"]["start"]) & (y["x"]["stop"] <= y["near"])))
    return F.reverse(F.transform(free, lambda y: y["x"]))


def listing(spans: Column, kinds: int = len(KINDS)) -> Column:
    """kind:start:end of the spans of the first ``kinds`` kinds, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    of = F.filter(spans, lambda x: x["rank"] < kinds)
    return F.array_join(F.transform(of, lambda x: F.concat_ws(":", names[x["rank"]], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", classes: tuple[CharacterClass, ...] = CLASSES) -> DataFrame:
    """``docs`` with every secret span of its text replaced by ``mark``; overlapping spans by one mark. Rows without one, nulls included, stay as they are."""
    t = F.col("body")
    # what lies between the last span and this one, and the mark, unless the spans overlap
    cut = lambda at, x: F.struct(F.greatest(at, x["stop"]).alias("state"), F.struct(at.alias("at"), F.greatest(x["start"] - at, F.lit(0)).alias("long"), F.when(x["start"] >= at, F.lit(mark)).otherwise("").alias("mark")).alias("out"))
    gaps = _scan(F.col("spans"), F.lit(0), cut, "struct<at:int,long:int,mark:string>")
    last = F.array_max(F.transform("spans", lambda x: x["stop"]))
    few = let(gaps, lambda g: F.concat(F.array_join(F.transform(g, lambda x: F.concat(F.substring(t, x["at"] + 1, x["long"]), x["mark"])), ""), F.substring(t, last + 1, F.length(t))))
    # a piece of a text is found by counting characters from its beginning: many pieces are cut from the characters themselves
    chars = F.split(t, "")
    many = let(gaps, lambda g: let(chars, lambda c: F.concat(F.array_join(F.transform(g, lambda x: F.concat(F.array_join(F.slice(c, x["at"] + 1, x["long"]), ""), x["mark"])), ""), F.array_join(F.slice(c, last + 1, F.size(c)), ""))))
    clean = F.when(F.size("spans") <= FEW, few).otherwise(many)
    columns = [F.when(F.size("spans") > 0, clean).otherwise(F.col(f"row.`{c}`")).alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return scan(docs, text, classes).select(*columns)

"""Rule bitmask ledger.

Every rule is evaluated once per document. Its failure sets one bit, and the
numbers it looked at are kept beside the bits, so that a policy (a versioned
set of rules) is a mask, a verdict is one bitwise AND, and an ablation is an
aggregation over the few bit patterns that occur. DataFrame expressions only;
all of a document's work happens inside its row, without a shuffle.

Defined results: a null text counts as empty (no words, all counts 0, fails
``few_words``); repeated rows are judged row by row; an empty table gives an
empty ledger; extra columns never clash, as only the id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words_of

SYMBOLS = "[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_bangs")


def _repeat_words(words: Column) -> Column:
    """Number of words covered by 3-word windows found twice or more.

    The windows are sorted with their positions, so equal ones meet; the
    comparison is on the words themselves, not on hashes.
    """

    def covered(s: Column) -> Column:
        last = F.size(s) - 1
        same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
        hit = F.filter(s, lambda x, i: F.when(i > 0, same(x, s[i - F.lit(1)])).otherwise(False) | F.when(i < last, same(x, s[i + F.lit(1)])).otherwise(False))
        return F.size(F.array_distinct(F.flatten(F.transform(hit, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))))

    n = F.size(words) - 2
    part = lambda k: F.slice(words, k, n)
    windows = F.arrays_zip(part(1).alias("a"), part(2).alias("b"), part(3).alias("c"), F.sequence(F.lit(0), n - 1).alias("p"))
    return F.when(n >= 2, let(F.sort_array(windows), covered)).otherwise(0).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as one struct column ``row``, and a column for each of MEASURES."""
    body = F.coalesce(F.col("text"), F.lit(""))
    less = lambda c, pattern: F.length(c) - F.length(F.regexp_replace(c, pattern, ""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (
        docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
        .select("row", "text", words_of(F.col("text")).alias("words"), lines.alias("lines"))
        .select("row", "words", "lines", F.array_join("words", "").alias("joined"))
        .select(
            "row",
            F.size("words").cast("long").alias("n_words"),
            F.length("joined").cast("long").alias("word_chars"),
            less(F.col("joined"), SYMBOLS).cast("long").alias("n_symbols"),
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            _repeat_words(F.col("words")).alias("n_repeat_words"),
            less(F.col("joined"), r"\p{Lu}").cast("long").alias("n_upper"),
            less(F.col("joined"), r"\p{L}").cast("long").alias("n_letters"),
            less(F.col("joined"), "!").cast("long").alias("n_bangs"),
        )
    )


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` (SQL over MEASURES) is true; its place in the list is its bit."""

    name: str
    fails: str


#: Bits are positions: append, never reorder.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "5 * n_symbols > n_words"),
    Rule("word_length", "n_words > 0 and (word_chars < 2 * n_words or word_chars > 14 * n_words)"),
    Rule("repeated_lines", "n_lines >= 4 and 10 * n_dup_lines > 6 * n_lines"),
    Rule("shouting", "n_letters > 0 and 10 * n_upper > 4 * n_letters"),
    Rule("exclamations", "10 * n_bangs > 3 * n_words"),
    Rule("no_letters", "2 * n_letters < word_chars"),
)


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        bits = {r.name: 1 << i for i, r in enumerate(rules)}
        return sum(bits[name] for name in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_windows"))
DEFAULT = Policy("prose-1", tuple(r.name for r in RULES))


def ledger(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``row``, the measurements and ``fail_bits``: bit i is set where rule i fails."""
    if len(rules) > 63:
        raise ValueError("a ledger holds 63 rules at most")
    bits = " + ".join(f"if({r.fails}, {1 << i}L, 0L)" for i, r in enumerate(rules)) or "0L"
    return measure(docs, text).withColumn("fail_bits", F.expr(bits))


def passes(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """The verdict of a policy over a ledger."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0


def ablations(book: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of a policy: documents that fail it, fail it alone, and would be kept without it.

    Rows collapse to the bit patterns that occur before anything else is done,
    so the cost after one partial aggregation doesn't follow the corpus.
    """
    mask = policy.mask(rules)
    patterns = book.select(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).groupBy("bits").agg(F.count("*").alias("n"))
    rule = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, r in enumerate(rules) if mask >> i & 1]))
    hit = F.col("r.bit").bitwiseAND(F.col("bits")) != 0
    return (
        patterns.select("bits", "n", rule.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failing"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_alone"),
            F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )


def keep_passing(docs: DataFrame, policy: Policy = DEFAULT, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with their own columns."""
    # a filter may not move below a column that isn't deterministic: below the
    # measurements it would compute them anew for each mention of them
    book = ledger(docs, text).withColumn("seen", F.monotonically_increasing_id())
    return book.where(passes(policy) & (F.col("seen") >= 0)).select("row.*")

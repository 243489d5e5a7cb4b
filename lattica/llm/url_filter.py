"""URL rules by a sort-merge range join.

A rule (host, path prefix) has the key *reversed host labels, NUL, path*. The
keys that start with it form an interval, and such intervals nest or are
disjoint. Sorted with the urls' keys, the last rule that begins at or before a
url holds on its stack (itself and the rules around it) every rule whose
interval contains the url. Subdomains are covered by giving a url one key for
each number of host labels that rules use.

The sweep is a window over (top label, salt): urls are spread over the salts
and rules repeated on each, so no host, however common, is one task's work;
equal urls are collapsed before. DataFrame expressions only.

Defined results: a null url or one without ``://`` has an empty host and path
and fits no rule; repeated rows each get the verdict; an empty table or an empty
rule list works; of rules with one key a block wins; of rules of equal length
that fit, the one with more host labels, then a block, then the greater text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, partitions

RULE_SCHEMA = "rule string, verdict string"


def split_url(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.regexp_replace(rest, r"^[^/?#]*", ""), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "\u0001"), F.lit("\u0000"), path)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """(verdict, "host/path prefix") pairs as the table that ``judge`` takes."""
    rows = [F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for v, r in rules]
    return spark.range(1).select(F.inline(F.array(*rows).cast(f"array<struct<{RULE_SCHEMA.replace(' ', ':')}>>".replace(",:", ","))))


def _stacks(rules: DataFrame) -> DataFrame:
    """Each rule's key, top label, host label count and stack: itself and the rules around it, as many as its key has characters at most."""
    host, path = F.regexp_extract("rule", r"^[^/]*", 0), F.regexp_replace("rule", r"^[^/]*", "")
    keyed = (
        rules.where(F.col("rule").isNotNull())
        .withColumn("labels", F.reverse(F.split(ascii_lower(host), r"\.", -1)))
        .select(_key(F.col("labels"), path).alias("key"), F.col("labels")[0].alias("top"), F.size("labels").alias("depth"), F.struct(F.length("rule").alias("length"), F.size("labels").alias("depth"), (F.col("verdict") == "block").alias("block"), "rule", "verdict").alias("rule"))
        .groupBy("key", "top", "depth")
        .agg(F.max("rule").alias("rule"))
    )
    around = keyed.select(F.col("key").alias("inner"), F.explode(F.transform(F.sequence(F.lit(1), F.length("key")), lambda n: F.substring(F.col("key"), F.lit(1), n))).alias("key")).join(keyed.select("key", "rule"), "key")
    stacks = around.groupBy(F.col("inner").alias("key")).agg(F.collect_list(F.struct(F.col("key"), F.col("rule"))).alias("stack"))
    return keyed.select("key", "top", "depth").join(stacks, "key")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", no_host: str = "block", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule (null where none fits) and verdict for each row of ``pages``.

    Without a fitting rule the verdict is ``default``, or ``no_host`` for a url that names no host.
    """
    spark = pages.sparkSession
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    host, path = split_url(F.col("url"))
    urls = urls.select("id", host.alias("host"), path.alias("path"))
    each = urls.where(F.col("host") != "").select("host", "path").distinct()

    stacks = _stacks(rules)
    facts = rules.select(F.size(F.split(F.regexp_extract("rule", r"^[^/]*", 0), r"\.", -1)).alias("depth")).groupBy("depth").agg(F.count("*").alias("n")).collect()  # a row per number of labels: 127 at most in a host name
    depths, n_rules = sorted(r["depth"] for r in facts), sum(r["n"] for r in facts)
    if not depths:
        depths, n_rules = [1], 1
    salts = max(1, min(partitions(spark), pages.count() // n_rules))  # rules on all salts are never more than the urls

    labels = F.reverse(F.split("host", r"\.", -1))
    keys = (
        each.withColumn("labels", labels)
        .select("host", "path", F.col("labels")[0].alias("top"), F.pmod(F.xxhash64("host", "path"), F.lit(salts)).cast("int").alias("salt"), "labels", F.explode(F.array(*map(F.lit, depths))).alias("depth"))
        .where(F.size("labels") >= F.col("depth"))
        .select("top", "salt", _key(F.slice("labels", F.lit(1), F.col("depth")), F.col("path")).alias("key"), F.lit(1).alias("kind"), F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"), "host", "path")
    )
    starts = stacks.select("top", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "key", F.lit(0).alias("kind"), "stack", F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"))
    sweep = Window.partitionBy("top", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    active = F.filter(F.col("around"), lambda r: F.startswith(F.col("key"), r["key"]))
    found = (
        keys.unionByName(starts)
        .withColumn("around", F.last("stack", ignorenulls=True).over(sweep))
        .where((F.col("kind") == 1) & F.col("around").isNotNull())
        .select("host", "path", F.array_max(F.transform(active, lambda r: r["rule"])).alias("rule"))
        .where(F.col("rule").isNotNull())
        .groupBy("host", "path")
        .agg(F.max("rule").alias("best"))
    )
    verdict = F.coalesce(F.col("best.verdict"), F.when(F.col("host") == "", F.lit(no_host)).otherwise(F.lit(default)))
    return urls.join(found, ["host", "path"], "left").select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))

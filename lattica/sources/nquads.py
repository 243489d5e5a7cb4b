"""N-Quads text: reading lines to quads, and writing quads as lines by part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import nquad_line, parse_nquad


def parse(lines: DataFrame, column: str = "value", *keep: str) -> DataFrame:
    """Quads of a table of lines, with ``ok`` false for a line that can't be read; blank lines and comments go.

    An explode, as a filter on parsed columns would be pushed below the parsing and parse each line again.
    """
    # outer: what an inner explode infers about its array would evaluate it once more
    return lines.select(*keep, F.explode_outer(parse_nquad(F.col(column))).alias("q")).where("q is not null").select("q.*", *keep)


def read(spark: SparkSession, path: str, shared_labels: bool = False) -> DataFrame:
    """Quads of files, with the file each comes from.

    A blank node's label holds within its file, so labels of different files are
    told apart by the file's path; ``shared_labels`` keeps them, for the parts of one document.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("path"))
    quads = parse(lines, "value", "file", "path")
    if not shared_labels:
        own = lambda c: F.when(F.col(c).startswith("_:"), F.concat(F.lit("_:f"), F.substring(F.sha2("path", 256), 1, 24), F.lit("."), F.substring(c, 3, 1 << 30))).otherwise(F.col(c))
        quads = quads.withColumns({"s": own("s"), "g": own("g"), "o": F.when(F.col("o_kind") == "blank", own("o")).otherwise(F.col("o"))})
    return quads.drop("path")


def render(quads: DataFrame, *keep: str) -> DataFrame:
    return quads.select(*keep, nquad_line(*[F.col(c) for c in ("s", "p", "o", "o_kind", "o_dt", "g")]).alias("line"))


def write(quads: DataFrame, path: str, *partitions: str) -> None:
    """Text files, in a folder for each value of ``partitions``; a rerun replaces what it writes again and leaves other folders."""
    df = render(quads, *partitions)
    if partitions:
        df = df.repartition(*partitions)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).text(path)


def write_table(quads: DataFrame, path: str) -> None:
    """The canonical store: Parquet by zone and source, clustered by predicate and subject so that pattern scans skip row groups. Ranges of both, so a frequent predicate is many tasks and files."""
    (quads.repartitionByRange("zone", "tsv_stem", "p", "s").sortWithinPartitions("zone", "tsv_stem", "p", "s").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("zone", "tsv_stem").parquet(path))

"""Reading delimited files and profiling them."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import DIALECT, Source

#: Goes into cache keys: a profile holds for the way a file was read, too.
DIALECT_HASH = hashlib.sha256(json.dumps(DIALECT, sort_keys=True).encode()).hexdigest()[:16]


def read(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """Rows as strings, the null mark as null."""
    return spark.read.schema(", ".join(f"`{c}` string" for c in columns)).options(**DIALECT).csv(path)


def read_source(spark: SparkSession, source: Source, path: Path | str) -> DataFrame:
    name = str(path).rsplit("/", 1)[-1]
    if name not in source.columns:
        # a further file: its header names the columns
        return spark.read.options(**DIALECT).csv(str(path))
    return read(spark, str(path), source.columns[name])


def profile(rows: DataFrame, file: str, content_hash: str, size: int) -> DataFrame:
    """(file, row_count, column_count, columns, size_bytes, content_hash, dialect)."""
    return rows.agg(F.count("*").alias("row_count")).select(
        F.lit(file).alias("file"),
        "row_count",
        F.lit(len(rows.columns)).cast("long").alias("column_count"),
        F.array(*map(F.lit, rows.columns)).alias("columns"),
        F.lit(size).cast("long").alias("size_bytes"),
        F.lit(content_hash).alias("content_hash"),
        F.lit(DIALECT_HASH).alias("dialect"),
    )

"""Content hashes and batch ids."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_sha256(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def hashes(spark: SparkSession, pattern: str) -> DataFrame:
    """(name, hash) of every file under a path that only Spark's readers open."""
    return spark.read.format("binaryFile").load(pattern).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("hash"))


def combined(names: Mapping[str, str]) -> tuple[str, str]:
    """(whole digest, batch id) of file hashes, whatever order they come in."""
    digest = hashlib.sha256("|".join(f"{n}:{h}" for n, h in sorted(names.items())).encode()).hexdigest()
    return digest, digest[:16]


def combine(found: DataFrame) -> DataFrame:
    """The same over a table (name, hash), one row a file: (digest, batch_id)."""
    digest = F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "name", "hash"))), "|"), 256)
    return found.agg(digest.alias("digest")).select("digest", F.substring("digest", 1, 16).alias("batch_id"))

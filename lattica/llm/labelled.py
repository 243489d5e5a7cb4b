"""What the two classifiers share: held-out splits and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a row without id counts as remainder 0."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(of)), F.lit(0)).cast("int")


def sample_ids(ids: DataFrame, most: int, seed: int) -> DataFrame:
    """``most`` distinct ids at most, by seeded hash: the same ones in every run, chosen from all rows."""
    return ids.where("id is not null").select("id").distinct().orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(most)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Whole texts of sampled ids; the sample is bounded, so it is sent to the documents and not they to it."""
    return docs.select("id", "text").join(F.broadcast(ids), "id")

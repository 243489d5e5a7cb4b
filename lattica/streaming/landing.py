"""Files that arrive are mapped as they land.

The mapping is stateless, so a stream of rows takes the same plan as a batch.
Each micro-batch is written under its number: a repeated batch replaces its own
output and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.mapping import map_rows
from ..plans.templates import Mapping
from ..sources.registry import DIALECT


def read_stream(spark: SparkSession, folder: str, columns: tuple[str, ...]) -> DataFrame:
    return spark.readStream.schema(", ".join(f"`{c}` string" for c in columns)).options(**DIALECT).csv(folder)


def quads_of(rows: DataFrame, mapping: Mapping, graph: str) -> DataFrame:
    return map_rows(rows, mapping, graph)


def land(rows: DataFrame, mapping: Mapping, graph: str, out: str, checkpoint: str, check: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Write the quads of each micro-batch to ``out``/batch=<number>; ``check`` may split or mark them. Stops when all that has landed is done."""

    def sink(batch: DataFrame, number: int) -> None:
        quads = map_rows(batch, mapping, graph)
        (check(quads) if check else quads).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    return rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

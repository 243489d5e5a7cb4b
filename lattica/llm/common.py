"""Shared pieces of the training-data operators: word rules, plan idioms and stage tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda body that names a computed column may have that computation
    inlined and repeated for every element; binding it to a lambda variable
    keeps it evaluated once whatever the optimizer collapses.
    """
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES, -1), "")


def ascii_lower(text: Column) -> Column:
    """A-Z only; other scripts keep their case."""
    return F.translate(text, UPPER, LOWER)


def stage_dir(spark: SparkSession) -> str:
    """The shared folder for stage tables: what ``spark.checkpoint.dir`` names.

    Where that is unset, a session on one machine (tests, notebooks) uses a
    temporary folder of its own; on a cluster that would lose rows, so there it is an error.
    """
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir") or spark.conf.get("lattica.local.stage.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lattica-stage-")
        spark.conf.set("lattica.local.stage.dir", base)
    return f"{base.rstrip('/')}/lattica/{conf.get('spark.app.id', 'app')}"


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class StageTables:
    """Tables written to the shared folder to cut lineage, so that a lost executor costs a read and no recomputation.

    An operator drops a table when it has served. What its result still reads
    stays as long as the application, whose end takes the whole folder away.
    """

    def __init__(self, spark: SparkSession):
        home = stage_dir(spark)
        self.spark, self.root, self.count = spark, f"{home}/{uuid.uuid4().hex}", 0
        p, files = self._at(home)
        files.deleteOnExit(p)

    def _at(self, path: str) -> tuple:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def put(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count:04d}"
        # what was shuffled to make a written table has served: its files go at once, not when the driver next collects its garbage
        before = self.spark.conf.get(_CLEAN, "false")
        self.spark.conf.set(_CLEAN, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            self.spark.conf.set(_CLEAN, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stage_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            if path := getattr(df, "_stage_path", None):
                p, files = self._at(path)
                files.delete(p, True)

    def clear(self) -> None:
        """Every table of this object goes."""
        p, files = self._at(self.root)
        files.delete(p, True)


#: Bits a hash, and bits of the whole, that ``hinted`` may take; a table of more hashes lets more rows pass for nothing.
HINT_BITS, HINT_MOST = 32, 1 << 28
_MAP, _PART = 1 << 15, 1 << 10  # bits of a bitmap that Spark builds, and of the parts that are looked up: a row's lookup copies one


def hinted(df: DataFrame, column: str, hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows whose ``column`` may be among ``hashes`` (one column of 64-bit hashes, none null), and rows whose isn't.

    A bitmap tells, which is broadcast: few bits a hash and never above ``HINT_MOST``. What is then joined is the first part, so rows of long texts that have no partner stay where they are, whatever the size of either table.
    """
    n = hashes.count()
    maps = 1 << max(0, min(HINT_MOST, n * HINT_BITS) // _MAP).bit_length()
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(maps * _MAP))
    built = hashes.toDF("_h").select((at(F.col("_h")) + 1).alias("_h")).groupBy(F.bitmap_bucket_number("_h").alias("_map")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_h")).alias("_all"))
    parts = built.select("_map", "_all", F.explode(F.sequence(F.lit(0), F.lit(_MAP // _PART - 1))).alias("_k"))
    bits = parts.select(((F.col("_map") - 1) * (_MAP // _PART) + F.col("_k")).alias("_part"), F.substring("_all", F.col("_k") * (_PART // 8) + 1, F.lit(_PART // 8)).alias("_bits"))
    place = F.pmod(at(F.col(column)), F.lit(_PART)).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    told = df.join(F.broadcast(bits), F.shiftright(at(F.col(column)), _PART.bit_length() - 1) == F.col("_part"), "left")
    found = F.coalesce(F.getbit(byte, place % 8) == 1, F.lit(False))
    return told.where(found).select(*df.columns), told.where(~found).select(*df.columns)


def row_hash(df: DataFrame) -> Column:
    """Of all columns, nulls included: equal rows have equal hashes."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def first_rows(docs: DataFrame, grouped: DataFrame, stages: StageTables, id_col: str = "doc_id") -> DataFrame:
    """One row of each group, with its own columns: that of the smallest id, and of rows that share it the smallest hash; a row without id only where the group has no other.

    ``grouped``: (id, row, group) of every row, ``row`` being its ``row_hash``. Names of ``docs`` never clash: its rows travel in a struct.
    """
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    rows = grouped.select("group", rank.alias("rank")).groupBy("group", "rank").agg(F.count("*").alias("n"))  # rows that are the same in every column fall together
    rows = stages.put(rows)
    first = rows.groupBy("group").agg(F.min("rank").alias("first"))
    gone = stages.put(rows.join(first, "group").where("rank <> first").select("rank.id", "rank.row").distinct())
    twice = stages.put(rows.where("n > 1").select("rank.id", "rank.row").distinct())
    stages.drop(rows)
    own = docs.select(F.struct("*").alias("doc"), F.col(id_col).cast("long").alias("_id"), row_hash(docs).alias("_row"))
    is_one_of = F.col("_id").eqNullSafe(F.col("id")) & (F.col("_row") == F.col("row"))
    perhaps, stay = hinted(own, "_row", gone.select("row"))
    left = perhaps.join(gone, is_one_of, "left_anti").unionByName(stay)
    if not twice.isEmpty():
        left = left.join(twice, is_one_of, "left_anti").unionByName(left.join(twice, is_one_of, "left_semi").dropDuplicates(["_id", "_row"]))
    return left.select("doc.*")


_shipped: set[str] = set()
#: Bytes of an Arrow batch, about: rows of very long texts or many hashes come fewer at a time.
_BATCH, _BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def ship(spark: SparkSession) -> None:
    """Make a session ready for Python tasks: batches bounded in bytes, and this package sent to the executors once per application, as they need not have it installed."""
    if not spark.conf.get("lattica.batch.bytes", None):
        spark.conf.set(_BATCH, str(_BYTES))
        spark.conf.set("lattica.batch.bytes", str(_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    made = Path(tempfile.mkdtemp(prefix="lattica-")) / f"{root.name}.zip"
    with zipfile.ZipFile(made, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(made))
    _shipped.add(sc.applicationId)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

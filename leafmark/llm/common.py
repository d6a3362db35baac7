"""What the operators of this subpackage share: the shared folder, checked broadcasts and bounded Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a narrow table (a few numbers a row) is sent to every executor; larger ones are joined by a shuffle.
BROADCAST_ROWS = 500_000

#: Keys that are dealt to several tasks, at most; and rows below which a key never is.
HOT_KEYS, HOT_ROWS = 100_000, 1024

#: Bytes of text that a vectorised kernel takes at a time. One longer text makes a slice of its own.
SLICE_BYTES = 512 << 10

#: Bytes of an Arrow batch between the JVM and a Python worker, so that long texts do not add up.
BATCH_BYTES = 4 << 20

pa.set_memory_pool(pa.system_memory_pool())  # gives large freed buffers back to the system at once


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share; a fresh one where the setting is missing (local tests)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        set_before = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_before.isDefined():
            return set_before.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='leafmark-')}"
        spark.sparkContext.setCheckpointDir(base)
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return base


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of this session are cut by bytes, beside Spark's cut by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_made: list[str] = []  # places given out by new_path() and not deleted yet


def new_path(spark: SparkSession, tag: str) -> str:
    _made.append(f"{shared_dir(spark).rstrip('/')}/leafmark/{tag}-{uuid.uuid4().hex}")
    return _made[-1]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes all tables that were written to the shared folder inside the block; results that read them must be written elsewhere before."""
    before = len(_made)
    try:
        yield
    finally:
        for path in _made[before:]:
            delete_path(spark, path)


def packed(*columns: Column | str) -> Column:
    """Columns as one struct `row`, so that no name of theirs meets one of an operator's own."""
    return F.struct(*columns).alias("row")


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def unpacked(df: DataFrame, without: Iterable[str] = ()) -> list[Column]:
    """The fields of df's struct `row`, less those that columns of the names `without` replace."""
    gone = {c.lower() for c in without}
    return [F.col("row").getField(c).alias(c) for c in df.schema["row"].dataType.names if c.lower() not in gone]


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, and survives the loss of any executor."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(*frames: DataFrame) -> None:
    """Deletes tables made by written() that no result reads any more."""
    for df in frames:
        files = df.inputFiles()
        if files:
            delete_path(df.sparkSession, files[0].rsplit("/", 1)[0])


def delete_path(spark: SparkSession, path: str) -> None:
    if path in _made:
        _made.remove(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Counts at most rows + 1 rows of a narrow written table."""
    return df.limit(rows + 1).count() <= rows


def join_small(left: DataFrame, right: DataFrame, on: list[str], how: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """left joined with a narrow written table: sent to every executor if it is small enough, else shuffled."""
    return left.join(F.broadcast(right) if small_enough(right, rows) else right, on, how)


def spread_join(left: DataFrame, right: DataFrame, on: str, n: str, by: list[str], how: str = "inner") -> DataFrame:
    """left joined with right, a written table of one row for each key, whose column n counts the rows of left that have the key.

    Keys with many rows are dealt to several tasks by a hash of the columns `by`, and their row of right goes to each of those. Of such keys there
    are at most HOT_KEYS, since each has more than a HOT_KEYS-th of all rows, so their list is sent to every executor.
    """
    total, most = right.agg(F.coalesce(F.sum(n), F.lit(0)), F.coalesce(F.max(n), F.lit(0))).first()
    hot = max(HOT_ROWS, total // HOT_KEYS)
    if most <= hot:
        return left.join(right.drop(n), on, how)
    parts = F.ceil(F.col(n) / hot).cast("long")
    heavy = right.where(F.col(n) > hot).select(on, parts.alias("_parts"))
    dealt = left.join(F.broadcast(heavy), on, "left").withColumn("_part", F.pmod(F.xxhash64(*by), F.coalesce("_parts", F.lit(1).cast("long")))).drop("_parts")
    return dealt.join(right.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(parts, F.lit(1)) - 1))).drop(n), [on, "_part"], how).drop("_part")


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column's values, one after another, and the offsets of its rows (one more than rows). Null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that the texts of each take about `most` bytes; whole rows only."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = string_buffers(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(at, at[start] + most, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def word_lower_bytes() -> np.ndarray:
    """A table of bytes that lower-cases A-Z alone."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table

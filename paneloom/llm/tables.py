"""Reading tables, writing intermediate results to the shared folder, and names that clash with nothing."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ARROW_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder under `spark.checkpoint.dir`.

    Only a session that runs in one process may do without that setting: it gets a temporary folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        master = context.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="paneloom-llm-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/paneloom-llm/{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that `shared_folder` named."""
    if spark.sparkContext._jsc is None:
        return
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Saved:
    """A result written once to the shared folder; rereading it needs no executor's memory."""

    def __init__(self, df: DataFrame):
        self._spark = df.sparkSession
        self.folder = shared_folder(self._spark)
        df.write.parquet(self.folder)
        self.df = self._spark.read.schema(df.schema).parquet(self.folder)
        atexit.register(self.drop)

    def drop(self) -> None:
        atexit.unregister(self.drop)
        try:
            remove(self._spark, self.folder)
        except Exception:  # noqa: BLE001 - the session may have ended; the folder is only scratch
            return


def save(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back; the folder goes when the driver's Python ends."""
    return Saved(df).df


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or the first of name_1, name_2, ... that `df` has no column for (letter case ignored)."""
    taken = {c.lower() for c in df.columns}
    number, found = 0, name
    while found.lower() in taken:
        number += 1
        found = f"{name}_{number}"
    return found


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bound what one Arrow batch holds, so that very long texts arrive few at a time."""
    spark.conf.set(ARROW_BATCH_BYTES, size)


def texts_of(column: pa.Array) -> list[str]:
    """A text column as Python strings; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def complete_runs(batches: Iterator[pa.RecordBatch], key: str, limit: int) -> Iterator[pa.Table]:
    """Regroup batches sorted by `key` into tables that end where a key ends.

    A table is passed on before its key ends only when it has over `limit` rows of one key.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(keys.searchsorted(keys[-1]))  # where the last key begins
        if cut or (held and held[-1].column(key)[-1].as_py() != keys[0]):
            if cut:
                held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held, rows = [], 0
        held.append(batch.slice(cut))
        rows += batch.num_rows - cut
        if rows > limit:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def offsets_of(counts: DataFrame, keys: list[str], part: str, count: str, name: str) -> DataFrame:
    """Sums of `count` over the earlier parts of the same keys; one row for each key and partition."""
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum(count).over(before), F.lit(0)).cast("long"))


def unsigned_hex(column: Column) -> Column:
    """16 lower-case hex digits of a long taken as unsigned."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))

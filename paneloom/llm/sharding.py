"""Sharding: contiguous shards of nearly equal bytes from prefix sums over partition totals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneloom.llm.tables import offsets_of, save, small_batches

ROW_OVERHEAD = 8


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each row the bytes and the rows before it in its partition."""
    size_before = rows_before = 0
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        ends = size_before + np.cumsum(sizes)
        places = rows_before + np.arange(len(sizes), dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(ends - sizes), pa.array(places)],
            names=[*batch.schema.names, "local_start", "local_place"],
        )
        if len(sizes):
            size_before, rows_before = int(ends[-1]), rows_before + len(sizes)


def shard_by_bytes(
    docs: DataFrame, shards: int = 24, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every row with its size, shard and slot: contiguous cuts of the input order at equal byte targets.

    Size is the text's UTF-8 bytes plus 8. A running sum inside each input partition, written once,
    and the prefix sums of one total per partition give each row its global byte range; a row goes
    to the shard that its middle falls in, so shards differ by about one row's size. Texts are
    read once and never shuffled; a hot source or group of copies changes nothing, as no key deals
    out rows. Slots count from 0 in each shard.

    Null texts have no bytes (size 8, crc32 0); empty texts likewise. Ties and repeated rows are
    rows of their own. An empty table gives an empty result. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    raw = F.encode(F.coalesce(F.col(text_column), F.lit("")), "UTF-8")
    light = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (F.octet_length(raw) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.spark_partition_id().alias("part"),
    )
    schema = "doc_id long, size long, text_crc32 long, part int, local_start long, local_place long"
    placed = save(light.mapInArrow(_running, schema))
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    one = totals.withColumn("one", F.lit(1))
    starts = offsets_of(offsets_of(one, ["one"], "part", "bytes", "start"), ["one"], "part", "rows", "place")
    starts = starts.withColumn("whole", F.sum("bytes").over(Window.partitionBy("one")))
    # One row per input partition; written, so that the planner sees its size and broadcasts it only if small.
    starts = save(starts.select("part", "start", "place", "whole"))
    places = placed.join(starts, "part").select(
        "doc_id", "size", "text_crc32", "whole",
        (F.col("start") + F.col("local_start")).alias("start"), (F.col("place") + F.col("local_place")).alias("place"),
    )
    shard = F.least(F.expr(f"(2 * start + size) * {int(shards)} div (2 * whole)"), F.lit(shards - 1)).cast("int")
    cut = places.withColumn("shard", shard)
    firsts = save(cut.groupBy("shard").agg(F.min("place").alias("first")))  # one row per shard
    return cut.join(firsts, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )

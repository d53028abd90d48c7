"""Documents in blocks of about equal text, for work by block.

A block is small enough for one task. Its distinct keys travel once per block
instead of once per document, which keeps the shuffles of corpus statistics
below the size of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore.runtime import scratch_path

SCHEMA = "block long, row_id long, doc_id long, text string"


def in_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Stored copy ``block, row_id, doc_id, text`` of the documents, a block's rows side by side.

    A block is a run of rows of one partition whose texts begin within
    ``block_bytes`` of each other, so dealing needs no shuffle and long texts that
    stand together fill several blocks. The copy fixes ``row_id`` and ``block``: rows
    of equal or null ``doc_id`` stay apart, and every later pass sees the same blocks,
    also after an executor is lost.
    """
    spark = docs.sparkSession

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy().astype(np.int64)
            begin = total + np.cumsum(size) - size
            total += int(size.sum())
            part = batch["row_id"].to_numpy() >> 33  # of monotonically_increasing_id: the partition
            yield pa.RecordBatch.from_arrays([pa.array((part << 31) + begin // block_bytes), *batch.columns], names=["block", *batch.schema.names])

    path = scratch_path(spark, "blocks")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    rows.mapInArrow(work, SCHEMA).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)

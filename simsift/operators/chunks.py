"""Splitting numbered records into chunks of equal size, and proving the split right."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chunk_of(line: Column, size: int) -> Column:
    """The chunk (from 0) of a 0-based line."""
    if size < 1:
        raise ValueError("a chunk holds at least one record")
    return F.floor(line / size).cast("bigint")


def chunk_name(base: Column, chunk: Column) -> Column:
    return F.concat(base, F.lit(".part"), F.lpad(chunk.cast("string"), 5, "0"), F.lit(".cxsmiles.bz2"))


def assigned(lines: DataFrame, size: int, line: str = "line") -> DataFrame:
    return lines.withColumn("chunk", chunk_of(F.col(line), size))


def verified(chunks: DataFrame, size: int) -> DataFrame:
    """chunk, records, first_line, last_line, exact: every chunk but the last must be full, the last
    not empty, and lines contiguous. chunks has chunk and line as read back."""
    per = chunks.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("records"), F.min("line").alias("first_line"), F.max("line").alias("last_line")
    )
    last = per.agg(F.max("chunk").alias("_last"))
    full = (F.col("records") == size) | ((F.col("chunk") == F.col("_last")) & (F.col("records") <= size))
    tight = (F.col("first_line") == F.col("chunk") * size) & (F.col("last_line") - F.col("first_line") + 1 == F.col("records"))
    return per.join(F.broadcast(last)).select("chunk", "records", "first_line", "last_line", (full & tight).alias("exact"))

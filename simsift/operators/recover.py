"""From locators back to records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ("archive_index", "ligand_line")


def recover(hits: DataFrame, library: DataFrame) -> DataFrame:
    """Hits with their record. Hits that share a locator each keep their row. Which side is sent is
    left to the planner: a K that fits its threshold is broadcast, a larger one shuffled."""
    return hits.join(library.select(*KEY, "record"), list(KEY))


def missing(hits: DataFrame, library: DataFrame) -> DataFrame:
    """Hits whose record isn't in the library."""
    return hits.join(library.select(*KEY), list(KEY), "left_anti")


def recover_all(hits: DataFrame, library: DataFrame) -> DataFrame:
    """As recover, but raises (when run) for a hit without its record."""
    found = library.select(*KEY, "record", F.lit(True).alias("_found"))
    lost = F.raise_error(F.concat_ws(" ", F.lit("no record at archive, line"), *[F.col(k).cast("string") for k in KEY]))
    rows = hits.join(found, list(KEY), "left")
    return rows.withColumn("record", F.when(F.col("_found"), F.col("record")).otherwise(lost.cast("string"))).drop("_found")


def needed(hits: DataFrame) -> DataFrame:
    """Of each archive with a hit: how many lines, and the last that a reader has to reach."""
    return hits.groupBy("archive_index").agg(
        F.count(F.lit(1)).alias("hits"), F.count_distinct("ligand_line").alias("unique_lines"), F.max("ligand_line").alias("last_line")
    )

"""The merge job: all shards of a run in, the ranked locator file and the pipeline's CSV out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simsift.functions import records
from simsift.jobs.search import shard_hits, shard_metadata
from simsift.operators import search, shards
from simsift.sources import cxsmiles, manifest, sinks
from simsift.space import written


def merge(
    spark: SparkSession,
    manifest_file: str,
    out: str,
    task_count: int,
    locators: str,
    pipeline: str,
    top_k: int | None = None,
    include_header: bool = False,
    digits: int = 10,
    short: str = "fail",
) -> DataFrame:
    """Writes both files; rank, tanimoto, archive_index, source_file, ligand_line of the final list.

    Refused: shards without metadata or with fewer hits than it says, shards that disagree, another
    manifest, another number of tasks, a K above the shards'. Records are read from the blocks that hold a
    hit, and no others. short says what a hit whose record has
    fewer than its twelve fields does: "fail", or "null" for a row without an id.
    """
    paths, metadata = manifest.read_manifest(manifest_file), shard_metadata(spark, out)
    if metadata is None:
        raise ValueError(f"{out} has no metadata")
    shards.verified(metadata, manifest.manifest_frame(spark, paths), task_count)
    first = metadata.select("top_k", "header_lines").first()
    k = shards.final_k(first["top_k"], top_k)
    best = written(search.best_ranked(shard_hits(spark, out, metadata).drop("task_index"), k), "ranked")
    sinks.write_locators(best, locators, digits)

    found = cxsmiles.recovered(best)
    parts = records.record_tokens(F.col("record"))
    found = found.withColumn("parts", records.checked(parts, F.col("record")) if short == "fail" else parts)
    name = F.when(records.complete(F.col("parts")), records.identifier(F.col("parts")))
    sinks.write_pipeline(sinks.pipeline_rows(found, records.structure(F.col("parts")), name), pipeline, include_header)
    return best

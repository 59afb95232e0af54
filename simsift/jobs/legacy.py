"""The older search as one call: all archives below a folder, a file of the K best with six decimals.

Scores are of single precision and ties are in order of archive and line; there is no cutoff, no
recovery and no CSV. It is the search job with one shard, so it reads each archive with many tasks
and goes on where it was stopped if it gets the same `work` folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from simsift.jobs.search import FP_SIZE, HEADER_LINES, RADIUS, TOP_K, search, shard_hits, shard_metadata
from simsift.operators.search import best_ranked
from simsift.sources import manifest, sinks
from simsift.space import new_folder, written

DIGITS = 6


def legacy_search(
    spark: SparkSession,
    root: str,
    query: str,
    output: str,
    top_k: int = TOP_K,
    header_lines: int = HEADER_LINES,
    column: int = 0,
    radius: int = RADIUS,
    fp_size: int = FP_SIZE,
    kind: str = "structure",
    work: str | None = None,
    progress: Callable[[str], None] | None = None,
) -> DataFrame:
    """Writes output: rank, tanimoto, source_file, ligand_line of the K best records below root; they, and archive_index.
    column is the token, from 0, that holds the structure."""
    if column < 0:
        raise ValueError("columns count from 0")
    work = work or new_folder(spark, "legacy-search")
    listed = f"{work}/archives.txt"
    where, path = manifest.opened(listed)
    if where.get_file_info(path).type == manifest.fs.FileType.NotFound:
        manifest.write_manifest(listed, manifest.discover(root))
    search(spark, listed, query, work, 1, None, top_k, None, header_lines, radius, fp_size, kind=kind, resume=True, column=column, single_precision=True, progress=progress)
    best = written(best_ranked(shard_hits(spark, work, shard_metadata(spark, work)).drop("task_index"), top_k), "legacy-best")
    sinks.write_locators(best, output, DIGITS)
    return best.select("rank", "tanimoto", "archive_index", "source_file", "ligand_line")


def figures(best: DataFrame) -> DataFrame:
    """One line on a ranked list: hits, archives that hold them, best and last score."""
    score = lambda c: F.coalesce(sinks.fixed(c, DIGITS), F.lit("-"))
    parts: list[Column] = [sinks.grouped(F.count(F.lit(1))), sinks.grouped(F.count_distinct("archive_index")), score(F.max("tanimoto")), score(F.min("tanimoto"))]
    return best.agg(F.format_string("%s hits in %s archives, scores %s to %s", *parts).alias("line"))

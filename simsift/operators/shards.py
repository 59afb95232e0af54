"""Task slices, run metadata and the checks made before shards are merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What all shards of a run must agree on.
AGREED = ("task_count", "manifest_sha256", "manifest_archive_count", "query_smiles", "top_k", "min_tanimoto", "radius", "fp_size", "use_chirality", "header_lines")


def slices(archives: int, tasks: int, spark) -> DataFrame:
    """task_index (from 1), slice_start, slice_end: contiguous, near equal, together all archives."""
    if tasks < 1:
        raise ValueError("there must be a task")
    t = F.col("id")
    bound = lambda k: (F.lit(archives).cast("bigint") * k / F.lit(tasks)).cast("bigint")
    return spark.range(1, tasks + 1).select(t.alias("task_index"), bound(t - 1).alias("slice_start"), bound(t).alias("slice_end"))


def manifest_digest(manifest: DataFrame) -> DataFrame:
    """SHA-256 over every path and a line break, in manifest order."""
    ordered = F.array_sort(F.collect_list(F.struct("archive_index", "source_file")))
    paths = F.transform(ordered, lambda x: F.concat(x["source_file"], F.lit("\n")))
    return manifest.agg(F.sha2(F.array_join(paths, ""), 256).alias("manifest_sha256"), F.count(F.lit(1)).alias("manifest_archive_count"))


def agreement(meta: DataFrame, keys: tuple[str, ...] = AGREED) -> DataFrame:
    """key, n_values, agree: how many values each key has over the shards, null counted as a value."""
    values = [F.count_distinct(F.struct(F.coalesce(F.col(k).cast("string"), F.lit("")), F.col(k).isNull())).alias(k) for k in keys]
    row = meta.agg(*values)
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("n_values")) for k in keys])
    return row.select(F.inline(pairs)).withColumn("agree", F.col("n_values") <= 1)


def verified(meta: DataFrame, manifest: DataFrame, tasks: int) -> None:
    """Raises unless all tasks' metadata are there and agree with each other and with the manifest."""
    lost = [r["task_index"] for r in missing_tasks(meta, tasks).collect()]
    if lost:
        raise ValueError(f"no metadata of tasks {lost[:10]}")
    differing = [r["key"] for r in agreement(meta).where("NOT agree").collect()]
    if differing:
        raise ValueError(f"shards differ in {differing}")
    own, first = manifest_digest(manifest).first(), meta.select("task_count", "manifest_sha256", "manifest_archive_count").first()
    if first["task_count"] != tasks:
        raise ValueError(f"the shards are of {first['task_count']} tasks, not {tasks}")
    if (own["manifest_sha256"], own["manifest_archive_count"]) != (first["manifest_sha256"], first["manifest_archive_count"]):
        raise ValueError("the shards are of another manifest")


def missing_tasks(meta: DataFrame, tasks: int) -> DataFrame:
    """Task indexes in 1..tasks without metadata."""
    expected = meta.sparkSession.range(1, tasks + 1).select(F.col("id").alias("task_index"))
    return expected.join(meta.select(F.col("task_index").cast("bigint").alias("task_index")).distinct(), "task_index", "left_anti")


def final_k(worker_k: int, asked: int | None) -> int:
    """The merge's K: the workers' unless asked for less; more can't be exact."""
    k = worker_k if asked is None else asked
    if not 1 <= k <= worker_k:
        raise ValueError(f"K must lie in 1..{worker_k}")
    return k

"""The search job: a manifest of archives and a query in, hits and metadata of every shard out.

A shard is a slice of the manifest, its K best hits and its counts. The archives' stretches, small
ones packed together, are scanned once each, in waves: first as many as fill the cluster, then each
time twice as many as are done, in an order that takes all shards and all parts of them alike. A
task scores the lines of its stretch, counts them by block and writes what can still matter to one
file: the K best that reach the cutoff and the K-th best score of their shard so far, which is read
from the files before each wave. So what is written follows the hits, and a file says that its
stretch is done: a run that stopped goes on with the others.

Once all stretches are done, block counts give the hits their line numbers, and the shards' K best
and their metadata are published together (sources/shards.py).
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from simsift.functions import records, smiles
from simsift.functions.fingerprints import token_bits
from simsift.functions.similarity import word_tanimoto
from simsift.operators import search as ops
from simsift.sources import cxsmiles, manifest
from simsift.sources import shards as files
from simsift.sources.sinks import fixed, grouped
from simsift.space import kept_until_done

TOP_K, HEADER_LINES, RADIUS, FP_SIZE = 1_000_000, 1, 2, 2048
METADATA = (
    "task_index int, task_count int, manifest string, manifest_sha256 string, manifest_archive_count int, slice_start int, slice_end int, archive_count int, "
    "query_smiles string, top_k bigint, min_tanimoto double, radius int, fp_size int, use_chirality boolean, header_lines int, "
    "total_records bigint, valid_records bigint, passing_cutoff bigint, retained bigint, elapsed_seconds double, files array<string>"
)
HITS = "tanimoto double, archive_index int, source_file string, ligand_line bigint, block bigint, row int, task_index int"
LINE = ("archive_index", "source_file", "ligand_line")
#: Scores are counted by so many equal steps to find how good a hit must be.
STEPS = 1 << 16


def every_score(library: DataFrame, query: str, kind: str = "structure", radius: int = RADIUS, fp_size: int = FP_SIZE, use_chirality: bool = False, line: tuple[str, ...] = LINE, column: int = 0, single: bool = False) -> DataFrame:
    """The columns that name a line, and tanimoto, of every record, null where it isn't valid.

    kind "structure" takes circular fingerprints of a token, the first if no other column is named; "tokens" the
    hashed tokens of the whole record. single: scores are rounded to single precision.
    """
    if kind == "structure":
        asked = smiles.query_fingerprint(query, radius, fp_size, use_chirality)
        token = records.column_at(records.record_tokens(F.col("record")), column)
        rows = smiles.fingerprints(library.select(*line, token.alias("smiles")), "smiles", radius, fp_size, use_chirality)
        words = [F.get("words", F.lit(i)) for i in range(len(asked))]
        score: Column = F.when(F.col("popcount") > 0, word_tanimoto(words, asked, F.col("popcount")))
    elif kind == "tokens":
        row = library.sparkSession.range(1).select(token_bits(F.lit(query), fp_size).alias("b")).first()
        rows, score = library.withColumn("bits", token_bits(F.col("record"), fp_size)), ops.score_of(sorted(row["b"]))
    else:
        raise ValueError(f"no such fingerprint: {kind}")
    return rows.select(*line, (score.cast("float").cast("double") if single else score).alias("tanimoto"))


def _spread_order(n: int) -> list[int]:
    """0..n-1 so that any beginning is spread evenly: in order of their reversed bits."""
    bits = max(1, (n - 1).bit_length())
    return sorted(range(n), key=lambda k: int(f"{k:0{bits}b}"[::-1], 2))


def _begun(out: str, task: int, asked: dict, pack: int) -> int:
    """Notes what a shard's stretches are searched for and how many bytes a task reads; raises if it was something
    else before. The bytes that hold, those of the first call."""
    where, folder = manifest.opened(f"{out}/parts/task_index={task}")
    if where.get_file_info(f"{folder}/_search.json").type != manifest.fs.FileType.NotFound:
        with where.open_input_stream(f"{folder}/_search.json") as f:
            before = json.loads(f.read())
        if before["asked"] != asked:
            raise ValueError(f"{out} holds an unfinished search of task {task} with other arguments")
        return before["pack"]
    where.create_dir(folder, recursive=True)
    with where.open_output_stream(f"{folder}/_search.json") as f:
        f.write(json.dumps({"asked": asked, "pack": pack}).encode())
    return pack


def _parts(spark: SparkSession, out: str, tasks: list[int]) -> DataFrame:
    paths = [f"{out}/parts/task_index={t}" for t in tasks]
    return spark.read.schema(f"{files.PARTS}, task_index int").option("basePath", f"{out}/parts").parquet(*paths)


def _bounds(parts: DataFrame, k: int) -> dict[int, float]:
    """Of each shard that has K hits already: a score that its K-th best can't be below."""
    step = F.floor(F.col("tanimoto") * STEPS).alias("step")
    counts = parts.where(F.col("tanimoto").isNotNull()).groupBy("task_index", step).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(W.partitionBy("task_index").orderBy(F.desc("step")))
    reached = counts.withColumn("upto", upto).where(F.col("upto") >= k).groupBy("task_index").agg(F.max("step").alias("step"))
    return {r["task_index"]: r["step"] / STEPS for r in reached.collect()}  # a row a shard


def search(
    spark: SparkSession,
    manifest_file: str,
    query: str,
    out: str,
    task_count: int,
    tasks: list[int] | None = None,
    top_k: int = TOP_K,
    min_tanimoto: float | None = None,
    header_lines: int = HEADER_LINES,
    radius: int = RADIUS,
    fp_size: int = FP_SIZE,
    use_chirality: bool = False,
    kind: str = "structure",
    resume: bool = False,
    stretch_bytes: int = cxsmiles.STRETCH_BYTES,
    column: int = 0,
    single_precision: bool = False,
    progress: Callable[[str], None] | None = None,
) -> DataFrame:
    """Writes the shards of tasks (1-based, next to each other; all if None) to out; their metadata.

    Shards that an earlier call left unfinished are gone on with, stretch by stretch, if their arguments were
    the same. Finished ones are refused, or with resume left as they are. progress is told what is done after each
    wave.
    """
    ops.check_arguments(top_k, min_tanimoto)
    if fp_size < 64 or fp_size % 64 or radius < 0 or header_lines < 0:
        raise ValueError("fp_size must be a multiple of 64, radius and header_lines not negative")
    paths, began = manifest.read_manifest(manifest_file), time.monotonic()
    if not 1 <= task_count <= len(paths):
        raise ValueError(f"{task_count} tasks for {len(paths)} archives: every task needs an archive")
    asked = list(range(1, task_count + 1)) if tasks is None else sorted(set(tasks))
    if not asked or asked[0] < 1 or asked[-1] > task_count or asked[-1] - asked[0] + 1 != len(asked):
        raise ValueError(f"tasks must be numbers in 1..{task_count} next to each other")
    known = shard_metadata(spark, out)
    done = set() if known is None else {r["task_index"] for r in known.select("task_index").collect()}
    if done & set(asked) and not resume:
        raise FileExistsError(f"{out} has some of these tasks already")
    tasks = [t for t in asked if t not in done]
    values = {
        "task_count": task_count,
        "manifest": manifest_file,
        "manifest_sha256": hashlib.sha256("".join(f"{p}\n" for p in paths).encode()).hexdigest(),
        "manifest_archive_count": len(paths),
        "query_smiles": query,
        "top_k": top_k,
        "min_tanimoto": min_tanimoto,
        "radius": radius,
        "fp_size": fp_size,
        "use_chirality": use_chirality,
        "header_lines": header_lines,
    }
    slices = {t: (len(paths) * (t - 1) // task_count, len(paths) * t // task_count) for t in tasks}

    def scores(plan: list[list[cxsmiles.Stretch]]) -> DataFrame:
        return every_score(cxsmiles.scan(spark, plan), query, kind, radius, fp_size, use_chirality, ("archive_index", "block", "row"), column, single_precision)

    scores([])  # an argument that is none is refused before anything is written
    with kept_until_done(spark):
        plans = {t: cxsmiles.stretches(paths[a:b], header_lines, a, stretch_bytes) for t, (a, b) in slices.items()}
        pack = cxsmiles.pack_bytes(spark, [s for plan in plans.values() for s in plan], stretch_bytes)
        asked_for = {**values, "kind": kind, "stretch_bytes": stretch_bytes, "column": column, "single_precision": single_precision}
        packs = {t: cxsmiles.packed(plan, _begun(out, t, asked_for, pack)) for t, plan in plans.items()}
        _scan(spark, out, packs, scores, top_k, min_tanimoto, progress or (lambda text: None))
        if tasks:
            _publish(spark, out, paths, slices, values, began)
    return shard_metadata(spark, out).where(F.col("task_index").isin(asked))


def _scan(spark: SparkSession, out: str, plans: dict[int, list[list]], scores, top_k: int, cutoff: float | None, progress: Callable[[str], None]) -> None:
    """Scans the packs of stretches that aren't done, in waves."""
    spark.dataSource.register(files.StretchSink)
    ready = {t: files.finished(out, t) for t in plans}
    left = {t: [plan[k] for k in _spread_order(len(plan)) if files.part_name(plan[k]) not in ready[t]] for t, plan in plans.items()}
    todo = [(place / len(own), t, pack) for t, own in left.items() for place, pack in enumerate(own)]
    todo.sort(key=lambda x: x[:2])
    scanned, size = sum(map(len, ready.values())), 2 * spark.sparkContext.defaultParallelism
    while todo:
        wave, todo = todo[:size], todo[size:]
        bounds = _bounds(_parts(spark, out, list(plans)), top_k) if scanned else {}
        options = {
            "out": out,
            "top_k": top_k,
            "cutoff": json.dumps(cutoff),
            "bounds": json.dumps(bounds),
            "todo": json.dumps([[t, files.part_name(pack), files.spans(pack)] for _, t, pack in wave]),
        }
        scores([pack for _, _, pack in wave]).write.format("stretches").options(**options).mode("append").save()
        scanned += len(wave)
        progress(f"{scanned:,} of {scanned + len(todo):,} parts of {len(plans):,} tasks are searched")
        size = max(size, 2 * scanned)
    ready = {t: files.finished(out, t) for t in plans}
    if lost := [files.part_name(pack) for t, plan in plans.items() for pack in plan if files.part_name(pack) not in ready[t]]:
        raise ValueError(f"stretches {lost[:10]} have no result")


def _publish(spark: SparkSession, out: str, paths: list[str], slices: dict[int, tuple[int, int]], values: dict, began: float) -> None:
    """From the stretches' files to the shards' hits and metadata."""
    tasks, top_k = list(slices), values["top_k"]
    parts = _parts(spark, out, tasks)
    blocks = parts.where(F.col("lines").isNotNull()).withColumnRenamed("row", "first_row")
    shift = cxsmiles.numbered(blocks).select("archive_index", "block", "shift")
    hits = parts.where(F.col("tanimoto").isNotNull()).select("tanimoto", "archive_index", "block", "row", "task_index")
    hits = hits.join(shift, ["archive_index", "block"]).withColumn("ligand_line", F.col("row") + F.col("shift"))
    best = ops.top_in_groups(hits.drop("shift"), top_k, "task_index").drop("group_rank")
    best = best.join(manifest.manifest_frame(spark, paths), "archive_index").select(*[x.split()[0] for x in HITS.split(", ")])

    archives = blocks.groupBy("archive_index").agg(F.sum("lines").alias("records"), F.sum("valid").alias("valid"), F.sum("passing").alias("passing_cutoff"))
    archives = archives.withColumn("retained", F.least("passing_cutoff", F.lit(top_k)))
    counts = {r["task_index"]: r for r in ops.shard_counts(archives, len(paths), values["task_count"], top_k).collect()}  # a row a shard
    names = ("total_records", "valid_records", "passing_cutoff", "retained")
    rows = []
    for t, (a, b) in slices.items():
        own = {n: counts[t][n] if t in counts else 0 for n in names}
        rows.append({"task_index": t, "slice_start": a, "slice_end": b, "archive_count": b - a, **values, **own, "elapsed_seconds": time.monotonic() - began})
    spark.dataSource.register(files.ShardSink)
    ready = best.repartition("task_index").sortWithinPartitions("task_index")
    ready.write.format("shards").options(out=out, metadata=json.dumps(rows)).mode("append").save()
    for t in tasks:
        where, folder = manifest.opened(f"{out}/parts/task_index={t}")
        where.delete_dir(folder)


def shard_metadata(spark: SparkSession, out: str) -> DataFrame | None:
    """The metadata that out holds, None without any."""
    where, path = manifest.opened(f"{out}/metadata")
    found = [x for x in where.get_file_info(manifest.fs.FileSelector(path, allow_not_found=True)) if x.base_name[0] not in "._"]
    return spark.read.schema(METADATA).json(f"{out}/metadata") if found else None


def shard_hits(spark: SparkSession, out: str, metadata: DataFrame) -> DataFrame:
    """The hits of the shards; raises unless each has as many as its metadata says."""
    named = [(r["task_index"], f) for r in metadata.select("task_index", "files").collect() for f in r["files"] or ()]  # some files a shard
    lost = sorted({t for t, f in named if manifest.opened(f)[0].get_file_info(manifest.opened(f)[1]).type == manifest.fs.FileType.NotFound})
    there = [f for t, f in named if t not in lost]
    hits = spark.read.schema(HITS).option("basePath", f"{out}/hits").parquet(*there) if there else spark.createDataFrame([], HITS)
    found = hits.groupBy("task_index").agg(F.count(F.lit(1)).alias("n"))
    odd = metadata.join(found, "task_index", "left").where(F.coalesce("n", F.lit(0)) != F.col("retained"))
    if lost := lost or [r["task_index"] for r in odd.select("task_index").limit(10).collect()]:
        raise ValueError(f"results of tasks {lost[:10]} are missing or incomplete")
    return hits


def summary(metadata: DataFrame) -> DataFrame:
    """task_index, line: what a run prints of each shard, numbers with thousands separators."""
    share = ops.passing_percent(F.col("passing_cutoff"), F.col("valid_records"))
    text = F.format_string(
        "%s archives, %s records, %s valid, %s passing (%s%%), %s retained, %s s, %s records/s",
        *[grouped(F.col(c)) for c in ("archive_count", "total_records", "valid_records", "passing_cutoff")],
        fixed(share, 6),
        grouped(F.col("retained")),
        fixed(F.col("elapsed_seconds"), 3),
        fixed(ops.rate(F.col("total_records"), F.col("elapsed_seconds")), 2),
    )
    return metadata.select("task_index", text.alias("line"))

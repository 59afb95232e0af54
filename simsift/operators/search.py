"""Exact similarity search: score a library against a query, keep the global top K, count what was seen.

A library is a DataFrame of archive_index int, source_file string, ligand_line bigint, record
string and a fingerprint: bits array<int>, or words array<bigint> with popcount int. Ranks follow
one total order: score descending, then archive, then line. An empty fingerprint is no valid record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from simsift.functions.fingerprints import BITS, token_bits
from simsift.functions.similarity import popcount_bounds, set_tanimoto, word_tanimoto
from simsift.space import written

HIT = ("tanimoto", "archive_index", "ligand_line")
ORDER = (F.desc, F.asc, F.asc)
#: K up to which a task's K best rows may go to one task; K of a group up to which the planner limits groups.
SMALL_K, GROUP_LIMIT = 10_000, 1000
#: Lines of an archive that one task may sort are 2 to this power.
RUN_BITS = 16


def hit_order() -> list[Column]:
    return [by(name) for by, name in zip(ORDER, HIT)]


def check_arguments(top_k: int | None = None, cutoff: float | None = None) -> None:
    if top_k is not None and top_k < 1:
        raise ValueError("top_k must be at least 1")
    if cutoff is not None and not 0 <= cutoff <= 1:
        raise ValueError("the cutoff must lie in 0..1")


def manifest_of(records: DataFrame, archive: str) -> DataFrame:
    """archive_index, source_file: the distinct archives in order of their names (null last), numbered from 0."""
    names = records.select(F.col(archive).alias("source_file")).distinct()
    index = F.row_number().over(W.orderBy(F.asc_nulls_last("source_file"))) - 1
    return names.select(index.cast("int").alias("archive_index"), "source_file")


def with_archive_index(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """records(source_file, ..) with archive_index; a null source_file is an archive like others."""
    names = manifest.select("archive_index", F.col("source_file").alias("_source"))
    return records.join(names, F.col("source_file").eqNullSafe(F.col("_source"))).drop("_source")


def document_library(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """Documents as a library: a source is an archive, doc_id the line, the tokens the fingerprint."""
    rows = docs.select(
        F.col("source").alias("source_file"), F.col("doc_id").alias("ligand_line"), F.col("text").alias("record"), token_bits(F.col("text"), bits).alias("bits")
    )
    return with_archive_index(rows, manifest_of(docs, "source"))


def query_bits(docs: DataFrame, doc_id: int = 0, bits: int = BITS) -> list[int]:
    """The query's bit positions: one row, as a query is a constant of a search. Without that row,
    as in an empty table, an empty fingerprint, which no valid record resembles."""
    row = docs.where(F.col("doc_id") == doc_id).select(token_bits(F.col("text"), bits).alias("b")).first()
    return sorted(row["b"]) if row is not None else []


def _kept(score: Column, cutoff: float | None, strict: bool, kind: str = "double") -> Column:
    """The score as a row of its own if it is one and passes. Filters can't be moved below a generator,
    so a fingerprint and its score are computed once a record."""
    check_arguments(cutoff=cutoff)
    limit = F.lit(cutoff).cast(kind)
    passes = lambda s: s.isNotNull() if cutoff is None else s > limit if strict else s >= limit
    return F.explode(F.filter(F.array(score.cast(kind)), passes)).alias("tanimoto")


def score_of(query: list[int]) -> Column:
    """Of bits; null for an empty fingerprint."""
    return F.get(F.transform(F.array("bits"), lambda b: F.when(F.size(b) > 0, set_tanimoto(b, query))), F.lit(0))


def scored(library: DataFrame, query: list[int], single_precision: bool = False, cutoff: float | None = None, strict: bool = False) -> DataFrame:
    """Valid records with their score, those at (strict: above) the cutoff if there is one; only the
    locator is kept, records are recovered later."""
    kept = _kept(score_of(query), cutoff, strict, "float" if single_precision else "double")
    return library.select(kept, "archive_index", "source_file", "ligand_line")


def scored_packed(library: DataFrame, query: list[int], cutoff: float | None = None, more: tuple[str, ...] = ()) -> DataFrame:
    """As scored, of packed words: bit counts in generated code. The bound that a cutoff sets to
    popcount goes to the scan. more columns are kept beside the locator."""
    words = [F.get("words", F.lit(i)) for i in range(len(query))]
    low, high = popcount_bounds(sum((q & (1 << 64) - 1).bit_count() for q in query), cutoff or 0.0)
    near = library.where(F.col("popcount").between(max(1, low), min(high, 1 << 30)))
    return near.select(_kept(word_tanimoto(words, query, F.col("popcount")), cutoff, False), "archive_index", "source_file", "ligand_line", *more)


def above(hits: DataFrame, cutoff: float | None, strict: bool = False) -> DataFrame:
    """Of hits that are stored; scored has a cutoff of its own."""
    check_arguments(cutoff=cutoff)
    if cutoff is None:
        return hits
    return hits.where(F.col("tanimoto") > cutoff if strict else F.col("tanimoto") >= cutoff)


def top(hits: DataFrame, k: int) -> DataFrame:
    """The K best in order. A small K is cut in each task and then in one; a large one by counts."""
    check_arguments(top_k=k)
    if k <= SMALL_K:
        return hits.orderBy(*hit_order()).limit(k)
    return first_k(written(hits, "hits"), k).orderBy(*hit_order())


def _split(rows: DataFrame, groups: list[str], key: str, best_first: bool, left: DataFrame | int) -> tuple[DataFrame, DataFrame]:
    """Rows that are among the first `left` of their group by key whatever comes after key, and rows
    of the key at which the group's count passes `left` (with _left, how many of these)."""
    counts = rows.groupBy(*groups, key).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_left", F.lit(left).cast("bigint")) if isinstance(left, int) else counts.join(left, groups)
    over = W.partitionBy(*groups).orderBy(F.desc(key) if best_first else F.asc(key))
    before = F.col("_upto") - F.col("_n")
    counts = counts.withColumn("_upto", F.sum("_n").over(over)).where((before < F.col("_left")) & (F.col("_upto") >= F.col("_left")))
    edges = counts.select(*groups, F.col(key).alias("_edge"), (F.col("_left") - before).alias("_left"))
    edges = F.broadcast(edges) if groups == ["_all"] else edges  # one row
    met = rows.join(edges, groups, "left")
    better = F.col(key) > F.col("_edge") if best_first else F.col(key) < F.col("_edge")
    sure = met.where(F.col("_edge").isNull() | better).drop("_edge", "_left")
    return sure, met.where(F.col(key) == F.col("_edge")).drop("_edge")


def first_k(hits: DataFrame, k: int, *groups: str) -> DataFrame:
    """The K best of all or of each group, in no order, for any K. hits is read several times: a
    written table.

    Scores are fractions of small integers, so counts by score are few. They tell at which score K
    is passed; rows above it stay without being sorted. Of the rows at that score, counts by archive
    and run of lines tell in which run K is passed, and only that run's rows are sorted.
    """
    check_arguments(top_k=k)
    by = list(groups) or ["_all"]
    run = F.struct("archive_index", F.shiftright("ligand_line", RUN_BITS).alias("run"))
    rows = hits if groups else hits.withColumn("_all", F.lit(0))
    sure, ties = _split(rows, by, "tanimoto", True, k)
    left = ties.select(*by, "_left").distinct()
    left = F.broadcast(left) if not groups else left
    early, last = _split(ties.drop("_left").withColumn("_run", run), by, "_run", False, left)
    number = F.row_number().over(W.partitionBy(*by).orderBy(*hit_order()))
    last = last.withColumn("_no", number).where(F.col("_no") <= F.col("_left"))
    names = hits.columns
    return sure.select(names).unionByName(early.select(names)).unionByName(last.select(names))


def ranked(hits: DataFrame, start: int = 1) -> DataFrame:
    """rank over hits that a limit has bounded."""
    return hits.withColumn("rank", (F.row_number().over(W.orderBy(*hit_order())) + (start - 1)).cast("bigint"))


def ranked_by_ranges(hits: DataFrame) -> DataFrame:
    """As ranked, for any number of hits: ranges of the order are numbered side by side, each from the
    number of hits in the ranges before it."""
    placed = hits.repartitionByRange(*hit_order()).withColumn("_range", F.spark_partition_id())
    placed = written(placed, "ranges")
    before = F.coalesce(F.sum("n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).select("_range", before.alias("_before"))  # a row a range
    number = F.row_number().over(W.partitionBy("_range").orderBy(*hit_order()))
    rows = placed.join(F.broadcast(counts), "_range").withColumn("rank", (F.col("_before") + number).cast("bigint"))
    return rows.drop("_range", "_before")


def best_ranked(hits: DataFrame, k: int) -> DataFrame:
    """The K best with their ranks, in no order: in one task for a small K, in many for a large one."""
    check_arguments(top_k=k)
    return ranked(top(hits, k)) if k <= SMALL_K else ranked_by_ranges(first_k(written(hits, "hits"), k))


def top_in_groups(hits: DataFrame, k: int, *groups: str) -> DataFrame:
    """The K best of each group, with their rank in it. Up to GROUP_LIMIT the planner keeps K rows a
    task and group before the shuffle; a larger K is cut by counts first. So a hot group reaches the
    window as K rows (a task)."""
    check_arguments(top_k=k)
    hits = hits if k <= GROUP_LIMIT else first_k(written(hits, "group-hits"), k, *groups)
    rank = F.row_number().over(W.partitionBy(*groups).orderBy(*hit_order()))
    return hits.withColumn("group_rank", rank).where(F.col("group_rank") <= k)


def task_of(index: Column, archives: Column, tasks: int) -> Column:
    """The 1-based task whose slice [n*(t-1) div c, n*t div c) holds the archive."""
    return ((F.lit(tasks).cast("bigint") * (index + 1) - 1) / archives).cast("bigint") + 1


def top_by_levels(hits: DataFrame, archives: int, k: int, tasks: int) -> DataFrame:
    """The K best by way of archive and shard lists; the same rows as `top`."""
    per_archive = top_in_groups(hits, k, "archive_index").drop("group_rank")
    shards = per_archive.withColumn("task_index", task_of(F.col("archive_index"), F.lit(archives), tasks))
    return top(top_in_groups(shards, k, "task_index").select("tanimoto", "archive_index", "source_file", "ligand_line"), k)


def archive_counts(scores: DataFrame, cutoff: float | None, k: int) -> DataFrame:
    """records, valid, passing_cutoff, retained of each archive of scores(archive_index, tanimoto),
    every record's, null if it isn't valid."""
    score = F.col("tanimoto")
    passing = score.isNotNull() if cutoff is None else score >= cutoff
    counts = scores.groupBy("archive_index").agg(F.count(F.lit(1)).alias("records"), F.count(score).alias("valid"), F.count_if(passing).alias("passing_cutoff"))
    return counts.withColumn("retained", F.least("passing_cutoff", F.lit(k).cast("bigint")))


def shard_counts(archives: DataFrame, total_archives: int, tasks: int, k: int) -> DataFrame:
    """Sums of archive counts by task, and the share of valid records that pass."""
    task = task_of(F.col("archive_index"), F.lit(total_archives), tasks)
    sums = archives.groupBy(task.alias("task_index")).agg(
        F.count(F.lit(1)).alias("archive_count"),
        F.sum("records").alias("total_records"),
        F.sum("valid").alias("valid_records"),
        F.sum("passing_cutoff").alias("passing_cutoff"),
        F.least(F.sum("retained"), F.lit(k).cast("bigint")).alias("retained"),
    )
    return sums.withColumn("passing_percent", passing_percent(F.col("passing_cutoff"), F.col("valid_records")))


def passing_percent(passing: Column, valid: Column) -> Column:
    return F.when(valid > 0, 100.0 * passing / valid).otherwise(F.lit(0.0))


def rate(records: Column, seconds: Column) -> Column:
    """Records a second, 0 for a run that took no time."""
    return F.when(seconds > 0, records / seconds).otherwise(F.lit(0.0))

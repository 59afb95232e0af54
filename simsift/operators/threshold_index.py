"""An index of fingerprints for searches with a cutoff, which look at candidates only.

    path/postings    rank, popcount, archive_index, ligand_line of each fingerprint's rarest bits
    path/stored      archive_index, source_file, ligand_line, words, popcount

Bits are ranked from rare to common. Two sets that share at least m bits share one among the s - m + 1
rarest of each, and a coefficient of t means m >= t * s for both. So a fingerprint is filed under its
s - ceil(least * s) + 1 rarest bits, and a query with a cutoff of at least `least` meets all that can
reach it under its own rarest bits. Postings lie in order of rank and popcount, fingerprints in
order of archive and line: row groups and pages that a search doesn't need aren't read.

A bit that a third of all records have is among the last ranks, and few records are filed under it.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simsift.functions.fingerprints import BITS, packed, query_words
from simsift.functions.similarity import popcount_bounds
from simsift.operators.search import check_arguments, scored_packed
from simsift.sources.manifest import opened
from simsift.space import written

KEY = ["archive_index", "ligand_line"]
#: Up to so many candidate lines go to the scan as values that prune pages.
FEW = 1_000
EPSILON = 1e-9


def _rarest(size: int, cutoff: float) -> int:
    return size - math.ceil(cutoff * size - EPSILON) + 1


def build(library: DataFrame, path: str, least: float, bits: int = BITS) -> None:
    """Writes the index of library(archive_index, source_file, ligand_line, bits) for cutoffs of at least `least`.
    Records without a bit are left out."""
    check_arguments(cutoff=least)
    if not least > 0:
        raise ValueError("the least cutoff must be above 0")
    library = library.where(F.size("bits") > 0).select("archive_index", "source_file", "ligand_line", "bits")
    packed(library, bits).repartitionByRange(*KEY).sortWithinPartitions(*KEY).write.parquet(f"{path}/stored")
    seen = {r["bit"]: r["count"] for r in library.select(F.explode("bits").alias("bit")).groupBy("bit").count().collect()}  # a row a bit
    order = sorted(range(bits), key=lambda b: (seen.get(b, 0), b))
    rank = [0] * bits
    for place, bit in enumerate(order):
        rank[bit] = place
    table = F.lit(rank)
    size = F.size("bits")
    held = size - F.ceil(size * F.lit(float(least)) - F.lit(EPSILON)).cast("int") + 1
    rare = F.slice(F.array_sort(F.transform("bits", lambda b: F.get(table, b))), F.lit(1), held)
    postings = library.select(F.explode(rare).alias("rank"), size.alias("popcount"), *KEY)
    postings.repartitionByRange("rank", "popcount", *KEY).sortWithinPartitions("rank", "popcount").write.parquet(f"{path}/postings")
    where, root = opened(path)
    with where.open_output_stream(f"{root}/_index.json") as f:
        f.write(json.dumps({"least": least, "bits": bits, "rank": rank}).encode())


def candidates(spark: SparkSession, path: str, query: list[int], cutoff: float) -> DataFrame:
    """archive_index, ligand_line of all records that can reach the cutoff, and few others."""
    where, root = opened(path)
    with where.open_input_stream(f"{root}/_index.json") as f:
        index = json.loads(f.read())
    if cutoff < index["least"]:
        raise ValueError(f"the index is for cutoffs of {index['least']} and more")
    check_arguments(cutoff=cutoff)
    rare = sorted(index["rank"][b] for b in set(query))[: _rarest(len(set(query)), cutoff)] if query else []
    low, high = popcount_bounds(len(set(query)), cutoff)
    postings = spark.read.parquet(f"{path}/postings").where(F.col("rank").isin(rare) & F.col("popcount").between(low, min(high, 1 << 30)))
    return postings.select(*KEY).distinct()


def search(spark: SparkSession, path: str, query: list[int], cutoff: float) -> DataFrame:
    """tanimoto, archive_index, source_file, ligand_line of all records at or above the cutoff."""
    found = written(candidates(spark, path, query, cutoff), "candidates")
    stored = spark.read.parquet(f"{path}/stored")
    lines = [r["ligand_line"] for r in found.select("ligand_line").distinct().limit(FEW + 1).collect()]
    if len(lines) <= FEW:
        stored = stored.where(F.col("ligand_line").isin(lines))
    with opened(path)[0].open_input_stream(f"{opened(path)[1]}/_index.json") as f:
        size = json.loads(f.read())["bits"]
    return scored_packed(stored.join(found, KEY, "left_semi"), query_words(sorted(set(query)), size), cutoff)

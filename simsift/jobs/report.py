"""The report job: the pipeline's CSV in, counts and a sampled gallery by score bracket out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simsift.operators import brackets
from simsift.sources import sinks
from simsift.space import written


def report(spark: SparkSession, csv: str, out: str, header: bool = False, seed: int = brackets.SEED, ranges: list | None = None) -> DataFrame:
    """Writes out/brackets and out/gallery as CSV with headers; the gallery.

    Hits that are the query itself (score 1), rows without a structure or a score are left out; a
    hit's place in the draw follows from the seed, its name and its archive.
    """
    rows = sinks.read_pipeline(spark, csv, header).withColumn("key", F.concat_ws("|", "ligand_name", "source_file"))
    rows = written(rows, "report-rows")
    brackets.counts(rows, ranges).orderBy("bracket").coalesce(1).write.option("header", True).csv(f"{out}/brackets")
    picks = written(brackets.gallery(rows, "key", ranges, seed=seed, more=("smiles", "ligand_name")), "gallery")
    picks.orderBy("bracket", "slot").coalesce(1).write.option("header", True).csv(f"{out}/gallery")
    return picks

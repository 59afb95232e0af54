"""Hits by score bracket: counts, reproducible samples, and a gallery of fixed shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Half-open score ranges, best first.
BRACKETS = [(0.95, 1.0), (0.90, 0.95), (0.85, 0.90), (0.80, 0.85), (0.75, 0.80), (0.70, 0.75), (0.65, 0.70), (0.60, 0.65)]
SEED, SAMPLE = 42, 5


def bracket_table(spark: SparkSession, brackets=None) -> DataFrame:
    """bracket (from 0), low, high, label."""
    rows = [(i, float(a), float(b), f"{a:.2f} – <{b:.2f}") for i, (a, b) in enumerate(brackets or BRACKETS)]
    return spark.createDataFrame(rows, "bracket int, low double, high double, label string")


def bracketed(hits: DataFrame, brackets=None) -> DataFrame:
    """Hits below 1 that fall in a bracket, with its number: an expression, so no join and no shuffle."""
    bracket = F.lit(None).cast("int")
    for i, (low, high) in reversed(list(enumerate(brackets or BRACKETS))):
        bracket = F.when((F.col("tanimoto") >= low) & (F.col("tanimoto") < high), F.lit(i)).otherwise(bracket)
    return hits.where(F.col("tanimoto") < 1.0).withColumn("bracket", bracket).where(F.col("bracket").isNotNull())


def counts(hits: DataFrame, brackets=None) -> DataFrame:
    """Hits of every bracket, empty ones too."""
    table = bracket_table(hits.sparkSession, brackets)
    seen = bracketed(hits, brackets).groupBy("bracket").agg(F.count(F.lit(1)).alias("n"))
    return table.join(seen, "bracket", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def sample(hits: DataFrame, key: str, brackets=None, n: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """Up to n hits of each bracket, chosen by a hash of seed and key, then numbered best first.
    Whichever rows a bracket holds, other brackets' picks don't change."""
    place = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    picks = bracketed(hits, brackets).withColumn("_place", place)
    chosen = F.row_number().over(W.partitionBy("bracket").orderBy("_place", key))
    picks = picks.withColumn("_n", chosen).where(F.col("_n") <= n)
    slot = F.row_number().over(W.partitionBy("bracket").orderBy(F.desc("tanimoto"), key))
    return picks.withColumn("slot", slot).drop("_place", "_n")


def gallery(hits: DataFrame, key: str, brackets=None, n: int = SAMPLE, seed: int = SEED, more: tuple[str, ...] = ()) -> DataFrame:
    """n slots for each bracket with the key, score and more columns of its pick; those without one
    are placeholders."""
    table = bracket_table(hits.sparkSession, brackets).select("bracket", "label", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("slot"))
    picks = sample(hits, key, brackets, n, seed).select("bracket", "slot", key, *more, "tanimoto")
    return table.join(picks, ["bracket", "slot"], "left").withColumn("is_placeholder", F.col("tanimoto").isNull())

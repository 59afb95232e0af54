"""Mixing sources to target weights by weighted fair queueing.

Each document of each source gets a place in its source's shuffled order; its virtual finish time
is the words of its source up to and with it, divided by the source's target. Where a target
exceeds its source, the source repeats in the same order, up to max_repeats times. The documents
of all sources in order of finish time, cut at the total budget, are the mix.

Both running sums (words in a source, words in the global order) are taken in levels: sums of small
buckets of the order, sums of SPREAD buckets each, a running sum over these, one within each of
them, and one within each bucket that starts at its bucket's offset. So no source, however large, is
one task's work, and the longest list that a task sums is one of rows / (BUCKET_ROWS * SPREAD).

Defined cases: a null text has size 0; a null source is a source of its own, last in order;
rows that repeat a doc_id are placed by their texts' hashes, and equal rows (doc_id and text) are
interchangeable and share a bucket; documents of size 0 take no words and are outside the queue,
each taken once; an empty table, or one without words, gives targets of 0; other columns are ignored
by `mix` and carried by `mixed`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from simsift.llm._space import written

WORD = r"[^\x20\x09-\x0D]+"
#: Documents a bucket of the two-step running sums holds on average.
BUCKET_ROWS, SPREAD = 500, 1000


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, max_repeats: int = 3, weight_cycle: int = 3) -> DataFrame:
    """source, source_size, source_docs, target, source_rank of docs(source, size).

    Sources in code point order (null last) weigh 1, 2, .. weight_cycle, repeating. Targets share
    the sum of all sizes by weight; none exceeds max_repeats times its source's size, and what it
    leaves is shared again by weight. A source is capped if the level (target a unit of weight)
    reaches its own limit, and limits in ascending order are passed one after another, so the
    level is the first that lies within the next limit: two running sums over the list of sources.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    per = per.withColumn("source_rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    per = per.withColumn("weight", ((F.col("source_rank") - 1) % weight_cycle + 1).cast("long"))
    per = per.withColumn("cap", F.col("source_size") * max_repeats).withColumn("limit", F.col("cap") / F.col("weight"))
    before = W.orderBy("limit", "source_rank").rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumns(
        {
            "total": F.sum("source_size").over(W.partitionBy()),
            "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weight_left": F.sum("weight").over(W.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    per = per.withColumn("level", (F.col("total") - F.col("cap_before")) / F.col("weight_left"))
    per = per.withColumn("fits", F.col("level") <= F.col("limit"))
    per = per.withColumn("final", F.min(F.when(F.col("fits"), F.struct("limit", "source_rank", "level"))).over(W.partitionBy()))
    capped = F.struct("limit", "source_rank") < F.struct(F.col("final.limit"), F.col("final.source_rank"))
    target = F.when(capped, F.col("cap").cast("double")).otherwise(F.col("final.level") * F.col("weight"))
    return per.select("source", "source_size", "source_docs", target.alias("target"), "source_rank")


def _offsets(sums: DataFrame, group: list[str], bucket: str) -> DataFrame:
    """sums(group, bucket, _sum) with _offset: the sums of all earlier buckets of the group."""
    sums = sums.withColumn("_coarse", F.floor(F.col(bucket) / SPREAD))
    upper = sums.groupBy(*group, "_coarse").agg(F.sum("_sum").alias("_upper"))
    ahead = W.partitionBy(*group).orderBy("_coarse").rowsBetween(W.unboundedPreceding, -1)
    upper = upper.withColumn("_before", F.coalesce(F.sum("_upper").over(ahead), F.lit(0))).drop("_upper")
    inside = W.partitionBy(*group, "_coarse").orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("_inside", F.coalesce(F.sum("_sum").over(inside), F.lit(0)))
    return sums.join(upper, [*group, "_coarse"]).withColumn("_offset", F.col("_before") + F.col("_inside")).select(*group, bucket, "_offset")


def _running(df: DataFrame, group: list[str], bucket: str, order: list, value: str, out: str) -> DataFrame:
    """df (a written table) with out: the sum of value up to and with each row, over group, in
    order of bucket and then of order."""
    keys = [*group, bucket]
    sums = _offsets(df.groupBy(*keys).agg(F.sum(value).alias("_sum")), group, bucket)
    within = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    df = df.withColumn("_within", F.sum(value).over(within)).join(sums, keys)
    return df.withColumn(out, F.col("_offset") + F.col("_within")).drop("_within", "_offset")


def mix(docs: DataFrame, max_repeats: int = 3, weight_cycle: int = 3, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, copies, taken of every row of docs(doc_id, text, source)."""
    order_hash = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.xxhash64("text").cast("string")))
    sizes = written(
        docs.select(
            "doc_id",
            "source",
            words_in(F.col("text")).alias("size"),
            order_hash.alias("place"),
            F.xxhash64("text").alias("tie"),
        ),
        "mix-sizes",
    )
    targets = written(source_targets(sizes, max_repeats, weight_cycle).coalesce(1), "mix-targets")
    joined = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    # The first 32 bits of the place are uniform, so equal ranges of them hold equal shares.
    share = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    buckets = F.ceil(F.col("source_docs") / BUCKET_ROWS)
    placed = written(joined.withColumn("bucket", F.floor(share * buckets / F.lit(1 << 32))).drop("source"), "mix-placed")
    order = ["place", "doc_id", "tie", "size"]
    queued = _running(placed.where("size > 0"), ["source_rank"], "bucket", order, "size", "upto")
    # One item a repeat that starts before the target.
    last = F.least(F.lit(max_repeats - 1), F.floor(F.col("target") / F.col("source_size"))).cast("int")
    items = queued.withColumn("repeat", F.explode(F.sequence(F.lit(0), last)))
    total = F.col("upto") + F.col("repeat") * F.col("source_size")
    items = items.withColumn("finish", total / F.col("target"))
    # Finish times to the cut are uniform in 0..1; what ends far beyond it is one bucket that is never summed.
    n = placed.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("budget")).collect()[0]
    slots = max(1, -(-n["n"] // BUCKET_ROWS))
    items = items.where(total - F.col("size") <= F.col("target"))
    items = items.withColumn("slot", F.floor(F.least("finish", F.lit(2.0)) * slots))
    items = written(items, "mix-items").withColumn("_all", F.lit(0))
    cut = _running(items, ["_all"], "slot", ["finish", "source_rank", "repeat", *order], "size", "mixed")
    cut = cut.where(F.col("mixed") <= F.lit(n["budget"] or 0))
    taken = cut.groupBy("source_rank", "place", "doc_id", "tie", "size").agg(F.count(F.lit(1)).alias("_n"))
    # Equal rows share a key: each gets its share of the repeats taken.
    return _shared(placed, taken)


def _shared(placed: DataFrame, taken: DataFrame) -> DataFrame:
    key = ["source_rank", "place", "doc_id", "tie", "size"]
    # place and tie name the row; rows that share them are told apart by number.
    none = placed.where("size = 0").withColumns({"copies": F.lit(1).cast("bigint"), "taken": F.lit(0).cast("bigint")})
    numbered = placed.where("size > 0").withColumn("_no", F.row_number().over(W.partitionBy(*key).orderBy(F.lit(0))))
    numbered = numbered.withColumn("_of", F.count(F.lit(1)).over(W.partitionBy(*key)))
    names = {k: f"_{k}" for k in key}
    taken = taken.select(*[F.col(k).alias(v) for k, v in names.items()], "_n")
    met = numbered.join(taken, [F.col(k).eqNullSafe(F.col(v)) for k, v in names.items()], "left")
    n = F.coalesce(F.col("_n"), F.lit(0))
    copies = F.floor(n / F.col("_of")) + (F.col("_no") <= n % F.col("_of")).cast("long")
    names = ["doc_id", "tie", "size", "source_size", "target", "copies", "taken"]
    return met.withColumns({"copies": copies, "taken": copies * F.col("size")}).select(names).unionByName(none.select(names))


def mixed(docs: DataFrame, **params) -> DataFrame:
    """The rows of docs that the mix takes, each as often as it is taken, with all their columns."""
    got = mix(docs, **params).groupBy("doc_id", "tie").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    got = written(got.where("copies > 0"), "mix-copies")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"))
    met = rows.join(got, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("tie")))
    number = F.lit(1)
    if not got.where("rows > 1").isEmpty():
        number = F.row_number().over(W.partitionBy("d", "h").orderBy(F.lit(0)))
    met = met.withColumn("own", F.floor(F.col("copies") / F.col("rows")) + (number <= F.col("copies") % F.col("rows")).cast("long"))
    met = met.where("own > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("own").cast("int"))))
    return met.select("row.*")

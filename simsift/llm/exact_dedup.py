"""Exact duplicates by a 128-bit content hash, with the bytes compared inside each group.

Hashes are counted first, 16 bytes a row. Only rows of hashes that occur more than once are compared, by
the least and the greatest text of the group; only if these two differ (a hash collision) are the
group's rows grouped by the text itself. Where the hashes that occur more than once can be broadcast, texts
stay where they are and are aggregated before the shuffle. Where they can't, texts meet them by hash and
salt: a hash of over HOT rows has a salt for each HOT of them, so the tasks of a hot text are many and
none has much more than HOT rows of it. Such hashes are at most the rows / HOT.

Defined cases: a null text counts as empty; rows with a null doc_id take part, and a group of
nothing else has a null keep_id; of rows that repeat a text and the kept doc_id, all are marked
kept; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simsift.llm._space import bounded, written

#: Rows of one hash that may meet in a task.
HOT = 100_000


def exact_duplicates(docs: DataFrame, keep: str = "min", content_hash=F.md5) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs(doc_id, text).

    keep is "min" or "max": which doc_id of equal texts stays. content_hash maps the text column
    to the grouping hash.
    """
    best = {"min": F.min, "max": F.max}[keep]
    text: Column = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("h", content_hash(F.col("text")))
    counted = written(rows.groupBy("h").agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "content-groups")
    several = counted.where("group_size > 1").select("h")
    hot = F.col("group_size") > HOT
    salts = bounded(written(counted.where(hot).select("h", F.ceil(F.col("group_size") / HOT).alias("salts")), "hot-content"))
    salted = rows.join(salts, "h", "left").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.coalesce("salts", F.lit(1))))
    wanted = several.join(salts, "h", "left").select("h", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    near = bounded(written(wanted, "content-salts"))
    ends = salted.join(near, ["h", "salt"]).groupBy("h", "salt").agg(F.min("text").alias("least"), F.max("text").alias("greatest"))
    ends = ends.groupBy("h").agg((F.min("least") != F.max("greatest")).alias("clash"))
    clashes = bounded(written(ends.where("clash").select("h"), "content-clashes"))
    # Both sides reach this join straight from files, so adaptive execution can split a hot hash.
    slim = docs.select("doc_id", text.alias("text")).select(
        "doc_id", content_hash(F.col("text")).alias("h"), F.sha2("text", 256).alias("text_sha256")
    )
    found = not clashes.isEmpty()
    clean = slim.join(counted.join(clashes, "h", "left_anti") if found else counted, "h")
    out = clean.select("doc_id", "keep_id", "group_size", "text_sha256")
    if found:
        same = rows.join(clashes, "h", "left_semi")
        exact = same.groupBy("text").agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        out = out.unionByName(
            same.join(exact, "text").select("doc_id", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256"))
        )
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )

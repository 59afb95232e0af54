"""The best K of a stream: each micro-batch is cut to its K best and folded into a stored list.

Top K is associative, so folding batches gives what one search over all archives gives. The state
is a table a batch, whole once its writer has committed it (_SUCCESS). A batch that runs again
starts from the table before its own and writes its own anew, so a restart counts no hit twice; a
restart without new files returns the newest committed table. Tables that no batch can start from
again are deleted: the state is two tables of K hits, however many batches there were.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from simsift.operators.search import top
from simsift.space import hadoop_path, new_folder


def newest(spark: SparkSession, state: str, before: int | None = None) -> str | None:
    """The committed table of the last batch (before a number), None if there is none."""
    where, folder = hadoop_path(spark, state)
    if not where.exists(folder):
        return None
    numbers = [int(n[6:]) for x in where.listStatus(folder) if (n := x.getPath().getName()).startswith("batch=")]
    for n in sorted((n for n in numbers if before is None or n < before), reverse=True):
        if where.exists(hadoop_path(spark, f"{state}/batch={n}/_SUCCESS")[1]):
            return f"{state}/batch={n}"
    return None


def _undone(spark: SparkSession, state: str) -> bool:
    """Whether a batch was planned and not committed."""
    names = []
    for kind in ("offsets", "commits"):
        where, folder = hadoop_path(spark, f"{state}/progress/{kind}")
        names.append({n for x in where.listStatus(folder) if (n := x.getPath().getName()).isdigit()} if where.exists(folder) else set())
    return bool(names[0] - names[1])


def fold_top_k(stream: DataFrame, score: Callable[[DataFrame], DataFrame], k: int, state: str | None = None) -> DataFrame:
    """Runs the stream over what is there now; the K best hits of it and of what the state held."""
    spark: SparkSession = stream.sparkSession
    state = state or new_folder(spark, "top-k")

    def fold(batch: DataFrame, number: int) -> None:
        best = top(score(batch), k)
        if (last := newest(spark, state, number)) is not None:
            best = top(best.unionByName(spark.read.schema(best.schema).parquet(last)), k)
        best.write.mode("overwrite").parquet(f"{state}/batch={number}")
        where, folder = hadoop_path(spark, state)
        for old in where.listStatus(folder):
            name = old.getPath().getName()
            if name.startswith("batch=") and int(name[6:]) < number and f"{state}/{name}" != last:
                where.delete(old.getPath(), True)

    # A run that begins with a batch that was left undone may end with it: what has come since is the next run's.
    for _ in range(2 if _undone(spark, state) else 1):
        query = stream.writeStream.foreachBatch(fold).option("checkpointLocation", f"{state}/progress").trigger(availableNow=True).start()
        query.awaitTermination()
    if (last := newest(spark, state)) is not None:
        return spark.read.parquet(last)
    return score(spark.createDataFrame([], stream.schema))

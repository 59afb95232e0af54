"""A corpus pipeline of five stages over documents, each of which works on all that the one before kept.

toxicity          documents scored as toxic go
near dedup        of each class of near copies (five-word shingles, similarity 0.8) one stays
decontamination   documents that hold a window of a benchmark item go
mixing            documents are taken, some more than once, so that sources meet their targets
token files       what is left is tokenised, written and read back: a digest row a document
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simsift.llm import decontamination, mixing, near_dedup, token_files, toxicity
from simsift.llm._space import bounded, read_table, written
from simsift.llm.language_id import in_fold

TOKENIZER, END = "word_bpe_49k.json", 2


def _rows(docs: DataFrame) -> DataFrame:
    """row (all columns), key (what a row is known by: doc_id, null last, and its text's hash), text."""
    key = F.struct(F.col("doc_id").isNull().alias("null"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("hash"))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"), "text")


def _without(rows: DataFrame, rejected: DataFrame, label: str) -> DataFrame:
    """The rows whose key isn't among the rejected (key): few are broadcast, many joined by shuffle."""
    return rows.join(bounded(written(rejected.distinct(), label)), "key", "left_anti").select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learn = docs.select("doc_id", "text", in_fold(F.col("doc_id"), 4, 2).alias("held_out")).where("NOT held_out")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(learn, learn.join(labels, "doc_id").select("doc_id", "text", "toxic"))
    return toxicity.score(_rows(docs).select("row", "text"), model).where("predicted = 0").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _rows(docs)
    classes = near_dedup.near_duplicates(rows.select(F.col("key").alias("doc_id"), "text"))
    kept = _without(rows, classes.where("NOT kept").select(F.col("doc_id").alias("key")), "copies")
    # Rows that repeat doc_id and text have one key: of those, one stays too.
    single = rows.groupBy("key").count().where("count > 1").isEmpty()
    return kept if single else kept.dropDuplicates(["doc_id", "text"])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _rows(docs)
    found = decontamination.contamination(rows.select(F.col("key").alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    return _without(rows, found.where("contaminated").select(F.col("doc_id").alias("key")), "contaminated")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.read_shards(token_files.write_shards(docs, public_tokenizers.path(TOKENIZER), END))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: No SQL can say the first and the last stage; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

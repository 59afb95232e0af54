import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.conftest import SMALL
from tests.llm import test_decontamination, test_near_dedup

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_are_the_stated_ones():
    assert [name for name, _ in cp.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_files"]


def test_toxic_documents_go_and_clean_ones_stay(spark):
    """On the tables with some hundred labels: the smallest have too few to learn from."""
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    kept = cp.drop_toxic(spark, docs, MIDDLE)
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0
    share = {y: kept.join(labels.where(F.col("toxic") == y), "doc_id").count() / docs.join(labels.where(F.col("toxic") == y), "doc_id").count() for y in (0, 1)}
    assert share[0] >= 0.97 and share[1] <= 0.4


def test_one_of_each_class_stays(spark, docs):
    kept = cp.drop_near_copies(spark, docs, SMALL)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert ids(kept) == sorted(d for d, _, _, k in test_near_dedup.brute(rows, 5) if k)
    assert kept.columns == docs.columns


def test_contaminated_documents_go(spark, docs):
    kept = cp.drop_contaminated(spark, docs, SMALL)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    bad = {r[0] for r in test_decontamination.brute(rows, items, 10) if r[5]}
    assert ids(kept) == sorted({d for d, _ in rows} - bad)


def test_odd_rows_pass_through(spark, odd, none):
    for stage in (cp.drop_near_copies, cp.drop_contaminated, cp.mix_sources, cp.drop_toxic):
        assert stage(spark, none, SMALL).collect() == []
        assert stage(spark, odd, SMALL).columns == odd.columns
    kept = [(r["doc_id"], r["text"]) for r in cp.drop_near_copies(spark, odd, SMALL).collect()]
    assert sum(t == "The cat sat on the mat and looked at the dog for a while" for _, t in kept) == 1
    assert (None, "no id at all") in kept and (8, "1d10t") in kept and (8, "another text under one id") in kept
    assert len(kept) == odd.count() - 2
    assert cp.drop_contaminated(spark, odd, SMALL).count() == odd.count()


def test_the_whole_run(spark, docs):
    got = cp.run(spark, SMALL).orderBy("start").collect()
    assert 0 < len(got)
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] > 0
        at += r["n_tokens"]
    assert max(Counter(r["doc_id"] for r in got).values()) <= 3
    texts = {r["doc_id"]: r["text"] for r in docs.where(F.col("doc_id").isin([r["doc_id"] for r in got])).collect()}
    assert all(r["n_tokens"] >= len(re.findall(r"\S+", texts[r["doc_id"]])) for r in got)

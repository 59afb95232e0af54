import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from simsift.llm import _space, exact_dedup, queries
from simsift.llm.exact_dedup import exact_duplicates
from tests.compare import same
from tests.conftest import SMALL


def brute(rows, keep):
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    out = []
    for r in rows:
        ids = [i for i in groups[r["text"] or ""] if i is not None]
        best = (min if keep == "min" else max)(ids, default=None)
        out.append((r["doc_id"], best, len(groups[r["text"] or ""]), r["doc_id"] == best, hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("content_hash", [F.md5, lambda t: F.length(t), lambda t: F.lit(1)])
def test_equals_brute_force_whatever_the_hash(odd, keep, content_hash):
    got = exact_duplicates(odd, keep, content_hash)
    assert sorted(map(tuple, got.collect()), key=str) == brute(odd.collect(), keep)


@pytest.mark.parametrize("content_hash", [F.md5, lambda t: F.lit(1)])
def test_hot_hashes_are_dealt_to_many_tasks(spark, odd, monkeypatch, content_hash):
    """Nothing is broadcast, and a hash of two rows is hot already."""
    monkeypatch.setattr(exact_dedup, "HOT", 1)
    monkeypatch.setattr(_space, "BROADCAST_ROWS", -1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = sorted(map(tuple, exact_duplicates(odd, "max", content_hash).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == brute(odd.collect(), "max")


def test_empty_table(none):
    assert exact_duplicates(none).collect() == []


def test_query_equals_sql(spark):
    same(spark, SMALL, queries.QUERIES["op7_exact_dedup"], queries.SQL["op7_exact_dedup"])

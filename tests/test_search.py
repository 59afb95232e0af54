import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from simsift.functions import similarity, smiles
from simsift.functions.fingerprints import packed, query_words
from simsift.operators import brackets, chunks, recover, search, shards, threshold_index

HITS = "tanimoto double, archive_index int, source_file string, ligand_line bigint"


@pytest.fixture(scope="module")
def hits(spark):
    rng = random.Random(5)
    rows = [(round(rng.random(), 2), i % 7, f"a{i % 7}", i) for i in range(600)]
    return spark.createDataFrame(rows, HITS).repartition(5)


def key(r):
    return (-r["tanimoto"], r["archive_index"], r["ligand_line"])


def test_top_is_the_sorted_prefix_however_partitioned(hits):
    want = sorted(hits.collect(), key=key)[:40]
    assert search.top(hits, 40).collect() == want
    assert search.top(hits.repartition(1), 40).collect() == want
    assert search.top(hits.limit(0), 3).collect() == []


def test_levels_and_unions_give_the_same_top(spark, hits):
    want = sorted(hits.collect(), key=key)[:25]
    assert sorted(search.top_by_levels(hits, 7, 25, 3).collect(), key=key) == want
    parts = [search.top(hits.where(F.col("ligand_line") % 2 == k), 25) for k in (0, 1)]
    assert search.top(parts[0].unionByName(parts[1]), 25).collect() == want


@pytest.mark.parametrize("k", [1, 7, 299, 600, 5000])
def test_a_large_k_is_cut_by_counts(hits, monkeypatch, k):
    """Ties over the edge, K above a partition's rows and above all rows, runs of few lines."""
    monkeypatch.setattr(search, "RUN_BITS", 3)
    rows = hits.collect()
    assert sorted(search.first_k(hits, k).collect(), key=key) == sorted(rows, key=key)[:k]
    per = search.first_k(hits, k, "archive_index").collect()
    want = [r for a in range(7) for r in sorted((r for r in rows if r["archive_index"] == a), key=key)[:k]]
    assert sorted(per, key=key) == sorted(want, key=key)
    same = hits.withColumn("tanimoto", F.lit(0.5))
    assert sorted(search.first_k(same, k).collect(), key=key) == sorted(same.collect(), key=key)[:k]
    assert search.first_k(hits.limit(0), k).collect() == []


def test_plans_of_a_large_k(hits):
    text = search.top(hits, 1_000_000)._jdf.queryExecution().toString()
    assert "TakeOrdered" not in text
    large = search.top_in_groups(hits, 1_000_000, "archive_index")._jdf.queryExecution().toString()
    assert "_edge" in large  # cut by counts before the window
    assert "WindowGroupLimit" in search.top_in_groups(hits, 1000, "archive_index")._jdf.queryExecution().toString()


def test_a_fingerprint_is_made_once_a_record(spark):
    docs = spark.createDataFrame([(0, "a b c", "s"), (1, "a b d", "s"), (2, None, None), (3, "c", None)], "doc_id long, text string, source string")
    hits = search.scored(search.document_library(docs), search.query_bits(docs), cutoff=0.1)
    plan = hits.select("tanimoto")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("md5(") == 1 and plan.count("array_intersect(") == 1
    assert {(r["ligand_line"], r["source_file"], r["archive_index"]) for r in hits.collect()} == {(0, "s", 0), (1, "s", 0), (3, None, 1)}
    assert search.query_bits(docs.limit(0)) == []
    assert search.scored(search.document_library(docs.limit(0)), []).collect() == []
    assert {r["tanimoto"] for r in search.scored(search.document_library(docs), []).collect()} == {0.0}


def test_packed_fingerprints_score_as_sets(spark):
    rng = random.Random(8)
    sets = [sorted(rng.sample(range(2048), rng.randint(0, 60))) for _ in range(40)] + [[63, 64, 127, 2047]]
    query = sets[3] or [1]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "ligand_line long, bits array<int>").withColumns({"archive_index": F.lit(0), "source_file": F.lit("a")})
    stored = packed(rows)
    assert [(list(r["words"]), r["popcount"]) for r in stored.orderBy("ligand_line").collect()] == [(query_words(s), len(s)) for s in sets]
    for cutoff in (None, 0.05, 0.9):
        a = search.scored(rows, query, cutoff=cutoff).select("ligand_line", "tanimoto").collect()
        b = search.scored_packed(stored, query_words(query), cutoff).select("ligand_line", "tanimoto").collect()
        assert sorted(a) == sorted(b)


def test_the_threshold_index_meets_all_and_only_candidates(spark, tmp_path):
    """Rare and common bits, empty and repeated records; every cutoff that the index serves."""
    rng = random.Random(7)
    sets = [sorted({min(int(rng.expovariate(0.02)), 255) for _ in range(rng.choice([0, 1, 5, 20, 40]))}) for _ in range(400)]
    sets += [sorted({*sets[k], rng.randrange(256)} - {sets[k][0]}) for k in range(400) if len(sets[k]) > 1]
    rows = spark.createDataFrame([(n % 5, f"a{n % 5}", n, b) for n, b in enumerate(sets)], "archive_index int, source_file string, ligand_line bigint, bits array<int>")
    path = f"file://{tmp_path}/i"
    threshold_index.build(rows.repartition(4), path, 0.5, 256)
    for asked in (sets[5], sets[17], sets[33], list(range(0, 256, 9)), []):
        for cutoff in (0.5, 0.6, 2 / 3, 0.8, 1.0):
            want = {(n % 5, n): len(x & q) / len(x | q) for n, b in enumerate(sets) if (x := set(b)) and (q := set(asked)) and len(x & q) / len(x | q) >= cutoff}
            got = threshold_index.search(spark, path, asked, cutoff)
            assert {(r["archive_index"], r["ligand_line"]): r["tanimoto"] for r in got.collect()} == want
    large = max(sets, key=len)
    near = threshold_index.candidates(spark, path, large, 0.8).count()
    assert 0 < near < len(sets) / 4
    for wrong in (0.4, 1.1):
        with pytest.raises(ValueError):
            threshold_index.search(spark, path, large, wrong)
    with pytest.raises(ValueError):
        threshold_index.build(rows, path, 0.0)
    plan = threshold_index.candidates(spark, path, large, 0.8)._jdf.queryExecution().toString()
    assert "PushedFilters: [In(rank" in plan or "PushedFilters: [IsNotNull(popcount), In(rank" in plan


def test_ranks_by_ranges_are_those_of_one_order(spark, hits, monkeypatch):
    want = sorted(hits.collect(), key=key)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = search.ranked_by_ranges(hits)
        assert [(r["rank"], key(r)) for r in sorted(got.collect(), key=lambda r: r["rank"])] == [(n, key(r)) for n, r in enumerate(want, 1)]
        monkeypatch.setattr(search, "SMALL_K", 10)
        best = search.best_ranked(hits, 70).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted((r["rank"], key(r)) for r in best) == [(n, key(r)) for n, r in enumerate(want[:70], 1)]
    assert search.ranked_by_ranges(hits.limit(0)).collect() == []


def test_ranks_are_contiguous_and_groups_bounded(hits):
    assert [r["rank"] for r in search.ranked(search.top(hits, 30)).orderBy("rank").collect()] == list(range(1, 31))
    assert {r["n"] for r in search.top_in_groups(hits, 4, "archive_index").groupBy("archive_index").agg(F.count("*").alias("n")).collect()} == {4}


def test_cutoff_is_inclusive_and_monotone(hits):
    at = hits.where("tanimoto = 0.5").count()
    assert search.above(hits, 0.5).count() == search.above(hits, 0.5, strict=True).count() + at
    counts = [search.above(hits, c).count() for c in (None, 0.0, 0.3, 0.9, 1.0)]
    assert counts == sorted(counts, reverse=True) and counts[0] == counts[1]
    for bad in (-0.1, 1.1):
        with pytest.raises(ValueError):
            search.above(hits, bad)
    with pytest.raises(ValueError):
        search.top(hits, 0)


def test_tanimoto_of_sets_and_words_agree(spark):
    rng = random.Random(3)
    sets = [sorted(rng.sample(range(128), rng.randint(0, 40))) for _ in range(60)]
    query = sets[0]
    rows = spark.createDataFrame([(s, *query_words(s, 128)) for s in sets], "bits array<int>, w0 bigint, w1 bigint")
    got = rows.select("bits", similarity.set_tanimoto(F.col("bits"), query).alias("s"), similarity.word_tanimoto([F.col("w0"), F.col("w1")], query_words(query, 128)).alias("w"))
    for r in got.collect():
        a, b = set(r["bits"]), set(query)
        want = len(a & b) / len(a | b) if a | b else 1.0
        assert r["s"] == want == r["w"]


@given(st.integers(1, 2048), st.floats(0.01, 1))
def test_popcount_bounds_lose_nothing(n, cutoff):
    low, high = similarity.popcount_bounds(n, cutoff)
    for m in (int(cutoff * n), int(cutoff * n) + 1, int(n / cutoff), int(n / cutoff) + 1):
        if m and min(m, n) / max(m, n) >= cutoff:
            assert low <= m <= high


def test_recovery_keeps_duplicates_and_notices_losses(spark):
    library = spark.createDataFrame([(0, 1, "a"), (0, 2, "b"), (1, 1, "c")], "archive_index int, ligand_line bigint, record string")
    found = spark.createDataFrame([(1, 0, 2), (2, 0, 2), (3, 1, 1)], "rank int, archive_index int, ligand_line bigint")
    assert sorted((r["rank"], r["record"]) for r in recover.recover_all(found, library).collect()) == [(1, "b"), (2, "b"), (3, "c")]
    lost = found.unionByName(spark.createDataFrame([(4, 1, 9)], found.schema))
    assert [r["ligand_line"] for r in recover.missing(lost, library).collect()] == [9]
    with pytest.raises(Exception, match="no record"):
        recover.recover_all(lost, library).collect()
    assert {(r["archive_index"], r["hits"], r["unique_lines"], r["last_line"]) for r in recover.needed(found).collect()} == {(0, 2, 1, 2), (1, 1, 1, 1)}


def test_brackets_edges_and_gallery(spark):
    scores = [0.5999, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95, 0.99, 1.0, *[0.61] * 9]
    rows = spark.createDataFrame([(s, i) for i, s in enumerate(scores)], "tanimoto double, ligand_line bigint")
    counts = {r["bracket"]: r["n"] for r in brackets.counts(rows).collect()}
    assert counts == {0: 2, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 10}
    gallery = brackets.gallery(rows, "ligand_line").collect()
    assert len(gallery) == 40 and sum(r["is_placeholder"] for r in gallery) == 40 - (2 + 6 + 5)
    assert brackets.counts(rows.limit(0)).agg(F.sum("n")).first()[0] == 0
    again = {(r["bracket"], r["slot"], r["ligand_line"]) for r in brackets.sample(rows.repartition(3), "ligand_line").collect()}
    assert again == {(r["bracket"], r["slot"], r["ligand_line"]) for r in brackets.sample(rows, "ligand_line").collect()}


@pytest.mark.parametrize("n,c,want", [(7, 3, [(0, 2), (2, 4), (4, 7)]), (2, 3, [(0, 0), (0, 1), (1, 2)]), (5, 1, [(0, 5)])])
def test_slices(spark, n, c, want):
    got = [(r["slice_start"], r["slice_end"]) for r in shards.slices(n, c, spark).orderBy("task_index").collect()]
    assert got == want
    tasks = spark.range(n).select("id", search.task_of(F.col("id"), F.lit(n), c).alias("t")).collect()
    assert all(got[r["t"] - 1][0] <= r["id"] < got[r["t"] - 1][1] for r in tasks)


META = "task_index int, task_count int, manifest_sha256 string, manifest_archive_count int, query_smiles string, top_k int, min_tanimoto double, radius int, fp_size int, use_chirality boolean, header_lines int"


def metadata(spark, **changed):
    manifest = spark.createDataFrame([(0, "/x/a"), (1, "/x/b")], "archive_index int, source_file string")
    digest = shards.manifest_digest(manifest).first()["manifest_sha256"]
    base = {"task_count": 2, "manifest_sha256": digest, "manifest_archive_count": 2, "query_smiles": "C", "top_k": 5, "min_tanimoto": None, "radius": 2, "fp_size": 2048, "use_chirality": False, "header_lines": 1}
    rows = [(1, *base.values()), (2, *(base | changed).values())]
    return spark.createDataFrame(rows, META), manifest


def test_metadata_agreement(spark):
    meta, manifest = metadata(spark)
    shards.verified(meta, manifest, 2)
    for name, value in [("task_count", 3), ("manifest_sha256", "x"), ("manifest_archive_count", 9), ("query_smiles", "N"), ("top_k", 6), ("min_tanimoto", 0.5), ("radius", 3), ("fp_size", 1024), ("use_chirality", True), ("header_lines", 0)]:
        meta, _ = metadata(spark, **{name: value})
        assert [r["key"] for r in shards.agreement(meta).where("NOT agree").collect()] == [name]
        with pytest.raises(ValueError, match="differ"):
            shards.verified(meta, manifest, 2)


def test_metadata_of_other_runs_is_refused(spark):
    meta, manifest = metadata(spark)
    with pytest.raises(ValueError, match="no metadata"):
        shards.verified(meta, manifest, 3)
    with pytest.raises(ValueError, match="no metadata"):
        shards.verified(meta.where("task_index = 1"), manifest, 2)
    other = spark.createDataFrame([(0, "/x/b"), (1, "/x/a")], manifest.schema)
    with pytest.raises(ValueError, match="manifest"):
        shards.verified(meta, other, 2)
    assert shards.final_k(10, None) == 10 and shards.final_k(10, 3) == 3
    for bad in (0, 11):
        with pytest.raises(ValueError):
            shards.final_k(10, bad)


@pytest.mark.parametrize("n,sizes", [(25, [10, 10, 5]), (20, [10, 10]), (3, [3])])
def test_chunks(spark, n, sizes):
    lines = chunks.assigned(spark.range(n).withColumnRenamed("id", "line"), 10)
    got = chunks.verified(lines, 10).orderBy("chunk").collect()
    assert [r["records"] for r in got] == sizes and all(r["exact"] for r in got)
    if n > 10:
        assert not all(r["exact"] for r in chunks.verified(lines.where("line <> 4"), 10).collect())


@pytest.mark.parametrize("bad", ["C1CC", "C(", "CC)", "", None, "C%1", "=C", "C(=)C", "xyz", "C.."[:3] + "="])
def test_texts_that_are_no_structure(bad):
    assert smiles.parse(bad) is None


@pytest.mark.parametrize("a,b", [("OCC", "CCO"), ("C1CCCCC1", "C2CCCCC2"), ("c1ccccc1C", "Cc1ccccc1"), ("C(N)(O)C", "CC(O)N"), ("C%12CC%12", "C1CC1"), ("[OH]CC", "OCC")])
def test_structures_don_t_depend_on_how_they_are_written(a, b):
    assert smiles.circular_bits(smiles.parse(a)) == smiles.circular_bits(smiles.parse(b))


def test_structures_named_in_the_analysis_parse():
    for s in ("O=C1NC(=S)NC(=O)C1=CC1=CC=NC=C1", "CC1=CC=CC=C1NC(=O)NCC2CCCCC2", "CN1C(=O)C=CC=C1C(=O)NC2CCCCN(C2)C(=O)CC3(C)CCCCC3", "[13CH3][C@@H](N)C(=O)[O-]"):
        bits = smiles.circular_bits(smiles.parse(s))
        assert len(bits) > 5 and bits == sorted(set(bits))
    assert smiles.query_fingerprint("CCO") != smiles.query_fingerprint("CCN") and len(smiles.query_fingerprint("CCO")) == 32
    with pytest.raises(ValueError):
        smiles.query_fingerprint("C1CC")

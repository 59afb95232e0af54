"""The four jobs from archives to result files, and what they refuse."""

import bz2
import csv
import random

import pytest

from simsift import space
from simsift.functions import smiles
from simsift.jobs import merge as merges
from simsift.jobs import search as searches
from simsift.jobs.report import report
from simsift.jobs.split import split
from simsift.sources import manifest
from simsift.streaming import top_k

QUERY = "CC1=CC=CC=C1NC(=O)NCC2CCCCC2"
PIECES = ["C", "CC", "C(=O)", "N", "O", "c1ccccc1", "C1CCNCC1", "CN", "C1CCCCC1"]


def record(smi, n):
    return f"{smi} ID{n} 46.07 3 0.1 1 1 0 0.5 20.2 M KEY{n}"


@pytest.fixture(scope="module")
def library(tmp_path_factory):
    """Five archives of structures (some repeated, some unreadable, blank lines), and their records."""
    root, rng, held = tmp_path_factory.mktemp("library"), random.Random(4), {}
    for a in range(5):
        lines = []
        for n in range(40):
            smi = "C" + "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 5)))
            lines.append("" if n % 17 == 3 else record("C1CC" if n % 13 == 5 else QUERY if n == 7 else smi, 100 * a + n))
        held[a] = lines
        (root / f"a{a}.cxsmiles.bz2").write_bytes(bz2.compress("\n".join(["header", *lines]).encode()))
    paths = [f"file://{root}/a{a}.cxsmiles.bz2" for a in range(5)]
    manifest.write_manifest(f"file://{root}/manifest.txt", paths)
    return f"file://{root}/manifest.txt", paths, held


def brute(held):
    """archive, line, score of every valid record, best first."""
    bits = lambda s: None if (mol := smiles.parse(s)) is None else set(smiles.circular_bits(mol))
    asked, rows = bits(QUERY), []
    for a, lines in held.items():
        for n, line in enumerate(lines):
            own = bits(line.split()[0]) if line.split() else None
            if own:
                rows.append((a, n, len(own & asked) / len(own | asked)))
    return sorted(rows, key=lambda r: (-r[2], r[0], r[1]))


def test_search_and_merge_give_both_files(spark, library, tmp_path):
    path, paths, held = library
    out, want = f"file://{tmp_path}/run", brute(held)
    meta = searches.search(spark, path, QUERY, out, 2, top_k=30, min_tanimoto=0.2).orderBy("task_index").collect()
    assert [(r["slice_start"], r["slice_end"], r["archive_count"]) for r in meta] == [(0, 2, 2), (2, 5, 3)]
    for r, archives in zip(meta, ((0, 1), (2, 3, 4))):
        mine = [x for x in want if x[0] in archives]
        passing = sum(x[2] >= 0.2 for x in mine)
        assert (r["total_records"], r["valid_records"], r["passing_cutoff"], r["retained"]) == (40 * len(archives), len(mine), passing, min(passing, 30))
    merged = merges.merge(spark, path, out, 2, f"file://{tmp_path}/tsv", f"file://{tmp_path}/csv", 20)
    got = [(r["archive_index"], r["ligand_line"], r["tanimoto"]) for r in merged.orderBy("rank").collect()]
    best = [x for x in want if x[2] >= 0.2][:20]
    assert got == best and len(got) == 20
    lines = next((tmp_path / "tsv").glob("part*")).read_text().splitlines()
    assert lines == ["rank\ttanimoto\tsource_file\tligand_line"] + [f"{k}\t{s:.10f}\t{paths[a]}\t{n}" for k, (a, n, s) in enumerate(best, 1)]
    with open(next((tmp_path / "csv").glob("part*")), newline="") as f:
        rows = list(csv.reader(f))
    assert rows == [[held[a][n].split()[0], f"ID{100 * a + n}", paths[a], repr(s)] for a, n, s in best]
    shown = searches.summary(searches.shard_metadata(spark, out)).orderBy("task_index").collect()
    assert shown[0]["line"].startswith("2 archives, 80 records, ") and "records/s" in shown[0]["line"]
    gallery = report(spark, f"file://{tmp_path}/csv", f"file://{tmp_path}/report").collect()
    assert len(gallery) == 40 and all(g["tanimoto"] is None or 0.6 <= g["tanimoto"] < 1 for g in gallery)


def test_shards_searched_one_by_one_are_the_same_run(spark, library, tmp_path):
    path, _, _ = library
    one, two = f"file://{tmp_path}/one", f"file://{tmp_path}/two"
    searches.search(spark, path, QUERY, one, 3, top_k=9)
    for t in (2, 1, 3):
        searches.search(spark, path, QUERY, two, 3, [t], top_k=9)
    a, b = (searches.shard_hits(spark, x, searches.shard_metadata(spark, x)).select("task_index", "archive_index", "ligand_line", "tanimoto") for x in (one, two))
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() == 27
    with pytest.raises(FileExistsError):
        searches.search(spark, path, QUERY, two, 3, [2], top_k=9)


def test_what_search_and_merge_refuse(spark, library, tmp_path):
    path, paths, held = library
    out = f"file://{tmp_path}/x"
    for bad in ({"task_count": 6}, {"task_count": 0}, {"task_count": 2, "tasks": [3]}, {"task_count": 3, "tasks": [1, 3]}, {"task_count": 1, "top_k": 0}, {"task_count": 1, "min_tanimoto": 1.5}, {"task_count": 1, "fp_size": 100}, {"task_count": 1, "kind": "?"}):
        with pytest.raises(ValueError):
            searches.search(spark, path, QUERY, out, **bad)
    with pytest.raises(ValueError, match="no structure"):
        searches.search(spark, path, "C1CC", out, 1)
    into = (f"file://{tmp_path}/t", f"file://{tmp_path}/c")
    with pytest.raises(ValueError, match="no metadata"):
        merges.merge(spark, path, out, 2, *into)
    searches.search(spark, path, QUERY, out, 2, [1], top_k=5)
    with pytest.raises(ValueError, match="no metadata of tasks"):
        merges.merge(spark, path, out, 2, *into)
    searches.search(spark, path, QUERY, out, 2, [2], top_k=5)
    with pytest.raises(ValueError, match="K must lie"):
        merges.merge(spark, path, out, 2, *into, top_k=6)
    other = f"file://{tmp_path}/other.txt"
    manifest.write_manifest(other, paths[::-1])
    with pytest.raises(ValueError, match="manifest"):
        merges.merge(spark, other, out, 2, *into)
    for f in (tmp_path / "x/hits/task_index=2").iterdir():
        f.unlink()
    with pytest.raises(ValueError, match="missing or incomplete"):
        merges.merge(spark, path, out, 2, *into)


def test_a_search_without_hits(spark, library, tmp_path):
    path, _, _ = library
    out = f"file://{tmp_path}/none"
    meta = searches.search(spark, path, "O=C1NC(=S)NC(=O)C1=CC1=CC=NC=C1", out, 2, top_k=5, min_tanimoto=0.99)
    assert {r["retained"] for r in meta.collect()} == {0}
    assert merges.merge(spark, path, out, 2, f"file://{tmp_path}/t", f"file://{tmp_path}/c").collect() == []


def test_the_older_search_in_one_call(spark, library, tmp_path):
    import numpy as np

    from simsift.jobs.legacy import figures, legacy_search

    _, paths, held = library
    root, told = paths[0].rpartition("/")[0], []
    best = legacy_search(spark, root, QUERY, f"file://{tmp_path}/t", 25, work=f"file://{tmp_path}/w", progress=told.append)
    want = sorted(((a, n, float(np.float32(s))) for a, n, s in brute(held)), key=lambda r: (-r[2], r[0], r[1]))[:25]
    assert [(r["archive_index"], r["ligand_line"], r["tanimoto"]) for r in best.orderBy("rank").collect()] == want
    lines = next((tmp_path / "t").glob("part*")).read_text().splitlines()
    assert lines == ["rank\ttanimoto\tsource_file\tligand_line"] + [f"{k}\t{s:.6f}\t{paths[a]}\t{n}" for k, (a, n, s) in enumerate(want, 1)]
    assert told and told[-1].endswith("of 1 tasks are searched")
    archives = len({a for a, _, _ in want})
    assert figures(best).first()["line"] == f"25 hits in {archives} archives, scores {want[0][2]:.6f} to {want[-1][2]:.6f}"
    other = legacy_search(spark, root, "CC", f"file://{tmp_path}/u", 5, column=1)  # ids are no structures
    assert other.collect() == [] and figures(other).first()["line"] == "0 hits in 0 archives, scores - to -"
    with pytest.raises(ValueError):
        legacy_search(spark, root, QUERY, f"file://{tmp_path}/v", 5, column=-1)


def test_split_is_safe(spark, tmp_path):
    def archive(name, lines):
        (tmp_path / name).write_bytes(bz2.compress("\n".join(lines).encode()))
        return f"file://{tmp_path}/{name}"

    one = archive("x.cxsmiles.bz2", ["head", *(f"r{i}" for i in range(25))])
    files = split(spark, one, 10).orderBy("chunk").collect()
    assert [r["records"] for r in files] == [10, 10, 5] and (tmp_path / "x.cxsmiles.bz2").exists()
    texts = [bz2.decompress((tmp_path / "x_chunks" / f"x.part{i:05d}.cxsmiles.bz2").read_bytes()).decode().splitlines() for i in range(3)]
    assert [t[0] for t in texts] == ["head"] * 3 and [x for t in texts for x in t[1:]] == [f"r{i}" for i in range(25)]
    assert not (tmp_path / "x_chunks.inprogress").exists()
    with pytest.raises(FileExistsError):
        split(spark, one, 10)
    two = archive("y.cxsmiles.bz2", ["a", "b", *(f"r{i}" for i in range(4))])
    (tmp_path / "y_chunks.inprogress").mkdir()
    (tmp_path / "y_chunks.inprogress" / "stale").write_text("")
    with pytest.raises(FileExistsError):
        split(spark, two, 10, header_lines=2)
    split(spark, two, 2, header_lines=2, delete_original=True, overwrite_inprogress=True)
    assert sorted(p.name for p in (tmp_path / "y_chunks").iterdir()) == ["y.part00000.cxsmiles.bz2", "y.part00001.cxsmiles.bz2"]
    assert not (tmp_path / "y.cxsmiles.bz2").exists()
    for lines in (["only a header"], []):
        with pytest.raises(ValueError, match="no record"):
            split(spark, archive("z.cxsmiles.bz2", lines), 10)
        assert (tmp_path / "z.cxsmiles.bz2").exists() and not (tmp_path / "z_chunks").exists()


def test_split_loses_nothing_whatever_changes_between_its_passes(spark, tmp_path, monkeypatch):
    from simsift.sources import cxsmiles

    rng = random.Random(6)
    lines = [f"r{i} " + "".join(rng.choices("abcdefghijklmnop", k=40)) for i in range(30_000)]
    one = tmp_path / "x.cxsmiles.bz2"
    one.write_bytes(bz2.compress("\n".join(["head", *lines[:14_000]]).encode() + b"\n", 1) + bz2.compress("\r\n".join(lines[14_000:]).encode(), 1))
    save, names = cxsmiles.save_chunks, ("spark.sql.files.maxPartitionBytes", "spark.sql.leafNodeDefaultParallelism")
    before = {n: spark.conf.get(n, None) for n in names}

    def changed(*args):
        spark.conf.set(names[0], "150k")
        spark.conf.set(names[1], "11")
        return save(*args)

    monkeypatch.setattr(cxsmiles, "save_chunks", changed)
    try:
        files = split(spark, f"file://{one}", 7_000, delete_original=True, stretch_bytes=60_000).orderBy("chunk").collect()
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)
    assert [r["records"] for r in files] == [7_000] * 4 + [2_000] and not one.exists()
    texts = [bz2.decompress((tmp_path / "x_chunks" / f"x.part{i:05d}.cxsmiles.bz2").read_bytes()).decode().splitlines() for i in range(5)]
    assert [t[0] for t in texts] == ["head"] * 5 and [x for t in texts for x in t[1:]] == lines


def test_chunks_that_differ_from_what_was_written_are_found(spark, tmp_path):
    from simsift.sources import cxsmiles

    rows = spark.range(25).selectExpr("'x' AS base", "id AS line", "concat('r', id) AS record")
    files = cxsmiles.write_chunks(rows, 10, "head", f"file://{tmp_path}/c").orderBy("chunk").collect()
    paths, sums = [r["file"] for r in files], [r["checksum"] for r in files]
    cxsmiles.verify_chunks(spark, paths, 10, 25, 1, ["head"], sums)
    changed = tmp_path / "c" / "x.part00001.cxsmiles.bz2"
    changed.write_bytes(bz2.compress(bz2.decompress(changed.read_bytes()).replace(b"r13", b"r31")))
    with pytest.raises(ValueError, match="differs from what was written"):
        cxsmiles.verify_chunks(spark, paths, 10, 25, 1, ["head"], sums)
    with pytest.raises(ValueError, match="header"):
        cxsmiles.verify_chunks(spark, paths, 10, 25, 1, ["other"], sums)


@pytest.fixture(scope="module")
def tokens(tmp_path_factory):
    """One archive of word records in many blocks, one small one, a query; and every score by brute force."""
    from hashlib import md5

    root, rng = tmp_path_factory.mktemp("tokens"), random.Random(8)
    words, held = [f"w{i}" for i in range(60)], {}
    for a, n in ((0, 20_000), (1, 300)):
        held[a] = [" ".join(rng.choices(words, k=rng.randint(5, 30))) if i % 50 else " " for i in range(n)]
        (root / f"t{a}.cxsmiles.bz2").write_bytes(bz2.compress("\n".join(["header", *held[a]]).encode(), 1))
    path = f"file://{root}/manifest.txt"
    manifest.write_manifest(path, [f"file://{root}/t{a}.cxsmiles.bz2" for a in held])
    query = " ".join(words[:20])
    bits = lambda t: {int(md5(w.encode()).hexdigest()[:8], 16) % 2048 for w in t.split()}
    asked = bits(query)
    scores = [(a, n, len(own & asked) / len(own | asked)) for a, lines in held.items() for n, line in enumerate(lines) if (own := bits(line))]
    return path, query, sorted(scores, key=lambda r: (-r[2], r[0], r[1])), held


def watch(monkeypatch, out, stop=False):
    """What the stretches' files hold just before the shards are published; with stop they never are."""
    seen, publish = {}, searches._publish

    def published(spark, *args):
        files = [f for f in (out / "parts").rglob("*.parquet") if f.name[0] != "."]
        seen.update({f.name: f.stat().st_mtime_ns for f in files})
        seen["hits"] = searches._parts(spark, f"file://{out}", [1, 2]).where("tanimoto IS NOT NULL").count()
        seen["rows"] = searches._parts(spark, f"file://{out}", [1, 2]).count()
        if stop:
            raise RuntimeError("the driver is gone")
        publish(spark, *args)

    monkeypatch.setattr(searches, "_publish", published)
    return seen


def rows_of(spark, out):
    rows = searches.shard_hits(spark, out, searches.shard_metadata(spark, out)).select("task_index", "archive_index", "ligand_line", "tanimoto").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0], -r[3], r[1], r[2]))


@pytest.mark.parametrize("k", [5, 40, 3_000])
def test_many_tasks_search_one_archive_and_write_little(spark, tokens, tmp_path, monkeypatch, k):
    path, query, scores, held = tokens
    seen = watch(monkeypatch, tmp_path)
    meta = searches.search(spark, path, query, f"file://{tmp_path}", 2, top_k=k, min_tanimoto=0.1, kind="tokens", stretch_bytes=8_000).orderBy("task_index").collect()
    want = [(a + 1, a, n, s) for a in (0, 1) for a_, n, s in [x for x in scores if x[0] == a and x[2] >= 0.1][:k]]
    assert rows_of(spark, f"file://{tmp_path}") == want
    stretches = len(seen) - 2
    assert stretches > 25 and seen["rows"] - seen["hits"] < 200  # a count a block, nothing a record
    passing = sum(s >= 0.1 for _, _, s in scores)
    assert seen["hits"] <= min(passing, 8 * k + 300) and (k > 100 or seen["hits"] < stretches * k / 2)
    for r in meta:
        mine = [s for a, _, s in scores if a == r["task_index"] - 1]
        counts = (len(held[r["task_index"] - 1]), len(mine), sum(s >= 0.1 for s in mine), min(k, sum(s >= 0.1 for s in mine)))
        assert (r["total_records"], r["valid_records"], r["passing_cutoff"], r["retained"]) == counts
    assert not list((tmp_path / "parts").rglob("*.parquet"))


def test_a_stopped_search_goes_on_where_it_was(spark, tokens, tmp_path, monkeypatch):
    path, query, scores, _ = tokens
    out, more = f"file://{tmp_path}/run", {"top_k": 30, "kind": "tokens", "stretch_bytes": 8_000}
    with monkeypatch.context() as m:
        first = watch(m, tmp_path / "run", stop=True)
        with pytest.raises(RuntimeError, match="gone"):
            searches.search(spark, path, query, out, 2, **more)
    assert searches.shard_metadata(spark, out) is None
    with pytest.raises(ValueError, match="other arguments"):
        searches.search(spark, path, query, out, 2, **{**more, "top_k": 31})
    folder = tmp_path / "run" / "parts" / "task_index=1"
    lost = sorted(folder.glob("*.parquet"))[3]
    lost.unlink()  # a stretch that was not done
    (folder / f".{lost.name}.half").write_bytes(b"half")  # and what its attempt left behind
    with monkeypatch.context() as m:
        second = watch(m, tmp_path / "run")
        searches.search(spark, path, query, out, 2, **more)
    assert set(first) == set(second) and {n for n in first if n.endswith("parquet") and first[n] != second[n]} == {lost.name}
    assert rows_of(spark, out) == [(a + 1, a, n, s) for a in (0, 1) for a_, n, s in [x for x in scores if x[0] == a][:30]]
    with pytest.raises(FileExistsError):
        searches.search(spark, path, query, out, 2, **more)
    assert searches.search(spark, path, query, out, 2, **more, resume=True).count() == 2


def test_two_attempts_at_a_stretch_leave_one_result(spark, tokens, tmp_path):
    """As if a task had been lost after it wrote its file: the same stretch twice in one wave."""
    from simsift.sources import cxsmiles, shards

    import json

    path, query, scores, _ = tokens
    out, plan = f"file://{tmp_path}", cxsmiles.stretches(manifest.read_manifest(path), size=15_000)[:3]
    spark.dataSource.register(shards.StretchSink)
    again = [*plan, *plan]
    options = {"out": out, "top_k": 10, "cutoff": "null", "bounds": "{}", "todo": json.dumps([[1, shards.part_name([s]), shards.spans([s])] for s in again])}
    rows = searches.every_score(cxsmiles.scan(spark, [[s] for s in again]), query, "tokens", line=("archive_index", "block", "row"))
    rows.write.format("stretches").options(**options).mode("append").save()
    assert sorted(shards.finished(out, 1)) == sorted(shards.part_name([s]) for s in plan)
    parts = searches._parts(spark, out, [1])
    assert parts.where("tanimoto IS NOT NULL").count() == 30 and parts.where("lines IS NOT NULL").select("block").distinct().count() == parts.where("lines IS NOT NULL").count()


def test_hits_that_don_t_fit_their_metadata_leave_nothing(spark, tmp_path):
    import json

    from simsift.sources import shards

    spark.dataSource.register(shards.ShardSink)
    rows = spark.range(9).selectExpr("0.5D AS tanimoto", "0 AS archive_index", "'a' AS source_file", "id AS ligand_line", "32L AS block", "0 AS row", "CAST(id % 2 + 1 AS INT) AS task_index")
    save = lambda *kept: rows.repartition(2, "task_index").sortWithinPartitions("task_index").write.format("shards").options(out=f"file://{tmp_path}", metadata=json.dumps([{"task_index": t + 1, "retained": n} for t, n in enumerate(kept)])).mode("append").save()
    with pytest.raises(Exception, match="its counts say"):
        save(5, 5)
    assert not list(tmp_path.rglob("*.parquet")) and searches.shard_metadata(spark, f"file://{tmp_path}") is None
    save(5, 4)
    meta = searches.shard_metadata(spark, f"file://{tmp_path}")
    assert searches.shard_hits(spark, f"file://{tmp_path}", meta).count() == 9


def test_circular_fingerprints_equal_brute_force(spark, library):
    _, paths, held = library
    from simsift.sources import cxsmiles

    scores = searches.every_score(cxsmiles.read_archives(spark, paths), QUERY)
    got = {(r["archive_index"], r["ligand_line"]): r["tanimoto"] for r in scores.collect()}
    assert {k: v for k, v in got.items() if v is not None} == {(a, n): s for a, n, s in brute(held)}
    assert len(got) == 200


def test_a_stream_starts_again(spark, tmp_path):
    rows = [(round(i * 37 % 101 / 101, 4), i % 3, "a", i) for i in range(90)]
    schema = "tanimoto double, archive_index int, source_file string, ligand_line bigint"
    want = lambda n: sorted(rows[:n], key=lambda r: (-r[0], r[1], r[3]))[:8]
    add = lambda a, b: spark.createDataFrame(rows[a:b], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda: sorted(map(tuple, top_k.fold_top_k(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), lambda d: d, 8, f"file://{tmp_path}/state").collect()), key=lambda r: (-r[0], r[1], r[3]))
    (tmp_path / "in").mkdir()
    assert run() == []
    for a, b in ((0, 20), (20, 40), (40, 60)):
        add(a, b)
    assert run() == want(60)
    assert run() == want(60)  # nothing new
    half = tmp_path / "state" / "batch=99"
    half.mkdir()  # a table that no writer committed
    assert run() == want(60)
    half.rmdir()
    add(60, 90)
    assert run() == want(90)


def test_archives_that_arrive_reach_the_list(spark, tokens, tmp_path):
    """In batches, by a restart, and by one more after a batch that failed."""
    from pyspark.sql import functions as F

    from simsift.operators import search as ops
    from simsift.sources import cxsmiles

    _, query, _, held = tokens
    folder, lines = tmp_path / "in", [x for x in held[0] if x.strip()][:900]
    folder.mkdir()
    put = lambda name, part: (folder / f"{name}.cxsmiles.bz2").write_bytes(bz2.compress("\n".join(["head", *part]).encode()))
    asked = sorted(spark.range(1).select(ops.token_bits(F.lit(query)).alias("b")).first()["b"])
    fails = []

    def score(batch):
        if fails:
            raise RuntimeError(fails.pop())
        return ops.scored(batch.withColumn("bits", ops.token_bits(F.col("record"))), asked)

    def run():
        stream = cxsmiles.arriving_archives(spark, f"file://{folder}", f"file://{tmp_path}/log")
        return sorted(((r["tanimoto"], r["archive_index"], r["ligand_line"]) for r in top_k.fold_top_k(stream, score, 12, f"file://{tmp_path}/state").collect()), key=lambda r: (-r[0], r[1], r[2]))

    def want(order):
        scores = []
        for a, part in enumerate(order):
            for r in ops.scored(spark.createDataFrame([(a, "", n, x) for n, x in enumerate(part)], "archive_index int, source_file string, ligand_line bigint, record string").withColumn("bits", ops.token_bits(F.col("record"))), asked).collect():
                scores.append((r["tanimoto"], r["archive_index"], r["ligand_line"]))
        return sorted(scores, key=lambda r: (-r[0], r[1], r[2]))[:12]

    assert run() == []
    parts = [lines[k : k + 150] for k in range(0, 900, 150)]
    for name, part in zip("cde", parts):
        put(name, part)
    assert run() == want(parts[:3])
    put("a", parts[3])  # comes before the others in order of names, later in order of arrival
    fails.append("lost")
    with pytest.raises(Exception, match="lost"):
        run()
    put("b", parts[4])
    assert run() == want(parts[:5]) and run() == want(parts[:5])
    assert len(list((tmp_path / "state").glob("batch=*"))) <= 2


def test_tables_of_a_run_are_deleted(spark):
    table = space.written(spark.range(3), "gone")
    [folder] = {f.rpartition("/")[0] for f in table.inputFiles()}
    space.discard(spark)
    where, path = space.hadoop_path(spark, folder)
    assert not where.exists(path)


def test_a_cluster_needs_the_shared_folder():
    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda name, default: default)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint"):
        space.shared_dir(Cluster)



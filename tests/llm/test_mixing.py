import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from simsift.llm import mixing
from simsift.llm.mixing import mix, mixed


def targets(sizes, cap=3, cycle=3):
    """Reshares what capped sources leave until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % cycle + 1 for i, s in enumerate(names)}
    done, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in done]
        left = total - sum(done.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return {**done, **share}
        done |= {s: cap * sizes[s] for s in over}


def rows_of(seed, n):
    rng = random.Random(seed)
    return [(i, " ".join(["w"] * rng.randint(0, 30)) or None, "en", rng.choice(["a"] * 8 + ["b", "c", "d", None, "ä"])) for i in range(n)]


@pytest.mark.parametrize("seed,n", [(1, 400), (2, 60), (3, 1)])
def test_targets_sizes_and_shares(make, seed, n):
    rows = rows_of(seed, n)
    got = {r["doc_id"]: r for r in mix(make(rows)).collect()}
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, t, _, s in rows:
        sizes[s] += len(re.findall(r"\S+", t or ""))
        taken[s] += got[i]["taken"]
    want = targets(sizes)
    for i, t, _, s in rows:
        r = got[i]
        assert r["size"] == len(re.findall(r"\S+", t or "")) and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s], abs=1e-6) and r["taken"] in {0, r["size"], 2 * r["size"], 3 * r["size"]}
    assert sum(taken.values()) <= sum(sizes.values())
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 31


def queue(docs, cap=3):
    """doc_id to words taken, by one fair queue over plain lists."""
    sizes, lists = defaultdict(int), defaultdict(list)
    for r in docs.select("doc_id", "source", "text", F.xxhash64("text").alias("tie")).collect():
        size = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        place = hashlib.md5(f"mix|{'null' if r['doc_id'] is None else r['doc_id']}|{r['tie']}".encode()).hexdigest()
        sizes[r["source"]] += size
        if size:
            lists[r["source"]].append((place, r["doc_id"], r["tie"], size))
    want, items = targets(sizes, cap), []
    for rank, s in enumerate(sorted(sizes, key=lambda x: (x is None, x or ""))):
        for repeat in range(cap):
            upto = repeat * sizes[s]
            for d in sorted(lists[s]):
                if upto <= want[s]:
                    items.append(((upto + d[3]) / want[s], rank, repeat, d))
                upto += d[3]
    taken, total = defaultdict(int), 0
    for _, _, _, (_, doc_id, _, size) in sorted(items):
        total += size
        if total <= sum(sizes.values()):
            taken[doc_id] += size
    return taken


@pytest.mark.parametrize("seed,n,rows,spread", [(1, 400, 20, 3), (6, 60, 2, 2)])
def test_taken_words_equal_a_plain_queue(make, monkeypatch, seed, n, rows, spread):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", rows)
    monkeypatch.setattr(mixing, "SPREAD", spread)
    docs = make(rows_of(seed, n) + [(10_000 + i, None, "en", "empty") for i in range(30)])
    want = queue(docs)
    assert {r["doc_id"]: r["taken"] for r in mix(docs).collect()} == {r["doc_id"]: want[r["doc_id"]] for r in docs.collect()}


def test_reruns_agree_however_partitioned(make):
    docs = make(rows_of(7, 200))
    first = sorted((r["doc_id"], r["taken"]) for r in mix(docs).collect())
    assert first == sorted((r["doc_id"], r["taken"]) for r in mix(docs.repartition(7)).collect())


def test_defined_cases(odd, none):
    got = mix(odd).collect()
    assert len(got) == odd.count() and all(r["taken"] <= 3 * r["size"] for r in got)
    assert {r["size"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    assert mix(none).collect() == [] and mixed(none).collect() == []


def test_mixed_rows_are_the_counted_ones(odd, make):
    for docs in (odd, make(rows_of(4, 100))):
        rows = mixed(docs)
        assert rows.columns == docs.columns
        words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows.collect())
        assert words == sum(r["taken"] for r in mix(docs).collect())

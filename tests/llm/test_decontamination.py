import hashlib
import random
import re
from collections import Counter

import pytest

from simsift.llm import decontamination as d
from simsift.llm import _space, queries
from tests.compare import same
from tests.conftest import SMALL

LOW = str.maketrans(d.UPPER, d.LOWER)


def words(text):
    return re.findall(d.WORD, (text or "").translate(LOW))


def brute(docs, items, window):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, t in items:
            x = words(t)
            k = min(window, len(x))
            for s in range(len(x) - k + 1) if x else ():
                for p in range(len(w) - k + 1):
                    if w[p : p + k] == x[s : s + k]:
                        hit.update(range(p, p + k))
                        ids.add(str(item_id))
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def plain(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=str)


def near(docs, items, window):
    """n_near by doc_id: of each distinct window, where it first occurs, its two rarest words' places."""
    texts = [words(t) for _, t in docs]
    count, first, out = Counter(x for w in texts for x in w), {}, {}
    for item_id, t in sorted(set(items), key=lambda x: x[0]):
        x = words(t)
        k = min(window, len(x))
        for s in range(len(x) - k + 1) if x else ():
            first.setdefault(tuple(x[s : s + k]), set()).add(item_id)
    for (doc_id, _), w in zip(docs, texts):
        found = set()
        for g, ids in first.items():
            rare = [g[p] for p in sorted(range(len(g)), key=lambda p: (count[g[p]], p))[:2]]
            if count[rare[0]] and any(
                len(rare) == 1 and w[a] == rare[0] or len(rare) == 2 and a != b and abs(a - b) < window and w[a] == rare[0] and w[b] == rare[1] for a in range(len(w)) for b in range(max(0, a - window), min(len(w), a + window))
            ):
                found |= ids
        out[doc_id] = len(found)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_equal_brute_force(spark, make, seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("ab") + rng.choice(["", ",", "C"]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 40))) for i in range(40)]
    items = [(k % 6, text(rng.randint(0, 8))) for k in range(9)]
    got = d.contamination(make([(i, t, "en", "s") for i, t in docs]), spark.createDataFrame(items, "item_id long, text string"), window=4)
    assert plain(got) == brute(docs, items, 4)
    assert {r["doc_id"]: r["n_near"] for r in got.collect()} == near(docs, items, 4)


def test_defined_cases(spark, odd, none):
    items = spark.createDataFrame([(1, "cat sat on the mat, and looked at the dog for"), (1, "no id"), (2, None), (3, ""), (4, "ÜNÏCODE"), (10, "word")], "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd.collect() if len(r["text"] or "") < 1000]
    small = odd.where("text IS NULL OR length(text) < 1000")
    assert plain(d.contamination(small, items)) == brute(docs, [tuple(r) for r in items.collect()], 10)
    assert d.contamination(odd, items.limit(0)).where("contaminated").count() == 0
    assert d.contamination(odd, items).count() == odd.count()
    assert d.contamination(none, items).collect() == []


def test_shuffled_joins_give_the_same(spark, odd, monkeypatch):
    items = spark.createDataFrame([(1, "cat sat on the mat")], "item_id long, text string")
    want = plain(d.contamination(odd, items))
    monkeypatch.setattr(_space, "BROADCAST_ROWS", -1)
    assert plain(d.contamination(odd, items)) == want


def test_phrases_and_proximity(spark, make):
    docs = make([(0, "a b c a b x", "en", "s"), (1, "c b a", "en", "s"), (2, None, "en", "s")])
    index = d.build_index(d.split_words(docs))
    asked = spark.createDataFrame([(1, ["a", "b"]), (2, ["b", "a"]), (3, ["a", "b", "c"])], "phrase_id int, words array<string>")
    got = d.phrase_matches(index, asked).select("phrase_id", "doc_id", "start").collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0), (1, 0, 3), (2, 1, 1), (3, 0, 0)]
    near = d.proximity_matches(index, asked.withColumnRenamed("phrase_id", "query_id"), 3).select("query_id", "doc_id", "start").collect()
    pairs = [(0, 0), (0, 1), (0, 3), (1, 1)]
    assert sorted(map(tuple, near)) == [(q, *x) for q in (1, 2) for x in pairs] + [(3, 0, 0), (3, 0, 1), (3, 0, 2), (3, 1, 0)]


def test_picks_beside_each_other_and_repeated_rows(spark, make):
    """Windows of one word, windows whose picks are one place, and rows that repeat."""
    rows = [(1, "x y x y z", "en", "s")] * 3 + [(2, "y", "en", "s")]
    items = spark.createDataFrame([(1, "x x x x"), (2, "y"), (3, "x y x"), (4, "q y x y z r")], "item_id long, text string")
    for window in (1, 2, 3):
        got = d.contamination(make(rows), items, window)
        assert plain(got) == brute([r[:2] for r in rows], [tuple(r) for r in items.collect()], window)


def test_query_equals_sql(spark):
    same(spark, SMALL, queries.QUERIES["op6_decontamination"], queries.SQL["op6_decontamination"])


def test_texts_that_repeat_themselves(spark, make):
    """Number tables, lyrics, junk: long texts of few words against items of the same."""
    pair = lambda n: " ".join(["la", "li"] * (n // 2))
    items = [(1, "la " * 200), (2, pair(60)), (3, "la " * 7), (4, "la " * 30 + "lu " + "la " * 30)]
    texts = ["la " * 500, pair(400) + " la la la", "la " * 40 + "lu " + "la " * 12, "li " * 300, "la la la la la la la"]
    got = d.contamination(make([(i, t, "en", "s") for i, t in enumerate(texts)]), spark.createDataFrame(items, "item_id long, text string"))
    assert plain(got) == brute(list(enumerate(texts)), items, 10)


def test_100_kb_of_one_word_against_1000_words_take_seconds(spark, make):
    import time

    began = time.monotonic()
    docs = make([(i, "la " * 33_000, "en", "s") for i in range(3)])
    rows = d.contamination(docs, spark.createDataFrame([(1, "la " * 1_000)], "item_id long, text string")).collect()
    assert [(r["n_words"], r["n_hit"], r["n_items"], r["n_near"]) for r in rows] == [(33_000, 33_000, 1, 1)] * 3
    assert time.monotonic() - began < 60


def test_words_that_nobody_asks_for_are_not_shuffled(spark, make, monkeypatch):
    """Too many places to broadcast, as on any large corpus: of a hit document only the asked words move."""
    passage = "zig zag zog zug zeg alpha beta gamma delta omega"
    docs = make([(i, "the of " * 2_500 + passage + f" w{i}" + " and in" * 2_500, "en", "s") for i in range(20)])
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    monkeypatch.setattr(_space, "BROADCAST_ROWS", 50)
    stages = lambda: {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in _listed(spark)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        old = stages()
        rows = d.contamination(docs, items).collect()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        moved = sum(n for k, n in stages().items() if k not in old)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [(r["n_words"], r["n_hit"], r["n_items"]) for r in rows] == [(10_011, 10, 1)] * 20
    assert moved < 20_000  # of 200,220 words


def _listed(spark):
    store, empty = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    found = store.stageList(None, False, False, empty, None)
    return [found.apply(i) for i in range(found.size())]

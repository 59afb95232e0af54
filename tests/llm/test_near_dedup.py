import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from simsift.llm import near_dedup as nd
from simsift.llm import _space, queries
from tests.compare import same
from tests.conftest import SMALL

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(rows, width):
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        out.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    return out


def brute(rows, width, percent=80):
    sets, root = sets_of(rows, width), list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]
    return sorted(((d, n, c, d == c) for d, n, c in out), key=str)


def edited(rng, words, rate):
    return [rng.choice("qxyz") + str(rng.randint(0, 999)) if rng.random() < rate else w for w in words]


def corpus(seed):
    """A star of near copies, a chain, pairs at the threshold, unlike texts and exact copies."""
    rng = random.Random(seed)
    new = lambda n: [f"w{rng.randint(0, 3000)}" for _ in range(n)]
    hub, texts = new(120), []
    texts += [edited(rng, hub, rng.choice([0.01, 0.03, 0.05, 0.08])) for _ in range(120)] + [hub] * 5
    link = new(80)
    for _ in range(25):
        link = edited(rng, link, 0.025)
        texts.append(link)
    for n in (9, 18, 45, 90):
        a = new(n)
        for k in (n // 9 - 1, n // 9, n // 9 + 1):
            texts += [a, a[: n - k] + new(k)]
    texts += [new(rng.randint(0, 60)) for _ in range(80)]
    rng.shuffle(texts)
    return [(i * 3, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,width", [(1, 2), (3, 5)])
def test_classes_equal_brute_force(make, seed, width):
    rows = corpus(seed)
    got = nd.near_duplicates(make([(i, t, "en", "s") for i, t in rows]), width)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, width)


def test_dense_regions_in_blocks_give_the_same(make, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 8)
    monkeypatch.setattr(nd, "PAIRS_A_TASK", 5)
    monkeypatch.setattr(_space, "BROADCAST_ROWS", -1)
    rows = corpus(4)[:170]
    got = nd.near_duplicates(make([(i, t, "en", "s") for i, t in rows]).repartition(3), 2)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 2)


def test_defined_cases(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for width in (2, 5):
        assert sorted(map(tuple, nd.near_duplicates(odd, width).collect()), key=str) == brute(rows, width)
    assert nd.near_duplicates(none).collect() == []


def test_components_of_long_chains(spark):
    b = lambda i: i.to_bytes(16, "big")
    rng = random.Random(2)
    names = list(range(60))
    rng.shuffle(names)
    edges = [(b(x), b(y)) for x, y in zip(names, names[1:])] + [(b(100), b(101)), (b(102), b(101))]
    label = {int.from_bytes(r["v"], "big"): r["root"] for r in nd.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert len(label) == 63 and len({label[x] for x in names}) == 1 and label[100] == label[101] == label[102] != label[0]


def test_the_forest_keeps_its_miss_rate():
    for rows in (1, 10**6, 10**8, 10**11):
        depth, trees = nd.forest_shape(rows)
        assert (1 - 0.8**depth) ** trees <= nd.MISS and trees < 200


def test_query_equals_sql(spark):
    same(spark, SMALL, queries.QUERIES["op2_near_dedup"], queries.SQL["op2_near_dedup"])


def test_no_tile_holds_a_region_of_many_components(make, spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 16)
    b = lambda i: i.to_bytes(16, "big")
    rows = spark.createDataFrame([(1, b(i), b(i), i > 0, 400, 399) for i in range(400)], "k long, sid binary, root binary, asks boolean, size int, n_asks int")
    dealt = nd.tiles(rows)
    got = dealt.collect()
    held, met = {}, set()
    for r in got:
        held.setdefault((r["askers"], r["block"]), []).append(r)
    assert max(map(len, held.values())) <= 4 * 16 and "text" not in dealt.columns
    for tile in held.values():
        assert len({r["sid"] for r in tile}) == len(tile)
        met |= {(x["sid"], y["sid"]) for x in tile if x["asks"] for y in tile if y["here"]}
    assert met == {(b(i), b(j)) for i in range(1, 400) for j in range(400)}


def family(seed, n, rate):
    """Texts of one template that are mostly unlinked, some of them with a near copy."""
    rng = random.Random(seed)
    base, texts = [f"w{i}" for i in range(120)], []
    for _ in range(n):
        texts.append(edited(rng, base, rate))
        if rng.random() < 0.2:
            texts.append(edited(rng, texts[-1], 0.01))
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_signatures_sort_and_go_on_deeper():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 63, 40).astype(np.uint64) for _ in range(5)]
    sets.append(np.append(sets[0][:39], sets[1][:1]))
    depth, trees = nd.forest_shape(1)
    short, more = nd.signatures(sets, depth, trees), nd.trees_at(depth + nd.STEP, 80)
    long = nd.signatures(sets, depth + nd.STEP, more)
    a, b = 2 * (depth + nd.STEP + 1), 2 * (depth + 2 * nd.STEP + 1)
    assert more > trees and all(len(x) == a * trees and len(y) == b * more for x, y in zip(short, long))
    for x, y in zip(short, long):
        assert all(x[t * a : t * a + a] == y[t * b : t * b + a] for t in range(trees))
    assert sum(long[0][t * b : t * b + a] == long[5][t * b : t * b + a] for t in range(more)) > 0
    assert (1 - 0.8 ** (depth + nd.STEP)) ** more <= nd.MISS / nd.LEVELS


def test_neighbours_have_the_longest_common_prefix(spark):
    rng = random.Random(9)
    b = lambda i: i.to_bytes(4, "big")
    rows = [(b(t) + bytes(rng.choice(b"ab") for _ in range(3)), i, rng.randint(0, 3)) for t in range(2) for i in range(60)]
    rows = sorted((sign, b(100 * sign[3] + i), root) for sign, i, root in rows)
    table = spark.createDataFrame([(s[:5], sid, b(root), s) for s, sid, root in rows], "k binary, sid binary, root binary, sign binary")
    want = {(min(x[1], y[1]), max(x[1], y[1])) for x, y in zip(rows, rows[1:]) if x[0][:5] == y[0][:5] and x[2] != y[2]}
    whole = {tuple(map(bytes, r)) for r in nd.neighbours(table.coalesce(1)).select("leaf", "hub").collect()}
    assert whole <= want and len(want - whole) < 8
    k, signs = spark.range(1).select(F.lit(b(0)[:2] + b(7)).alias("k"), F.lit(bytes(range(20))).alias("s")).select("k", nd.sign_in(F.lit(b"\x00\x01xx"), F.col("s"), 10)).first()
    assert bytes(signs) == bytes(range(10, 20))


def test_families_of_unlinked_texts(make, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 8)
    depths, plain = [], nd.deeper
    monkeypatch.setattr(nd, "deeper", lambda texts, width, depth, trees: depths.append(depth) or plain(texts, width, depth, trees))
    rows = family(5, 60, 0.07)
    got = nd.near_duplicates(make([(i, t, "en", "s") for i, t in rows]).repartition(3), 2)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 2)
    assert depths and depths[0] == 8

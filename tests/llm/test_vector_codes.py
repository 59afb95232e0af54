"""Product codes: against whole-number loops, limb products against Python's integers, odd rows."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from simsift.llm import vector_codes as vc
from tests.compare import same
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<double>, label int, q string, code int, part int"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """rows (vec_id, vector, label), ids distinct: code, error, label error by id, and the codebooks' digest."""
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    part = lambda v, p: v[p * width : (p + 1) * width]
    books = [[part(v, p) for _, v, _ in sorted(kept)[:entries]] for p in range(parts)]

    def best(v, p):
        far = [sum((a - b) ** 2 for a, b in zip(part(v, p), c)) for c in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        chosen = [[best(v, p)[0] for p in range(parts)] for _, v, _ in kept]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [part(v, p) for (_, v, _), c in zip(kept, chosen) if c[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    out, labels = {}, {}
    for i, v, label in kept:
        found = [best(v, p) for p in range(parts)]
        out[i] = ("".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), label)
        labels[label] = labels.get(label, 0) + out[i][1]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return {i: (code, error, labels[label], digest) for i, (code, error, label) in out.items()}


def coded(spark, rows):
    frame = spark.createDataFrame([(i, v, label, "x", 1, 2) for i, v, label in rows], SCHEMA).repartition(3)
    return {r["vec_id"]: (r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in vc.compressed(frame).collect()}


def random_rows(n, dims, size, seed=1):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rng.normal(size=dims) * size], None if i % 5 == 0 else int(i % 3)) for i in rng.permutation(n)]


@pytest.mark.parametrize("size", [0.3, 4000.0, 1e6, 1e12])
def test_codes_equal_those_of_whole_number_loops(spark, size):
    """Small ones in one limb, then two limbs, then beyond int64."""
    rows = random_rows(60, 16, size)
    got, want = coded(spark, rows), plain(rows)
    within = lambda r: (r[0], r[1] if r[1] < 1 << 63 else None, r[2] if r[2] < 1 << 63 else None, r[3])
    if size < 1e9:
        assert got == {i: within(r) for i, r in want.items()}
    else:
        assert {i: (r[0], r[3]) for i, r in got.items()} == {i: (r[0], r[3]) for i, r in want.items()}
        assert {i: r[1] for i, r in got.items()} == {i: within(r)[1] for i, r in want.items()}


def test_ties_repeated_rows_and_few_vectors(spark):
    rows = [(i, [float(i % 2)] * 8, 1) for i in range(9)]
    assert coded(spark, rows) == plain(rows)
    assert coded(spark, rows[:1]) == plain(rows[:1])
    twice = spark.createDataFrame([(1, [0.5] * 8, 2, "x", 1, 2)] * 3, SCHEMA)
    assert [tuple(r)[:1] + (r["code"], r["error"]) for r in vc.compressed(twice).collect()] == [(1, "00" * 8, 0)] * 3


def test_unsound_vectors_are_dropped(spark):
    good = random_rows(20, 8, 1.0)
    odd = [(100, None, 1), (101, [], 1), (102, [1.0, None] * 4, 1), (103, [float("nan")] * 8, 1), (104, [float("inf")] * 8, None), (105, [1.0] * 7, 1), (106, [1.0] * 16, 1), (-1, [-float("inf")] + [0.0] * 7, 1)]
    assert coded(spark, good + odd) == plain(good)


def test_null_ids_come_last(spark):
    rows = random_rows(20, 8, 1.0)
    frame = spark.createDataFrame([(i, v, label, "x", 1, 2) for i, v, label in [*rows, (None, [5.0] * 8, 1)]], SCHEMA)
    got = vc.compressed(frame).collect()
    assert len(got) == 21 and sum(r["vec_id"] is None for r in got) == 1


def test_an_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert vc.compressed(none).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 33), st.integers(1, 40), st.randoms(use_true_random=False))
def test_limb_products_are_exact(width, bits, rnd):
    greatest = (1 << bits) - 1
    draw = lambda n: [[rnd.randint(-greatest, greatest) for _ in range(width)] for _ in range(n)]
    x, c = draw(4), draw(3)
    got = vc.exact_products(np.array(x, np.int64), np.array(c, np.int64), greatest)
    wrapped = lambda v: (v + (1 << 63)) % (1 << 64) - (1 << 63)
    assert got.tolist() == [[wrapped(sum(a * b for a, b in zip(r, e))) for e in c] for r in x]
    size = vc.limb_bits(width)
    assert width * (1 << 2 * size) < 1 << 53


def test_the_query_equals_sql(spark):
    from simsift.llm import queries

    same(spark, SMALL, queries.QUERIES["op11_vector_codes"], queries.SQL["op11_vector_codes"])

"""Runs by synchronising sets against trying every period at every place."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import example, given, settings
from hypothesis import strategies as st

from simsift.llm import periodic_runs as pr
from simsift.llm import queries
from tests.conftest import SMALL
from tests.llm.conftest import LONG


def plain_runs(words, least=6):
    """start, length, period: stretches of equal words q apart, smallest q first."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 4 * q) and (i, j + q - i) not in found:
                found[i, j + q - i] = q
            i = j
    return sorted((a, n, q) for (a, n), q in found.items())


def ours(*texts):
    """Of each list of words, all worked on at once."""
    number = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    words = np.array([x for k, t in enumerate(texts) for x in [*[number[w] + len(number) * k for w in t], -1 - k]], np.int64)
    text_of = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    out = [[] for _ in texts]
    for a, b, p in zip(*(x.tolist() for x in pr.find_runs(words, text_of))):
        if b - a >= 6:
            out[text_of[a]].append((a - int(first[text_of[a]]), b - a, p))
    return [sorted(x) for x in out]


#: Words, and pieces of them repeated, some of which are repeated again.
piece = st.recursive(st.text(alphabet="ab", min_size=1, max_size=6), lambda inner: st.builds(lambda a, n, b: a * n + b, inner, st.integers(1, 9), inner), max_leaves=6)


@settings(max_examples=400, deadline=None)
@given(st.lists(piece.map(lambda s: s[:300]), min_size=1, max_size=3))
@example(["a" * 64, "ab" * 40, ("aaaaaaab" * 9) + "a" * 30])
@example([("a" * 20 + "b") * 8, "abaab" * 20 + "abaa"])
@example(["a" * 6, "a" * 5, "ab" * 4, "ab" * 3 + "a"])
def test_runs_are_those_of_trying_all(texts):
    assert ours(*[list(t) for t in texts]) == [plain_runs(list(t)) for t in texts]


def test_long_periods_among_random_words():
    rng = np.random.default_rng(3)
    for p in [1, 2, 3, 4, 5, 7, 8, 15, 16, 31, 33, 64, 100, 127, 128]:
        block = rng.integers(0, 3, p).tolist()
        text = [*rng.integers(0, 9, 50).tolist(), *(block * 6)[: 4 * p + p // 2 + 4], *rng.integers(0, 9, 50).tolist()]
        assert ours(text) == [plain_runs(text)]


def test_the_sets_are_sparse():
    """About a place in tau / 2 of random words, and hardly any in a periodic text."""
    rng = np.random.default_rng(5)
    for words, bound in ((rng.integers(0, 50, 20_000), 4.0), (np.zeros(20_000, int), 4.0)):
        names, tau, none = np.unique(words, return_inverse=True)[1], 1, np.zeros(20_000, bool)
        while tau < 64:
            names, tau = pr._doubled(names, tau)[0], 2 * tau
        periodic = none if len(set(words)) > 1 else np.arange(20_000) <= 20_000 - 64
        assert len(pr._synchronising(names, 64, periodic)) <= bound * 20_000 / 64


def collapse(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_odd_rows(odd, none):
    rows = pr.periodic_runs(odd.repartition(3)).collect()
    want = []
    for r in odd.collect():
        words = split(r["text"])
        runs = [(0, len(words), 2)] if r["text"] == LONG else plain_runs(words)
        want.append((r["doc_id"], len(words), runs, collapse(words, runs)))
    assert sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in rows), key=str) == sorted(want, key=str)
    assert pr.periodic_runs(none).collect() == []


def test_spaces_are_the_six_and_no_others(make):
    [row] = pr.periodic_runs(make([(1, "x y\x1cz \x0b\x0c\r\n\tx y\x1cz", "en", "a")])).collect()
    assert row["n_words"] == 2


def test_the_query_as_registered(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = queries.QUERIES["op13_periodic_runs"](spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    with_runs = 0
    for r in rows:
        words = split(texts[r["doc_id"]])
        n, h = len(words), zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words) if n < 2000 else [tuple(x) for x in ours(words)[0]]
        with_runs += bool(runs)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        lead = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        text = "".join(f"{a},{m},{q}\n" for a, m, q in sorted(runs, key=lambda x: (x[0], x[2])))
        assert tuple(r)[:8] == (r["doc_id"], len(runs), *lead, sha(text), sha(collapse(words, runs)))
    assert with_runs > 5

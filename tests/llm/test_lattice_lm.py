import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from simsift.llm import lattice_lm as lm
from simsift.llm.language_id import in_fold
from tests.conftest import SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def pieces():
    return lm.Pieces(PATH)


def paths(pieces, w, word):
    """The log of the sum over all segmentations, by listing them."""
    names = [{}, {}]
    for which in (0, 1):
        for i in range(len(word) + 1):
            for j in range(i, len(word) + 1):
                buf = np.frombuffer(word, np.uint8)
                at, piece = pieces.find(which, lm.span_hashes(buf, np.array([i]), np.array([j])))
                if len(at):
                    names[which][word[i:j]] = piece[0]

    def rest(i):
        if i == len(word):
            return 1.0
        return sum(math.exp(w.inner[names[1][word[i:j]]]) * rest(j) for j in range(i + 1, len(word) + 1) if word[i:j] in names[1])

    total = sum(math.exp(w.first[names[0][word[:j]]]) * rest(j) for j in range(len(word) + 1) if word[:j] in names[0])
    return math.log(total) + w.stop


def test_forward_recursion_sums_all_segmentations(pieces):
    w = lm.Weights(pieces.tables[0][2], pieces.tables[1][2], 0.3)
    words = [b"the", b"a", "über".encode(), b"nation", b"zq\x01x", b"\xf0\x9f\x98\x80", b"token"]
    seen = 0
    for rows, lattice in lm.lattices(pieces, pa.array(words, pa.binary())):
        for k, p in zip(rows, lattice.log_probability(w)):
            assert p == pytest.approx(paths(pieces, w, words[k]), rel=1e-9)
            seen += 1
    assert seen == len(words)


def test_expected_uses_explain_each_word_once(pieces):
    w = lm.Weights(pieces.tables[0][2], pieces.tables[1][2], 0.3)
    first, inner = np.zeros(len(w.first)), np.zeros(len(w.inner))
    words = [b"station", b"x", b"the"]
    for _, lattice in lm.lattices(pieces, pa.array(words, pa.binary())):
        lattice.expected(w, first, inner)
    assert first.sum() == pytest.approx(3) and 0 < inner.sum() < sum(map(len, words))


def test_long_words_arc_by_arc_are_the_same(pieces, monkeypatch):
    w = lm.Weights(pieces.tables[0][2], pieces.tables[1][2], 0.3)
    words = [b"station", b"inter\xc3\xbcnational" * 20]
    got = []
    for limit in (10_000, 1):
        monkeypatch.setattr(lm, "LONG_WORD", limit)
        first, inner, logs = np.zeros(len(w.first)), np.zeros(len(w.inner)), {}
        for rows, lattice in lm.lattices(pieces, pa.array(words, pa.binary())):
            lattice.expected(w, first, inner)
            logs |= dict(zip(rows.tolist(), lattice.log_probability(w)))
        got.append((logs[0], logs[1], *first, *inner))
    assert got[0] == pytest.approx(got[1], rel=1e-9, abs=1e-12)
    [(_, lattice)] = list(lm.lattices(pieces, pa.array([b"QWxhZGRpbjpvcGVu" * 4000], pa.binary())))
    assert math.isfinite(lattice.log_probability(w)[0])


def brute_scores(pieces, rows, kinds):
    """doc_id, score, lattice_score of rows(doc_id, text, kind, held_out), word by word: the model's
    weights are taken from the operator's own learning, all sums are made here."""
    train = [(words(t), k) for _, t, k, out in rows if not out]
    names = [k for k, _ in sorted(Counter(k for _, k in train if k is not None).items(), key=lambda x: (-x[1], x[0]))][: lm.MAX_KINDS - 1]
    number = {k: i for i, k in enumerate(names)}
    own = [Counter() for _ in range(len(names) + 1)]
    docs = [0] * len(own)
    for w, k in train:
        own[number.get(k, len(names))].update(w)
        docs[number.get(k, len(names))] += 1
    every = sum(own, Counter())
    n, once, twice = sum(every.values()), sum(v == 1 for v in every.values()), sum(v == 2 for v in every.values())
    d, total = min(0.95, max(0.3, once / max(1, once + 2 * twice))), sum(docs)
    spread = pa.array([w.encode() for w in sorted(every)], pa.binary())
    first, inner, w = pieces.tables[0][2], pieces.tables[1][2], lm.Weights(pieces.tables[0][2], pieces.tables[1][2], 0.3)
    for _ in range(lm.ROUNDS if len(every) else 0):
        a, b = np.zeros(len(first)), np.zeros(len(inner))
        for _, lattice in lm.lattices(pieces, spread):
            lattice.expected(w, a, b)
        w = lm.Weights((a + lm.PRIOR * first) / (a.sum() + lm.PRIOR), (b + lm.PRIOR * inner) / (b.sum() + lm.PRIOR), (a.sum() + 0.3) / (a.sum() + b.sum() + 1))
    path = lambda x: math.exp([lattice for _, lattice in lm.lattices(pieces, pa.array([x.encode()], pa.binary()))][0].log_probability(w)[0])
    ends, share = [(x + 1) / (sum(c.values()) + x + 2) for x, c in zip(docs, own)], [(x + 1) / (total + len(own)) for x in docs]
    end, known, out = (total + 1) / (n + total + 2), {}, []
    for i, t, _, _ in rows:
        in_kind, alone = [math.log10(s) + math.log10(e) for s, e in zip(share, ends)], math.log10(end)
        for x in words(t):
            if x not in known:
                p = path(x)
                all_ = max(every[x] - d, 0) / max(1, n) + (d * len(every) / n if n else 1) * p
                mine = [max(c[x] - d, 0) / max(1, sum(c.values())) + (d * len(c) / sum(c.values()) if c else 1) * all_ for c in own]
                known[x] = math.log10(p * (1 - end)), [math.log10(q * (1 - e)) for q, e in zip(mine, ends)]
            alone += known[x][0]
            in_kind = [a + b for a, b in zip(in_kind, known[x][1])]
        out.append((i, max(in_kind) + math.log10(sum(10 ** (x - max(in_kind)) for x in in_kind)), alone))
    return out


def test_document_scores_equal_brute_force(spark, pieces):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("held_out", in_fold(F.col("doc_id"), 10, 0)).where("length(text) < 1500")
    rows = [(r["doc_id"], r["text"], r["lang"], r["held_out"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["score"], r["lattice_score"]) for r in lm.score(docs, PATH, "lang").collect()}
    for i, score, alone in brute_scores(pieces, rows, "lang"):
        assert got[i] == pytest.approx((score, alone), rel=1e-6)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def base(rows):
    """doc_id, n_tokens, n_known, train_tokens, base_score by the formula."""
    c, docs = Counter(), 0
    for _, t, out in rows:
        if not out:
            c.update(words(t))
            docs += 1
    n, v = sum(c.values()) + docs, len(c) + (docs > 0)
    p = lambda k: math.log10((k + 0.1) / (n + 0.1 * (v + 1)))
    return [(i, len(words(t)) + 1, sum(c[x] > 0 for x in words(t)) + (docs > 0), n, round(sum(p(c[x]) for x in words(t)) + p(docs), 6)) for i, t, _ in rows]


def plain(got):
    return sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=str)


@pytest.mark.parametrize("frequent", [2_000_000, 200, 1])
def test_base_scores_and_counts(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("held_out", in_fold(F.col("doc_id"), 10, 0))
    got = lm.score(docs, PATH, "lang").collect()
    rows = [(r["doc_id"], r["text"], r["held_out"]) for r in docs.collect()]
    assert plain(got) == sorted(base(rows), key=str)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    test_base_scores_and_counts.seen = getattr(test_base_scores_and_counts, "seen", None) or {r["doc_id"]: r["score"] for r in got}
    for r in got:
        assert r["score"] == pytest.approx(test_base_scores_and_counts.seen[r["doc_id"]], rel=1e-9)


def test_word_probabilities_stay_below_one(pieces):
    t = lm.Totals([50, 30], [10, 8], [5, 4], 14, 6, 3)
    c = np.array([[20, 0], [10, 10], [1, 0], [0, 1], [0, 0]])
    p = 10 ** t.weights(c, np.log(np.array([1e-3, 1e-3, 1e-4, 1e-5, 1e-6])))
    assert (p > 0).all() and (p.sum(0) < 1).all() and p[0, 0] > p[0, 1]


def test_defined_cases(odd, none):
    docs = odd.withColumn("held_out", F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False)))
    rows = [(r["doc_id"], r["text"], r["held_out"]) for r in docs.collect()]
    assert plain(lm.score(docs, PATH, "lang").collect()) == sorted(base(rows), key=str)
    untrained = docs.withColumn("held_out", F.lit(True))
    got = lm.score(untrained, PATH).collect()
    assert plain(got) == sorted(base([(i, t, True) for i, t, _ in rows]), key=str) and all(math.isfinite(r["score"]) for r in got)
    assert lm.score(none.withColumn("held_out", F.lit(False)), PATH, "lang").collect() == []

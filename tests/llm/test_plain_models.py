"""The classifiers' learning, features and scores against plain loops over bytes and words.

The queries' own models are taken; every score of the table is made again from its text, feature by feature.
"""

import math
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from simsift.llm import _ftrl, language_id, quality, toxicity
from simsift.llm._text import chunks
from simsift.llm.language_id import in_fold
from tests.conftest import SMALL

MASK = (1 << 64) - 1
ODD = 0x9E3779B97F4A7C15


def mixed(h):
    h ^= h >> 33
    h = h * 0xFF51AFD7ED558CCD & MASK
    h ^= h >> 33
    h = h * 0xC4CEB9FE1A85EC53 & MASK
    return h ^ h >> 33


def hashed(span):
    """Sum of (byte + 1) times powers of a constant, and the length, mixed."""
    return mixed((sum((b + 1) * pow(ODD, k, 1 << 64) for k, b in enumerate(span)) + len(span)) & MASK)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}


def lowered(data):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in data)


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-35, min(35, x))))


def test_updates_are_those_of_the_algorithm(spark, monkeypatch):
    """Per weight: w = -sign(z) max(|z| - l1, 0) / ((beta + sqrt n) / alpha + l2), then z and n are moved."""
    rng = np.random.default_rng(4)
    rows = [([int(rng.integers(2)) for _ in range(2)], sorted(rng.choice(30, 4, replace=False).tolist()), rng.random(4).astype(np.float32).tolist()) for _ in range(80)]
    tables, written = [], _ftrl.written
    monkeypatch.setattr(_ftrl, "written", lambda df, label: tables.append(written(df, label)) or tables[-1])
    alpha, beta, l1, l2 = 0.4, 1.0, 0.05, 0.02
    got = _ftrl.train(spark.createDataFrame(rows, _ftrl.EXAMPLE), 2, 30, epochs=3, parts=1, alpha=alpha, l1=l1, l2=l2)
    stored = tables[0].collect()
    z, n = [[0.0] * 30 for _ in range(2)], [[0.0] * 30 for _ in range(2)]
    weight = lambda o, i: 0.0 if abs(z[o][i]) <= l1 else -math.copysign(abs(z[o][i]) - l1, z[o][i]) / ((beta + math.sqrt(n[o][i])) / alpha + l2)
    for epoch in range(3):
        for k in np.random.default_rng(epoch).permutation(len(stored)):
            y, idx, val = stored[int(k)]
            for o in range(2):
                w = [weight(o, i) for i in idx]
                p = sigmoid(sum(a * b for a, b in zip(w, val)))
                for i, x, old in zip(idx, val, w):
                    g = (p - y[o]) * x
                    z[o][i] += g - (math.sqrt(n[o][i] + g * g) - math.sqrt(n[o][i])) / alpha * old
                    n[o][i] += g * g
    assert np.allclose(got, [[weight(o, i) for i in range(30)] for o in range(2)], atol=2e-3)


def test_language_ids_are_those_of_a_plain_decoder(docs, texts):
    model = language_id.fit(docs.where(~in_fold(F.col("doc_id"), 4, 2)))
    weights, code = model.weights.astype(float), model.code.astype(float)
    rows = language_id.predict(docs.select("doc_id", "text"), model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        data = texts[r["doc_id"]]
        if not any(unicodedata.category(c).startswith("L") for c in data.decode()):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        letters = re.sub(rb"[^a-z\x80-\xff]+", b" ", lowered(data))
        grams = {}
        for n in (1, 2, 3):
            for k in range(len(letters) - n + 1):
                value = n
                for b in letters[k : k + n]:
                    value = value * 257 + b & MASK
                slot = ((value * ODD & MASK) >> 40) % (language_id.BUCKETS - 1)
                grams[slot] = grams.get(slot, 0) + 1
        norm = math.sqrt(sum(grams.values()))
        margins = [max(-30, min(30, weights[o][-1] + sum(weights[o][s] * math.sqrt(c) / norm for s, c in grams.items()))) for o in range(len(weights))]
        loss = [sum(math.log1p(math.exp(-m * word[o])) * trust[o] for o, m in enumerate(margins)) for word, trust in zip(code, model.trust)]
        best = min(range(len(loss)), key=lambda k: (loss[k], k))
        share = [math.exp(-code.shape[1] * (x - loss[best])) for x in loss]
        assert r["lang_pred"] == model.languages[best] and r["score"] == pytest.approx(1 / sum(share), abs=2e-3)


def test_quality_scores_are_plain_dot_products(docs, texts, spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    weights = quality.fit(docs.where(~in_fold(F.col("doc_id"), 5, 0)).join(labels, "doc_id").select("doc_id", "text", "quality"))
    assert np.count_nonzero(weights) > 100
    for r in quality.score(docs.select("doc_id", "text"), weights).collect():
        parts = [hashed(m.group()) for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0D]+", texts[r["doc_id"]])]
        pairs = [0x123456789ABCDEF if a == b else mixed((a * 0xD6E8FEB86659FD93 + b) & MASK) for a, b in zip(parts, parts[1:])]
        counts = {}
        for h in [*parts, *pairs]:
            slot = (h >> 20) % (quality.BUCKETS - 1)
            counts[slot] = counts.get(slot, 0) + 1
        norm = math.sqrt(sum(counts.values())) or 1.0
        score = sigmoid(float(weights[-1]) + sum(float(weights[s]) * math.sqrt(c) / norm for s, c in counts.items()))
        assert r["score"] == pytest.approx(score, abs=1e-4) and r["predicted"] == (r["score"] >= 0.3)


def test_toxicity_scores_are_plain_dot_products_of_restored_texts(docs, texts, spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "toxic")
    learn = docs.where(~in_fold(F.col("doc_id"), 4, 2))
    model = toxicity.fit(learn, learn.join(labels, "doc_id").select("doc_id", "text", "toxic"))
    restorer = toxicity.Restorer(model.chars)
    import pyarrow as pa

    for r in toxicity.score(docs.select("doc_id", "text"), model).collect():
        [chunk] = chunks(pa.array([texts[r["doc_id"]].decode()]))
        restored = lowered(restorer.chunk(chunk).buf.tobytes())
        counts, once = {}, {}
        for m in re.finditer(rb"[a-z\x80-\xff]+", restored):
            once[m.group()] = once.get(m.group(), 0) + 1
        for word, n in once.items():
            for h in [hashed(word), *(hashed(word[:size]) ^ size for size in toxicity.BEGINNINGS if len(word) > size)]:
                slot = (h >> 20) % (quality.BUCKETS - 1)
                counts[slot] = counts.get(slot, 0) + n
        score = sigmoid(float(model.weights[-1]) + sum(float(model.weights[s]) * math.log2(1 + c) for s, c in counts.items()))
        assert r["score"] == pytest.approx(score, abs=1e-4) and r["predicted"] == (r["score"] >= 0.3)


def test_trigram_costs_are_plain_counts(docs, texts):
    """Of the channel's language model: counts of letters by the two before, words' edges as a letter."""
    counted = toxicity.char_counts(docs)
    plain = {}
    for data in texts.values():
        code = [0, 0]
        for b in lowered(data):
            code.append(b - 96 if 97 <= b <= 122 else 27 if b >= 128 else 0)
        code.append(0)
        for a, b, c in zip(code, code[1:], code[2:]):
            plain[a, b, c] = plain.get((a, b, c), 0) + 1
    plain.pop((0, 0, 0), None)
    inner = {k: v for k, v in plain.items() if k[0] and k[1]}  # texts of a chunk share their edges
    assert {k: counted[k[0] * 784 + k[1] * 28 + k[2]] for k in inner} == inner

"""Language identification by error-correcting output codes.

Every language has a codeword of bits. A binary classifier of byte n-grams (hashed, logistic,
FTRL) predicts each bit, for all bits at once. Decoding is loss-weighted: the loss of each bit's
margin against each codeword, weighted by how often that bit's classifier is right for that
language on the training rows; the least loss wins. Rows whose two least losses lie close are
flagged as ambiguous.

The classifiers learn from a sample of labelled rows: up to about SAMPLE_ROWS / languages, but
LEAST_ROWS at least, of each language, chosen by hash of doc_id and text, so that a rare language is
learned at any size. Prediction reads the whole text and nothing else. The languages themselves are
the model's size: their list, bits that grow with its logarithm, and nothing else goes to the driver.

Defined cases: a null text, or one without a letter, is `und` with score 0; with no labelled
training rows every row is `und`; with one language all texts with letters are that language with
score 1; rows that repeat are predicted alike; other columns don't matter.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simsift.llm._ftrl import lists, map_texts, train
from simsift.llm._space import written
from simsift.llm._text import LOWER, Chunk

SAMPLE_ROWS, LEAST_ROWS, BUCKETS, GRAMS, UNKNOWN = 6_000, 20, 1 << 13, (1, 2, 3), "und"
AMBIGUOUS = 0.1
_LETTERS = re.compile(r"[^\W\d_]+")


def has_letter(text: str) -> bool:
    """Whether a character is of the Unicode categories L*; number signs as in "½" are none."""
    return any(c.isalpha() for m in _LETTERS.finditer(text) for c in m.group())


def codewords(classes: int) -> np.ndarray:
    """+1/-1, classes x bits. Up to 7 classes all ways to split them in two; beyond, the best of
    random codes (10 bits a doubling) by the least distance of two codewords."""
    if classes < 2:
        return np.ones((classes, 1), np.int8)
    if classes <= 7:
        splits = np.arange(1, 1 << (classes - 1))
        return np.where(splits[None, :] >> np.arange(classes)[:, None] & 1, 1, -1).astype(np.int8)
    bits, best, code = int(10 * np.log2(classes)), -1, None
    for seed in range(200 if classes <= 100 else 5):
        c = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (classes, bits))
        same = c.astype(int) @ c.T
        np.fill_diagonal(same, -bits)
        if (least := (bits - same.max()) / 2) > best and (np.abs(c.sum(0)) < classes).all():
            best, code = least, c
    return code


def histograms(chunk: Chunk) -> np.ndarray:
    """texts x BUCKETS: hashed byte n-gram counts of the lower-cased texts, scaled to unit length;
    runs of bytes that are no letters count as one space. The last bucket is the constant 1."""
    other = np.ones(256, bool)
    other[list(range(97, 123)) + list(range(128, 256))] = False
    raw = LOWER[chunk.buf]
    text = np.repeat(np.arange(chunk.rows), np.diff(chunk.offsets))
    gap = other[raw]
    raw = np.where(gap, 32, raw)
    keep = np.ones(len(raw), bool)
    keep[1:] = ~(gap[1:] & gap[:-1] & (text[1:] == text[:-1]))
    raw, text = raw[keep].astype(np.uint64), text[keep]
    out = np.zeros(chunk.rows * BUCKETS)
    for n in GRAMS:
        if len(raw) < n:
            continue
        code = np.full(len(raw) - n + 1, n, np.uint64)
        for k in range(n):
            code = code * np.uint64(257) + raw[k : len(raw) - n + 1 + k]
        slot = (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(BUCKETS - 1)
        inside = text[: len(code)] == text[n - 1 :]
        out += np.bincount(text[: len(code)][inside] * BUCKETS + slot[inside].astype(np.int64), minlength=len(out))
    out = np.sqrt(out.reshape(chunk.rows, BUCKETS))
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    out[:, -1] = 1
    return out.astype(np.float32)


def _sparse(chunk: Chunk) -> dict:
    h = histograms(chunk)
    row, idx = np.nonzero(h)
    offsets = np.searchsorted(row, np.arange(chunk.rows + 1))
    return {"idx": lists(idx.astype(np.int32), offsets), "val": lists(h[row, idx], offsets)}


class Model:
    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, trust: np.ndarray):
        self.languages, self.code, self.weights, self.trust = languages, code, weights, trust


def fit(train_rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """From train_rows(text, lang, doc_id); rows with a null text or lang aren't used."""
    rows = train_rows.where(F.col("text").isNotNull()).select("doc_id", "text", "lang")
    languages = sorted(r[0] for r in rows.where("lang IS NOT NULL").select("lang").distinct().toLocalIterator())
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((1, BUCKETS), np.float32), np.ones(code.shape))
    each = max(LEAST_ROWS, sample_rows // len(languages))
    counts = rows.where("lang IS NOT NULL").groupBy("lang").count().where(F.col("count") > each)
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1 << 30))
    sample = rows.where("lang IS NOT NULL").join(F.broadcast(counts), "lang", "left").where(F.col("count").isNull() | (place / F.lit(float(1 << 30)) < F.lit(float(each)) / F.col("count")))
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")) - 1
    examples = map_texts(sample.select("text", number.cast("int").alias("k")), "idx array<int>, val array<float>", lambda: _sparse)
    bits = F.array(*[F.array(*[F.lit(int(b > 0)).cast("byte") for b in row]) for row in code])
    examples = examples.select(F.element_at(bits, F.col("k") + 1).alias("y"), "idx", "val", "k")
    examples = written(examples, "language-examples")
    weights = train(examples.select("y", "idx", "val"), code.shape[1], BUCKETS, alpha=0.3, l1=0.02, l2=0.001)

    def right(batches):
        hits, seen = np.zeros(code.shape), np.zeros(len(code))
        for batch in batches:
            for k, idx, val in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                margin = weights[:, np.asarray(idx.values)] @ np.asarray(val.values)
                hits[k] += np.sign(margin) == code[k]
                seen[k] += 1
        yield pa.RecordBatch.from_pydict({"hits": [hits.ravel().tolist()], "seen": [seen.tolist()]})

    counts = examples.select("k", "idx", "val").mapInArrow(right, "hits array<double>, seen array<double>").collect()
    hits = sum(np.array(r["hits"]).reshape(code.shape) for r in counts)
    seen = sum(np.array(r["seen"]) for r in counts)
    trust = (hits + 1) / (seen + 2)[:, None]
    return Model(languages, code, weights, trust / trust.sum(1, keepdims=True))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs's columns but text, and lang_pred, score (the decoded distribution's share), ambiguous."""
    languages, code, weights, trust = model.languages, model.code.astype(np.float32), model.weights, model.trust

    def work(chunk: Chunk) -> dict:
        data = chunk.buf.tobytes()
        letters = [has_letter(data[a:b].decode("utf-8", "replace")) for a, b in zip(chunk.offsets[:-1], chunk.offsets[1:])]
        if not languages:
            letters = [False] * chunk.rows
        if len(languages) < 2:
            return {"lang_pred": [languages[0] if x else UNKNOWN for x in letters], "score": [float(x) for x in letters], "ambiguous": [False] * chunk.rows}
        margins = np.clip(histograms(chunk) @ weights.T, -30, 30)
        loss = np.log1p(np.exp(-margins[:, None, :] * code[None])) * trust[None]
        loss = loss.sum(2)
        share = np.exp(-code.shape[1] * (loss - loss.min(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        two = np.sort(loss, axis=1)[:, :2]
        best = loss.argmin(1)
        return {
            "lang_pred": [languages[k] if x else UNKNOWN for k, x in zip(best, letters)],
            "score": [float(share[i, k]) if x else 0.0 for i, (k, x) in enumerate(zip(best, letters))],
            "ambiguous": (two[:, 1] - two[:, 0] < AMBIGUOUS) & np.array(letters),
        }

    return map_texts(docs, "lang_pred string, score double, ambiguous boolean", lambda: work)


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))

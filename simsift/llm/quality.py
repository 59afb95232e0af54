"""Quality scores: logistic regression over hashed word n-grams, trained with FTRL updates.

Words are runs of letters and digits (in their own case) and runs of other signs, so tables, noise
signs and shouting are words as well. Features are 1- and 2-grams of words, and one for a word
that repeats the word before it; counts are damped and scaled to unit length. A score is the
logistic of a sparse dot product over the whole text.

Training takes a sample of about SAMPLE_ROWS labelled rows, chosen by hash of doc_id and text. The
learning rate and penalties were chosen by the log loss of a fourth of the training rows, set apart
by another hash, of models fitted on the rest; rows held out for a query had no part in it.

Defined cases: null and empty texts get the score of the bias alone; rows that repeat score alike;
without labelled rows every score is 0.5; a doc_id labelled more than once counts once each; other
columns don't matter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsift.llm._ftrl import labelled_sample, lists, map_texts, train
from simsift.llm._text import SPACES, Chunk, mix, span_hashes, spans

SAMPLE_ROWS, BUCKETS, THRESHOLD = 8_000, 1 << 18, 0.3
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SIGNS = ~_LETTERS & ~SPACES


def counted(text: np.ndarray, hashes: np.ndarray, rows: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs with counts: texts, buckets (the last is left free), counts."""
    slots = (hashes >> np.uint64(20)) % np.uint64(buckets - 1)
    keys, n = np.unique(text.astype(np.int64) * buckets + slots.astype(np.int64), return_counts=True)
    return keys // buckets, keys % buckets, n


def ngrams(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """texts, buckets, values of the features, in order of text."""
    a, b = spans(chunk, _LETTERS), spans(chunk, _SIGNS)
    starts, ends = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    text = np.searchsorted(chunk.offsets, starts, "right") - 1
    one = span_hashes(chunk.buf, starts, ends)
    two = mix(one[:-1] * np.uint64(0xD6E8FEB86659FD93) + one[1:])
    two = np.where(one[:-1] == one[1:], np.uint64(0x123456789ABCDEF), two)
    inside = text[:-1] == text[1:]
    rows, slots, n = counted(np.concatenate([text, text[:-1][inside]]), np.concatenate([one, two[inside]]), chunk.rows, BUCKETS)
    val = np.sqrt(n)
    norm = np.sqrt(np.bincount(rows, val * val, chunk.rows))
    return rows, slots, (val / np.maximum(norm[rows], 1e-9)).astype(np.float32)


def sparse(features):
    """Features as example columns, with the constant 1 in the last bucket."""

    def work(chunk: Chunk) -> dict:
        rows, slots, val = features(chunk)
        rows = np.concatenate([rows, np.arange(chunk.rows)])
        slots, val = np.append(slots, np.full(chunk.rows, BUCKETS - 1)), np.append(val, np.ones(chunk.rows, np.float32))
        order = np.argsort(rows, kind="stable")
        offsets = np.searchsorted(rows[order], np.arange(chunk.rows + 1))
        return {"idx": lists(slots[order].astype(np.int32), offsets), "val": lists(val[order].astype(np.float32), offsets)}

    return work


def scorer(features, weights: np.ndarray):
    def work(chunk: Chunk) -> dict:
        rows, slots, val = features(chunk)
        margin = np.bincount(rows, weights[slots] * val, chunk.rows) + weights[-1]
        score = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
        return {"score": score, "predicted": (score >= THRESHOLD).astype(np.int32)}

    return work


def fit_labels(docs: DataFrame, label: str, features, sample_rows: int, **params) -> np.ndarray:
    """Weights from docs(doc_id, text, label) with label 0, 1 or null."""
    sample = labelled_sample(docs.select("doc_id", "text", label), label, sample_rows)
    y = F.array((F.col(label) == 1).cast("byte"))
    examples = map_texts(sample.select("text", y.alias("y")), "idx array<int>, val array<float>", lambda: sparse(features))
    return train(examples.select("y", "idx", "val"), 1, BUCKETS, **params)[0]


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    return fit_labels(docs, "quality", ngrams, sample_rows, alpha=10.0, l1=0.1, l2=0.001)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """docs's columns but text, and score, predicted."""
    return map_texts(docs, "score double, predicted int", lambda: scorer(ngrams, weights))

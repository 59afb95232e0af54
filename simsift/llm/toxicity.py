"""Toxicity scores of texts whose disguises are undone first.

Spans that look disguised (signs or digits among letters, letters three times in a row, words of three or more
letters each of which is doubled, four or more letters spaced or dotted apart) are read as a noisy channel's output: each observed character may stand
for several letters or for none, and an exact Viterbi search over all pairs of last letters finds the
letters that the channel and a character trigram model, counted over all training texts, make likeliest. The restored text is
scored by a logistic regression (FTRL) over how often it holds which words and word beginnings, hashed.

Labels are learned from a sample of about SAMPLE_ROWS labelled rows, chosen by hash of doc_id and
text, with a learning rate and penalties chosen inside the training rows, as those of quality.

Defined cases: null and empty texts get the score of the bias alone; rows that repeat score alike;
without labelled rows every score is 0.5; a text of any length is read whole; other columns don't
matter.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsift.llm import quality
from simsift.llm._ftrl import map_texts
from simsift.llm._text import LOWER, SPACES, Chunk, chunks, span_hashes, spans

SAMPLE_ROWS, BEGINNINGS = 12_000, (3, 4, 5, 6, 7)
#: Spans kept with their readings by a worker, and the longest such span in bytes.
KEPT_SPANS, KEPT_BYTES = 100_000, 64
#: What each sign may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
APART = " .-_*"
ANY_SPACE, DOUBLED = re.compile(r"[\t-\r]"), re.compile(r"((?:([^\W\d_])\2){3,})[!|+@$]*")
#: Costs of the channel (minus log probabilities, but for a constant).
STANDS_FOR, AS_IT_IS, REPEATED, TWICE, JOINED, PARTED = 1.0, 9.0, 0.3, 7.0, 0.3, 5.0

_ALPHABET = np.full(256, 27, np.int64)
_ALPHABET[97:123] = np.arange(1, 27)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


def _mask(chars: str) -> np.ndarray:
    m = np.zeros(256, bool)
    m[[ord(c) for c in chars]] = True
    return m


_DIGIT, _SIGN, _LAST, _APART = _mask("01345789"), _mask("@$!|+"), _mask("@$"), _mask(APART[1:])


class CharModel:
    """Trigrams over a-z, a sign for all other letters (27) and the word edge (0)."""

    def __init__(self, trigrams: np.ndarray):
        c3 = trigrams.reshape(28, 28, 28).astype(float)
        c2, c1 = c3.sum(0), c3.sum((0, 1))
        p1 = (c1 + 0.5) / (c1.sum() + 14)
        p2 = (c2 + 5 * p1) / (c2.sum(1, keepdims=True) + 5)
        self.cost = -np.log((c3 + 5 * p2[None]) / (c3.sum(2, keepdims=True) + 5))
        self.cost = self.cost.tolist()

    def decode(self, seen: str) -> str:
        """The likeliest letters behind the lower-case characters seen, edges of words as spaces.

        Exact: every state (the last two letters, so 28 * 28 at most) is kept at each character. A path
        is a chain of links to the letter before, so the work grows with the length of seen.
        """
        paths: dict = {(0, 0): (0.0, None)}
        for i, c in enumerate(seen):
            out = []
            if c in LEET:
                out = [(x, STANDS_FOR + math.log(len(LEET[c]))) for x in LEET[c]] + [(c, AS_IT_IS)]
            elif c in APART:
                out = [("", JOINED), (" ", PARTED)]
            else:
                out = [(c, 0.0)]
            if i and c == seen[i - 1] and c not in APART:
                longer = (i > 1 and seen[i - 2] == c) or (i + 1 < len(seen) and seen[i + 1] == c)
                out.append(("", REPEATED if longer else TWICE))
            new: dict = {}
            for (a, b), (cost, path) in paths.items():
                for x, more in out:
                    if not x:
                        key, total = (a, b), cost + more
                    elif x == " ":
                        key, total = (0, 0), cost + more + (self.cost[a][b][0] if b else 0)
                    else:
                        k = ord(x) - 96 if "a" <= x <= "z" else 27
                        key, total = (b, k), cost + more + self.cost[a][b][k]
                    if key not in new or total < new[key][0]:
                        new[key] = (total, (path, x) if x else path)
            paths = new
        a, b = min(paths, key=lambda s: (paths[s][0] + self.cost[s[0]][s[1]][0], s))
        path = paths[a, b][1]
        text = []
        while path is not None:
            path, x = path
            text.append(x)
        return "".join(reversed(text))


def doubled(b: np.ndarray, letter: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Spans, but for signs at their ends, of three or more letters of which each stands twice."""
    inner = np.concatenate([[0], np.cumsum(letter)])
    first = np.minimum(np.searchsorted(inner, inner[starts] + 1) - 1, len(b) - 1)  # the span's first letter
    count = inner[ends] - inner[starts]
    last = np.minimum(first + count, ends)
    differ = np.append(b[1:] != b[:-1], True)
    even = np.concatenate([[0], np.cumsum(differ & (np.arange(len(b)) % 2 == 0))])
    odd = np.concatenate([[0], np.cumsum(differ & (np.arange(len(b)) % 2 == 1))])
    unlike = np.where(first % 2 == 0, even[last] - even[first], odd[last] - odd[first])
    return (count >= 6) & (count % 2 == 0) & (inner[last] - inner[first] == count) & (unlike == 0)


def disguised(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the spans to restore, in order and apart from each other."""
    b = LOWER[chunk.buf]
    n = len(b)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pad = np.concatenate([b, np.full(4, 32, np.uint8)])
    letter, sep = _LETTER[pad], _APART[pad]
    before = np.concatenate([[False], letter[: n - 1]])
    odd = (_DIGIT[b] & (before | letter[1 : n + 1])) | (_SIGN[b] & letter[1 : n + 1]) | (_LAST[b] & before)
    odd |= letter[:n] & (b == pad[1 : n + 1]) & (b == pad[2 : n + 2])
    odd |= letter[:n] & sep[1 : n + 1] & letter[2 : n + 2] & sep[3 : n + 3] & letter[4 : n + 4]
    starts, ends, _ = spans(chunk, ~SPACES)
    sums = np.concatenate([[0], np.cumsum(odd)])
    marked = (sums[ends] > sums[starts]) | doubled(b, letter[:n], starts, ends)
    # Runs of four or more one-character words, not all of the same character.
    text = np.searchsorted(chunk.offsets, starts, "right") - 1
    alone = (ends - starts == 1) & (letter[starts] | _DIGIT[b[starts]] | _SIGN[b[starts]])
    same = alone[1:] & alone[:-1] & (text[1:] == text[:-1])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    runs = [(x, y) for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()) if y - x >= 3 and (b[starts[x : y + 1]] != b[starts[x]]).any()]
    for x, y in runs:
        marked[x : y + 1] = False
    s = np.concatenate([starts[marked], [starts[x] for x, _ in runs]]).astype(np.int64)
    e = np.concatenate([ends[marked], [ends[y] for _, y in runs]]).astype(np.int64)
    order = np.argsort(s)
    return s[order], e[order]


class Restorer:
    def __init__(self, model: CharModel):
        self.model, self.known = model, {}

    def span(self, seen: bytes) -> bytes:
        if (out := self.known.get(seen)) is None:
            text = ANY_SPACE.sub(" ", seen.decode("utf-8", "replace").lower())
            core = text.strip("#%&*?,.;:()[]{}\"'`~^<>=/\\-_")
            if twice := DOUBLED.fullmatch(core):
                core = twice.group(1)[::2]
            out = (" " + self.model.decode(core) + " ").encode()
            if len(self.known) >= KEPT_SPANS:
                self.known.clear()
            if len(seen) <= KEPT_BYTES:
                self.known[seen] = out
        return out

    def chunk(self, chunk: Chunk) -> Chunk:
        starts, ends = disguised(chunk)
        if not len(starts):
            return chunk
        data, parts, at, grown = chunk.buf.tobytes(), [], 0, np.zeros(len(starts), np.int64)
        for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
            parts += [data[at:a], new := self.span(data[a:b])]
            at, grown[k] = b, len(new) - (b - a)
        buf = np.frombuffer(b"".join([*parts, data[at:]]), np.uint8)
        shift = np.concatenate([[0], np.cumsum(grown)])
        return Chunk(chunk.first, buf, chunk.offsets + shift[np.searchsorted(starts, chunk.offsets, "left")])


def beginnings(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """texts, buckets, values of the words of each text and their beginnings; a value is the damped
    number of occurrences, whatever the text's length."""
    buf = LOWER[chunk.buf]
    starts, ends, _ = spans(Chunk(0, buf, chunk.offsets), _LETTER)
    text = np.searchsorted(chunk.offsets, starts, "right") - 1
    h = span_hashes(buf, starts, ends)
    key = (h >> np.uint64(12)) | (text.astype(np.uint64) << np.uint64(52))
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    starts, ends, text, h = starts[first], ends[first], text[first], h[first]
    texts, hashes, counts = [text], [h], [n]
    for size in BEGINNINGS:
        long = ends - starts > size
        texts.append(text[long])
        hashes.append(span_hashes(buf, starts[long], starts[long] + size) ^ np.uint64(size))
        counts.append(n[long])
    slots = (np.concatenate(hashes) >> np.uint64(20)) % np.uint64(quality.BUCKETS - 1)
    keys = np.concatenate(texts).astype(np.int64) * quality.BUCKETS + slots.astype(np.int64)
    keys, which = np.unique(keys, return_inverse=True)
    val = np.log2(1 + np.bincount(which, np.concatenate(counts)))
    return keys // quality.BUCKETS, keys % quality.BUCKETS, val.astype(np.float32)


def char_counts(docs: DataFrame) -> np.ndarray:
    """Character trigrams of all words of docs(text): 28 cubed counts, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(28**3, np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                b = LOWER[chunk.buf]
                code = np.where(_LETTER[b], _ALPHABET[b], 0)
                edges = chunk.offsets[1:-1]
                code = np.concatenate([[0, 0], np.insert(code, edges, 0), [0]])
                total += np.bincount(code[:-2] * 784 + code[1:-1] * 28 + code[2:], minlength=28**3)
        keys = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"k": pa.array(keys, pa.int32()), "n": pa.array(total[keys], pa.int64())})

    counts = docs.select("text").mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n"))
    out = np.zeros(28**3)
    for r in counts.collect():
        out[r["k"]] = r["n"]
    out[0] = 0  # edge after edge after edge says nothing
    return out


class Model:
    def __init__(self, chars: CharModel, weights: np.ndarray):
        self.chars, self.weights = chars, weights

    def features(self):
        restorer = Restorer(self.chars)
        return lambda chunk: beginnings(restorer.chunk(chunk))


def fit(train_docs: DataFrame, labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Characters from train_docs(text), labels from labelled(doc_id, text, toxic)."""
    model = Model(CharModel(char_counts(train_docs)), np.zeros(quality.BUCKETS, np.float32))

    def features(chunk: Chunk, made=[]):  # noqa: B006
        made or made.append(model.features())
        return made[0](chunk)

    model.weights = quality.fit_labels(labelled, "toxic", features, sample_rows, alpha=1.0, l1=4.0, l2=0.01)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs's columns but text, and score, predicted."""
    return map_texts(docs, "score double, predicted int", lambda: quality.scorer(model.features(), model.weights))

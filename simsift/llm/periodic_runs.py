"""Runs of repeating words: maximal stretches with a short period, by string synchronising sets.

For scales tau = 1, 2, 4, .. the places of all windows of tau words are named so that equal windows
have equal names, those of a scale from pairs of the one below. A place is in the synchronising set
of the scale if the least hash of the names at it and the tau places after it stands at the first or
the last of them: places whose next 2 tau words are equal are both in the set or both not, and of
any tau places one is in it, unless they lie in a region of period tau / 4 or less. Such highly
periodic regions are the runs that smaller scales have found; their windows are left out of the
minimum, which keeps the set sparse.

In a run of period p, tau <= p < 2 tau, of at least 4 p words, some place of the set has its context of
2 tau words again p words on, and nowhere between. So pairs of neighbouring places of equal context, at a
distance in that range, propose the period; overlapping proposals are one run, whose ends are found
word by word. Their period is the smallest: a smaller one would have brought an equal context between.

Some consecutive texts are worked on at once, each with an end mark of its own, in pieces of about a
million bytes; texts that are too short for a scale or repeat no window of 2 tau words drop out of it.

Defined cases: a null or empty text, or one of white space, has no words and no runs; a text of any length
is one piece of work, of O(n log^2 n) time; rows that repeat get the same result each; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simsift.llm._text import chunks

#: A run has so many words at least, and so many periods.
LEAST, TIMES = 6, 4
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _hashed(names: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit names."""
    with np.errstate(over="ignore"):
        x = names.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _doubled(names: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of windows of 2 tau from those of tau, and which of them occur more than once. A window
    beyond the end is like no other."""
    n = len(names)
    key = names[: n - tau] * np.int64(names.max() + 1) + names[tau:] if n > tau else names[:0]
    _, out, counts = np.unique(key, return_inverse=True, return_counts=True)
    again = np.zeros(n, bool)
    again[: len(out)] = counts[out] > 1
    return np.concatenate([out, len(counts) + np.arange(n - len(out))]).astype(np.int64), again


def _synchronising(names: np.ndarray, tau: int, periodic: np.ndarray) -> np.ndarray:
    """Places of the set; periodic marks windows of tau words in highly periodic regions."""
    ids = _hashed(names)
    ids[periodic] = LAST
    if len(ids) <= tau:
        return np.zeros(0, np.int64)
    least, size = ids, 1
    while size < tau:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    first, last = ids[:-tau], ids[tau:]
    least = np.minimum(least[: len(first)], last)
    return np.flatnonzero((least != LAST) & ((least == first) | (least == last)))


def _proposed(places: np.ndarray, context: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end, period of overlapping proposals of neighbouring places of equal context."""
    order = np.argsort(context[places], kind="stable")
    at = places[order]
    step = at[1:] - at[:-1]
    near = (context[at[1:]] == context[at[:-1]]) & (step >= tau) & (step < 2 * tau)
    at, period = at[:-1][near], step[near]
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    new = np.ones(len(at), bool)
    new[1:] = (period[1:] != period[:-1]) | (at[1:] > at[:-1] + 2 * tau)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at)) - 1 if len(at) else heads
    return at[heads], at[tails] + period[heads] + 2 * tau, period[heads]


def _extended(words: np.ndarray, start: int, end: int, p: int) -> tuple[int, int]:
    """The whole stretch around start..end in which words p apart are equal."""
    step = 4 * p
    while start > 0:
        low = max(0, start - step)
        differ = np.flatnonzero(words[low:start] != words[low + p : start + p])
        if len(differ):
            start = low + int(differ[-1]) + 1
            break
        start, step = low, 2 * step
    step = 4 * p
    while end < len(words):
        high = min(len(words), end + step)
        differ = np.flatnonzero(words[end:high] != words[end - p : high - p])
        if len(differ):
            end += int(differ[0])
            break
        end, step = high, 2 * step
    return start, end


def find_runs(words: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end, period of all runs of at least TIMES periods. words are numbers, the last of each
    text one that occurs nowhere else; text_of is ascending."""
    place = np.arange(len(words))
    _, names = np.unique(words, return_inverse=True)
    found: list[tuple[int, int, int]] = []
    regions = np.zeros((0, 3), np.int64)  # start, end, period where texts that dropped out are cut away
    tau = 1
    while len(names):
        context, again = _doubled(names, tau)
        if not again.any():
            break
        periodic = np.zeros(len(names) + 1, np.int32)
        near = regions[(regions[:, 2] * TIMES <= tau) & (regions[:, 1] - regions[:, 0] >= tau)]
        np.add.at(periodic, near[:, 0], 1)
        np.add.at(periodic, near[:, 1] - tau + 1, -1)
        places = _synchronising(names, tau, np.cumsum(periodic[:-1]) > 0)
        fresh = []
        for start, end, p in zip(*(x.tolist() for x in _proposed(places, context, tau))):
            start, end = _extended(words, start, end, p)
            if end - start >= TIMES * p:
                fresh.append((start, end, p))
        found += [(int(place[a]), int(place[a]) + b - a, p) for a, b, p in fresh]
        if fresh:
            regions = np.concatenate([regions, np.array(fresh, np.int64)])
        tau *= 2
        sizes = np.bincount(text_of)
        stays = ((sizes > TIMES * tau) & (np.bincount(text_of[again], minlength=len(sizes)) > 0))[text_of]
        if not stays.all():
            moved = np.cumsum(stays) - 1
            regions = regions[stays[regions[:, 0]]]
            shift = regions[:, 0] - moved[regions[:, 0]]
            regions[:, 0] -= shift
            regions[:, 1] -= shift
            context, words, place, text_of = context[stays], words[stays], place[stays], text_of[stays]
        names = context
    rows = np.array(sorted(set(found)), np.int64).reshape(-1, 3)
    return rows[:, 0], rows[:, 1], rows[:, 2]


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period, by start and period), collapsed (the words that no run holds
    after its first period, joined by a space) of every row of docs(doc_id, text)."""

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch.column(1)):
                texts = [c.buf[a:b].tobytes().split() for a, b in zip(c.offsets[:-1], c.offsets[1:])]
                sizes = np.array([len(t) for t in texts], np.int64)
                number: dict[bytes, int] = {}
                plain = [number.setdefault(w, len(number)) for t in texts for w in t]
                text_of = np.repeat(np.arange(len(texts)), sizes + 1)
                first = np.concatenate([[0], np.cumsum(sizes + 1)])
                words = np.empty(len(text_of), np.int64)
                inner = np.ones(len(words), bool)
                inner[first[1:] - 1] = False
                words[inner] = np.array(plain, np.int64) + len(number) * text_of[inner]
                words[~inner] = -1 - np.arange(len(texts))
                start, end, period = find_runs(words, text_of)
                long = end - start >= least
                start, end, period = start[long], end[long], period[long]
                gone = np.zeros(len(words) + 1, np.int32)
                np.add.at(gone, start + period, 1)
                np.add.at(gone, end, -1)
                kept = np.cumsum(gone[:-1]) == 0
                owner = text_of[start]
                per = np.bincount(owner, minlength=len(texts))
                collapsed = []
                for k, t in enumerate(texts):
                    stay = kept[first[k] : first[k] + len(t)]
                    collapsed.append(b" ".join(t if not per[k] else [w for w, s in zip(t, stay.tolist()) if s]))
                fields = [pa.array(x, pa.int64()) for x in (start - first[owner], end - start, period)]
                runs = pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
                ends = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
                columns = [batch.column(0).slice(c.first, c.rows), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, runs), pa.array(collapsed, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(of_texts, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string")


def most_repeated(runs: Column) -> Column:
    """Of runs that are in order the one with the greatest length / period, compared exactly; the first of equals, null without any."""
    better = lambda a, b: F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    return F.aggregate(runs, F.lit(None).cast(RUNS[6:-1]), better)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the most repeated run, digests of all runs and of the collapsed text."""
    best = found.withColumn("best", most_repeated(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    text = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    milli = F.expr("best.length * 1000L div best.period")
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        milli.alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text where a tenth of the texts, by a hash of doc_id, repeat a stretch of their words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = rows.withColumn("words", words).withColumn("g", F.floor(F.col("h") / 10)).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.array_repeat(F.slice("words", F.col("a").cast("int") + 1, F.col("p").cast("int")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int"))
    planted = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), F.flatten(again)), F.lit(1), F.col("n"))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))

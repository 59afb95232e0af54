"""Logistic regression by follow-the-regularised-leader updates, trained over Spark partitions.

Each epoch every partition goes on from the shared state (z and n of each weight) over its own
rows; the states are then averaged by the rows they saw (iterative parameter mixing). A state is
outputs x buckets numbers however many rows there are, so it may pass through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from simsift.llm._space import written
from simsift.llm._text import chunks, worker_cache

EXAMPLE = "y array<byte>, idx array<int>, val array<float>"


class Ftrl:
    """One or several outputs over shared hashed features."""

    def __init__(self, outputs: int, buckets: int, alpha=0.1, beta=1.0, l1=0.1, l2=0.01):
        self.z, self.n = np.zeros((outputs, buckets), np.float32), np.zeros((outputs, buckets), np.float32)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, z: np.ndarray | None = None, n: np.ndarray | None = None) -> np.ndarray:
        z, n = (self.z, self.n) if z is None else (z, n)
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def update(self, y: np.ndarray, idx: np.ndarray, val: np.ndarray) -> None:
        z, n = self.z[:, idx], self.n[:, idx]
        w = self.weights(z, n)
        p = 1 / (1 + np.exp(-np.clip(w @ val, -35, 35)))
        g = (p - y)[:, None] * val[None, :]
        more = n + g * g
        self.z[:, idx] = z + g - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[:, idx] = more


def labelled_sample(docs: DataFrame, label: str, rows: int, key: str = "doc_id") -> DataFrame:
    """About rows (at most, in expectation) of the rows whose label isn't null, chosen by hash of key and text."""
    known = docs.where(F.col(label).isNotNull())
    total = known.select(label).count()
    if total <= rows:
        return known
    names = [c for c in (key, "text") if c in docs.columns]
    return known.where(F.pmod(F.xxhash64(F.lit("sample"), *names), F.lit(1 << 30)) < int((1 << 30) * rows / total))


def train(examples: DataFrame, outputs: int, buckets: int, epochs: int = 5, parts: int = 6, **params) -> np.ndarray:
    """Weights (outputs x buckets) from examples(y, idx, val); rows must be few enough to sample (a bounded table)."""
    table = written(examples.repartition(parts), "examples")
    model = Ftrl(outputs, buckets, **params)
    for epoch in range(epochs):
        state = model

        def run(batches: Iterator[pa.RecordBatch], state=state, epoch=epoch) -> Iterator[pa.RecordBatch]:
            own, rows = Ftrl(outputs, buckets, **params), 0
            own.z[:], own.n[:] = state.z, state.n
            for batch in batches:
                y, idx, val = (batch.column(k) for k in range(3))
                order = np.random.default_rng(epoch).permutation(len(batch))
                for k in order:
                    own.update(
                        np.asarray(y[k].values, np.float32), np.asarray(idx[k].values, np.int64), np.asarray(val[k].values, np.float32)
                    )
                rows += len(batch)
            if rows:
                yield pa.RecordBatch.from_pydict({"rows": [rows], "z": [own.z.tobytes()], "n": [own.n.tobytes()]})

        states = table.mapInArrow(run, "rows long, z binary, n binary").collect()
        total = sum(r["rows"] for r in states)
        if not total:
            break
        mixed = Ftrl(outputs, buckets, **params)
        for r in states:
            for to, part in ((mixed.z, r["z"]), (mixed.n, r["n"])):
                to += np.frombuffer(part, np.float32).reshape(outputs, buckets) * (r["rows"] / total)
        model = mixed
    return model.weights().astype(np.float32)


def map_texts(docs: DataFrame, schema: str, make: Callable[[], Callable], column: str = "text") -> DataFrame:
    """docs's other columns, and for each row what make()'s function returns for chunks of texts.

    The function takes a Chunk and returns a dict of a column (list or array) for each output. A
    column of docs that has an output's name gives way to it.
    """
    made = StructType.fromDDL(schema)
    names = made.names
    others = [c for c in docs.columns if c != column and c not in names]
    fields = StructType([*(docs.schema[c] for c in others), *made.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("")
        work = make()
        for batch in batches:
            for chunk in chunks(batch.column(0), rows=256):
                new = work(chunk)
                kept = [batch.column(1 + k).slice(chunk.first, chunk.rows) for k in range(len(others))]
                yield pa.RecordBatch.from_arrays([*kept, *(x if isinstance(x := new[n], pa.Array) else pa.array(x) for n in names)], names=[*others, *names])

    return docs.select(column, *[F.col(f"`{c}`") for c in others]).mapInArrow(run, fields)


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))

"""Product codes of vectors: exact integer k-means over parts of vectors, by limb-split matrix products.

A component x becomes the integer floor(scale * x); a vector is cut into equal consecutive parts,
each position of which has a codebook of its own. A codebook starts as that part of the first
vectors by id; a round assigns every part to its nearest entry and replaces each entry by the
floored mean of its parts.

Distances come from |x|^2 - 2 x.c + |c|^2. To have x.c exact from float64 BLAS, integers are broken
into limbs of so few bits that a whole product of limb matrices stays below 2^53; the products are
shifted and added in int64, and the first argmin is taken. Where even a squared distance could leave
int64, whole numbers of any size (Python's) take over, slower and as exact.

A round is one pass over the stored integers: tasks emit sums of parts x entries x width, Spark adds
them up as decimals, and only the codebooks (parts x entries x width numbers, whatever the number
of vectors) reach the driver.

Defined cases: a vector that is null, empty, or holds a null, NaN, infinite or greater than 1e20
component is dropped; so is one whose length differs from the kept vector with the smallest id, or
isn't a multiple of the number of parts; fewer vectors than entries make smaller codebooks; of rows
that repeat an id each is coded, and the smaller vector comes first; null ids come last; an error
beyond a long is null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsift.llm._space import bounded, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
GREATEST = 1e20
EXACT_BITS = 53

Codebooks = list[list[list[int]]]


def limb_bits(width: int) -> int:
    """Bits of a limb such that `width` products of two limbs, signed ones too, add up to less than 2^53."""
    return (EXACT_BITS - 1 - max(width, 1).bit_length()) // 2


def limbs(a: np.ndarray, bits: int, count: int) -> list[np.ndarray]:
    """int64 matrices as float64 ones, lowest limb first; the last is signed."""
    out = []
    for _ in range(count - 1):
        out.append((a & ((1 << bits) - 1)).astype(np.float64))
        a = a >> bits
    return [*out, a.astype(np.float64)]


def exact_products(x: np.ndarray, c: np.ndarray, greatest: int) -> np.ndarray:
    """x @ c.T of int64 matrices whose components are at most `greatest` in size."""
    bits = limb_bits(x.shape[1])
    count = max(1, -(-(greatest.bit_length()) // bits))
    total = np.zeros((len(x), len(c)), np.int64)
    right = limbs(c, bits, count)
    for i, a in enumerate(limbs(x, bits, count)):
        for j, b in enumerate(right):
            total += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return total


def fits(greatest: int, width: int) -> bool:
    """Whether all that a distance is made of stays in int64."""
    return max(width, 1) * (2 * greatest) ** 2 < 1 << 62


def nearest(x: np.ndarray, book: list[list[int]], greatest: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of whole numbers (float64) the first nearest entry and the squared distance."""
    if fits(greatest, x.shape[1]):
        rows, entries = x.astype(np.int64), np.array(book, np.int64).reshape(len(book), -1)
        far = (entries * entries).sum(1)[None, :] - 2 * exact_products(rows, entries, greatest)
        own = (rows * rows).sum(1)
    else:
        rows, entries = exact_ints(x), np.array(book, object).reshape(len(book), -1)
        far = (entries * entries).sum(1)[None, :] - 2 * rows.dot(entries.T)
        own = (rows * rows).sum(1)
    first = np.argmin(far, 1).astype(np.int64)
    return first, own + far[np.arange(len(x)), first]


def exact_ints(x: np.ndarray) -> np.ndarray:
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), length)


def integers(vectors: DataFrame, parts: int = PARTS, scale: float = SCALE) -> DataFrame:
    """vec_id, label, q (the integers, as exact doubles) of the vectors that are kept, as a table."""
    whole = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("q"))
    sound = F.forall("q", lambda v: F.coalesce(F.abs(v) <= GREATEST, F.lit(False)))
    whole = whole.where((F.size("q") > 0) & (F.size("q") % parts == 0) & sound)
    names = ["vec_id", "label", "q"]

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * scale)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(ends, flat)], names=names)

    return written(whole.mapInArrow(floors, whole.schema), "vector-integers")


def start(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The codebooks before the first round: the parts of the first vectors by id."""
    order = [F.asc_nulls_last("vec_id"), F.asc("q")]
    first = table.orderBy(*order).limit(1).select(F.size("q").alias("n")).first()
    if first is None:
        return []
    heads = table.where(F.size("q") == first["n"]).orderBy(*order).limit(entries).select("q").collect()
    width = first["n"] // parts
    return [[[int(v) for v in r["q"][p * width : (p + 1) * width]] for r in heads] for p in range(parts)]


def _assigned(batches: Iterator[pa.RecordBatch], at: int, books: Codebooks, greatest: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray, np.ndarray]]:
    """batch, part, its rows, entries and distances."""
    width = len(books[0][0])
    for b in batches:
        if len(b):
            x = _matrix(b.column(at), width * len(books))
            for p, book in enumerate(books):
                rows = x[:, p * width : (p + 1) * width]
                yield b, p, rows, *nearest(rows, book, greatest)


def next_books(table: DataFrame, books: Codebooks, greatest: int) -> Codebooks:
    """One round: entries become the floored means of the parts nearest to them, unused ones stay."""
    parts, entries, width = len(books), len(books[0]), len(books[0][0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), object)
        for _, p, rows, first, _ in _assigned(batches, 0, books, greatest):
            whole = rows.astype(np.int64) if fits(greatest, width) else exact_ints(rows)
            for e in np.unique(first):
                mine = whole[first == e]
                counts[p, e] += len(mine)
                total[p, e] += mine.sum(0).astype(object)
        p, e, at = (g.ravel() for g in np.meshgrid(range(parts), range(entries), range(width), indexing="ij"))
        used = counts[p, e] > 0
        values = [Decimal(int(total[k])) for k in zip(p[used], e[used], at[used])]
        columns = [pa.array(p[used], pa.int32()), pa.array(e[used], pa.int32()), pa.array(at[used], pa.int32()), pa.array(counts[p, e][used], pa.int64()), pa.array(values, pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "at", "n", "total"])

    made = table.select("q").mapInArrow(sums, "part int, entry int, at int, n bigint, total decimal(38,0)")
    made = made.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    out = [[list(entry) for entry in book] for book in books]
    for r in made.collect():  # parts x entries x width rows
        out[r["part"]][r["entry"]][r["at"]] = int(r["total"]) // r["n"]
    return out


def codebooks_digest(books: Codebooks) -> str:
    """SHA-256 of all integers by part, entry and place, with commas between them."""
    return hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()


def train(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks, int]:
    """Of a table of integers: those rows that are coded, the final codebooks and the greatest size of an integer."""
    books = start(table, parts, entries)
    if not books:
        return table, books, 0
    table = table.where(F.size("q") == len(books) * len(books[0][0]))
    greatest = int(table.select(F.max(F.array_max(F.transform("q", F.abs)))).first()[0])
    for _ in range(rounds):
        books = next_books(table, books, greatest)
    return table, books, greatest


def encode(table: DataFrame, books: Codebooks, greatest: int) -> DataFrame:
    """vec_id, label, code, error of every row of integers."""
    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint"
    if not books:
        return table.sparkSession.createDataFrame([], schema)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, error = [], None
        for b, p, _, first, far in _assigned(batches, 2, books, greatest):
            code = [first] if p == 0 else [*code, first]
            error = far.astype(object) if p == 0 else error + far
            if p == len(books) - 1:
                texts = ["".join(f"{e:02x}" for e in row) for row in np.stack(code, 1).tolist()]
                errors = [int(v) if v < 1 << 63 else None for v in error]
                columns = [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(errors, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return table.select("vec_id", "label", "q").mapInArrow(coded, schema)


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE, name: Callable[[Codebooks], str] = codebooks_digest) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every kept row of
    vectors(vec_id, embedding, label)."""
    table, books, greatest = train(integers(vectors, parts, scale), parts, entries, rounds)
    rows = written(encode(table, books, greatest), "vector-codes")
    per = rows.groupBy(F.col("label").alias("_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error"))
    per = bounded(written(per, "label-errors"))
    out = rows.join(per, F.col("label").eqNullSafe(F.col("_label")), "left")
    return out.select("vec_id", "label", "code", "error", "label_error", F.lit(name(books)).alias("codebooks_sha256"))

"""Fingerprints as sets of bit positions and as packed words, from built-in expressions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 2048
#: White space as the record reader knows it: ASCII, separators and Unicode spaces.
SPACE = r"[\s\x1c-\x1f\p{Z}\x85]+"


def tokens(text: Column, pattern: str = r"[ \t\n\r]+") -> Column:
    """Non-empty tokens of a text; none for null."""
    return F.coalesce(F.filter(F.split(text, pattern), lambda t: t != ""), F.array().cast("array<string>"))


def token_bits(text: Column, bits: int = BITS) -> Column:
    """Distinct bit positions of the lower-cased tokens: the first 32 bits of a token's MD5, modulo bits."""
    position = lambda t: (F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint") % bits).cast("int")
    return F.array_distinct(F.transform(F.array_distinct(tokens(F.lower(text))), position))


def packed_words(positions: pa.ListArray, size: int = BITS) -> np.ndarray:
    """Rows of distinct positions as rows x size / 64 words, bit i of word w set for position 64 w + i."""
    flat = np.zeros((len(positions), size), np.uint8)
    lengths = np.array(pc.fill_null(pc.list_value_length(positions), 0), np.int64)
    flat[np.repeat(np.arange(len(positions)), lengths), np.array(positions.flatten(), np.int64)] = 1
    return np.packbits(flat, axis=1, bitorder="little").view("<i8")


def word_lists(words: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(words) + 1, dtype=np.int32) * words.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(words.ravel()))


def packed(library: DataFrame, size: int = BITS) -> DataFrame:
    """library with words array<bigint> and popcount int in place of bits: a fingerprint of fixed
    width, to be stored once and searched often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            bits = batch.column(names.index("bits"))
            counts = pc.fill_null(pc.list_value_length(bits), 0).cast(pa.int32())
            rest = [batch.column(k) for k, n in enumerate(names) if n != "bits"]
            yield pa.RecordBatch.from_arrays([*rest, word_lists(packed_words(bits, size)), counts], names=[*(n for n in names if n != "bits"), "words", "popcount"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in library.schema.fields if f.name != "bits"]
    return library.mapInArrow(run, ", ".join([*fields, "words array<bigint>", "popcount int"]))


def sign_bits(vector: Column, dims: int) -> list[Column]:
    """Words of 64 bits, bit i set where component i is above zero; unrolled for code generation."""
    words = []
    for at in range(0, dims, 64):
        word = F.lit(0).cast("bigint")
        for i in range(at, min(dims, at + 64)):
            bit = (1 << (i - at)) if i - at < 63 else -(1 << 63)
            word = word.bitwiseOR(F.when(F.get(vector, F.lit(i)) > 0, F.lit(bit).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        words.append(word)
    return words


def query_words(bits: list[int], size: int = BITS) -> list[int]:
    """Signed 64-bit words of a query's bit positions."""
    words = [0] * (-(-size // 64))
    for b in bits:
        words[b // 64] |= 1 << (b % 64)
    return [w - (1 << 64) if w >> 63 else w for w in words]

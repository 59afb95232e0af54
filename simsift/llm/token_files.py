"""Token ids in seekable zstandard files.

A shard holds the ids of consecutive documents as little-endian unsigned 32-bit integers:

    data frames      independent zstandard frames of up to FRAME_IDS ids, each with its checksum
    document index   a skippable frame: ids and token counts of the documents, compressed
    seek table       the last skippable frame: of each frame above the compressed size, the
                     decompressed size (0 for the index) and the low 32 bits of the XXH64 of the
                     content, then the footer (number of frames, descriptor, magic)

So a reader fetches the tail, then only the frames that the wanted documents lie in; and any
zstandard decoder reads the whole file as one stream of ids.

Tasks write under names of their own and report them in a manifest table, whose commit decides
which files count: a lost or repeated task leaves at most files that nobody reads.

Defined cases: a null or empty text is the end id alone; null doc_ids come first, rows that repeat
a doc_id follow each other in order of their text's hash; an empty table writes no file; a text of
any length is spread over as many frames as it needs; other columns are ignored.
"""

from __future__ import annotations

import os
import string
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from simsift.llm._space import new_folder, written
from simsift.llm._text import Chunk, chunks, worker_cache

FRAME_IDS, PLACES = 65_536, 4_096
#: Texts that are split and gathered at once.
TEXT_BYTES = 1_000_000
#: Fixed values of the seekable zstandard format.
INDEX_MAGIC, SEEK_MAGIC, FOOTER_MAGIC, WITH_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
#: Words kept with their ids by a worker, in two generations, and the longest such word in bytes.
CACHED_WORDS, CACHED_BYTES = 1_200_000, 64
ENDINGS = b".,;:!?#$%&*"

MANIFEST = "shard int, file string, documents long, tokens long"


class ShardWriter:
    def __init__(self, out, level: int = 3):
        self.out, self.level = out, level
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.pending: list[np.ndarray] = []
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.counts.append(len(ids))
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= FRAME_IDS:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, "<u4")
        at = 0
        while len(ids) - at >= FRAME_IDS or (all_of_it and at < len(ids)):
            data = ids[at : at + FRAME_IDS].astype("<u4").tobytes()
            at += FRAME_IDS
            frame = zstandard.ZstdCompressor(level=self.level, write_checksum=True).compress(data)
            self.out.write(frame)
            self.frames.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.pending, self.waiting = [ids[at:]], max(0, len(ids) - at)

    def close(self) -> None:
        self._flush(True)
        known = np.array([x is not None for x in self.ids], np.uint8)
        ids = np.array([x or 0 for x in self.ids], "<i8")
        index = known.tobytes() + ids.tobytes() + np.array(self.counts, "<i8").tobytes()
        packed = zstandard.ZstdCompressor(level=self.level, write_checksum=True).compress(index)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(packed)) + packed)
        self.frames.append((len(packed) + 8, 0, xxhash.xxh64_intdigest(index) & 0xFFFFFFFF))
        table = b"".join(struct.pack("<III", *x) for x in self.frames)
        table += struct.pack("<IBI", len(self.frames), WITH_CHECKSUMS, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)


class ShardReader:
    """Documents of a shard by place; only the frames they lie in are read and decompressed."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        n, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or descriptor != WITH_CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        entries = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.sums = entries[:, 2]
        self.offsets = np.concatenate([[0], np.cumsum(entries[:, 0])])
        self.places = np.concatenate([[0], np.cumsum(entries[:, 1] // 4)])
        packed = self._at(self.offsets[n - 1] + 8, entries[n - 1, 0] - 8)
        index = zstandard.ZstdDecompressor().decompress(packed)
        self._verify(n - 1, index)
        count = len(index) // 17
        known = np.frombuffer(index, np.uint8, count)
        ids = np.frombuffer(index, "<i8", count, count)
        self.doc_ids = [int(x) if k else None for x, k in zip(ids, known)]
        self.counts = np.frombuffer(index, "<i8", count, 9 * count)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self._kept: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(int(offset))
        return self.source.read(int(size))

    def _verify(self, k: int, data: bytes) -> None:
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k}: checksum differs")

    def _frame(self, k: int) -> np.ndarray:
        if self._kept[0] != k:
            data = zstandard.ZstdDecompressor().decompress(self._at(self.offsets[k], self.offsets[k + 1] - self.offsets[k]))
            self._verify(k, data)
            self._kept = (k, np.frombuffer(data, "<u4"))
        return self._kept[1]

    def document(self, place: int) -> np.ndarray:
        first, last = self.starts[place], self.starts[place + 1]
        parts = []
        k = int(np.searchsorted(self.places, first, "right")) - 1
        while first < last:
            stop = min(last, self.places[k + 1])
            parts.append(self._frame(k)[first - self.places[k] : stop - self.places[k]])
            first, k = stop, k + 1
        return np.concatenate(parts) if parts else np.zeros(0, "<u4")


class WordEncoder:
    """Ids of texts, word by word: words between ASCII white space are encoded by the library once
    and kept. Right for tokenizers whose tokens never cross white space and don't depend on it, and
    never join an ASCII letter or digit to a sign of ENDINGS that follows it.

    New words go to the library as one text, a bar between them, which is one id of its own. Words of
    ASCII letters alone go lower-cased to the tokenizer's model without its normalizer and splitter, if
    these only lower-case such words and keep them whole, which all pairs of letters show.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.letters, self.known, self.older = Tokenizer.from_file(path), Tokenizer.from_file(path), {}, {}
        self.bar = self.tokenizer.encode("|", add_special_tokens=False).ids
        self.letters.normalizer, self.letters.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        pairs = "| | " + " | ".join(a + b for a in string.ascii_letters for b in string.ascii_letters)
        plain, whole = (t.encode(x, add_special_tokens=False).ids for t, x in ((self.letters, pairs.lower()), (self.tokenizer, pairs)))
        self.lowers = len(self.bar) == 1 and plain == whole

    def _together(self, tokenizer, words: list[bytes]) -> None:
        for at in range(0, len(words), 1000):
            some = words[at : at + 1000]
            text = b" | ".join(some).decode("utf-8", "replace")
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            data, cuts = ids.tobytes(), (4 * np.flatnonzero(ids == self.bar[0])).tolist()
            if len(cuts) != len(some) - 1:
                raise ValueError("the tokenizer doesn't keep words apart")
            self.known.update(zip(some, [data[x + 4 : y] for x, y in zip([-4, *cuts], [*cuts, len(data)])]))

    def _encode(self, words: list[bytes]) -> None:
        known, rest = self.known, words
        if self.lowers:
            small, large = [w for w in words if w.isalpha() and w.islower()], [w for w in words if w.isalpha() and not w.islower()]
            rest = [w for w in words if not w.isalpha()]
            self._together(self.letters, small + self._unknown({w.lower() for w in large}.difference(known, small)))
            known.update([(w, known[w.lower()]) for w in large])
        plain = [w for w in rest if b"|" not in w] if len(self.bar) == 1 else []
        self._together(self.tokenizer, plain)
        rest = [w for w in rest if b"|" in w] if plain else rest
        encoded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in rest], add_special_tokens=False)
        known.update((w, array("I", e.ids).tobytes()) for w, e in zip(rest, encoded))

    def _unknown(self, words: Iterable[bytes]) -> list[bytes]:
        """Words that the older generation hasn't kept either; the others move to the younger."""
        older = self.older
        self.known.update([(w, older[w]) for w in words if w in older])
        return [w for w in words if w not in older]

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Of distinct words their ids as little-endian unsigned 32-bit integers."""
        found = list(map(self.known.get, words))
        rest = [k for k, ids in enumerate(found) if ids is None]
        if 2 * (len(self.known) + len(rest)) > CACHED_WORDS:
            self.known, self.older = {}, self.known
        known = self.known
        new = self._unknown([words[k] for k in rest])
        ended = [(w, core, w[len(core) :]) for w in new if (core := w.rstrip(ENDINGS)) != w and core[-1:].isalnum()]
        parts = set(new).difference([w for w, _, _ in ended]).union([x for _, x, _ in ended], [x for _, _, x in ended])
        self._encode(self._unknown(parts.difference(known)))
        known.update([(w, known[core] + known[end]) for w, core, end in ended])
        for k in rest:
            found[k] = known[words[k]]
        for w in [*new, *parts]:
            if len(w) > CACHED_BYTES:
                known.pop(w, None)
                known.pop(w.lower(), None)
        return found

    def __call__(self, texts: list[bytes] | Chunk) -> list[np.ndarray]:
        """Of each text its ids. Arrow splits the texts and finds the distinct words; ids are gathered by word."""
        if not isinstance(texts, Chunk):
            texts = next(chunks(pa.array(texts, pa.large_binary()), 1 << 62, 1 << 62), None)
            if texts is None:
                return []
        column = pa.Array.from_buffers(pa.large_string(), texts.rows, [None, *(pa.py_buffer(np.ascontiguousarray(x)) for x in (texts.offsets, texts.buf))])
        split = pc.ascii_split_whitespace(column)
        coded = split.flatten().dictionary_encode()
        distinct = next(chunks(coded.dictionary, 1 << 62, 1 << 62))  # each text has a word, an empty one at least
        data, cuts = distinct.buf.tobytes(), distinct.offsets.tolist()
        found = self._ids([data[a:b] for a, b in zip(cuts, cuts[1:])])
        ids, word = np.frombuffer(b"".join(found), "<u4"), coded.indices.to_numpy()
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins, lengths = np.cumsum(sizes) - sizes, sizes[word]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        places = np.repeat(begins[word] - ends[:-1], lengths)
        places += np.arange(len(places))
        out, edges = ids[places], ends[split.offsets.to_numpy()].tolist()
        return [out[a:b] for a, b in zip(edges, edges[1:])]


def encoder(path: str) -> WordEncoder:
    """Kept by a worker from task to task."""
    encoders = worker_cache("token_files")
    if path not in encoders:
        encoders[path] = WordEncoder(path)
    return encoders[path]


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Writes docs(doc_id, text) in ascending doc_id order; the manifest, a row a shard.

    tokenizer is the path of a tokenizers file that every executor has.
    """
    folder = folder or new_folder(docs.sparkSession, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, end = encoder(tokenizer), np.array([end_id], "<u4")
        shard = TaskContext.get().partitionId()
        name, writer, out = f"{folder}/tokens-{shard:06d}-{uuid.uuid4().hex}.zst", None, None
        for batch in batches:
            if len(batch) and writer is None:
                where, path = _opened(name)
                where.create_dir(path.rpartition("/")[0], recursive=True)
                out = where.open_output_stream(path, compression=None)
                writer = ShardWriter(out)
            doc_ids = batch.column(0).to_pylist()
            for chunk in chunks(batch.column(1), TEXT_BYTES):
                for doc_id, ids in zip(doc_ids[chunk.first :], encode(chunk)):
                    writer.add(doc_id, np.append(ids, end))
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "file": [name],
                    "documents": pa.array([len(writer.counts)], pa.int64()),
                    "tokens": pa.array([int(sum(writer.counts))], pa.int64()),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ranged = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    return written(ranged.mapInArrow(write, MANIFEST), "token-manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files of the manifest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                where, path = _opened(file)
                with where.open_input_file(path) as source:
                    shard = ShardReader(source)
                    crc = [zlib.crc32(shard.document(k).tobytes()) for k in range(len(shard.counts))]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(shard.doc_ids, pa.int64()),
                            "start": pa.array(shard.starts[:-1] + base, pa.int64()),
                            "n_tokens": pa.array(shard.counts, pa.int64()),
                            "ids_crc32": pa.array(crc, pa.int64()),
                        }
                    )

    # One row a shard: a running sum over them is small however large the files are.
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    based = manifest.select("shard", "file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    shards = max(1, manifest.count())
    spread = based.repartitionByRange(shards, "shard").select("file", "base")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_index(manifest: DataFrame) -> DataFrame:
    """doc_id, file, place of every document: the files' tails alone are read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                where, path = _opened(file)
                with where.open_input_file(path) as source:
                    ids = pa.array(ShardReader(source).doc_ids, pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array([file] * len(ids)), pa.array(range(len(ids)), pa.int64())], names=["doc_id", "file", "place"])

    return manifest.select("file").repartition("file").mapInArrow(read, "doc_id long, file string, place long")


def read_documents(manifest: DataFrame, doc_ids: DataFrame) -> DataFrame:
    """doc_id, ids of the wanted documents (doc_ids: a column doc_id); other frames aren't touched.
    The wanted are joined with the files' indexes; PLACES neighbouring documents are one task's at most."""
    wanted = doc_ids.select(F.col("doc_id").cast("long").alias("_wanted")).distinct()
    found = read_index(manifest).join(wanted, F.col("doc_id").eqNullSafe(F.col("_wanted"))).withColumn("part", F.floor(F.col("place") / PLACES))
    found = found.repartition("file", "part").sortWithinPartitions("file", "place").select("file", "place", "doc_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source, shard = None, None, None
        for batch in batches:
            for file, place, doc_id in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if file != name:
                    if source is not None:
                        source.close()
                    where, path = _opened(file)
                    name, source = file, where.open_input_file(path)
                    shard = ShardReader(source)
                ids = pa.array([shard.document(place).astype(np.int64)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), ids], names=["doc_id", "ids"])
        if source is not None:
            source.close()

    return found.mapInArrow(read, "doc_id long, ids array<long>")

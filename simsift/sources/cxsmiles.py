"""Compressed text archives as a DataFrame source and sink.

    read_archives(spark, paths)        archive_index, source_file, block, row, ligand_line, record

An archive is cut into stretches of compressed bytes, fixed before the scan starts and part of its
plan; a stretch is one task, which reads the blocks that begin in it (sources/bzip2.py), so any number of
tasks share an archive and none of them sees a split that another doesn't. A line is known by its block and its
row there. Its number, from 0 after the header, blank lines too, is the lines of all blocks before and
its row: a first pass counts them where an archive has more than one stretch. Bytes that are no UTF-8 are
replaced. The lines that a later step asks for are read from their blocks alone (recovered).

Written archives are files of equal numbers of records, the header in each; tasks write under names
of their own, and their commit messages decide which files get their final names.
"""

from __future__ import annotations

import bz2
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage

from simsift.operators.chunks import chunk_name, chunk_of
from simsift.sources.bzip2 import Blocks, lines_of
from simsift.sources.manifest import SUFFIX, discover, opened
from simsift.space import new_folder, written

SCHEMA = "archive_index int, source_file string, block bigint, row int, ligand_line bigint, record string"
BLOCKS = "archive_index int, stretch int, block bigint, first_row int, lines bigint"
FILES = "file string, chunk bigint, records bigint, checksum bigint"
BATCH_ROWS, UNFINISHED = 50_000, ".unfinished"
#: Compressed bytes of a stretch; bytes read at once when single blocks are sought.
STRETCH_BYTES, SEEK_STEP = 32 << 20, 300_000


@dataclass
class Stretch:
    """Bytes start..end of an archive, or, with a limit, so many lines from a row of a block on."""

    index: int
    path: str
    number: int
    start: int
    end: int
    header: int = 0
    first: int | None = None
    block: int = -1
    row: int = 0
    limit: int = -1


class Pack(InputPartition):
    """Stretches that a task reads one after the other: one of a large archive, several of small ones."""

    def __init__(self, stretches: list[Stretch]):
        super().__init__(None)
        self.stretches = stretches


def _each(work, items: list) -> list:
    """work of many items that wait for a store."""
    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(work, items))


def _size(uri: str) -> int:
    where, path = opened(uri)
    info = where.get_file_info(path)
    if info.type != fs.FileType.File:
        raise FileNotFoundError(uri)
    return info.size


def stretches(paths: list[str], header_lines: int = 1, first_index: int = 0, size: int = STRETCH_BYTES) -> list[Stretch]:
    """The archives' stretches in order. An archive of one stretch has its lines numbered."""
    if size < 64:
        raise ValueError("a stretch has at least 64 bytes")
    out = []
    for index, (path, total) in enumerate(zip(paths, _each(_size, paths)), first_index):
        n = max(1, -(-total // size))
        for k in range(n):
            out.append(Stretch(index, path, k, k * size, min((k + 1) * size, total), header_lines if k == 0 else 0, 0 if n == 1 else None))
    return out


def packed(plan: list[Stretch], limit: int) -> list[list[Stretch]]:
    """Neighbouring stretches of together at most so many bytes, or one larger one."""
    out: list[list[Stretch]] = []
    held = 0
    for s in plan:
        if not out or held + s.end - s.start > limit:
            out.append([])
            held = 0
        out[-1].append(s)
        held += s.end - s.start
    return out


def pack_bytes(spark: SparkSession, plan: list[Stretch], size: int) -> int:
    """What a task should read: a stretch's size, less if there wouldn't be three tasks a core."""
    return min(size, sum(s.end - s.start for s in plan) // (3 * spark.sparkContext.defaultParallelism))


def stretch_lines(s: Stretch) -> Iterator[tuple[int, int, list[bytes]]]:
    """block, row, lines after the header."""
    where, path = opened(s.path)
    with where.open_input_file(path) as file:
        blocks = Blocks(file, size := file.size())
        if s.limit >= 0:
            left = s.limit
            for block, row, lines in blocks.lines_at(s.block) if left else ():
                if block == s.block and row < s.row:
                    lines, row = lines[s.row - row :], max(row, min(s.row, row + len(lines)))
                if lines := lines[:left]:
                    yield block, row, lines
                    left -= len(lines)
                if not left:
                    return
            if left:
                raise OSError(f"{s.path} ends {left} lines too early")
            return
        skip = s.header
        for block, row, lines in lines_of(blocks.since(s.start, s.end), 8 * s.end, s.start == 0):
            past = min(skip, len(lines))
            skip -= past
            if past < len(lines):
                yield block, row + past, lines[past:]
        if skip and s.end < size:
            raise ValueError(f"the header of {s.path} is longer than a stretch: take larger ones")


def decoded(lines: list[bytes]) -> list[str]:
    return b"\n".join(lines).decode("utf-8", "replace").split("\n")


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.plan = [Pack([Stretch(*x) for x in pack]) for pack in json.loads(options["stretches"])]

    def partitions(self) -> list[InputPartition]:
        return self.plan

    def read(self, partition: Pack | None) -> Iterator[pa.RecordBatch]:
        for stretch in partition.stretches if partition is not None else ():
            yield from self._read(stretch)

    def _read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        line, blocks, rows, records = partition.first, [], [], []
        for block, row, lines in stretch_lines(partition):
            for at in range(0, len(lines), BATCH_ROWS):
                part = lines[at : at + BATCH_ROWS]
                blocks += [block] * len(part)
                rows += range(row + at, row + at + len(part))
                records += decoded(part)
                if len(records) >= BATCH_ROWS:
                    yield self._batch(partition, line, blocks, rows, records)
                    line = None if line is None else line + len(records)
                    blocks, rows, records = [], [], []
        if records:
            yield self._batch(partition, line, blocks, rows, records)

    @staticmethod
    def _batch(s: Stretch, line: int | None, blocks: list[int], rows: list[int], records: list[str]) -> pa.RecordBatch:
        n = len(records)
        lines = pa.nulls(n, pa.int64()) if line is None else pa.array(range(line, line + n), pa.int64())
        columns = [pa.array([s.index] * n, pa.int32()), pa.array([s.path] * n), pa.array(blocks, pa.int64()), pa.array(rows, pa.int32()), lines, pa.array(records, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["archive_index", "source_file", "block", "row", "ligand_line", "record"])


class BlockReader(ArchiveReader):
    """Of each block with lines: the first row after the header, and how many lines."""

    def _read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[int]] = {}
        for block, row, lines in stretch_lines(partition):
            found.setdefault(block, [row, 0])[1] += len(lines)
        n, types = len(found), (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
        values = ([partition.index] * n, [partition.number] * n, list(found), [v[0] for v in found.values()], [v[1] for v in found.values()]) if n else ([],) * 5
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=["archive_index", "stretch", "block", "first_row", "lines"])


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cxsmiles"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ArrivingArchives(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return ChunkWriter(self.options)


class ArrivingArchives(DataSourceStreamReader):
    """The archives below a folder, each once, as they arrive; a partition an archive, whose lines are numbered.

    `log` holds a file for each time that new archives were seen, with their names in order, numbered from 1; an offset
    is the number of such files. So an offset names the same archives in every attempt and after a
    restart, whatever has arrived since, and an archive's index is its place in the log.
    """

    def __init__(self, options: dict):
        self.folder, self.log = options["folder"], options["log"]
        self.header = int(options.get("header_lines", 1))

    def _logged(self) -> list[list[str]]:
        where, root = opened(self.log)
        names = sorted(x.base_name for x in where.get_file_info(fs.FileSelector(root, allow_not_found=True)) if x.base_name.endswith(".json"))
        out = []
        for name in names:
            with where.open_input_stream(f"{root}/{name}") as f:
                out.append(json.loads(f.read()))
        return out

    def initialOffset(self) -> dict:
        return {"seen": 0}

    def latestOffset(self) -> dict:
        logged = self._logged()
        known = {a for names in logged for a in names}
        if new := [a for a in discover(self.folder, none_is_wrong=False) if a not in known]:
            where, root = opened(self.log)
            where.create_dir(root, recursive=True)
            with where.open_output_stream(f"{root}/.new") as f:
                f.write(json.dumps(new).encode())
            where.move(f"{root}/.new", f"{root}/{len(logged) + 1:010d}.json")
        return {"seen": len(logged) + bool(new)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        logged = self._logged()
        first = sum(map(len, logged[: start["seen"]]))
        new = [a for names in logged[start["seen"] : end["seen"]] for a in names]
        sizes = _each(_size, new)
        return [Pack([Stretch(k, a, 0, 0, size, self.header, 0)]) for k, (a, size) in enumerate(zip(new, sizes), first)]

    def read(self, partition: Pack) -> Iterator[pa.RecordBatch]:
        return ArchiveReader({"stretches": "[]"}).read(partition)


class BlockSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cxsmiles_blocks"

    def schema(self) -> str:
        return BLOCKS

    def reader(self, schema) -> DataSourceReader:
        return BlockReader(self.options)


def scan(spark: SparkSession, plan: list[list[Stretch]], source: type[DataSource] = ArchiveSource) -> DataFrame:
    """The lines of stretches as they lie, a task a list; ligand_line is null where it isn't known yet."""
    spark.dataSource.register(source)
    fields = [[[s.index, s.path, s.number, s.start, s.end, s.header, s.first, s.block, s.row, s.limit] for s in pack] for pack in plan]
    return spark.read.format(source.name()).option("stretches", json.dumps(fields)).load()


def block_index(spark: SparkSession, plan: list[Stretch]) -> DataFrame:
    """archive_index, stretch, block, first_row, lines of every block that has lines, from one pass over the stretches."""
    return scan(spark, [[s] for s in plan], BlockSource)


def read_archives(spark: SparkSession, paths: list[str], header_lines: int = 1, first_index: int = 0, size: int = STRETCH_BYTES) -> DataFrame:
    """archive_index (counted from first_index), source_file, block, row, ligand_line, record of all lines."""
    plan = stretches(paths, header_lines, first_index, size)
    if several := [s for s in plan if s.first is None]:
        counts = block_index(spark, several).groupBy("archive_index", "stretch").agg(F.sum("lines").alias("n"))
        known = {(r["archive_index"], r["stretch"]): r["n"] for r in counts.collect()}  # a number for each stretch of the plan
        line = 0
        for s in several:
            line = 0 if s.number == 0 else line
            s.first, line = line, line + known.get((s.index, s.number), 0)
    return scan(spark, packed(plan, pack_bytes(spark, plan, size)))


def arriving_archives(spark: SparkSession, folder: str, log: str, header_lines: int = 1) -> DataFrame:
    """A stream of the lines of archives below a folder, those that are there and those that come. Archives are put there
    by a rename, as the split job does, and log belongs to this stream alone."""
    spark.dataSource.register(ArchiveSource)
    return spark.readStream.format("cxsmiles").options(folder=folder, log=log, header_lines=header_lines).load()


def numbered(blocks: DataFrame) -> DataFrame:
    """blocks(archive_index, block, first_row, lines) with shift: what a row of the block has to be added to be its line's number."""
    earlier = W.partitionBy("archive_index").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return blocks.withColumn("shift", F.coalesce(F.sum("lines").over(earlier), F.lit(0)) - F.col("first_row"))


def fetched(batches: Iterator[pa.RecordBatch], taken: list[int] | None = None) -> Iterator[pa.RecordBatch]:
    """Batches in order of source_file and block, with their records, each block read once; taken
    gets the bytes read of every block."""
    now, lines = None, []
    for batch in batches:
        records = []
        for file, block, row in zip(*(batch.column(c).to_pylist() for c in ("source_file", "block", "row"))):
            if now != (file, block):
                where, path = opened(file)
                with where.open_input_file(path) as f:
                    blocks = Blocks(f, f.size(), SEEK_STEP)
                    lines = [x for _, _, part in blocks.lines_at(block, block + 1) for x in part]
                now = (file, block)
                if taken is not None:
                    taken.append(blocks.taken)
            if row >= len(lines):
                raise ValueError(f"no record at {file}, bit {block}, row {row}")
            records.append(decoded([lines[row]])[0])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(records, pa.string())], names=[*batch.schema.names, "record"])


def recovered(hits: DataFrame) -> DataFrame:
    """hits(source_file, block, row, ..) with their record. Only blocks that hold a hit are read, each
    once; a hit without its record is an error."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hits.schema.fields)
    ordered = hits.repartition("source_file", "block").sortWithinPartitions("source_file", "block", "row")
    return ordered.mapInArrow(lambda batches: fetched(batches), f"{fields}, record string")


@dataclass
class WrittenChunks(WriterCommitMessage):
    files: list[tuple[str, str, int, int, int]]


class ChunkWriter(DataSourceArrowWriter):
    """Writes rows(file, chunk, record), in order of file in each task, below `folder`."""

    def __init__(self, options: dict):
        self.folder, self.report = options["folder"], options["report"]
        self.header = json.loads(options["header"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        where, root = opened(self.folder)
        out, name, files = None, None, []
        for batch in iterator:
            names = batch.column(0).to_pylist()
            ends = [k for k in range(1, len(names)) if names[k - 1] != names[k]] if names and names[0] != names[-1] else []
            for start, end in zip([0, *ends], [*ends, len(names)]) if names else ():
                file = names[start]
                if file != name:
                    if out is not None:
                        out.close()
                    own = f"{root}/{file}.{uuid.uuid4().hex}{UNFINISHED}"
                    out, name = bz2.BZ2File(where.open_output_stream(own, compression=None), "w"), file
                    if self.header is not None:
                        out.write(self.header.encode() + b"\n")
                    files.append([file, own, batch.column(1)[start].as_py(), 0, 0])
                data = "\n".join(pc.fill_null(batch.column(2), "").slice(start, end - start).to_pylist()).encode() + b"\n"
                out.write(data)
                files[-1][3:] = files[-1][3] + end - start, zlib.crc32(data, files[-1][4])
        if out is not None:
            out.close()
        return WrittenChunks([tuple(f) for f in files])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        where, root = opened(self.folder)
        _each(lambda f: where.move(f[1], f"{root}/{f[0]}"), files)
        self._sweep(where, root)
        rows = [{"file": f"{self.folder}/{f[0]}", "chunk": f[2], "records": f[3], "checksum": f[4]} for f in files]
        store, path = opened(self.report)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/files.json") as f:
            f.write("".join(json.dumps(r) + "\n" for r in rows).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._sweep(*opened(self.folder))

    @staticmethod
    def _sweep(where: fs.FileSystem, root: str) -> None:
        """Deletes what lost and repeated attempts left behind."""
        infos = where.get_file_info(fs.FileSelector(root, allow_not_found=True))
        _each(where.delete_file, [x.path for x in infos if x.path.endswith(UNFINISHED)])


def save_chunks(rows: DataFrame, header: str | None, folder: str) -> DataFrame:
    """Writes rows(file, chunk, record), a file's rows in one task and in order; the written files: file, chunk, records, checksum."""
    spark, report = rows.sparkSession, new_folder(rows.sparkSession, "chunk-files")
    where, root = opened(folder)
    where.create_dir(root, recursive=True)
    spark.dataSource.register(ArchiveSource)
    options = {"folder": folder, "report": report, "header": json.dumps(header)}
    rows.select("file", "chunk", "record").write.format("cxsmiles").options(**options).mode("append").save()
    return spark.read.schema(FILES).json(report)


def write_chunks(records: DataFrame, size: int, header: str | None, folder: str) -> DataFrame:
    """Writes records(base, line, record) as archives of size records each, the header in every one;
    returns the written files. A chunk is one task's work and never held whole."""
    chunk = chunk_of(F.col("line"), size)
    rows = records.select(chunk_name(F.col("base"), chunk).alias("file"), chunk.alias("chunk"), "record", "line")
    return save_chunks(rows.repartition("file").sortWithinPartitions("file", "line"), header, folder)


def cut(spark: SparkSession, archive: str, blocks: DataFrame, size: int, base: str, stretch_bytes: int = STRETCH_BYTES) -> DataFrame:
    """file, chunk, record of an archive's lines in chunks of size. A task has one chunk, or neighbouring small ones, and reads
    their lines from the block where the first begins: no shuffle, no sort. blocks is the archive's block index."""
    total = blocks.agg(F.sum("lines")).first()[0] or 0
    tasks = max(3 * spark.sparkContext.defaultParallelism, -(-_size(archive) // stretch_bytes))
    lines = size * max(1, -(-total // size) // tasks)  # of a task
    n, before = F.col("lines"), F.col("shift") + F.col("first_row")
    first, last = F.ceil(before / lines), F.floor((before + n - 1) / lines)
    starts = numbered(blocks).where(first <= last).select(F.explode(F.sequence(first, last)).alias("k"), "block", "shift")
    plan = []
    for r in starts.orderBy("k").collect():  # a row a task
        line = r["k"] * lines
        plan.append([Stretch(0, archive, r["k"], 0, 0, 0, line, r["block"], line - r["shift"], min(lines, total - line))])
    chunk = chunk_of(F.col("ligand_line"), size)
    return scan(spark, plan).select(chunk_name(F.lit(base), chunk).alias("file"), chunk.alias("chunk"), "record")


def headers_of(uri: str, header_lines: int) -> list[str]:
    """The first header_lines lines of an archive; fewer if it has fewer."""
    out: list[str] = []
    with opened(uri)[0].open_input_file(opened(uri)[1]) as file:
        for _, _, lines in lines_of(Blocks(file, file.size(), SEEK_STEP).since(0, file.size()), None, True) if header_lines else ():
            out += decoded(lines[: header_lines - len(out)])
            if len(out) == header_lines:
                break
    return out


def _proof(uri: str, header_lines: int) -> tuple[list[bytes], int, int]:
    """Header, number and checksum of the lines after it of a written archive, read from its start."""
    where, path = opened(uri)
    with where.open_input_stream(path, compression=None) as raw, bz2.BZ2File(io.BufferedReader(raw)) as data:
        header = [data.readline().rstrip(b"\n") for _ in range(header_lines)]
        count = checksum = 0
        while piece := data.read(1 << 20):
            count, checksum = count + piece.count(b"\n"), zlib.crc32(piece, checksum)
    return header, count, checksum


def verify_chunks(spark: SparkSession, files: list[str], size: int, total: int, header_lines: int = 1, header: list[str] | None = None, checksums: list[int] | None = None) -> None:
    """Reads the chunks again; raises unless all but the last are full, all records are there, each
    begins with the header and, if checksums are given, holds the very lines that were written."""
    if not total:
        raise ValueError("the archive has no record")
    want = None if header is None else [h.encode() for h in header]

    def proved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_proof(f, header_lines) for f in batch.column(0).to_pylist()]
            columns = [batch.column(1), batch.column(2), pa.array([p[1] for p in found], pa.int64()), pa.array([p[2] for p in found], pa.int64()), pa.array([want is None or p[0] == want for p in found])]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "checksum", "n", "own", "headed"])

    rows = [(f, k, checksums[k] if checksums else None) for k, f in enumerate(files)]
    names = spark.createDataFrame(rows, "file string, place int, checksum bigint").repartition(max(1, min(len(files), 200)))
    made = written(names.mapInArrow(proved, "place int, checksum bigint, n bigint, own bigint, headed boolean"), "chunk-proofs")
    odd = made.where((F.col("n") > size) | ((F.col("n") < size) & (F.col("place") < len(files) - 1)))
    if not odd.isEmpty() or (made.agg(F.sum("n")).first()[0] or 0) != total:
        raise ValueError(f"the chunks don't hold the {total} records in full chunks of {size}")
    if not made.where("NOT headed").isEmpty():
        raise ValueError("a chunk's header differs from the archive's")
    if not made.where("checksum != own").isEmpty():
        raise ValueError("a chunk differs from what was written")


__all__ = ["SUFFIX", "block_index", "cut", "headers_of", "read_archives", "recovered", "save_chunks", "scan", "stretches", "verify_chunks", "write_chunks"]

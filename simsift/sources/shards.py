"""What a search writes: a file for each finished stretch, then the shards' hits and metadata at once.

    out/parts/task_index=t/a-n.parquet   of stretch n of archive a, and those in its pack: the hits that can still
                                         matter, and a row a block with its counts; the file is there once they are done
    out/hits/task_index=t/..parquet      the K best of a shard
    out/metadata/..json                  a row a shard, which names the shard's files: what it doesn't name
                                         isn't part of a run

A task writes under a name of its own and renames it, so the second attempt at a stretch, in the same
run or in one that goes on with it, leaves one file. Hits count from the moment at which the driver
renames the metadata; a write that fails before deletes its files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from simsift.sources.manifest import opened

#: Hits have a score and no lines, counts have lines; row is a count's first row.
PARTS = "archive_index int, block bigint, row int, tanimoto double, lines bigint, valid bigint, passing bigint"
_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]


def part_name(pack: list) -> str:
    return f"{pack[0].index}-{pack[0].number}.parquet"


def publish(folder: str, name: str, table: pa.Table) -> str:
    """A Parquet file that is there whole or not at all."""
    where, root = opened(folder)
    where.create_dir(root, recursive=True)
    own, final = f"{root}/.{name}.{uuid.uuid4().hex}", f"{root}/{name}"
    with where.open_output_stream(own) as f:
        pq.write_table(table, f)
    try:
        where.move(own, final)
    except OSError:  # stores that don't replace: another attempt has written the same
        if where.get_file_info(final).type == fs.FileType.NotFound:
            raise
        where.delete_file(own)
    return f"{folder}/{name}"


def spans(pack: list) -> list[tuple[int, int, int]]:
    """Archives of a pack, and the bytes of them that it holds."""
    held: dict[int, list[int]] = {}
    for s in pack:
        held.setdefault(s.index, []).extend((s.start, s.end))
    return [(a, min(x), max(x)) for a, x in held.items()]


def finished(out: str, task: int) -> set[str]:
    """Names of the files of a shard's finished stretches."""
    where, root = opened(f"{out}/parts/task_index={task}")
    infos = where.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return {x.base_name for x in infos if x.base_name.endswith(".parquet") and x.base_name[0] not in "._"}


class Best:
    """The k best of scores that come in batches, in order of score and place (archive, block, row); at most 2 k are held."""

    def __init__(self, k: int):
        self.k = k
        self.held = [np.zeros(0), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)]

    def add(self, *columns: np.ndarray) -> None:
        self.held = [np.concatenate(x) for x in zip(self.held, columns)]
        if len(self.held[0]) > 2 * self.k:
            self.cut()

    def cut(self) -> list[np.ndarray]:
        score, archive, block, row = self.held
        order = np.lexsort((row, block, archive, -score))[: self.k]
        self.held = [x[order] for x in self.held]
        return self.held


@dataclass
class Finished(WriterCommitMessage):
    file: str


class StretchWriter(DataSourceArrowWriter):
    """Rows archive_index, block, row, tanimoto (null: not valid) of every line of a pack of stretches, a task's
    partition; todo names the packs in the order of partitions: task, file, archives with their bytes."""

    def __init__(self, options: dict):
        self.out, self.k = options["out"], int(options["top_k"])
        self.todo, self.bounds = json.loads(options["todo"]), {int(t): b for t, b in json.loads(options["bounds"]).items()}
        self.cutoff = json.loads(options["cutoff"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        task, name, spans = self.todo[TaskContext.get().partitionId()]
        bits = {a: (8 * start, max(8 * end, 33)) for a, start, end in spans}
        limit = max(self.cutoff or 0.0, self.bounds.get(task, 0.0))
        best, counts = Best(self.k), {}
        for b in iterator:
            if not len(b):
                continue
            archives, blocks, rows = (b.column(k).to_numpy() for k in range(3))
            score = b.column(3).to_numpy(zero_copy_only=False)  # null is NaN
            valid = ~np.isnan(score)
            passing = valid & (score >= (self.cutoff or 0.0))
            new = np.flatnonzero(np.append(True, (archives[1:] != archives[:-1]) | (blocks[1:] != blocks[:-1])))
            for start, end in zip(new.tolist(), [*new[1:].tolist(), len(b)]):
                archive, block = int(archives[start]), int(blocks[start])
                low, high = bits.get(archive, (0, 0))
                if not low <= block < high:
                    raise AssertionError(f"rows of archive {archive}, bit {block}, which {name} doesn't hold")
                own = counts.setdefault((archive, block), [int(rows[start]), 0, 0, 0])
                own[1:] = own[1] + end - start, own[2] + int(valid[start:end].sum()), own[3] + int(passing[start:end].sum())
            near = valid & (score >= limit)
            best.add(score[near], archives[near], blocks[near], rows[near])
        score, archive, block, row = best.cut()
        none, n, m = [None], len(score), len(counts)
        columns = [
            [*archive.tolist(), *(a for a, _ in counts)],
            [*block.tolist(), *(b for _, b in counts)],
            [*row.tolist(), *(c[0] for c in counts.values())],
            [*score.tolist(), *none * m],
            *([*none * n, *(c[k] for c in counts.values())] for k in (1, 2, 3)),
        ]
        names = [x.split()[0] for x in PARTS.split(", ")]
        table = pa.table([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=names)
        return Finished(publish(f"{self.out}/parts/task_index={task}", name, table))

    def commit(self, messages: list) -> None:
        """Nothing is left to do: a stretch counts from the moment its file is there."""

    def abort(self, messages: list) -> None:
        """Finished stretches stay, for the run that goes on."""


class StretchSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "stretches"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return StretchWriter(self.options)


@dataclass
class Hits(WriterCommitMessage):
    files: list[list]


class ShardWriter(DataSourceArrowWriter):
    """Rows of shards, task_index last; metadata holds the shards' rows, published with the hits."""

    def __init__(self, options: dict):
        self.out, self.metadata = options["out"], json.loads(options["metadata"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files: list[list] = []
        out = where = None
        for batch in iterator:
            tasks = batch.column(batch.schema.names.index("task_index")).to_numpy()
            for task in np.unique(tasks).tolist():  # tasks come in order
                own = batch.filter(pa.array(tasks == task)).drop_columns(["task_index"])
                if not files or files[-1][0] != task:
                    if out is not None:
                        out.close()
                    folder = f"{self.out}/hits/task_index={task}"
                    where, root = opened(folder)
                    where.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.parquet"
                    out = pq.ParquetWriter(f"{root}/{name}", own.schema, filesystem=where)
                    files.append([task, f"{folder}/{name}", 0])
                out.write_batch(own)
                files[-1][2] += len(own)
        if out is not None:
            out.close()
        return Hits(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        for row in self.metadata:
            row["files"] = sorted(f[1] for f in files if f[0] == row["task_index"])
            if (found := sum(f[2] for f in files if f[0] == row["task_index"])) != row["retained"]:
                raise ValueError(f"task {row['task_index']} has {found} hits, its counts say {row['retained']}")
        where, root = opened(f"{self.out}/metadata")
        where.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.json"
        with where.open_output_stream(f"{root}/.{name}") as f:
            f.write("".join(json.dumps(row) + "\n" for row in self.metadata).encode())
        where.move(f"{root}/.{name}", f"{root}/{name}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        for message in messages:
            for _, file, _ in message.files if message is not None else ():
                where, path = opened(file)
                where.delete_file(path)


class ShardSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shards"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return ShardWriter(self.options)

"""The split job: one archive in, a folder of verified chunks of equal size out."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simsift.sources import cxsmiles
from simsift.sources.manifest import STAGING, SUFFIX, opened
from simsift.space import written

CHUNK_SIZE = 10_000_000


def _there(where: fs.FileSystem, path: str) -> bool:
    return where.get_file_info(path).type != fs.FileType.NotFound


def split(
    spark: SparkSession,
    archive: str,
    chunk_size: int = CHUNK_SIZE,
    header_lines: int = 1,
    delete_original: bool = False,
    overwrite_inprogress: bool = False,
    stretch_bytes: int = cxsmiles.STRETCH_BYTES,
) -> DataFrame:
    """file, chunk, records of the chunks of X.cxsmiles.bz2, which stand in X_chunks once all are proven.

    One pass over the archive's stretches counts the lines of its blocks; the total comes from it alone.
    Then the chunks are read from the blocks where they begin and written to X_chunks.inprogress, each by one task,
    read again (sizes, total, headers, checksums), and the folder is renamed. An existing X_chunks is
    refused, and a staging folder that a run left behind unless overwrite_inprogress; an archive without records is an error. The archive is deleted, if asked
    for, as the last step.
    """
    if chunk_size < 1 or header_lines < 0 or not archive.endswith(SUFFIX):
        raise ValueError(f"an archive ends in {SUFFIX}, a chunk holds a record at least")
    base = archive.removesuffix(SUFFIX)
    final, staging = f"{base}_chunks", f"{base}{STAGING}".rstrip("/")
    where, at = opened(staging)
    if _there(where, opened(final)[1]):
        raise FileExistsError(f"{final} exists")
    if _there(where, at):
        if not overwrite_inprogress:
            raise FileExistsError(f"{staging} exists: another run writes it or has left it behind")
        where.delete_dir(at)
    header = cxsmiles.headers_of(archive, header_lines)
    blocks = written(cxsmiles.block_index(spark, cxsmiles.stretches([archive], header_lines, size=stretch_bytes)), "blocks")
    total = blocks.agg(F.sum("lines")).first()[0] or 0
    if len(header) < header_lines or not total:
        raise ValueError(f"{archive} has no record")
    rows = cxsmiles.cut(spark, archive, blocks, chunk_size, base.rpartition("/")[2], stretch_bytes)
    files = cxsmiles.save_chunks(rows, "\n".join(header) if header else None, staging)
    made = files.orderBy("chunk").collect()  # a row a chunk
    cxsmiles.verify_chunks(spark, [r["file"] for r in made], chunk_size, total, header_lines, header, [r["checksum"] for r in made])
    where.move(at, opened(final)[1])
    if delete_original:
        where.delete_file(opened(archive)[1])
    return files.drop("checksum").withColumn("file", F.concat(F.lit(final + "/"), F.element_at(F.split("file", "/"), -1)))

"""Manifests: the ordered list of archives, whose position is an archive's key."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

SUFFIX = ".cxsmiles.bz2"
#: Folders that a split in progress uses; their files aren't archives yet.
STAGING = "_chunks.inprogress/"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def discover(root: str, suffix: str = SUFFIX, none_is_wrong: bool = True) -> list[str]:
    """All archives below root in order of their paths, without those of a split in progress."""
    where, path = opened(root)
    scheme = root[: root.index("://") + 3] if "://" in root else ""
    infos = where.get_file_info(fs.FileSelector(path, recursive=True))
    found = sorted(x.path for x in infos if x.type == fs.FileType.File and x.path.endswith(suffix))
    found = [scheme + p for p in found if STAGING not in p]
    if not found and none_is_wrong:
        raise ValueError(f"no *{suffix} below {root}")
    return found


def kept_originals(paths: list[str]) -> list[str]:
    """Archives that stand beside their own chunks: searching both counts their records twice."""
    folders = {p.rpartition("/")[0] for p in paths}
    return [p for p in paths if p.removesuffix(SUFFIX) + "_chunks" in folders]


def read_manifest(uri: str) -> list[str]:
    """Lines of a manifest file without blank ones, in order."""
    where, path = opened(uri)
    with where.open_input_stream(path) as f:
        lines = [x.strip() for x in f.read().decode().splitlines()]
    lines = [x for x in lines if x]
    if not lines:
        raise ValueError(f"{uri} lists no archive")
    return lines


def manifest_frame(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(paths)), "archive_index int, source_file string")


def write_manifest(uri: str, paths: list[str]) -> None:
    where, path = opened(uri)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    with where.open_output_stream(path) as f:
        f.write("".join(f"{p}\n" for p in paths).encode())

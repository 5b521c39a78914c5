"""File listings.

`list_files` uses Spark's own file index, which ends up on the driver: right for a folder or a subset. `walk_files` lists
on the executors, folder by folder, and keeps the result there: for trees of any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from os import scandir

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.functions.paths import has_extension, plain_path
from papyrine.sources.tables import materialize

_ENTRY_SCHEMA = "root string, inside string, length long, is_folder boolean"
_BATCH_ROWS = 10_000


def _any_case(extension: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)


def scan_files(
    spark: SparkSession, *roots: str, extensions: tuple[str, ...] = (".pdf",), recursive: bool = True
) -> DataFrame:
    """Files below the roots as (path, modificationTime, length, content), each file once.

    Paths are spelled as by `plain_path`. Extensions match in any case, while listing. File contents are read only where `content` is used. Empty files are
    left out.
    """
    pattern = "*{" + ",".join(_any_case(one) for one in extensions) + "}"
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    files = reader.option("recursiveFileLookup", str(recursive).lower()).load(list(roots))
    return files.withColumn("path", plain_path(F.col("path")))


def list_files(
    spark: SparkSession, *roots: str, extensions: tuple[str, ...] = (".pdf",), recursive: bool = True
) -> DataFrame:
    """Paths of the files below the roots."""
    return scan_files(spark, *roots, extensions=extensions, recursive=recursive).select("path")


@lru_cache(maxsize=64)
def _opened(root: str) -> tuple[fs.FileSystem, str]:
    """Opened once per root and worker."""
    return fs.FileSystem.from_uri(root)


def _entries(root: str, folder: str) -> Iterator[tuple[str, int, bool]]:
    """Name, size and kind of what a folder holds, one by one where the file system allows. Links to folders are left out."""
    system, top = _opened(root)
    place = f"{top.rstrip('/')}/{folder}"
    if system.type_name == "local":
        with scandir(place) as found:
            for entry in found:
                if not (entry.is_symlink() and entry.is_dir()):
                    yield entry.name, entry.stat().st_size if entry.is_file() else 0, entry.is_dir()
        return
    for entry in system.get_file_info(fs.FileSelector(place)):
        yield entry.base_name, entry.size or 0, entry.type == fs.FileType.Directory


def outer_roots(roots: tuple[str, ...]) -> list[str]:
    """The roots in one spelling, without repeats and without those inside others."""
    plain = sorted({"/" + root.removeprefix("file:").strip("/") if root.startswith(("/", "file:")) else root.rstrip("/") for root in roots})
    return [root for root in plain if not any(root.startswith(other.rstrip("/") + "/") for other in plain if other != root)]


def walk_files(spark: SparkSession, *roots: str, extensions: tuple[str, ...] = (".pdf",)) -> DataFrame:
    """Files below the roots as (path, length), each file once, empty ones too; paths are spelled as by `plain_path`.

    One job per level of the tree: the folders of a level are dealt out over the tasks, and what they hold is written to
    the shared folder. A root is an absolute path or a URI that the executors can reach; links to folders are not followed.
    """

    def list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The entries of each folder, which is named by a root and its place below that root."""

        def rows(root: str, folder: str, part: list[tuple[str, int, bool]]) -> pa.RecordBatch:
            names, sizes, kinds = zip(*part)
            columns = [
                pa.array([root] * len(part), pa.string()),
                pa.array([folder + name for name in names], pa.string()),
                pa.array(sizes, pa.int64()),
                pa.array(kinds, pa.bool_()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["root", "inside", "length", "is_folder"])

        for batch in batches:
            for root, folder in zip(batch.column("root").to_pylist(), batch.column("inside").to_pylist()):
                part: list[tuple[str, int, bool]] = []
                for entry in _entries(root, folder):
                    part.append(entry)
                    if len(part) >= _BATCH_ROWS:
                        yield rows(root, folder, part)
                        part = []
                if part:
                    yield rows(root, folder, part)

    tasks = spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame([(root or "/", "") for root in outer_roots(roots)], "root string, inside string")
    levels = []
    while not levels or not folders.isEmpty():
        entries = materialize(folders.repartition(tasks).mapInArrow(list_folders, _ENTRY_SCHEMA), "entries")
        levels.append(entries.filter(~F.col("is_folder") & has_extension(F.col("inside"), *extensions)))
        folders = entries.filter("is_folder").select("root", F.concat("inside", F.lit("/")).alias("inside"))
    files = reduce(DataFrame.unionByName, levels)
    return files.select(plain_path(F.concat("root", F.lit("/"), "inside")).alias("path"), "length")

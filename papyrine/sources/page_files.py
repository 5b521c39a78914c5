"""Files of pages as a Spark data source: `spark.read.format("page_files")`.

    register(spark)
    spark.read.format("page_files").option("reader", "my_readers:pdf_pages").load("hdfs://cluster/scrape")

Partitions are planned by bytes: small files share one, a large one has one for itself, so no task has a large file and many small
ones besides. Where that would make too many, they get more bytes each: a task holds one file at a time, so it takes no more memory. Filters on the path are applied while planning, so files that no one asks for are never opened. Contents are
read by the tasks, through the same file systems as `walk_files`; the driver sees names and sizes only.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator, Sequence
from importlib import import_module

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)
from pyspark.sql.types import StructType

from papyrine.operators.hooks import _PAGE_TYPES, PAGE_SCHEMA, _text_maker

FORMAT = "page_files"
PARTITION_BYTES = 128 << 20
MOST_PARTITIONS = 1_000  # unless they would be larger than PARTITION_BYTES
_ROWS = 1_000  # of a batch


def lines_as_pages(path: str, content: bytes) -> Iterator[str]:
    """Every line of a text file is a page."""
    return iter(content.decode("utf-8", "replace").removesuffix("\n").split("\n"))


def planned(files: Sequence[tuple[str, int]], most: int) -> list[list[str]]:
    """Files (name, bytes) in groups of at most `most` bytes; a larger file is a group by itself.

    The largest file first, each goes to the group with the least bytes if it fits there, else to a new one. Empty files take a byte.
    """
    groups: list[list[str]] = []
    open_groups: list[tuple[int, int]] = []
    for name, size in sorted(files, key=lambda file: (-file[1], file[0])):
        size = max(size, 1)
        if open_groups and open_groups[0][0] + size <= most:
            held, place = heapq.heappop(open_groups)
        else:
            held, place = 0, len(groups)
            groups.append([])
        groups[place].append(name)
        heapq.heappush(open_groups, (held + size, place))
    return groups


def bytes_each(total: int, most: int) -> int:
    """`most`, or as much more as keeps the partitions of `total` bytes at MOST_PARTITIONS, but PARTITION_BYTES is enough.

    A task has a cost of its own, some tenths of a second for a new worker and its reader.
    """
    return max(most, min(PARTITION_BYTES, total // MOST_PARTITIONS))


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)


class _PageReader(DataSourceReader):
    def __init__(self, root: str, reader: str, extensions: tuple[str, ...], most: int):
        self.root, self.reader, self.extensions, self.most = root, reader, extensions, most
        self.tests: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Those on the path are done here, as nothing but files that pass them is planned."""
        kinds = {EqualTo: "is", EqualNullSafe: "is", In: "in", StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "holds"}
        for one in filters:
            if type(one) in kinds and tuple(one.attribute) == ("pdf_path",):
                self.tests.append((kinds[type(one)], one.value))
            else:
                yield one

    def _wanted(self, path: str) -> bool:
        tests = {
            "is": lambda value: path == value,
            "in": lambda value: path in value,
            "starts": path.startswith,
            "ends": path.endswith,
            "holds": lambda value: value in path,
        }
        return all(value is not None and tests[kind](value) for kind, value in self.tests)

    def partitions(self) -> list[InputPartition]:
        system, top = fs.FileSystem.from_uri(self.root)
        found = system.get_file_info(fs.FileSelector(top, recursive=True))
        files = [(file.path, file.size or 0) for file in found if file.type == fs.FileType.File]
        kept = [(path, size) for path, size in files if path.lower().endswith(self.extensions) and self._wanted(path)]
        most = bytes_each(sum(size for _, size in kept), self.most)
        return [_Files(paths) for paths in planned(kept, most)] or [_Files([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(self.root)
        module, _, name = self.reader.partition(":")
        pages_of: Callable[[str, bytes], Iterable[str | None]] = getattr(import_module(module), name)
        to_text, rows = _text_maker(), []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), _PAGE_TYPES.types, strict=True)], _PAGE_TYPES.names)

        for path in partition.value:
            try:
                with system.open_input_stream(path) as stream:
                    content = stream.read()
                for number, text in enumerate(pages_of(path, content), start=1):
                    rows.append((path, number, to_text(text), None))
                    if len(rows) >= _ROWS:
                        yield batch()
                        rows = []
            except Exception as failure:
                rows.append((path, None, None, to_text(failure) or type(failure).__name__))
        if rows:
            yield batch()


class PageFiles(DataSource):
    """Pages (pdf_path, page_no, text, error) of all files below a folder; pages count from 1.

    Options: `path` or load(...), the folder; `reader`, "module:function", from path and bytes to the texts of the pages in order, by
    default `lines_as_pages`; `extensions`, separated by commas, in any case; `partitionBytes`, which grows with very large
    inputs as told by `bytes_each`. A file that fails gives a row
    with the error, after the pages read so far. Files below hidden names are files like others.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return PAGE_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        root = self.options.get("path")
        if not root:
            raise ValueError("name the folder: load(path)")
        if "://" not in root and not root.startswith("file:"):
            root = f"file://{root}"
        root = "file://" + root.removeprefix("file:") if root.startswith("file:/") and not root.startswith("file://") else root
        extensions = tuple(one.strip().lower() for one in self.options.get("extensions", ".pdf").split(","))
        reader = self.options.get("reader", f"{__name__}:{lines_as_pages.__name__}")
        return _PageReader(root, reader, extensions, int(self.options.get("partitionBytes", PARTITION_BYTES)))


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let it see filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageFiles)

"""A folder tree as a data source: which files there are, without opening any.

Spark's own file sources leave out empty files and names starting with a dot or underscore, which an
inventory must show. Here the tree is planned once: folders are listed from the root until there are
enough of them for the tasks, a folder with very many files is cut into ranges of names, and the other
folders are dealt over the tasks, which walk them. So a scan is one job, however deep the tree is, and a flat
folder is spread over tasks too.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, StringStartsWith,
)

ROWS = pa.schema([("path", pa.string()), ("size", pa.int64()), ("mtime", pa.timestamp("us", tz="UTC"))])
ROWS_PER_BATCH = 10_000
_COMPARE = {
    GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b,
}


def open_root(root: str):
    """File system and base path of a root folder; any scheme pyarrow knows, or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")


@dataclass
class Part(InputPartition):
    """Folders to be walked, or the files of one folder whose names lie from ``first`` up to ``last``."""

    folder: str
    walk: bool
    first: str = ""
    last: str | None = None
    more: tuple[str, ...] = ()


class WholeTreeReader(DataSourceReader):
    """Reads the tree, or the paths that start with the option ``under``, in any session."""

    def __init__(self, options: dict):
        self.root = options["root"].rstrip("/")
        self.excluded = set(json.loads(options.get("exclude", "[]")))
        self.parts, self.names = int(options.get("parts", 64)), int(options.get("names", 100_000))
        self.prefix, self.sizes = options.get("under", ""), []

    def _list(self, folder: str) -> tuple[list[str], list]:
        """Folders to enter and files of a folder, by name."""
        from pyarrow import fs

        system, base = open_root(self.root)
        found = sorted(system.get_file_info(fs.FileSelector(f"{base}/{folder}".rstrip("/"))), key=lambda i: i.base_name)
        inside = lambda name: f"{folder}/{name}".lstrip("/")
        folders = [
            inside(i.base_name) for i in found
            if i.type == fs.FileType.Directory and i.base_name not in self.excluded and self._on_the_way(inside(i.base_name))
        ]
        return folders, [i for i in found if i.type != fs.FileType.Directory]

    def _on_the_way(self, folder: str) -> bool:
        """Whether the folder can hold paths that start with the prefix."""
        return f"{folder}/".startswith(self.prefix) or self.prefix.startswith(f"{folder}/")

    def partitions(self) -> list[Part]:
        open_, done = [""], []
        while open_ and len(open_) + len(done) < self.parts:
            folder = open_.pop(0)
            folders, files = self._list(folder)
            open_ += folders
            cuts = [files[i].base_name for i in range(self.names, len(files), self.names)]
            if files:
                done += [Part(folder, False, a, b) for a, b in zip(["", *cuts], [*cuts, None])]
        # one level may hold far more folders than there should be tasks
        dealt = [open_[i :: self.parts] for i in range(min(self.parts, len(open_)))]
        return done + [Part(folder, True, more=tuple(more)) for folder, *more in dealt] or [Part("", False)]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        waiting, rows = [part.folder, *part.more], []
        while waiting:
            folder = waiting.pop()
            folders, files = self._list(folder)
            if part.walk:
                waiting += folders
            for i in files:
                if i.base_name < part.first or (part.last is not None and i.base_name >= part.last):
                    continue
                path, size = f"{folder}/{i.base_name}".lstrip("/"), i.size or 0
                if path.startswith(self.prefix) and all(_COMPARE[kind](size, value) for kind, value in self.sizes):
                    rows.append((path, size, (i.mtime_ns or 0) // 1000))
                if len(rows) == ROWS_PER_BATCH:
                    yield self._batch(rows)
                    rows = []
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ROWS.types)], schema=ROWS)


class TreeReader(WholeTreeReader):
    """With pushed filters. Spark refuses such a reader where ``spark.sql.python.filterPushdown.enabled`` is off."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Path prefixes and size limits spare listing and rows; Spark applies all filters again."""
        for f in filters:
            if isinstance(f, StringStartsWith) and f.attribute == ("path",) and f.value.startswith(self.prefix):
                self.prefix = f.value
            elif type(f) in _COMPARE and f.attribute == ("size",):
                self.sizes.append((type(f), f.value))
            yield f


class FileTree(DataSource):
    """Options: ``root``; ``exclude``, a JSON list of folder names that are not entered; ``under``, how all
    paths begin; ``parts``, folders to plan for and the most tasks that walk some; ``names``, files of one
    folder in a task; ``pushdown``, "true" to push filters too, in a session that allows it."""

    @classmethod
    def name(cls) -> str:
        return "docfleet_file_tree"

    def schema(self) -> str:
        return "path string, size bigint, mtime timestamp"

    def reader(self, schema) -> WholeTreeReader:
        return (TreeReader if self.options.get("pushdown") == "true" else WholeTreeReader)(self.options)

"""Folders as tables: a Python data source that lists files, one partition per top folder."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith

SCHEMA = "top string, folder string, name string, stem string, suffix string, bytes long"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
#: Predicates that are decided while a folder is walked; those on ``top`` spare whole partitions.
TESTS = {
    EqualTo: lambda v, x: v == x, In: lambda v, x: v in x, StringStartsWith: lambda v, x: v.startswith(x),
    StringEndsWith: lambda v, x: v.endswith(x), StringContains: lambda v, x: x in v,
}


@dataclass
class Top(InputPartition):
    """One folder (or file) right below the root."""

    path: str
    top: str
    is_file: bool


class FolderReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.tests = path, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if type(f) in TESTS and f.attribute[0] in NAMES:
                self.tests.append((f.attribute[0], type(f), f.value))
            else:
                yield f

    def holds(self, row: dict) -> bool:
        return all(c not in row or TESTS[kind](row[c], x) for c, kind, x in self.tests)

    def partitions(self) -> list[Top]:
        store, root = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        tops = [Top(x.path, "" if x.is_file else x.base_name, x.is_file) for x in sorted(found, key=lambda x: x.path)]
        return [t for t in tops if self.holds({"top": t.top})] or [Top("", "", True)]

    def read(self, part: Top) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        store, root = fs.FileSystem.from_uri(self.path)
        start = [store.get_file_info(part.path)] if part.is_file else store.get_file_info(fs.FileSelector(part.path))
        todo, rows = list(start), []
        while todo:
            x = todo.pop()
            if x.is_file:
                stem, dot, suffix = x.base_name.rpartition(".")
                folder = x.path[len(root) :].strip("/").rpartition("/")[0]
                row = {"top": part.top, "folder": folder, "name": x.base_name, "stem": stem if dot else x.base_name, "suffix": dot + suffix if dot else "", "bytes": x.size}
                if self.holds(row):
                    rows.append(row)
            else:
                todo += store.get_file_info(fs.FileSelector(x.path))
            if len(rows) >= 10_000:
                yield pa.RecordBatch.from_pylist(rows)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows)


class FolderSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tessera_folder"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.options["path"])


def read_folder_tree(spark: SparkSession, path: str) -> DataFrame:
    """Rows (top, folder, name, stem, suffix, bytes) of all files below ``path``; contents are not read.

    Folders right below the root are dealt out to tasks, each of which walks its own. Equality, membership, and beginnings, ends and parts of names are
    pushed down: those on ``top`` leave out folders before any task walks them. An empty or missing folder gives no rows.
    """
    spark.dataSource.register(FolderSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("tessera_folder").load(path if "://" in path else f"file://{quote(path)}")


def write_files(df: DataFrame, root: str) -> int:
    """A file below ``root`` for each row of (path, content binary); how many. Files of one path overwrite each other.

    Rows are dealt to as many tasks as shuffles have partitions, as a file costs the same time however short it is.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        n, made = 0, set()
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folder = f"{base}/{path}".rpartition("/")[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{base}/{path}", compression=None) as out:
                    out.write(content or b"")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select("path", F.col("content").cast("binary")).repartition(tasks, "path").mapInArrow(put, "n long").agg(F.sum("n")).first()[0] or 0

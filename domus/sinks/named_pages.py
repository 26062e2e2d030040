"""Landing of pages as named objects: one object per page, under the page's own name.

Spark's file writers choose their own file names, so this is a batch data source with a writer of
its own. Every task writes its pages to a staging folder of its attempt; only when all tasks have
ended does the commit move the objects to their names, and a failed write removes what it
staged. A lost task's attempt stays unseen, since readers skip folders that begin with ``_``.
Re-landing a page replaces the object of that name. Objects travel from the executors straight to
the landing folder; the driver sees names only.

Paths may be local (a shared mount) or any URI that the Arrow file systems know.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StringType, StructType

FORMAT = "named_pages"
STAGING = "_staging"
MOVERS = 16


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    names: list[str]


class NamedPagesWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.staging = f"{self.path}/{STAGING}/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        task = TaskContext.get()
        folder = f"{self.staging}/{task.partitionId()}-{task.taskAttemptId()}"
        files, root = _place(folder)
        names: list[str] = []
        for batch in iterator:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not name or "/" in name or name.startswith(("_", ".")):
                    raise ValueError(f"not an object name: {name!r}")
                if not names:
                    files.create_dir(root, recursive=True)
                with files.open_output_stream(f"{root}/{name}") as out:
                    out.write((value or "").encode())
                names.append(name)
        return Staged(folder, names)

    def commit(self, messages: list[Staged]) -> None:
        files, root = _place(self.path)
        files.create_dir(root, recursive=True)
        moves = [(f"{_place(m.folder)[1]}/{name}", f"{root}/{name}") for m in messages if m for name in dict.fromkeys(m.names)]
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(lambda m: files.move(*m), moves))
        self._clear()

    def abort(self, messages: list[Staged]) -> None:
        self._clear()

    def _clear(self) -> None:
        files, root = _place(self.staging)
        if files.get_file_info(root).type != fs.FileType.NotFound:
            files.delete_dir(root)


class NamedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> NamedPagesWriter:
        if [f.dataType for f in schema.fields] != [StringType(), StringType()]:
            raise ValueError("named pages need two text columns: file_name, value")
        return NamedPagesWriter(self.options["path"])


# the classes travel with the plan: workers need not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_named_pages(pages: DataFrame, path: str) -> None:
    """One object per row (``file_name``, ``value``), all of them or none."""
    pages.sparkSession.dataSource.register(NamedPages)
    pages.select("file_name", "value").write.format(FORMAT).mode("append").option("path", path).save()

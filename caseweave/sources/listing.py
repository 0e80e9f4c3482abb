"""Names of stored files, listed on the executors, one folder of the root at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from caseweave.deploy import ensure_on_workers

NAMES_AT_ONCE = 10_000


@dataclass
class Prefix(InputPartition):
    """A folder to list, with all below it or only the files that lie in it."""

    path: str
    below: bool


class ObjectListing(DataSource):
    """Options: ``path`` (a folder or its URI) and ``glob`` (of file names)."""

    @classmethod
    def name(cls) -> str:
        return "object_listing"

    def schema(self) -> str:
        return "uri string"

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(self.options["path"], self.options.get("glob", "*"))


class ListingReader(DataSourceReader):
    def __init__(self, folder: str, glob: str):
        self.folder, self.glob = folder, glob

    def _store(self) -> tuple[fs.FileSystem, str, str]:
        """The file system, the root in it and what makes a URI of a path."""
        store, root = fs.FileSystem.from_uri(self.folder)
        if isinstance(store, fs.LocalFileSystem):
            return store, root, "file:"
        scheme, _, rest = self.folder.partition("://")
        # Object stores count the bucket to the path; others keep their host apart from it.
        host = "" if rest.startswith(root.split("/")[0] or "\0") else rest.split("/")[0]
        return store, root, f"{scheme}://{host}"

    def partitions(self) -> list[Prefix]:
        """One for each folder in the root, and one for the files beside them."""
        store, root, _ = self._store()
        inside = store.get_file_info(fs.FileSelector(root))
        folders = sorted(i.path for i in inside if i.type == fs.FileType.Directory and not _hidden(i.base_name))
        return [Prefix(root, False), *(Prefix(path, True) for path in folders)]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        store, _, start = self._store()
        found, waiting = [], [partition.path]
        while waiting:
            for item in store.get_file_info(fs.FileSelector(waiting.pop())):
                if _hidden(item.base_name):
                    continue
                if item.type == fs.FileType.Directory:
                    waiting += [item.path] * partition.below
                elif item.size != 0 and fnmatchcase(item.base_name, self.glob):
                    found.append(start + item.path)
            while len(found) >= NAMES_AT_ONCE or (found and not waiting):
                yield pa.RecordBatch.from_arrays([pa.array(found[:NAMES_AT_ONCE], pa.string())], ["uri"])
                del found[:NAMES_AT_ONCE]


def _hidden(name: str) -> bool:
    """Names that Spark's own file sources pass over."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def list_prefixes(spark: SparkSession, folder: str, glob: str = "*.jpg") -> DataFrame:
    """The rows of ``list_objects``, each folder in ``folder`` listed by a task of its own.

    The driver reads only the names that lie in ``folder`` itself, so millions of files in
    many folders neither pass through it nor wait for each other.  A folder that is
    missing is an error, an empty one gives no rows.  ``glob`` knows ``*``,
    ``?`` and ``[...]``; hidden files and folders are left out, and so
    are files without a byte, as Spark's own file sources do.
    """
    ensure_on_workers(spark)
    spark.dataSource.register(ObjectListing)
    return spark.read.format(ObjectListing.name()).option("path", folder).option("glob", glob).load()

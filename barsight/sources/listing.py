"""Object listing as a DataFrame of paths.

Spark's file sources plan no split for a zero-length file, so a listing of them
would lose empty objects.  ``objects`` is a Python data source instead: the
driver reads the names of one folder level, deals the subfolders to a bounded
number of tasks, and each task lists its own subtrees, whatever they hold.
No file body is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TASKS = 64  # tasks of a listing, at most
FORMAT = "objects"


def _source():
    """The data source; made in a function so that it travels to the workers by value."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Prefixes(InputPartition):
        def __init__(self, folders, files):
            self.folders, self.files = folders, files

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.root, self.glob = options["path"], options.get("glob", "*")
            self.tasks = max(1, int(options.get("tasks", "64")))

        def _open(self):
            from pyarrow import fs
            system, path = fs.FileSystem.from_uri(self.root) if "://" in self.root else (fs.LocalFileSystem(), self.root)
            scheme = self.root.split("://")[0] + "://" if "://" in self.root else "file:"
            return system, path.rstrip("/"), scheme

        def partitions(self):
            from pyarrow import fs
            system, path, _ = self._open()
            top = system.get_file_info(fs.FileSelector(path))
            folders = sorted(f.path for f in top if f.type == fs.FileType.Directory)
            parts = [Prefixes(folders[i::self.tasks], False) for i in range(min(self.tasks, len(folders)))]
            return [*parts, Prefixes([path], True)]

        def read(self, partition):
            from fnmatch import fnmatchcase

            from pyarrow import fs
            system, _, scheme = self._open()
            for folder in partition.folders:
                for f in system.get_file_info(fs.FileSelector(folder, recursive=not partition.files)):
                    if f.type == fs.FileType.File and fnmatchcase(f.base_name, self.glob):
                        yield scheme + f.path, f.size

    class Objects(DataSource):
        @classmethod
        def name(cls):
            return "objects"

        def schema(self):
            return "path string, size bigint"

        def reader(self, schema):
            return Reader(self.options)

    return Objects


def list_objects(spark: SparkSession, root: str, glob: str = "*.txt", tasks: int = TASKS) -> DataFrame:
    """``path`` and ``size`` of every object below ``root`` whose name matches
    ``glob``, empty ones included.  A root that does not exist raises."""
    spark.dataSource.register(_source())
    return spark.read.format(FORMAT).option("glob", glob).option("tasks", tasks).load(root)

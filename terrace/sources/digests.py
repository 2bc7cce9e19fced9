"""Python Data Source ``file_digests``: md5 and length of files of any size.

Spark's ``binaryFile`` hands over a file as one value, under 2 GB.  Here a task
reads its files by ranges of ``block`` bytes and hashes them in order, so its
memory is one block.  A digest is sequential within a file: the largest file
is the longest task; small files share tasks of about ``task_bytes``.
"""

from __future__ import annotations

SCHEMA = "file string, path string, length bigint, md5 string"


def register(spark) -> None:
    """Makes ``spark.read.format("file_digests")`` known to the session.  Options:
    ``path`` (file or folder; hidden files are left out), ``block``,
    ``task_bytes``.  The classes live here so that workers get them by value."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    def opened(path):
        import os

        from pyarrow import fs
        return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))

    class Files(InputPartition):
        def __init__(self, files):
            super().__init__(None)
            self.files = files

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.path = options["path"]
            self.block = int(options.get("block", 8 << 20))
            self.task_bytes = int(options.get("task_bytes", 128 << 20))

        def partitions(self):
            from pyarrow import fs
            system, root = opened(self.path)
            info = system.get_file_info(root)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(self.path)
            found = [info] if info.type == fs.FileType.File else [
                f for f in system.get_file_info(fs.FileSelector(root, recursive=True))
                if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))]
            parts, files, held = [], [], 0
            for f in sorted(found, key=lambda f: (-f.size, f.path)):
                if files and held + f.size > self.task_bytes:
                    parts.append(Files(files))
                    files, held = [], 0
                files.append(f.path)
                held += f.size
            return [*parts, Files(files)]

        def read(self, partition):
            import hashlib
            system, _ = opened(self.path)
            for path in partition.files:
                digest, length = hashlib.md5(), 0
                with system.open_input_stream(path) as stream:
                    while chunk := stream.read(self.block):
                        digest.update(chunk)
                        length += len(chunk)
                yield path.rsplit("/", 1)[-1], path, length, digest.hexdigest()

    class FileDigests(DataSource):
        @classmethod
        def name(cls):
            return "file_digests"

        def schema(self):
            return SCHEMA

        def reader(self, schema):
            return Reader(self.options)

    spark.dataSource.register(FileDigests)

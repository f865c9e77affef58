"""File moves through Hadoop's FileSystem, so they work on any store Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Storage:
    """The file system that holds one path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path_class = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path_class(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path_class(path))

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path_class(path))

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path_class(source), self._path_class(target)):
            raise OSError(f"could not move {source} to {target}")

    def remove(self, path: str) -> None:
        self._fs.delete(self._path_class(path), True)

    def write_text(self, path: str, text: str) -> None:
        """A whole file, there or not there: written under another name, then renamed."""
        folder, name = path.rsplit("/", 1)
        part = f"{folder}/.{name}"
        out = self._fs.create(self._path_class(part), True)
        try:
            out.write(text.encode())
        finally:
            out.close()
        self.move(part, path)

    def read_text(self, path: str, jvm) -> str:
        stream = self._fs.open(self._path_class(path))
        try:
            return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        """Everything that lies directly in a folder, hidden or not."""
        if not self.exists(folder):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path_class(folder))]

    def size(self, path: str) -> int:
        return self._fs.getFileStatus(self._path_class(path)).getLen()

    def remove_if_empty(self, folder: str) -> None:
        if self.exists(folder) and not self.names(folder):
            self._fs.delete(self._path_class(folder), False)

    def full_path(self, path: str) -> str:
        return self._fs.makeQualified(self._path_class(path)).toString()

    def data_files(self, folder: str) -> list[str]:
        """Data files lying directly in a folder, named as Spark's reader sees them."""
        if not self.exists(folder):
            return []
        names = [s.getPath() for s in self._fs.listStatus(self._path_class(folder)) if s.isFile()]
        return [p.toString() for p in names if not p.getName().startswith(("_", "."))]

"""Small files and folders of the store that Spark reads, through its own file-system
layer (any scheme Spark has; Python's ``open`` reaches local folders alone)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if it is not there."""
        p = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def files(self, folder: str) -> list[tuple[str, int]]:
        """(whole address, bytes) of all data files under a folder; names that start
        with an underscore or a dot are not data. The address is that in the
        ``_metadata.file_path`` of rows read from the file, but for the number of
        slashes behind the scheme of local files."""
        out, todo = [], [""]
        while todo:
            at = todo.pop()
            for s in self._fs.listStatus(self._path("/".join(x for x in (folder, at) if x))):
                name = s.getPath().getName()
                below = f"{at}/{name}" if at else name
                if name[0] in "_.":
                    continue
                if s.isDirectory():
                    todo.append(below)
                else:
                    out.append((s.getPath().toUri().toString(), s.getLen()))
        return sorted(out)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str, tmp: str) -> bool:
        """Write a file that must not exist yet, as a whole: to ``tmp`` first, then
        renamed. False if another writer was first."""
        stream = self._fs.create(self._path(tmp), True)
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()
        target = self._path(name)
        self._fs.mkdirs(target.getParent())
        if self._fs.exists(target) or not self._fs.rename(self._path(tmp), target):
            self._fs.delete(self._path(tmp), False)
            return False
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

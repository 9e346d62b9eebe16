"""Tables that are replaced as a whole, without a moment in which a reader finds none, or a part."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class VersionedTable:
    """A table in a folder that the cluster shares. Each version is a folder of its own, which nothing changes once it is written; a small file with the
    version's number names it afterwards. Readers take the largest number that has a name in it, so they see the old table whole until the
    new one is, and a reader that began goes on with what it began with. A number is taken by creating its file, which only one writer can;
    a writer that dies before leaves a folder that nothing names. No file is renamed, so object stores serve as well."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        """keep: versions that stay when a new one comes, with it; 2 at least, for readers of the one before."""
        if keep < 2:
            raise ValueError("keep must be 2 at least")
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _named(self, number: int) -> str:
        """The folder that a number names; "" where its writer hasn't got that far."""
        stream = self._files().open(self._path(f"_versions/{number:012d}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _numbers(self) -> list[int]:
        at = self._path("_versions")
        if not self._files().exists(at):
            return []
        return sorted(int(f.getPath().getName()) for f in self._files().listStatus(at) if f.getPath().getName().isdigit())

    def version(self) -> int | None:
        """The number of the current version; None before the first."""
        return next((n for n in reversed(self._numbers()) if self._named(n)), None)

    def read(self, version: int | None = None) -> DataFrame:
        """The current version, or the one with a number that is still kept."""
        number = version or self.version()
        if number is None:
            raise FileNotFoundError(f"{self.path} has no version yet")
        return self.spark.read.parquet(f"{self.path}/{self._named(number)}")

    def replace(self, df: DataFrame) -> int:
        """Write df as the next version and return its number. df may read the current one."""
        folder = f"data-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        number = max(self._numbers(), default=0) + 1
        while True:
            try:
                stream = self._files().create(self._path(f"_versions/{number:012d}"), False)  # fails where another writer has the number
            except Exception:
                if not self._files().exists(self._path(f"_versions/{number:012d}")):
                    raise
                number += 1
                continue
            try:
                stream.write(bytearray(folder.encode()))
            finally:
                stream.close()
            break
        for old in self._numbers()[: -self.keep]:
            name = self._named(old)
            self._files().delete(self._path(f"_versions/{old:012d}"), False)
            if name:
                self._files().delete(self._path(name), True)
        return number

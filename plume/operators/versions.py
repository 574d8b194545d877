"""Versions of a set of tables under one folder, made visible by a commit file.

``versions/<number>-<attempt>/`` holds a version's tables and ``commits/<number>`` names the attempt that
counts. The commit file appears by rename after all else is written, so an attempt that dies anywhere
leaves the last version in place and a retry starts from the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plume.session import remove


class Committed:
    KEEP = 2                        # committed versions that stay

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _listed(self, folder: str) -> list[str]:
        fs, p = self._fs(f"{self.base}/{folder}")
        return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []

    def _commits(self) -> list[int]:
        return sorted(int(n) for n in self._listed("commits") if n.isdigit())

    def committed(self) -> tuple[int, str] | None:
        """Newest committed number and its version folder."""
        numbers = self._commits()
        return (numbers[-1], self._version(numbers[-1])) if numbers else None

    def _version(self, number: int) -> str:
        attempt = self.spark.read.text(f"{self.base}/commits/{number}").first()[0]
        return f"{self.base}/versions/{number}-{attempt}"

    def read(self, name: str) -> DataFrame:
        """Table ``name`` of the newest committed version."""
        state = self.committed()
        if state is None:
            raise LookupError("no batch has been committed yet")
        return self.spark.read.parquet(f"{state[1]}/{name}")

    def _commit(self, number: int, attempt: str) -> None:
        fs, tmp = self._fs(f"{self.base}/commits/_{number}-{attempt}")
        out = fs.create(tmp, True)
        out.write(bytearray(attempt.encode()))
        out.close()
        _, final = self._fs(f"{self.base}/commits/{number}")
        if not fs.rename(tmp, final):
            raise RuntimeError(f"batch {number} could not be committed")

    def _prune(self) -> None:
        """Remove versions and commit files that no reader can take any more, and what only an attempt reads."""
        numbers = self._commits()
        keep = set(numbers[-self.KEEP:])
        for n in self._listed("versions"):
            if int(n.split("-")[0]) not in keep:
                remove(self.spark, f"{self.base}/versions/{n}")
        for n in numbers:
            if n not in keep:
                remove(self.spark, f"{self.base}/commits/{n}")
        remove(self.spark, f"{self.base}/work")

"""A3: the raw table across syncs: full refreshes and partial deliveries, by generation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.operators.versions import Committed
from plume.schemas import RAW_SCHEMA
from plume.session import remove

_ID, _AT, _GENERATION = "_airbyte_raw_id", "_airbyte_extracted_at", "_airbyte_generation_id"


class RawTable(Committed):
    """Raw rows (``RAW_SCHEMA``) delivered in loads; ``rows`` is the table as of the last committed load.

    A *partial* load adds to what is there; a *full* one replaces it, so ids that it lacks go. Per raw
    id the newest row wins: largest generation, then extraction time, then load, then (equal rows of
    one load aside) a hash of the row. Rows of a generation older than the last full load's are stale and
    never come back, whenever they arrive. So loading a delivery again changes nothing. One writer at a time.

    A load writes its own rows and a list of the loads that count, never the history; the newest row is
    found when the table is read, in one aggregate that combines map-side. ``compact`` writes that
    result as the one load. Loads become visible by a commit file, as in ``operators.versions``.
    """

    def __init__(self, spark: SparkSession, base: str):
        super().__init__(spark, base)

    def load(self, delivery: DataFrame, full: bool = False) -> int:
        """Commit a delivery; returns its load number. A NULL raw id, or a full load of a generation before the
        last full one, raises ValueError and commits nothing. An empty full load empties the table."""
        state, floor = self._state()
        number, attempt, path = self._write(delivery, state)
        written = self._load(path)
        oldest = written.agg(F.min(_GENERATION)).first()[0]
        stale = full and floor is not None and oldest is not None and oldest < floor
        if stale or not written.where(F.col(_ID).isNull()).isEmpty():
            remove(self.spark, path)
            raise ValueError(f"delivery: generation {oldest} is before {floor}" if stale else "delivery: a raw id is NULL")
        if full and oldest is not None:
            floor = oldest
        return self._publish(number, attempt, floor, None if full else state)

    def compact(self) -> int:
        """Write the table as one load. Its contents, and which rows are stale, stay as they are."""
        state, floor = self._state()
        number, attempt, _ = self._write(self.rows(), state)
        return self._publish(number, attempt, floor, None)

    def _state(self):
        """Newest commit, and the generation of the last full load."""
        state = self.committed()
        return state, self.spark.read.parquet(f"{state[1]}/loads").agg(F.max("floor")).first()[0] if state else None

    def _write(self, rows: DataFrame, state) -> tuple[int, str, str]:
        number, attempt = (state[0] + 1 if state else 0), uuid.uuid4().hex
        path = f"{self.base}/loads/{number}-{attempt}"
        rows.select(*[F.col(f.name).cast(f.dataType) for f in RAW_SCHEMA.fields]).write.parquet(path)
        return number, attempt, path

    def _publish(self, number: int, attempt: str, floor, earlier) -> int:
        loads = self.spark.createDataFrame([(number, attempt, floor)], "load long, attempt string, floor long")
        if earlier:
            loads = loads.unionByName(self.spark.read.parquet(f"{earlier[1]}/loads"))
        loads.coalesce(1).write.parquet(f"{self.base}/versions/{number}-{attempt}/loads")
        self._commit(number, attempt)
        self._prune()
        return number

    def _load(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(RAW_SCHEMA).parquet(*paths)

    def _names(self, version: str) -> list[tuple]:
        """The loads of a version: one small row per load since the last full or compacted one."""
        return [tuple(r) for r in self.spark.read.parquet(f"{version}/loads").select("load", "attempt", "floor").collect()]

    def rows(self) -> DataFrame:
        state = self.committed()
        if state is None:
            raise LookupError("nothing has been loaded yet")
        loads = self._names(state[1])
        floor = max((f for *_, f in loads if f is not None), default=None)
        names = [f.name for f in RAW_SCHEMA.fields]
        all_rows = (self._load(*[f"{self.base}/loads/{n}-{a}" for n, a, _ in loads])
                    .select("*", F.regexp_extract(F.col("_metadata.file_path"), r"/loads/(\d+)-", 1).cast("bigint").alias("_load")))
        if floor is not None:
            all_rows = all_rows.where(F.col(_GENERATION) >= floor)
        newest = all_rows.groupBy(_ID).agg(F.max_by(
            F.struct(*names), F.struct(_GENERATION, _AT, "_load", F.xxhash64(*names))).alias("_row"))
        return newest.select("_row.*")

    def _prune(self) -> None:
        super()._prune()
        used = {f"{n}-{a}" for number in self._commits() for n, a, _ in self._names(self._version(number))}
        for name in self._listed("loads"):
            if name not in used:
                remove(self.spark, f"{self.base}/loads/{name}")

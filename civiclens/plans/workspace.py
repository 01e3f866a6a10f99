"""Stage tables of one pipeline run, written once to the shared folder and read back.

The pipeline hands tables from step to step (raw → deduplicated → dimensions → fact →
reports). Each step's result is a Parquet table, which cuts lineage: a lost executor costs a
re-read, not a rebuild, and every report scans only the columns it needs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.operators.dedup import dedup_requests
from civiclens.operators.dimensions import (
    dim_department,
    dim_geography,
    dim_infrastructure,
    dim_location,
    dim_service,
    dim_time,
)
from civiclens.operators.facts import fact_requests, fact_star
from civiclens.session import shared_folder
from civiclens.sources.folders import CODEC, drop_folder, release_after, slices_of, write_slices
from civiclens.sources.tables import raw_requests

DIMENSIONS = (
    "dim_service",
    "dim_department",
    "dim_location",
    "dim_time",
    "dim_geography",
    "dim_infrastructure",
)
TABLES = ("raw_requests", "requests", *DIMENSIONS, "fact_requests", "fact_star")
"""All stage tables, each after the ones it is built from."""


class Workspace:
    """Builds each table on first use, from the tables it depends on.

    ``raw`` is the raw request table, used where it lies, or a function that derives it; a
    derived one is written first. Tables go below ``root``, by default a new folder of the
    run inside the shared one. With ``reuse``, tables that an earlier run finished below the
    same root are read instead of built again, if the raw table has the same files as then.
    The models train on days up to ``train_until`` and are tested on the later ones.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: DataFrame | Callable[[], DataFrame],
        root: str | None = None,
        reuse: bool = False,
        train_until: str = "1999-12-31",
    ):
        self.spark = spark
        self.reuse = reuse
        self.lasting = root is not None
        self.root = root or f"{shared_folder(spark)}/civiclens-{uuid.uuid4().hex[:12]}"
        self._derive_raw = raw if callable(raw) else None
        self._tables: dict[str, DataFrame] = {} if callable(raw) else {"raw_requests": raw}
        self.train_until = train_until
        self._source: str | None = None
        self._folders: dict[str, str] = {}
        self._scratch_labels: list[str] = []

    def stage(self, frame: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write a frame below the root and return it as read from there."""
        path = f"{self.root}/{label}"
        frame.write.mode("overwrite").option("compression", CODEC).partitionBy(*partition_by).parquet(path)
        release_after(frame)
        return self.spark.read.schema(frame.schema).parquet(path)

    def folder(self, label: str) -> str:
        """A new folder for files that a query writes by itself."""
        return f"{self.root}/{label}-{uuid.uuid4().hex[:8]}"

    def once(self, label: str, write: Callable[[str], None]) -> str:
        """The folder that ``write`` filled, on the first call for this label."""
        if label not in self._folders:
            folder = self.folder(label)
            write(folder)
            self._folders[label] = folder
        return self._folders[label]

    def _drop(self, label: str) -> None:
        """Delete a folder below the root that nothing reads any more."""
        drop_folder(self.spark, f"{self.root}/{label}")

    def source(self) -> str:
        """What the raw table's files are: names, lengths and times; of a table without files, something new."""
        if self._source is None:
            files = self._tables["raw_requests"].inputFiles() if "raw_requests" in self._tables else []
            if files:
                listed = self.spark.read.format("binaryFile").load(files).drop("content")
                key = F.xxhash64("path", "length", "modificationTime")
                total = listed.agg(F.count("*"), F.bit_xor(key), F.sum(F.shiftright(key, 16))).first()
                self._source = "/".join(map(str, total))
            else:
                self._source = uuid.uuid4().hex
        return self._source

    def _mark(self, name: str, finished: bool) -> None:
        """Note below a lasting root from which raw files the finished table was built."""
        if self.lasting:
            rows = [(name, self.source())] if finished else []
            marker = self.spark.createDataFrame(rows, "table_name string, source string")
            marker.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/finished/{name}")

    def _finished(self, name: str) -> bool:
        try:
            marker = self.spark.read.schema("table_name string, source string")
            return self.source() in [r["source"] for r in marker.parquet(f"{self.root}/finished/{name}").collect()]
        except AnalysisException:
            return False

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            if self.reuse and self._finished(name):
                self._tables[name] = self.spark.read.parquet(f"{self.root}/{name}")
            else:
                self._mark(name, finished=False)
                self._tables[name] = self._build(name)
                for label in self._scratch_labels:
                    self._drop(label)
                self._scratch_labels.clear()
                self._mark(name, finished=True)
        return self._tables[name]

    @property
    def raw(self) -> DataFrame:
        return self.table("raw_requests")

    @property
    def requests(self) -> DataFrame:
        """Raw requests, one row per request number."""
        return self.table("requests")

    def _scratch(self, name: str) -> Callable[[DataFrame, str], DataFrame]:
        """Stages a table that is deleted once the table it is for has been written."""

        def stage(frame: DataFrame, label: str) -> DataFrame:
            self._scratch_labels.append(f"numbering/{name}-{label}")
            return self.stage(frame, self._scratch_labels[-1])

        return stage

    def _build(self, name: str) -> DataFrame:
        if name == "raw_requests":
            return self.stage(self._derive_raw(), name)
        if name == "requests":
            slices = [dedup_requests(part) for part in slices_of(self.raw)]
            write_slices(slices, f"{self.root}/{name}")
            return self.spark.read.schema(slices[0].schema).parquet(f"{self.root}/{name}")
        if name == "dim_service":
            return self.stage(dim_service(self.requests, self._scratch(name)), name)
        if name == "dim_department":
            return self.stage(dim_department(self.requests, self._scratch(name)), name)
        if name == "dim_time":
            return self.stage(dim_time(self.requests), name)
        if name == "dim_geography":
            return self.stage(dim_geography(self.requests, self._scratch(name)), name)
        if name == "dim_infrastructure":
            return self.stage(dim_infrastructure(self.requests, self._scratch(name)), name)
        if name == "dim_location":
            return self.stage(dim_location(self.requests, self._scratch(name)), name)
        if name == "fact_requests":
            fact = fact_requests(
                self.requests,
                self.table("dim_service"),
                self.table("dim_department"),
                self.table("dim_location"),
                self._scratch(name),
            )
            return self.stage(fact, name, ("year", "month"))
        if name == "fact_star":
            fact = fact_star(self.requests, *[self.table(d) for d in DIMENSIONS])
            return self.stage(fact, name)
        raise KeyError(name)


_open: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str, fresh: bool = False) -> Workspace:
    """The workspace of this application over the tables in ``folder``.

    The folder's tables are taken as unchanged while the application runs; pass ``fresh``
    after changing them.
    """
    key = (spark.sparkContext.applicationId, folder)
    if fresh or key not in _open:
        _open[key] = Workspace(spark, lambda: raw_requests(spark, folder))
    return _open[key]

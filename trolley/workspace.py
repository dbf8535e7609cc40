"""Shared scratch space for tables Spark derives from the input.

The folder comes from ``spark.checkpoint.dir``, which every executor can reach. Only a local-mode session without
that setting gets a folder of its own; a cluster without it is an error, never a machine-local directory.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable
from typing import Any, TypeVar

from pyspark.sql import DataFrame, SparkSession

from trolley.sizing import shuffles_freed

T = TypeVar("T")


class Workspace:
    def __init__(self, root: str):
        self.root = root
        self.tables: list[str] = []  # catalog tables over files below root
        self._made: dict[tuple[str, str], Any] = {}
        self._lock = threading.RLock()

    def fresh(self, name: str) -> str:
        """A path nothing has written to yet."""
        return f"{self.root}/{name}-{uuid.uuid4().hex}"

    def once(self, name: str, source: str, make: Callable[[str], T]) -> T:
        """What ``make`` returned for one input folder: called on first use, with a path of its own to write to, and
        remembered for the rest of the session."""
        with self._lock:
            if (name, source) not in self._made:
                self._made[(name, source)] = make(self.fresh(name))
            return self._made[(name, source)]

    def forget(self, source: str) -> None:
        """Drop what is remembered about one input folder, e.g. after its tables changed."""
        with self._lock:
            self._made = {k: v for k, v in self._made.items() if k[1] != source}

    def materialise(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` to the shared folder and read it back: lineage ends at files that outlive any executor."""
        path = self.fresh(name)
        with shuffles_freed(df.sparkSession):
            df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)


    def close(self, spark: SparkSession) -> None:
        """Drop the catalog tables and delete every file of this workspace; results that still read them become
        useless. For the owner of a session on a shared metastore, at its end."""
        with self._lock:
            for table in self.tables:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.tables.clear()
            self._made.clear()
            path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_workspaces: dict[str, Workspace] = {}
_lock = threading.Lock()


def workspace(spark: SparkSession) -> Workspace:
    app = spark.sparkContext.applicationId
    with _lock:
        if app not in _workspaces:
            _workspaces[app] = Workspace(f"{_shared_folder(spark)}/trolley-{app}")
        return _workspaces[app]


def _shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="trolley-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder

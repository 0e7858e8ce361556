"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Settings every job of this library expects.  AQE does the run-time work
#: (coalescing, skew splitting, switching to broadcast on measured sizes).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder all executors can reach.

    Taken from the session.  Only a local session that names none gets a
    temporary folder; on a cluster a missing setting is an error, because
    a machine-local path would be lost with its executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            current = tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(current)
        current = context.getCheckpointDir()
    return current


class Scratch:
    """Folders of the shared folder with one life time.

    Paths handed out inside ``collect`` belong to it and go with ``drop``.
    What still reads from them must be finished by then; ``keep`` leaves the
    folders that a frame reads to the scope around.
    """

    def __init__(self) -> None:
        self.paths: list[str] = []

    @contextmanager
    def collect(self) -> Iterator[Scratch]:
        outer = _SCOPE.set(self)
        try:
            yield self
        finally:
            _SCOPE.reset(outer)

    def keep(self, df: DataFrame) -> DataFrame:
        files, outer = [_plain(f) for f in df.inputFiles()], _SCOPE.get()
        used = [p for p in self.paths if any(f.startswith(_plain(p) + "/") for f in files)]
        self.paths = [p for p in self.paths if p not in used]
        if outer is not None and outer is not self:
            outer.paths += used
        return df

    def drop(self, spark: SparkSession) -> None:
        gone, self.paths = self.paths, []
        for path in gone:
            delete_path(spark, path)


_SCOPE: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


def _plain(path: str) -> str:
    """A path without its scheme and doubled slashes, to compare by."""
    return "/" + path.split(":", 1)[-1].lstrip("/")


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through its file system; false if there was none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def list_path(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if there is no such folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """A scope whose folders are deleted at its end, also after an error."""
    scope = Scratch()
    try:
        with scope.collect():
            yield scope
    finally:
        scope.drop(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.paths.append(path)
    return path


def written(
    df: DataFrame, label: str, partition_by: str | None = None, session: SparkSession | None = None
) -> DataFrame:
    """Cut the lineage by writing ``df`` to the shared folder and reading it back, if told in another session."""
    path = scratch_path(df.sparkSession, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return (session or df.sparkSession).read.schema(df.schema).parquet(path)


def parquet_schema(spark: SparkSession, path: str) -> StructType | None:
    """Schema of the Parquet files below ``path``, ``None`` if there are none."""
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise

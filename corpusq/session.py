"""Session set-up, and the shared folder that holds intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Set only where the session leaves them unset.
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # Rows are whole documents: bound a batch sent to a Python worker by bytes as well as rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
}
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime defaults this library is tuned for, keeping anything already chosen."""
    chosen = spark.conf.getAll
    for key, value in RUNTIME_DEFAULTS.items():
        if key not in chosen:
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, which need it for the Arrow functions."""
    _ship_once(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _ship_once(application_id: str) -> None:
    package = Path(__file__).resolve().parent
    # Spark's file server passes the archive on, so a local folder of the driver will do.
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='corpusq-')}/{package.name}", "zip", package.parent, package.name
    )
    SparkSession.active().sparkContext.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder (remembered in
    the same setting); a cluster session is refused, since no machine-local
    folder would outlive an executor.
    """
    local = spark.sparkContext.master.startswith("local")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not local and _is_temporary(configured):
            raise ValueError(f"spark.checkpoint.dir {configured} is a temporary folder of one machine")
        return configured.rstrip("/")
    already = spark.sparkContext.getCheckpointDir()
    if already:
        return already.rstrip("/")
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="corpusq-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def _is_temporary(path: str) -> bool:
    scheme, colon, rest = path.partition(":")
    local_path = rest if colon and scheme == "file" else "" if colon else path
    folder = "/" + local_path.lstrip("/") if local_path else ""
    return any(folder.startswith(f"{t}/") or folder == t for t in {"/tmp", "/var/tmp", tempfile.gettempdir()})


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/corpusq/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back.

    Cuts lineage durably (a lost executor re-reads files instead of re-running
    the plan), gives later joins true sizes, and makes counts a footer read.
    """
    return _saved(df, fresh_path(df.sparkSession, name))


def _saved(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back. The shuffle files of this write go with its end:
    nothing reads them again, and they would stay until the driver happens to collect its garbage."""
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one loop, removed together once what follows no longer reads them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.count = spark, fresh_path(spark, name), 0

    def written(self, df: DataFrame) -> DataFrame:
        self.count += 1
        return _saved(df, f"{self.path}/{self.count}")

    def keep_last(self) -> None:
        """Remove all tables but the one written last."""
        for k in range(1, self.count):
            self._delete(f"{self.path}/{k}")

    def remove(self) -> None:
        self._delete(self.path)

    def _delete(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

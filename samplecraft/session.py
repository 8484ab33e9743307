"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTINGS = {
    # Two keys may become equal after a rename or a merge: the later one wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Text without a zone is UTC, and epoch text is rendered in UTC.
    "spark.sql.session.timeZone": "UTC",
    # A key that a JSON object repeats has its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # State of streams on disk below the executors, not in their heaps; some operators need it.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Rows sent to a Python worker at once; texts may be long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp()) / f"{here.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(here.rglob("*.py")):
            out.write(source, source.relative_to(here.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which the driver and all executors share.

    A local session may do without the setting; a cluster may not, as executors would not see each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="samplecraft-")
    return f"{root.rstrip('/')}/samplecraft-{uuid.uuid4().hex}"


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options that the operators need and ship the package; safe to call repeatedly."""
    ship(spark)
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


#: Rows that one task takes of a table whose rows cost much time each.
TASK_ROWS = 25_000


def spread(df: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """The rows of a table as it is stored, dealt into tasks of about ``rows``.

    A file is read by no more tasks than it has row groups, and a group may hold a million rows. Where each row costs
    tenths of a millisecond, they are dealt out first, while they are narrow: unread columns are pruned below. The
    count comes from the files' footers.
    """
    tasks = -(-df.count() // rows)
    return df.repartition(tasks) if tasks > 1 else df


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, read back: the lineage of an iteration is cut, and a lost executor costs
    nothing that was written. The folder's owner clears it after the run."""
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings that every query of this package relies on for right results.
REQUIRED_CONF = {"spark.sql.session.timeZone": "UTC"}

# Settings that only change speed; a cluster may override all of them.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    app: str = "tallyloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session; ``conf`` wins over the defaults above."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    settings = {**TUNING_CONF, **(conf or {}), **REQUIRED_CONF}
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def require_conf(spark: SparkSession) -> SparkSession:
    """Prepare a session that somebody else built: result-relevant settings, package."""
    ship_package(spark)
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, as ``--py-files`` would, once per application.

    Tasks that run Python functions import it there, whatever folder the driver
    was started in.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).parent
        archive = f"{tempfile.mkdtemp(prefix='tallyloom-')}/{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process; ``local-cluster`` is not."""
    return spark.sparkContext.master.split("[")[0] == "local"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Tables written between two stages and stream checkpoints go here, so that
    they outlive any executor. Only a local session without that setting gets a
    folder of this machine; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise ValueError(
                "spark.checkpoint.dir is not set: name a folder that all executors share"
            )
        base = tempfile.mkdtemp(prefix="tallyloom-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


# Folders handed out, by application.
_SCRATCH: dict[str, list[str]] = {}


def clear_scratch(spark: SparkSession) -> None:
    """Delete all folders that this application got; results that read them end with them."""
    application = spark.sparkContext.applicationId
    for key in [key for key in _TABLES if key[0] == application]:
        del _TABLES[key]
    for folder in _SCRATCH.pop(application, []):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows as a table in the shared folder and read it back.

    This cuts the lineage: later steps survive lost executors without redoing the
    work above, and see the same rows each time.
    """
    path = scratch_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


# Folders of stored tables by application, purpose and state of the input.
_TABLES: dict[tuple, str] = {}


def stored_table(spark: SparkSession, purpose: str, source: str, write: Callable[[str], None]) -> str:
    """Folder of a table that ``write`` made of the input at ``source``, once per state of it.

    The folder is remembered when it is whole, and forgotten when scratch is cleared or the
    input changes its size, its number of files or its time.
    """
    key = (spark.sparkContext.applicationId, purpose, source, *_state_of(spark, source))
    if key not in _TABLES:
        folder = scratch_dir(spark, purpose)
        write(folder)
        _TABLES[key] = folder
    return _TABLES[key]


def _state_of(spark: SparkSession, source: str) -> tuple[int, int, int]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = files.getContentSummary(path)
    return held.getLength(), held.getFileCount(), files.getFileStatus(path).getModificationTime()


def state_partitions(spark: SparkSession) -> int:
    """Partition count for stream state, which AQE cannot coalesce later."""
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if is_local(spark):
        return min(configured, spark.sparkContext.defaultParallelism)
    return configured

"""Session settings the results depend on, and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Results depend on time zone, ANSI casts and duplicate keys; the rest lets Spark re-plan joins.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A JSON object that names a key twice means the last one, as for most readers.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


_local_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def pin(spark: SparkSession) -> SparkSession:
    """Set the run-time options on a session somebody else has built."""
    for key, value in REQUIRED_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and the bench. On a cluster, build your own and call `pin`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quarrymill")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**REQUIRED_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, for checkpoints and intermediate tables.

    The cluster names it in `spark.checkpoint.dir`. Where it names none, a local master gets a
    temporary folder and a cluster falls back to its warehouse, which is shared as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_quarrymill"
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="quarrymill-")
    return _local_dirs[application]


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application, for what runs in Python there."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="quarrymill-")) / package.name
        context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
    return spark


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder of this library, wherever it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

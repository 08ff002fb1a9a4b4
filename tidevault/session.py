"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tidevault", cores: str = "8", partitions: str = "8") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        # Listing folders of a local disk is faster on the driver than as a job.
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "5000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Chunk and bucket edges are UTC instants, so the session zone has to be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone!r}")


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Few rows that are about to become many, over all the cores there are.

    The number is given outright: AQE would join small partitions into one again.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * cores)
    return df.repartition(n, *columns)


_writing: dict[tuple[str, str], tuple[int, str | None]] = {}
_lock = threading.Lock()


@contextmanager
def _while_written(df: DataFrame, key: str, value: str) -> Iterator[None]:
    """A setting that holds while ``df`` is written; it is the session's, so writers in several threads share it."""
    session = df.sparkSession
    name = session._jsparkSession.sessionUUID(), key
    with _lock:
        writers, before = _writing.get(name, (0, session.conf.get(key, None)))
        _writing[name] = (writers + 1, before)
        session.conf.set(key, value)
    try:
        yield
    finally:
        with _lock:
            writers, before = _writing.pop(name)
            if writers > 1:
                _writing[name] = (writers - 1, before)
            elif before is None:
                session.conf.unset(key)
            else:
                session.conf.set(key, before)


def micros_timestamps(df: DataFrame) -> AbstractContextManager[None]:
    """Write zoned timestamps as 64-bit microseconds while ``df`` is written.

    Spark's default for them is a 96-bit type without statistics: a filter on ``ts``
    could skip no row group, and ordered instants could not be stored as differences.
    """
    return _while_written(df, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")


def shuffles_removed(df: DataFrame) -> AbstractContextManager[None]:
    """Let Spark remove the shuffle files of ``df`` as soon as it is written.

    They stay otherwise until the driver happens to collect its garbage.
    """
    return _while_written(df, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@lru_cache(maxsize=1)
def _local_base() -> str:
    base = tempfile.mkdtemp(prefix="tidevault-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share.

    That folder is the session's ``spark.checkpoint.dir``. A temporary folder of
    this machine stands in only where the setting is missing and the master is
    local, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

"""Session helpers: scratch space, scoped settings and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when a bound on its size, known before the join is
# planned, is below this.  Anything larger takes the shuffle route.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64


def build_session(app: str = "sluiceway", cores: int | str | None = None) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    cores = cores or os.environ.get("BENCH_CPUS") or "8"
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SLUICEWAY_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Plans here are built from many small expressions; do not record a stack trace for each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _shared_base(spark: SparkSession) -> str:
    """The shared folder named by the session; a private one only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="sluiceway-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{_shared_base(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def qualified(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths with the file system that the session takes where they name none."""
    home = None
    found = []
    for path in paths:
        if path.startswith("/"):
            if home is None:
                root = spark._jvm.org.apache.hadoop.fs.Path("/")
                home = str(root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(root))
            path = home.rstrip("/") + path
        found.append(path)
    return found


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none if there is no such folder.  Hidden names are left out."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(target):
        return []
    names = (status.getPath().getName() for status in files.listStatus(target))
    return sorted(n for n in names if n[0] not in "._" or "=" in n)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(_shared_base(spark))


@contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply settings for the duration of a block and put the old ones back."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def fits_broadcast(rows: int, row_bytes: int) -> bool:
    """True when `rows` rows of at most `row_bytes` payload stay under the limit."""
    return rows * (row_bytes + ROW_OVERHEAD_BYTES) <= BROADCAST_LIMIT_BYTES


def broadcast_bounded(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Mark `df` for broadcast if its bound fits; otherwise leave the choice to Spark."""
    return F.broadcast(df) if fits_broadcast(rows, row_bytes) else df

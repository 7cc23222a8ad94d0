"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the plans are written for.  They only state intent; sizes are left to
# the cluster (shuffle partitions are coalesced or split by adaptive execution).
SKEW = (
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.skewJoin.enabled",
    # split a hot join key even when the next join on that key then needs an exchange of its own
    "spark.sql.adaptive.forceOptimizeSkewedJoin",
)
# Shuffled ids pack tightly: the 64 MB of a default task unpack to ten million rows and more, several times over
# where a task holds both sides of a join or union.
TASK_BYTES, TASK_MB = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 8
DEFAULTS = {
    **dict.fromkeys(SKEW, "true"),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "martloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the defaults above; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Turn on the skew settings the joins rely on in a session made elsewhere, and bound what one task reads of a shuffle."""
    for key in SKEW:
        spark.conf.set(key, "true")
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsMb(spark.conf.get(TASK_BYTES)) > TASK_MB:
        spark.conf.set(TASK_BYTES, f"{TASK_MB}m")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a missing setting is an error, since local disks are not shared.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/martloom/{purpose}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Drop what ``materialize`` wrote inside the block at its end.

    For blocks that finish their work, such as a load; frames made inside must
    not be read afterwards.
    """
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        yield
    finally:
        _staged.reset(token)
        for path in paths:
            delete(spark, path)


SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ending: dict[str, tuple[int, str | None]] = {}  # by session: blocks open now, and the setting before the first of them
_ending_lock = threading.Lock()


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Queries begun inside the block drop their shuffle files as soon as they end; left to itself Spark keeps them
    until the driver happens to collect garbage. For writes, which nothing reads a shuffle of again; blocks may overlap in threads.
    """
    session, conf = spark._jsparkSession.sessionUUID(), spark.conf
    with _ending_lock:
        blocks, before = _ending.get(session) or (0, conf.get(SHUFFLES_END, None))
        _ending[session] = (blocks + 1, before)
        conf.set(SHUFFLES_END, "true")
    try:
        yield
    finally:
        with _ending_lock:
            blocks, before = _ending.pop(session)
            if blocks > 1:
                _ending[session] = (blocks - 1, before)
            elif before is None:
                conf.unset(SHUFFLES_END)
            else:
                conf.set(SHUFFLES_END, before)


def materialize(df: DataFrame, purpose: str = "cut") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, survives lost executors, and, being parquet, keeps column
    pruning and size statistics for whatever reads it next. The shuffle files
    behind it are dropped at once: the table is there to be read again, not they.
    """
    spark = df.sparkSession
    path = work_path(spark, purpose)
    scope = _staged.get()
    if scope is not None:
        scope.append(path)
    with shuffles_end(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

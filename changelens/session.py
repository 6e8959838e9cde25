"""Spark session helpers.

The library never creates a cluster session by itself: callers pass their own
``SparkSession``.  ``local_session`` exists for tests, benches and the smoke
entry point.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE is what turns the per-page summary joins
# into broadcast joins once the real (materialised) size of the summary is
# known, and splits skewed partitions when the summary is too big to ship.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("changelens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CHANGELENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_conf(spark)
    return spark


#: Bytes of rows that go to a Python worker at once: what a task holds several times over.
ARROW_BATCH_BYTES = 8 << 20


def prepare_python(spark: SparkSession) -> None:
    """For queries with Python workers: let them find this package when only
    the driver's path names it, and keep Arrow batches of long texts small."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def apply_job_conf(spark: SparkSession) -> None:
    """Set the job settings that differ, on the session that runs the job."""
    prepare_python(spark)
    for k, v in JOB_CONF.items():
        if spark.conf.get(k, None) != v and spark.conf.isModifiable(k):
            spark.conf.set(k, v)


# Folders staged by this process, per application id, for ``drop_stages``,
# but those staged inside a ``stage_scope``, which deletes its own.
_STAGED: dict[str, list[str]] = {}
TABLE_PREFIX = "table:"
_SCOPE: ContextVar[list[str] | None] = ContextVar("stage_scope", default=None)
_LOCAL_SCRATCH: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, as named by ``spark.checkpoint.dir``.

    On a cluster this must be set by whoever runs the job (a shared file
    system).  Only a local-mode session without the setting gets a private
    scratch folder (one per application), which is what tests and benches use.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    sc = spark.sparkContext
    if not (sc.master or "").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = sc.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="changelens-stage-")
    return _LOCAL_SCRATCH[app]


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    path = name if name.startswith(TABLE_PREFIX) else f"{checkpoint_dir(spark)}/stage-{name}-{uuid.uuid4().hex[:12]}"
    scope = _SCOPE.get()
    (_STAGED.setdefault(spark.sparkContext.applicationId, []) if scope is None else scope).append(path)
    return path


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """What is staged inside the block is deleted at its end, also on failure.

    A job writes its result inside the block to a path named outside of it;
    frames that read the block's staged tables can't be used afterwards.
    """
    own: list[str] = []
    token = _SCOPE.set(own)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        delete_paths(spark, own)


def staged_since(spark: SparkSession, since: int = 0) -> list[str]:
    """The folders that the running scope (the application outside of one) has staged, from the ``since``-th on."""
    scope = _SCOPE.get()
    return (_STAGED.get(spark.sparkContext.applicationId, []) if scope is None else scope)[since:]


def drop_since(spark: SparkSession, since: int, keep: tuple[str, ...] = ()) -> None:
    """Delete what was staged since then, but for the names in ``keep``: a job of many rounds does not hold
    what its earlier rounds have staged.  Frames that read it can't be used afterwards."""
    scope = _SCOPE.get()
    paths = _STAGED.get(spark.sparkContext.applicationId, []) if scope is None else scope
    gone = [p for p in paths[since:] if p.rsplit("/", 1)[-1].rsplit("-", 1)[0] not in {f"stage-{name}" for name in keep}]
    delete_paths(spark, gone)
    paths[since:] = [p for p in paths[since:] if p not in gone]


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _write_alone(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write that is staged go at its end: nothing reads them again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def stage_table(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: a lineage cut that survives executor loss and keeps later plans
    small.  Used at the few points where a result feeds several branches.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    with _write_alone(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_bucketed(df, name: str, key: str):
    """``stage_table`` bucketed and sorted by ``key``, for a side that many joins
    on ``key`` read: they don't shuffle it.  It is a table of the session's
    catalog, which is dropped with its folder."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    table = f"stage_{path.rsplit('-', 1)[1]}"
    stage_path(spark, TABLE_PREFIX + table)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _write_alone(spark):
        df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).option("compression", "zstd").saveAsTable(table)
    return spark.table(table)


def delete_paths(spark: SparkSession, paths: list[str]) -> int:
    """Delete folders of any file system Spark knows; how many there were."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    for path in paths:
        if path.startswith(TABLE_PREFIX):
            spark.sql(f"DROP TABLE IF EXISTS {path.removeprefix(TABLE_PREFIX)}")
            continue
        p = jvm.org.apache.hadoop.fs.Path(path)
        n += bool(p.getFileSystem(conf).delete(p, True))
    return n


def drop_stages(spark: SparkSession) -> int:
    """Delete every folder this application has staged outside of a scope; call
    it once the results that read them have been written.  Returns how many
    were deleted."""
    return delete_paths(spark, _STAGED.pop(spark.sparkContext.applicationId, []))

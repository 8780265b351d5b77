"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import io
import shutil
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on. Shuffle partitions are left to the cluster; AQE coalesces them.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A wide cleaning projection makes one generated method that the JIT refuses to compile. Stages
    # above its limit run without whole-stage code instead, about three times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording a call site per column operation costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "nestmetrics", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's settings; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: For a step that runs a wide projection in one stage, in sessions that were built without BASE_CONF.
WIDE = {"spark.sql.codegen.hugeMethodLimit": BASE_CONF["spark.sql.codegen.hugeMethodLimit"]}
#: For a step that sends long texts to Python: a batch of Spark's 10,000 rows holds them twice, in either process.
LONG_TEXTS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.parquet.columnarReaderBatchSize": "512"}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside; the session's own come back after."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Scratch folders of local sessions that name none themselves, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names for checkpoints.

    Only a local session with no such setting falls back to a temporary folder, which goes when
    Python ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        root = _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return _LOCAL_ROOTS[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_root(spark)}/nestmetrics/{label}-{uuid.uuid4().hex}"


#: Contexts whose workers have been given this package.
_SHIPPED: weakref.WeakSet = weakref.WeakSet()


def ship_code(spark: SparkSession) -> None:
    """Give the workers this package, once for each Spark context, by the shared folder."""
    context = spark.sparkContext
    if context in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    with zipfile.ZipFile(out := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    path = scratch_path(spark, "code") + f"/{package.name}-{uuid.uuid4().hex}.zip"
    write_bytes(spark, path, out.getvalue())
    context.addPyFile(path)
    _SHIPPED.add(context)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """One small file in the shared folder, through the cluster's own file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(data))
    finally:
        out.close()

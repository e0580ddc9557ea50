"""Intermediate tables in the cluster's shared folder.

Lineage is cut with Parquet tables under ``spark.checkpoint.dir``, which every
executor and the driver can read; a lost executor then costs only the tasks it
was running. The folder of a session is removed when the driver exits.
"""

from __future__ import annotations

import atexit
import contextlib
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Hashable, Iterator

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}
_SHIPPED: set[str] = set()
_SCOPES: list[set[str]] = []
_KEPT: dict[Hashable, object] = {}


# Rows and bytes in one Arrow batch, unless the session sets its own: by Spark's
# defaults a batch of long texts is held several times over in each worker.
BATCH_ROWS, BATCH_CONF = "1000", "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_DEFAULT = "10000"
BATCH_BYTES, BYTES_CONF = str(8 << 20), "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application
    (Spark's own file distribution; the zip itself is read by the driver only),
    and keep their Arrow batches small."""
    if spark.conf.get(BATCH_CONF, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_CONF, BATCH_ROWS)
        spark.conf.set(BYTES_CONF, BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="contactlane-zip-"), "contactlane_llm.zip")
    with zipfile.ZipFile(name, "w") as out:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(name)
    _SHIPPED.add(app)


def kept(name: Hashable, build: Callable[[], object]):
    """``build()``, which this process keeps for its next tasks. It keeps one thing
    at a time: Spark's Python workers live on from stage to stage, and what the
    stages before had kept would add up in them."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = build()
    return _KEPT[name]


def keep_nothing() -> None:
    """For tasks that need memory themselves: what this process has kept goes."""
    _KEPT.clear()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, one sub-folder per application.

    Only a local session without ``spark.checkpoint.dir`` (as in tests) gets a
    scratch folder; a cluster session without the setting is an error.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _ROOTS:
        return _ROOTS[app]
    base = (spark.conf.get("spark.checkpoint.dir", None)
            or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir())
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="contactlane-llm-")
    _ROOTS[app] = f"{base.rstrip('/')}/llm-{app}-{uuid.uuid4().hex[:8]}"
    atexit.register(_remove_at_exit, spark, _ROOTS[app])
    return _ROOTS[app]


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    # The session may already be stopped; there is nothing to report then.
    if spark.sparkContext._jsc is not None:
        remove(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (lineage ends there)."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like :func:`stored`, with the path, so that the caller can remove it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    for scope in _SCOPES:
        scope.add(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[set[str]]:
    """What is stored inside is removed at the end, but for the paths taken out of
    the set that this gives, and the shuffle files of its steps are let go."""
    own: set[str] = set()
    _SCOPES.append(own)
    try:
        yield own
    finally:
        _SCOPES[:] = [s for s in _SCOPES if s is not own]
        for path in sorted(own):
            remove(spark, path)
        release(spark)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nothing refers to any more.
    It does so when the driver collects its garbage, which can take half an hour
    on its own; after a large step the files would lie beside the next one's."""
    gc.collect()  # Python's handles on the plans go first
    spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table that no later plan reads."""
    for scope in _SCOPES:
        scope.discard(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)

"""Session settings the operators rely on.

Nothing here names a master or sizes executors: that is the cluster's business.
The settings below only fix semantics (ANSI, UTC) and keep the adaptive planner on.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stored pages and texts can be large: bound an Arrow batch by bytes, not only by rows.  A task holds several batches at
    # once, in the JVM beside its heap and in Python.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024),
    # The JIT compiler skips methods above 8000 bytes of bytecode; wide marts exceed that
    # when fused, so let Spark split them instead of running them interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Counts, least and greatest values from Parquet footers, where a table is read for these alone (tables.footer_scan).
    "spark.sql.parquet.aggregatePushdown": "true",
}

# Only settable before the session exists: call-site capture costs several JVM round
# trips per Column operation.
AT_START = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers once per application, so that its functions also run where it is on the driver's path only."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="touchline-package-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "touchline.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for at, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def get_session(app: str = "touchline", **overrides: str) -> SparkSession:
    """Session for scripts; ``overrides`` are extra ``spark.*`` settings."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **AT_START, **overrides}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_scratch: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for written tables that cut lineage.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local master may fall
    back to a temporary folder, one for the process and gone with it; elsewhere a
    missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set; name a folder all executors share")
    if not _scratch:
        _scratch.append(tempfile.mkdtemp(prefix="touchline-", dir=os.environ.get("TMPDIR", "/tmp")))
        atexit.register(shutil.rmtree, _scratch[0], ignore_errors=True)
    return _scratch[0]


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, cut from its lineage, safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/touchline-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

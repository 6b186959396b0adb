"""Sessions: the engine's settings, and the way its modules reach the executors."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent


def session(app: str = "afterview", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; further settings by keyword, `_` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    fixed = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for key, value in {**fixed, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """This application's folder under spark.checkpoint.dir, which the driver and all
    executors share. Where the setting is missing, a session on one machine gets
    a temporary folder; on a cluster that is refused."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
        at = getattr(spark.sparkContext, "_afterview_dir", None) or tempfile.mkdtemp(prefix="afterview-")
        spark.sparkContext._afterview_dir = at
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(at)
    return f"{at.rstrip('/')}/afterview-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Deletes what this application has stored; results that were not written elsewhere go with it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package to the executors, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_afterview_shipped", None):
        return spark
    at = os.path.join(tempfile.mkdtemp(prefix="afterview-"), "afterview.zip")
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as out:
        for p in sorted(PACKAGE.rglob("*.py")):
            out.write(p, p.relative_to(PACKAGE.parent))
    context.addPyFile(at)
    context._afterview_shipped = True
    return spark

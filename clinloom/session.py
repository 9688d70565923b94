"""Session settings that results depend on, and the shared folder for written tables."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: dict[str, str] = {}


def build_session(app: str = "clinloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the pinned settings; extra ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    pinned = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in (pinned | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset on a local
    master a temporary one made once for the application. On a cluster it must be set."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir names no shared folder")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="spark-")
    return _own_dir[app]


def store(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes ``df`` as Parquet into the shared folder, with the writer's ``options``, and reads it back: lineage is cut, and a
    lost executor costs a re-read instead of a recomputation. A table whose writing fails leaves nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        df.write.options(**options).parquet(path)
    except BaseException:
        _delete(spark, path)
        raise
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(stored: DataFrame) -> None:
    """Deletes a table that ``store`` wrote; nothing may read it any more."""
    _delete(stored.sparkSession, stored._stored_at)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, unless PYTHONPATH already leads them to it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sc = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_clinloom_sent", False):
        return
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="spark-"), "clinloom"), "zip", root, "clinloom"
    )
    sc.addPyFile(archive)
    sc._clinloom_sent = True

"""Sessions: settings for this engine, and this package's code on the executors."""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent
#: Of the contexts that have the code already.
_shipped: set[str] = set()
#: Work folders by application.
_folders: dict[str, list[str]] = {}


def session(app: str = "strandloom", **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; conf adds or replaces settings."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package's modules to the executors, once for each application, so that Python workers can import them."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            for f in sorted(_PACKAGE.rglob("*.py")):
                z.write(f, f"{_PACKAGE.name}/{f.relative_to(_PACKAGE)}")
        name = os.path.join(tempfile.mkdtemp(prefix="strandloom-code-"), "strandloom_code.zip")
        Path(name).write_bytes(held.getvalue())
        spark.sparkContext.addPyFile(name)
        _shipped.add(app)
    return spark


def _path(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def work_folder(spark: SparkSession) -> str:
    """A new folder path in the shared folder named by spark.checkpoint.dir; clean deletes it.

    Only a local master may go without that setting (tests, one machine): a temporary folder takes its place. On a cluster
    its absence raises an error, as no other folder is known to be shared.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[[^\[\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="strandloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    path, system = _path(spark, f"{base.rstrip('/')}/strandloom-{uuid.uuid4().hex}")
    whole = re.sub("^file:/+", "file:///", system.makeQualified(path).toString())
    _folders.setdefault(spark.sparkContext.applicationId, []).append(whole)
    return whole


def delete(spark: SparkSession, folder: str) -> None:
    path, system = _path(spark, folder)
    system.delete(path, True)


def clean(spark: SparkSession) -> None:
    """Deletes all work folders of this application; results that were not read or written before are lost."""
    for folder in _folders.pop(spark.sparkContext.applicationId, []):
        delete(spark, folder)

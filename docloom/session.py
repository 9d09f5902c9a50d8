"""Session settings that the library's results rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}


def session(name: str = "docloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for k, v in {**SETTINGS, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package where their PYTHONPATH lacks it."""
    root = Path(__file__).resolve().parents[1]
    app = spark.sparkContext.applicationId
    if app in _shipped or str(root) in os.environ.get("PYTHONPATH", "").split(":"):
        return
    _shipped.add(app)
    target = Path(tempfile.mkdtemp(prefix="docloom-code-")) / "docloom.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((root / "docloom").rglob("*.py")):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(str(target))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where))


def place(spark: SparkSession, label: str) -> str:
    """A fresh path in the cluster's shared folder; in a temporary one only where all tasks run on this machine."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="docloom-")
    return f"{top.rstrip('/')}/{label}-{uuid.uuid4().hex[:10]}"

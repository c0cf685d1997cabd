"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Paths given out, by application.
_made: dict[str, list[str]] = {}


def build_session(app_name: str = "linktally", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans assume.

    Adaptive execution is what sizes shuffle partitions, splits skewed join
    partitions and picks broadcast joins from measured sizes. Keyword arguments
    use ``__`` for dots: ``spark__sql__shuffle__partitions="2000"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that the cluster names.

    Only a local run, whose executors share the driver's disk, may leave
    ``spark.checkpoint.dir`` unset: a temporary folder is then made and kept as
    the setting for the rest of the session. Elsewhere an unset folder raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        base = tempfile.mkdtemp(prefix="linktally-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch tables that this application has made, and say how many there were.

    A result may read them until it is written or used, so this is for its owner to
    call, at the end of a job; other applications' tables in the same folder stay.
    """
    paths = _made.pop(spark.sparkContext.applicationId, [])
    found = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        found += bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True))
    return found

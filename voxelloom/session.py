"""Session settings the engine expects; a cluster's own settings win over these defaults."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("voxelloom")
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SCRATCH: dict[str, str] = {}


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the folder all executors share, `spark.checkpoint.dir`; in a folder of our own where that is unset."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _SCRATCH.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="voxelloom-")
        _SCRATCH[spark.sparkContext.applicationId] = base
    return f"{base.removeprefix('file://').rstrip('/')}/{label}-{uuid.uuid4().hex}"

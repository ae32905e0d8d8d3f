"""Session factory with the settings every plan here relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "wayfold", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with AQE; on a cluster the master and sizes come from spark-submit."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()

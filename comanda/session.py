"""Session settings shared by the bench, the tests and stand-alone runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

AJUSTES = {
    # every timestamp key is read as UTC micros, so the zone is part of the data contract
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even where a later exchange has to be added for it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


def crear_sesion(master: str | None = None, app: str = "comanda", **extra: str) -> SparkSession:
    """Session with the library's settings; cluster sizing is left to spark-submit."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**AJUSTES, **extra}.items():
        b = b.config(k, v)
    return b.getOrCreate()

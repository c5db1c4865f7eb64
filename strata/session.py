"""Session builder with the settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings every session should have; callers may override any of them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",  # sketches of many small groups: no sort before 4096 of them
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build(app: str = "strata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS; keyword arguments use '__' for the dots of a setting's name.

    On a cluster name the shared folder for cut lineage, as spark__checkpoint__dir or in the cluster's own settings.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

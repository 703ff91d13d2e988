"""Session settings the library relies on for speed; results do not depend on them."""

from __future__ import annotations

from pyspark.sql import SparkSession

# HotSpot does not compile methods above 8000 bytecodes, and typing some thirty text
# columns in one whole-stage method exceeds that: it would run interpreted. With the
# limit at the same size Spark generates one method per operator there instead.
_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": ("65535", "8000")}


def tuned(spark: SparkSession) -> SparkSession:
    """Apply the settings that are still at Spark's defaults."""
    for name, (default, value) in _SETTINGS.items():
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, value)
    return spark

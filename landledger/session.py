"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The epoch columns turn into dates in the session time zone, and adaptive
# execution picks join sides and partition counts from measured sizes.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot compiles no method beyond this; such a generated method would be interpreted row by row
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(
    app_name: str = "landledger",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the required settings; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_settings(spark: SparkSession) -> SparkSession:
    """Put the required settings on a session somebody else created."""
    for key, value in REQUIRED_SETTINGS.items():
        spark.conf.set(key, value)
    return spark

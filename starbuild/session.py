"""Session settings.  Every operator also accepts whatever session the caller already has."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs the next operator one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def get_session(app_name: str = "starbuild", extra: Mapping[str, str] | None = None) -> SparkSession:
    """The active session if there is one, else a new one with the library's settings."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def jdbc_settings(env: Mapping[str, str] | None = None) -> tuple[str, dict[str, str]]:
    """JDBC address and connection properties from DW_HOST, DW_PORT, DW_DATABASE, DW_USER, DW_PASSWORD.

    The password has no default: without it this fails.
    """
    env = os.environ if env is None else env
    url = "jdbc:postgresql://{}:{}/{}".format(
        env.get("DW_HOST", "postgres"), env.get("DW_PORT", "5432"), env.get("DW_DATABASE", "university_dw")
    )
    properties = {
        "user": env.get("DW_USER", "datawarehouse"),
        "password": env["DW_PASSWORD"],
        "driver": "org.postgresql.Driver",
    }
    return url, properties

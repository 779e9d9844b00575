"""Session helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def builder(app_name: str = "cardlens") -> SparkSession.Builder:
    """A session builder with the settings the operators rely on; sizes stay with the cluster."""
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in a folder every executor can reach.

    That is the folder named by ``spark.checkpoint.dir``, or, where it is unset, ``scratch`` below the
    warehouse, which every session has and which lies on shared storage on a cluster. What is written
    there belongs to the caller; nothing here deletes it.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        root = f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/scratch"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"

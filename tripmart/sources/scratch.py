"""Folders for intermediate tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"
MASTER = "spark.master"


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder that the session names.

    A session without that setting gets one below its warehouse. On a cluster the default
    warehouse is a folder of each machine by itself, which is refused.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        warehouse = spark.conf.get(WAREHOUSE_DIR)
        of_machine = warehouse.startswith("file:") or "://" not in warehouse
        if of_machine and not (spark.conf.get(MASTER, None) or "").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all machines share")
        root = f"{warehouse.rstrip('/')}/scratch"
    return f"{root.rstrip('/')}/tripmart-{label}-{uuid4().hex}"

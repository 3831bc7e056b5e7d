"""Where streams and stored tables keep their files: the shared folder the cluster names."""

from __future__ import annotations

from urllib.parse import urlparse
from uuid import uuid4

from pyspark.sql import SparkSession

SHARED_DIR_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, or on a local master below the warehouse where none is named.

    On a cluster the default warehouse is a folder of one machine, which the others cannot see: without
    a shared folder that is an error. Nothing removes what is written there, since a result may still
    be read.
    """
    shared = spark.conf.get(SHARED_DIR_SETTING, "")
    if not shared:
        warehouse = spark.conf.get(WAREHOUSE_SETTING)
        on_one_machine = spark.conf.get("spark.master", "").partition("[")[0] == "local"
        if not on_one_machine and (urlparse(warehouse).scheme or "file") == "file":
            raise ValueError(f"set {SHARED_DIR_SETTING} to a folder that all executors share")
        shared = f"{warehouse.rstrip('/')}/scratch"
    return f"{shared.rstrip('/')}/{label}-{uuid4().hex}"

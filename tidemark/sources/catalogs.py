"""Session settings: broker connector, lakehouse catalog, state store."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Classes of the table format's Spark integration.
SESSION_EXTENSIONS = "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
CATALOG_CLASS = "org.apache.iceberg.spark.SparkCatalog"
RUNTIME_PACKAGE = "org.apache.iceberg:iceberg-spark-runtime-4.0_2.13:1.10.0"

# Spark's own disk-backed state store and broker connector.
ROCKSDB_CLASS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"


def iceberg_configs(
    catalog: str = "local", warehouse: str = "warehouse", package: str = RUNTIME_PACKAGE
) -> dict[str, str]:
    """Session settings for a Hadoop catalog in a warehouse folder."""
    prefix = f"spark.sql.catalog.{catalog}"
    return {
        "spark.jars.packages": package,
        "spark.sql.extensions": SESSION_EXTENSIONS,
        prefix: CATALOG_CLASS,
        f"{prefix}.type": "hadoop",
        f"{prefix}.warehouse": warehouse,
    }


def kafka_configs(package: str = KAFKA_PACKAGE) -> dict[str, str]:
    """Session settings for reading and writing broker topics."""
    return {"spark.jars.packages": package}


def keyed_state_configs() -> dict[str, str]:
    """Session settings for streaming state larger than memory, as de-duplication over long delays
    or one row per key needs; only what changed is written per micro-batch."""
    return {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_CLASS,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


PACKAGES = "spark.jars.packages"


def configure(builder: SparkSession.Builder, *settings: dict[str, str]) -> SparkSession.Builder:
    """Put settings on a session builder. Packages of several settings are joined, so a session can
    have a broker and a lakehouse. Master and parallelism stay with the caller."""
    packages: list[str] = []
    for name, value in (item for part in settings for item in part.items()):
        if name == PACKAGES:
            packages += [p for p in value.split(",") if p not in packages]
            value = ",".join(packages)
        builder = builder.config(name, value)
    return builder

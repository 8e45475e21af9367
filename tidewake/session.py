"""Sessions and settings.

Two profiles: `local` uses Parquet tables and file streams; `lakehouse` sets a catalog with Iceberg tables
and an object store, whose libraries must be on the classpath (not part of this repository's tests).
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    """From environment variables, once."""

    profile: str = field(default_factory=lambda: os.environ.get("TIDEWAKE_PROFILE", "local"))
    catalog: str = field(default_factory=lambda: os.environ.get("TIDEWAKE_CATALOG", "nessie"))
    catalog_uri: str = field(default_factory=lambda: os.environ.get("NESSIE_URI", "http://nessie:19120/api/v1"))
    branch: str = field(default_factory=lambda: os.environ.get("NESSIE_REF", "main"))
    bucket: str = field(default_factory=lambda: os.environ.get("LAKEHOUSE_BUCKET", "lakehouse"))
    endpoint: str = field(default_factory=lambda: os.environ.get("S3_ENDPOINT", "http://minio:9000"))
    access_key: str = field(default_factory=lambda: os.environ.get("S3_ACCESS_KEY", ""))
    secret_key: str = field(default_factory=lambda: os.environ.get("S3_SECRET_KEY", ""), repr=False)
    bootstrap: str = field(default_factory=lambda: os.environ.get("KAFKA_BOOTSTRAP_SERVERS", "kafka:9092"))

    seed_customers: int = 10_000
    seed_products: int = 10_000
    seed_orders: int = 1_000_000
    seed_items_per_order: int = 4
    seed_batch_rows: int = 25_000
    seed: int = 42

    def checkpoint(self, table: str) -> str:
        return f"s3a://{self.bucket}/checkpoints/bronze/{table}/"


def build_session(app: str, settings: Settings | None = None, **conf: str) -> SparkSession:
    s = settings or Settings()
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.scheduler.mode", "FAIR")
    if s.profile == "lakehouse":
        c = f"spark.sql.catalog.{s.catalog}"
        b = b.config(map={
            "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions,org.projectnessie.spark.extensions.NessieSparkSessionExtensions",
            c: "org.apache.iceberg.spark.SparkCatalog", f"{c}.catalog-impl": "org.apache.iceberg.nessie.NessieCatalog", f"{c}.uri": s.catalog_uri, f"{c}.ref": s.branch, f"{c}.warehouse": f"s3a://{s.bucket}/",
            "spark.sql.defaultCatalog": s.catalog, "spark.hadoop.fs.s3a.endpoint": s.endpoint, "spark.hadoop.fs.s3a.path.style.access": "true", "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        })
        if s.access_key:
            b = b.config(map={"spark.hadoop.fs.s3a.access.key": s.access_key, "spark.hadoop.fs.s3a.secret.key": s.secret_key})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()

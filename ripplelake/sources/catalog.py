"""Catalog upkeep (A7-A9): external Parquet tables over the lake folders and
partition discovery.

``USING parquet`` tables need no Hive support; ``MSCK REPAIR TABLE`` /
``recoverPartitions`` registers partitions written by jobs or streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import (BRONZE_COLUMNS, BRONZE_SCHEMA, GOLD_PARTITIONS, GOLD_PRODUCTS_SCHEMA,
                       GOLD_REVENUE_SCHEMA, GOLD_SALES_SCHEMA, GOLD_SEGMENTS_SCHEMA, SILVER_PARTITIONS,
                       SILVER_SCHEMA)
from . import publish

_INGEST = [c for c in BRONZE_COLUMNS if c.startswith("ingest_")]


def _ddl(schema: T.StructType, partitions: list[str]) -> str:
    cols = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in partitions]
    cols += [f"`{p}` int" for p in partitions]
    return ", ".join(cols)


# (table, relative folder, schema, partition columns)
TABLES = [
    ("gold_revenue_metrics", "gold/revenue_metrics", GOLD_REVENUE_SCHEMA, GOLD_PARTITIONS),
    ("gold_top_products", "gold/top_products", GOLD_PRODUCTS_SCHEMA, GOLD_PARTITIONS),
    ("gold_user_segments", "gold/user_segments", GOLD_SEGMENTS_SCHEMA, GOLD_PARTITIONS),
    ("silver_events", "silver/cleaned_events", SILVER_SCHEMA, SILVER_PARTITIONS),
    ("bronze_events", "bronze/raw_events", BRONZE_SCHEMA, _INGEST),
    ("gold_sales_metrics", "gold/sales_metrics", GOLD_SALES_SCHEMA, []),
]


def create_table(spark: SparkSession, name: str, location: str, schema: T.StructType,
                 partitions: list[str]) -> None:
    part = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema, partitions)}) USING parquet{part} "
              f"LOCATION '{location}'")


def create_tables(spark: SparkSession, base: str, prefix: str = "") -> list[str]:
    """Register every lake table under ``base``; returns the names."""
    names = []
    for name, folder, schema, parts in TABLES:
        create_table(spark, prefix + name, f"{base.rstrip('/')}/{folder}", schema, parts)
        names.append(prefix + name)
    return names


def refresh_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Discover partitions written since the last refresh and return the
    partition list (``SHOW PARTITIONS``)."""
    spark.catalog.recoverPartitions(table)
    return spark.sql(f"SHOW PARTITIONS {table}")


def drop_tables(spark: SparkSession, prefix: str = "") -> None:
    """Take the tables of ``create_tables`` out of the catalog; their files stay."""
    for name, *_ in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{name}")


def add_published(spark: SparkSession, table: str, base: str, folder: str, after: int = -1) -> int:
    """A9 from the manifests (``sources.publish``): add the days that runs after
    number ``after`` published to a table, drop those they emptied, and return the
    last number.  The cost follows the touched days, not the table's folders.
    """
    held: dict[str, bool] = {}
    for m in publish.manifests(spark, base):
        if m.number > after and folder in m.tables:
            for day in m.tables[folder]["days"]:
                held[day] = bool(publish.children(spark, f"{base}/{folder}/{day}"))
            after = m.number
    for verb, wanted in (("ADD IF NOT EXISTS", True), ("DROP IF EXISTS", False)):
        parts = ["PARTITION (" + day.replace("/", ", ") + ")" for day, there in sorted(held.items()) if there is wanted]
        if parts:
            spark.sql(f"ALTER TABLE {table} {verb} " + ("" if wanted else ", ").join(f"{x} " if wanted else x for x in parts))
    return after

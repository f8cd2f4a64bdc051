"""Layer databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import delete_path


def layer_db(env: str, layer: str) -> str:
    """Fixed naming of layer databases."""
    return f"{env.lower()}_fraudes_{layer}"


def ensure_layer_db(spark: SparkSession, env: str, layer: str, base: str, drop_first: bool = False) -> str:
    """Create a layer's database at its location; dropping what is there is explicit."""
    name = layer_db(env, layer)
    if drop_first:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{base}/warehouse/{name}'")
    return name


def table_location(base: str, db: str, table: str) -> str:
    return f"{base}/warehouse/{db}/{table.lower()}"


def rename_table(spark: SparkSession, name: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {name} RENAME TO {to}")


def table_detail(spark: SparkSession, name: str, what: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == what).collect()
    return rows[-1].data_type if rows else None


def location_of(spark: SparkSession, name: str) -> str:
    """Where a table's files lie, or would by default if there is no such table."""
    if spark.catalog.tableExists(name):
        found = table_detail(spark, name, "Location")
        return found.split(".versions/")[0]
    db, _, table = name.rpartition(".")
    return f"{spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{table.lower()}"


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table with its files, wherever they lie."""
    if spark.catalog.tableExists(name):
        location = table_detail(spark, name, "Location")
        spark.sql(f"DROP TABLE {name}")
        delete_path(spark, location)


def recover_table(spark: SparkSession, name: str) -> None:
    """Undo or finish a replacement that ended half way.

    ``__writing`` may lack rows and goes; ``__new`` is whole and takes the table's
    place if that is empty; ``__old`` does so if there is nothing newer.
    """
    drop_table(spark, f"{name}__writing")
    for held in (f"{name}__new", f"{name}__old"):
        if spark.catalog.tableExists(held):
            if spark.catalog.tableExists(name):
                drop_table(spark, held)
            else:
                rename_table(spark, held, name)


def list_tables(spark: SparkSession, db: str) -> DataFrame:
    """Names of a database's tables."""
    rows = sorted((t.name,) for t in spark.catalog.listTables(db) if not t.isTemporary)
    return spark.createDataFrame(rows, "tabla string")

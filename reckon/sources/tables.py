"""Batch table scans. A table is one parquet file or one parquet directory of that name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reckon.schemas import TABLES


def table(spark: SparkSession, root: str, name: str, schema: StructType | None = None) -> DataFrame:
    """Scan ``root/name.parquet``. A schema saves the footer read and pins types on a cluster."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{root}/{name}.parquet")


def period(column: str, unit: str) -> Column:
    """What a time column is partitioned by: its day, or the first day of its month."""
    day = F.to_date(column)
    return (F.trunc(day, "month") if unit == "month" else day).alias(f"{column}_{unit}")


def create_tables(spark: SparkSession, namespace: str, location: str) -> None:
    """The namespace and its stored tables, where they don't exist yet; each partitioned by its period."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS `{namespace}`")
    for name, (columns, column, unit) in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{namespace}`.`{name}` ({columns}, `{column}_{unit}` date) USING parquet PARTITIONED BY (`{column}_{unit}`) LOCATION '{location}/{name}'")


def insert(df: DataFrame, namespace: str, name: str) -> None:
    """Append rows to a stored table, in its columns and partitions."""
    columns, column, unit = TABLES[name]
    schema = StructType.fromDDL(columns)
    df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields], period(column, unit)).write.insertInto(f"`{namespace}`.`{name}`")


def stored(spark: SparkSession, namespace: str, name: str) -> DataFrame:
    """A stored table without its partition column; a filter on the period column before this prunes."""
    _, column, unit = TABLES[name]
    return spark.table(f"`{namespace}`.`{name}`").drop(f"{column}_{unit}")


def drop_tables(spark: SparkSession, namespace: str) -> None:
    """Drop the namespace with all its tables."""
    spark.sql(f"DROP NAMESPACE IF EXISTS `{namespace}` CASCADE")

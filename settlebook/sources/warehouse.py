"""Read settlement inputs stored as tables (parquet folders or catalog
tables) and write stage outputs.

A production close reads the warehouse tables directly; nothing here goes
through the adapters, which only exist to derive these shapes from the
driver's test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from settlebook.sources.adapters import SettlementInputs
from settlebook.sources.schema import CONTRACT, TIME, conform_all

# Table name per input (override any of them with ``names=``).
INPUT_TABLES = {name: name for name in CONTRACT}


def read_table(spark: SparkSession, where: str, name: str, fmt: str = "parquet") -> DataFrame:
    """``where`` is a folder (``{where}/{name}``) or, with ``fmt="table"``, a
    catalog database (``{where}.{name}``)."""
    if fmt == "table":
        return spark.table(f"{where}.{name}" if where else name)
    return spark.read.format(fmt).load(f"{where.rstrip('/')}/{name}")


def read_input(spark: SparkSession, where: str, table: str, field: str, fmt: str = "parquet") -> DataFrame:
    """The stored table of an input. Instants in Parquet files are read as UTC
    wall clocks at once, by asking the reader for them: so cutoffs on them are
    pushed into the scan as they are for wall clocks. (Instants of a catalog
    table are turned into wall clocks above the scan, see ``schema``.)"""
    df = read_table(spark, where, table, fmt)
    times = {c for c, kind in CONTRACT[field].items() if kind == TIME}
    if fmt == "parquet" and any(f.name in times and isinstance(f.dataType, T.TimestampType) for f in df.schema.fields):
        schema = T.StructType([T.StructField(f.name, T.TimestampNTZType()) if f.name in times and isinstance(f.dataType, T.TimestampType) else f
                               for f in df.schema.fields])
        df = spark.read.schema(schema).parquet(f"{where.rstrip('/')}/{table}")
    return df


def load_inputs(spark: SparkSession, where: str, fmt: str = "parquet",
                names: dict[str, str] | None = None, voids=()) -> SettlementInputs:
    """The inputs by table name, in their declared types (``schema.CONTRACT``);
    one ``SchemaError`` names every column that is missing or of a wrong type.
    ``voids`` are the payout ids voided by hand, used where there is no
    ``manual_voids`` table."""
    n = {**INPUT_TABLES, **(names or {})}
    found = {field: read_input(spark, where, table, field, fmt) for field, table in n.items()
             if field != "manual_voids" or table_exists(spark, where, table, fmt)}
    if "manual_voids" not in found:
        found["manual_voids"] = manual_voids_table(spark, voids)
    return SettlementInputs(**conform_all(found))


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write a table in place of what is at ``path``. The former files go first:
    for a stage that others read, use :class:`~settlebook.sources.stages.StageStore`."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def table_exists(spark: SparkSession, where: str, name: str, fmt: str = "parquet") -> bool:
    if fmt == "table":
        return spark.catalog.tableExists(f"{where}.{name}" if where else name)
    return path_exists(spark, f"{where.rstrip('/')}/{name}")


def manual_voids_table(spark: SparkSession, payout_ids) -> DataFrame:
    """The ``manual_voids`` input from a list of payout ids, e.g. the
    December 2018 lists in ``settlebook.plans.rules``."""
    return spark.createDataFrame([(int(i),) for i in payout_ids], "payout_id bigint")

"""The partitioned report table in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REPORT_PARTITIONS = ["year", "month", "day"]

from cadenza.sources.missing import or_none


def _exists(spark: SparkSession, path: str) -> bool:
    return or_none(lambda: spark.read.parquet(path)) is not None


def write_report_table(df: DataFrame, table: str, path: str | None = None,
                       mode: str = "overwrite") -> None:
    """Dynamic partitions; ``overwrite`` replaces only the days present in ``df``
    (re-running a day is idempotent), ``append`` adds rows as the original did.

    The table is external, at ``path`` (default: the warehouse folder / table
    name).  A session whose catalog does not know the table yet (e.g. an
    in-memory catalog after a restart) re-registers it over the stored data
    instead of failing on the existing location.
    """
    spark = df.sparkSession
    if path is None:
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}"
    if not spark.catalog.tableExists(table) and _exists(spark, path):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        parts = ", ".join(f"`{c}`" for c in REPORT_PARTITIONS)
        loc = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE `{table}` ({cols}) USING parquet PARTITIONED BY ({parts}) "
                  f"LOCATION '{loc}'")
        spark.catalog.recoverPartitions(table)
    if spark.catalog.tableExists(table):
        (df.write.option("partitionOverwriteMode", "dynamic")
         .insertInto(table, overwrite=(mode == "overwrite")))
        return
    (df.write.mode("overwrite" if mode == "overwrite" else "append")
     .partitionBy(*REPORT_PARTITIONS).option("path", path).format("parquet").saveAsTable(table))


def read_report_table(spark: SparkSession, table: str) -> DataFrame:
    """What SQL clients read."""
    return spark.table(table)

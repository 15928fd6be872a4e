"""Tables laid out for their joins: partitioned by what a run replaces, bucketed and sorted by the key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class BucketedTable:
    """A catalog table of Parquet files. Two tables with the same number of buckets are joined on the key without an exchange; a write replaces the
    partitions that its rows have, and no other.

    schema: with the partition columns, which may stand anywhere; key: one column; buckets: so many that a bucket of the whole table fits a task.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, schema: T.StructType, key: str, partition: str | None = None, buckets: int = 16):
        self.spark, self.name, self.key, self.partition, self.buckets = spark, name, key, partition, buckets
        columns = [f for f in schema if f.name != partition]
        self.columns = [*(f.name for f in columns), *([partition] if partition else [])]
        if not spark.catalog.tableExists(name):
            quoted = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (*columns, *([schema[partition]] if partition else [])))
            dealt = f" PARTITIONED BY (`{partition}`)" if partition else ""
            spark.sql(f"CREATE TABLE {name} ({quoted}) USING parquet{dealt} CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")

    def overwrite(self, rows: DataFrame) -> None:
        """Replace the partitions that rows have (without partitions: all). Rows are dealt by the key first, so a bucket of a partition is one file."""
        ready = rows.select(*self.columns).repartition(self.buckets, self.key)
        setting, conf = "spark.sql.sources.partitionOverwriteMode", self.spark.conf
        before = conf.get(setting)
        conf.set(setting, "dynamic" if self.partition else "static")
        try:
            ready.write.insertInto(self.name, overwrite=True)
        finally:
            conf.set(setting, before)

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Forget the table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

"""Date-partitioned catalog tables: create, overwrite partitions, drop, count.

K1  dynamic-partition overwrite: only the dt values present in the data are
    replaced; other partitions survive, so a re-run of a day is idempotent.
K4  static-partition overwrite: ``INSERT OVERWRITE ... PARTITION (dt='...')``
    replaces that partition whatever the data holds; an empty frame empties it.
K5  create the partitioned table from a schema.
K6  drop one partition (managed table: its files go too).
K7  drop the table.
K8  rows per partition, newest first (top-k by dt).
O4  rows are rebalanced on dt before the write: all rows of a day would
    otherwise go to one writer task; the rebalance lets AQE split a large day
    into evenly sized files.

A table may be bucketed and sorted by columns (K5): rows are dealt by the hash
that Spark buckets by, so each bucket of a day is one file, and joins and
aggregates on those columns need no exchange of the table.

A day can also be staged: written beside the table, checked, and then swapped
in by one change of metadata (``stage``, ``swap``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COL = "dt"


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_database(spark: SparkSession, name: str, location: str) -> str:
    """A database whose managed tables live under ``location``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
    return name


class PartitionedTable:
    def __init__(self, spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet",
                 buckets: int = 0, bucket_by: Sequence[str] = ()):
        if schema.fieldNames()[-1] != PARTITION_COL:
            raise ValueError("the partition column dt must be the last column")
        self.spark, self.name, self.schema, self.fmt = spark, name, schema, fmt
        self.columns = schema.fieldNames()
        self.buckets, self.bucket_by = buckets, list(bucket_by)

    def create(self) -> PartitionedTable:
        """K5.  Dynamic overwrite is an option of the table, so that no write has to change the session."""
        keys = ", ".join(f"`{c}`" for c in self.bucket_by)
        clustered = f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS" if self.buckets else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({_ddl(self.schema)}) USING {self.fmt} "
                       f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({PARTITION_COL}){clustered}")
        return self

    def _dealt(self, df: DataFrame, *keys: str) -> DataFrame:
        """Rows as they are written: a task per bucket, or files of even size."""
        return df.repartition(self.buckets, *self.bucket_by) if self.buckets else df.hint("rebalance", *keys)

    def _cast(self, df: DataFrame, columns: list[str]) -> DataFrame:
        """Columns by name, cast to the table's types (inserts are positional)."""
        fields = {f.name: f.dataType for f in self.schema.fields}
        return df.select(*[F.col(c).cast(fields[c]).alias(c) for c in columns])

    def _overwrites_dynamically(self) -> bool:
        if self.spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static").lower() == "dynamic":
            return True
        stored = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Storage Properties'").first()
        return stored is not None and "partitionoverwritemode=dynamic" in stored.data_type.lower()

    def overwrite_partitions(self, df: DataFrame) -> PartitionedTable:
        """Replace exactly the dt partitions present in ``df``."""
        if not self._overwrites_dynamically():  # a static overwrite would empty all other partitions
            raise ValueError(f"{self.name} was not made by create(): ALTER TABLE {self.name} "
                             "SET SERDEPROPERTIES ('partitionOverwriteMode'='dynamic') first")
        self._dealt(self._cast(df, self.columns), PARTITION_COL).write.insertInto(self.name, overwrite=True)
        return self

    def overwrite_partition(self, df: DataFrame, dt: str) -> PartitionedTable:
        """K4: ``df`` becomes the whole content of the partition ``dt``."""
        view = f"load_{uuid.uuid4().hex}"
        self._dealt(self._cast(df, self.columns[:-1])).createOrReplaceTempView(view)
        try:
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({PARTITION_COL}='{dt}') SELECT * FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)
        return self

    def location(self) -> str:
        return self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Location'").first().data_type.rstrip("/")

    def partition_location(self, dt: str) -> str | None:
        """Where the partition ``dt`` lies; None if the table has none."""
        if not self.spark.sql(f"SHOW PARTITIONS {self.name} PARTITION ({PARTITION_COL}='{dt}')").head(1):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name} PARTITION ({PARTITION_COL}='{dt}')")
        return rows.where("col_name = 'Location'").first().data_type.rstrip("/")

    def stage(self, df: DataFrame, dt: str) -> str:
        """Write ``df`` as a version of the partition ``dt`` beside the table, where no reader looks."""
        path = f"{self.location()}/_staged/{PARTITION_COL}={dt}/{uuid.uuid4().hex}"
        self._cast(df, self.columns[:-1]).hint("rebalance").write.format(self.fmt).save(path)
        return path

    def staged(self, path: str, dt: str) -> DataFrame:
        """The rows of a staged version, with the columns of the table."""
        fields = T.StructType(self.schema.fields[:-1])
        return self.spark.read.schema(fields).format(self.fmt).load(path).withColumn(PARTITION_COL, F.lit(dt))

    def swap(self, dt: str, path: str) -> str | None:
        """Let the partition ``dt`` be the version at ``path``: one change of metadata.  Returns where it lay before."""
        if self.buckets:
            raise ValueError("a staged version has no buckets")
        before = self.partition_location(dt)
        spec = f"PARTITION ({PARTITION_COL}='{dt}')"
        if before is None:
            self.spark.sql(f"ALTER TABLE {self.name} ADD {spec} LOCATION '{path}'")
        else:
            self.spark.sql(f"ALTER TABLE {self.name} {spec} SET LOCATION '{path}'")
        self.spark.catalog.refreshTable(self.name)
        return before

    def drop_partition(self, dt: str) -> PartitionedTable:
        """K6."""
        self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({PARTITION_COL}='{dt}')")
        return self

    def drop(self) -> None:
        """K7."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def read(self, dt: str | None = None) -> DataFrame:
        """Whole table, or one partition (pruned at the scan)."""
        df = self.spark.table(self.name)
        return df if dt is None else df.where(F.col(PARTITION_COL) == F.lit(dt))

    def partition_counts(self, latest: int = 5) -> DataFrame:
        """K8 + A10 + O1: rows per dt, newest ``latest`` partitions."""
        return partition_counts(self.read(), latest)


def partition_counts(df: DataFrame, latest: int = 5) -> DataFrame:
    return (df.groupBy(PARTITION_COL).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.col(PARTITION_COL).desc()).limit(latest))

"""Helpers shared by the operators: shared tables, hold-out rule, name clashes."""

from __future__ import annotations

import atexit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Rows whose crc32(doc_id as text) mod 5 is 0 are held out; a null id counts as
#: the empty text (remainder 0), so a row without an id is never learned from.
HELD_OUT_SQL = "crc32(coalesce(cast({id} as string), '')) % 5 = 0"


def held_out(id_col: str = "doc_id"):
    return F.expr(HELD_OUT_SQL.format(id=f"`{id_col}`"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches sent to Python by bytes instead of rows, whatever the lengths of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100000")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor can read, so a lost
    executor never forces the work before this point to run again.  The files
    are deleted when the driver process ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:    # else the session has been stopped before
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def remove_table(df: DataFrame) -> None:
    """Delete the files behind a frame returned by ``materialise`` before the driver process ends."""
    files = df.inputFiles()
    if files:
        _remove(df.sparkSession, files[0].rpartition("/")[0])


def fresh(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column of ``columns`` has it (case-insensitive)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name

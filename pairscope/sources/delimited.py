"""Delimited text exchange: the TSV feature extract and the scored-pair CSV.

The reference moves data between stages as text files; in this build the
stages share DataFrames, and text is only an import/export edge.  Reads always
take an explicit schema (no inference) and the same null marker the writer
used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NULL_MARKER = "NULL"  # how the Hive CLI prints a null


def write_tsv(df: DataFrame, path: str, compression: str | None = "gzip") -> str:
    """K2: tab-separated with a header row (one file per task, no driver merge)."""
    w = (df.write.mode("overwrite").option("sep", "\t").option("header", True)
           .option("nullValue", NULL_MARKER).option("emptyValue", ""))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header row skipped, explicit schema, gzip handled by the codec."""
    return (spark.read.schema(schema).option("sep", "\t").option("header", True)
            .option("nullValue", NULL_MARKER).option("emptyValue", "")
            .option("mode", "FAILFAST").csv(path))


def write_scores_csv(scores: DataFrame, path: str) -> str:
    """K3: scored pairs as comma-separated text with a header."""
    (scores.select("username", "search_route", "q_ratio")
           .write.mode("overwrite").option("header", True).option("nullValue", NULL_MARKER)
           .csv(path))
    return path


def read_scores_csv(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField("username", T.StringType()),
                           T.StructField("search_route", T.StringType()),
                           T.StructField("q_ratio", T.DoubleType())])
    return (spark.read.schema(schema).option("header", True).option("nullValue", NULL_MARKER)
            .option("mode", "FAILFAST").csv(path))

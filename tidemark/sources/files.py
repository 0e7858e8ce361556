"""Reading and writing files in the supported formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# name -> (Spark format, options); avro needs its package on the class path
FORMATS = {
    "parquet": ("parquet", {}),
    "orc": ("orc", {}),
    "avro": ("avro", {}),
    "json": ("json", {}),
    "csv": ("csv", {"header": "true"}),
    "tsv": ("csv", {"header": "true", "sep": "\t"}),
}


def write_format(
    df: DataFrame, fmt: str, path: str, mode: str = "overwrite", partition_by: list[str] = []
) -> None:
    name, options = FORMATS[fmt]
    writer = df.write.format(name).options(**options).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_format(spark: SparkSession, fmt: str, path: str, schema: StructType | None = None) -> DataFrame:
    """Read files; delimited text without a schema has its types inferred."""
    name, options = FORMATS[fmt]
    reader = spark.read.format(name).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif name == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.load(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_renamed(spark: SparkSession, fmt: str, path: str, names: list[str]) -> DataFrame:
    """Read files and name the columns by position."""
    return read_format(spark, fmt, path).toDF(*names)


def append_partitioned_orc(df: DataFrame, path: str, partition: str) -> None:
    df.write.mode("append").partitionBy(partition).orc(path)


def manifest(spark: SparkSession, path: str, glob: str = "*.gz") -> DataFrame:
    """File name, size and md5 of every exported file.

    Each task hashes whole files; export files are bounded by the batch size.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select("path", "length", F.md5("content").alias("md5"))

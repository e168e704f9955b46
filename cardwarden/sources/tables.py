"""Batch sources: delimited files at the edge, Parquet inside, partitioned relational reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.functions.numeric import nan_to_null


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV table under its declared schema.

    No inference pass over the data; a missing path is an AnalysisException.  Bad values fail the
    job instead of turning into nulls that would count as missing.
    """
    rows = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    return nan_to_null(rows)


def read_pair(spark: SparkSession, transactions: str, identity: str, transaction_schema: T.StructType,
              identity_schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The transaction table and the identity table."""
    return (read_csv(spark, transactions, transaction_schema),
            read_csv(spark, identity, identity_schema))


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def read_relational(spark: SparkSession, url: str, table: str, key: str, low: int, high: int,
                    partitions: int, **options) -> DataFrame:
    """A relational table read in key ranges by many tasks at once."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high,
        numPartitions=partitions, **options).load()


def column_names(df: DataFrame) -> DataFrame:
    """(position, column, type): from the schema, no job."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def file_sizes(df: DataFrame) -> DataFrame:
    """(file, bytes) of a file-backed table."""
    return df.select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).distinct()


def inspect(df: DataFrame, key: str, sample_rows: int = 5) -> dict[str, DataFrame]:
    """Columns and types, the first rows by key, and file sizes."""
    return {"columns": column_names(df), "sample": df.orderBy(key).limit(sample_rows),
            "files": file_sizes(df)}


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a table is a folder of part files, on any file system that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()


def table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """The Parquet table ``folder/name`` as a stream, be it one file or a folder of part files."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if is_folder(spark, f"{folder}/{name}"):
        return reader.parquet(f"{folder}/{name}")
    return reader.option("pathGlobFilter", name).parquet(folder)

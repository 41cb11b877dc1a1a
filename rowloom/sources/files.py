"""File readers and writers; schemas are explicit unless inference is asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, infer: bool = False,
             header: bool = True) -> DataFrame:
    """CSV with a StructType, a DDL string, or (one extra pass) inferred types."""
    reader = spark.read.option("header", header)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder with one file per partition, header in each."""
    df.write.mode(mode).option("header", True).csv(path)


def write_sized_csv(df: DataFrame, path: str, rows_per_file: int, mode: str = "errorifexists") -> None:
    """Few files of at most ``rows_per_file`` rows; a small table is one file, and no task writes a large one alone."""
    (df.hint("rebalance").write.mode(mode).option("header", True).option("maxRecordsPerFile", rows_per_file).csv(path))


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: Sequence[str] = ()) -> None:
    """Parquet, optionally one folder per value of the partition columns.

    Rows of a folder are brought together before the write; the rebalance hint
    lets Spark split large folders and merge small ones by their real size.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Schema from the files; filters and columns are pushed into the scan."""
    return spark.read.parquet(path)


def write_orc(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """S8."""
    df.write.mode(mode).orc(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    """S8."""
    return spark.read.orc(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line."""
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              multi_line: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """Line-wise JSON splits over tasks; ``multi_line`` reads whole files per task."""
    reader = spark.read.option("multiLine", multi_line).option("encoding", encoding)
    if encoding != "UTF-8" and not multi_line:
        reader = reader.option("lineSep", "\n")  # Spark can't tell it from the bytes of any encoding
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def avro_available(spark: SparkSession) -> bool:
    """Whether the separate Avro module is on the class path.

    Reading no files gets as far as the missing schema only if the format is known.
    """
    try:
        spark.read.format("avro").load()
    except AnalysisException as error:
        return error.getCondition() == "UNABLE_TO_INFER_SCHEMA"
    return True


def _need_avro(spark: SparkSession) -> None:
    if not avro_available(spark):
        raise RuntimeError("Avro needs the spark-avro module on the class path")


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Needs the Avro module; says so if it is missing."""
    _need_avro(spark)
    return spark.read.format("avro").load(path)


def write_avro(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Needs the Avro module; says so if it is missing."""
    _need_avro(df.sparkSession)
    df.write.mode(mode).format("avro").save(path)

"""Readers and writers of the catalog, report, segment and recommendation tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfline.operators.segments import attach_clusters
from shelfline.schema import CLEAN_SCHEMA, RAW_SCHEMA, RECOMMENDATION_SCHEMA, SEGMENT_COLUMNS, SEGMENT_SCHEMA


def _read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool, mode: str) -> DataFrame:
    """Columns by the names in the header, in any order; columns beyond the schema are left out.

    Every file must have the header that was found. Rows with too few or too many fields, or with values
    that aren't of their type, follow `mode`: FAILFAST fails, PERMISSIVE fills with nulls, DROPMALFORMED
    drops. The header is read when called.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "enforceSchema": False,
               # Pruned columns would hide rows with too many fields.
               "columnPruning": False, "mode": mode}
    header = spark.read.options(**options).csv(path).columns
    missing = [c for c in schema.names if c not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    given = StructType([schema[c] if c in schema.names else StructField(c, StringType()) for c in header])
    return spark.read.schema(given).options(**options).csv(path).select(*schema.names)


def read_raw_catalog(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA, multi_line: bool = True,
                     mode: str = "FAILFAST") -> DataFrame:
    """CSV catalog with every column as text, columns by name. Quoted fields may hold commas, quotes and line breaks.

    Spark can't split a file whose fields may hold line breaks; `multi_line=False` reads large files without such
    fields in parallel.
    """
    return _read_csv(spark, path, schema, multi_line, mode)


def _write(df: DataFrame, path: str, file_format: str, partition_by: list[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if file_format == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(file_format).save(path)


def write_catalog(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    _write(df, path, file_format)


def _read(spark: SparkSession, path: str, schema: StructType, file_format: str) -> DataFrame:
    if file_format == "csv":
        return _read_csv(spark, path, schema, True, "FAILFAST")
    return spark.read.schema(schema).format(file_format).load(path)


def read_catalog(spark: SparkSession, path: str, file_format: str = "parquet",
                 schema: StructType = CLEAN_SCHEMA) -> DataFrame:
    return _read(spark, path, schema, file_format)


def read_catalog_with_clusters(spark: SparkSession, catalog: str, clusters: str) -> DataFrame:
    return attach_clusters(read_catalog(spark, catalog), read_segments(spark, clusters))


def write_report(report: dict[str, DataFrame], folder: str) -> None:
    """One CSV folder per named table."""
    for name, df in report.items():
        _write(df, f"{folder}/{name}", "csv")


def read_report(spark: SparkSession, folder: str, schemas: dict[str, StructType]) -> dict[str, DataFrame]:
    """The named tables; one that was never written comes back empty, with its known schema."""
    out = {}
    for name, schema in schemas.items():
        try:
            out[name] = _read(spark, f"{folder}/{name}", schema, "csv")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            out[name] = spark.createDataFrame([], schema)
    return out


def write_segments(df: DataFrame, path: str) -> None:
    _write(df.select([c for c in SEGMENT_COLUMNS if c in df.columns]), path, "parquet")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, SEGMENT_SCHEMA, "parquet")


def write_segment_report(tables: dict[str, DataFrame], folder: str) -> None:
    """Composition matrices, statistics and interpretations; list columns become text for CSV."""
    for name, df in tables.items():
        nested = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
        _write(df.withColumns({c: F.to_json(c) for c in nested}), f"{folder}/{name}", "csv")


def write_recommendations(df: DataFrame, path: str) -> None:
    """Partitioned by strategy, so a reader of one strategy skips the others."""
    _write(df, path, "parquet", ["strategy"])


def read_recommendations(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, RECOMMENDATION_SCHEMA, "parquet").select(*RECOMMENDATION_SCHEMA.names)


def write_model(model: KMeansModel, parameters: DataFrame, path: str) -> None:
    """The K-Means model with the scaling parameters of its features, in their order."""
    model.write().overwrite().save(f"{path}/kmeans")
    _write(parameters, f"{path}/scaling", "parquet")


def read_model(spark: SparkSession, path: str) -> tuple[KMeansModel, DataFrame]:
    return KMeansModel.load(f"{path}/kmeans"), spark.read.parquet(f"{path}/scaling")

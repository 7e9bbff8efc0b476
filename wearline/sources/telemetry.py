"""Telemetry text files, label files, and the prepared and ready tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.spec import SPEC, TelemetrySpec

# Fixed value: the group number is the run of digits before the extension.
GROUP_IN_PATH = r"(\d+)\.[^./]*$"


def tag_subset(df: DataFrame, spec: TelemetrySpec = SPEC, pattern: str = GROUP_IN_PATH) -> DataFrame:
    """Add the group from the path of the file a row was read from."""
    return df.withColumn(spec.group, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).cast("int"))


def read_telemetry_text(spark: SparkSession, path: str | list[str], spec: TelemetrySpec = SPEC,
                        pattern: str = GROUP_IN_PATH) -> DataFrame:
    """Headerless rows separated by runs of white space: entity, cycle, settings, sensors.

    Fields beyond the last named column are ignored, absent ones are NULL, and text that is no
    number fails the job.
    """
    lines = tag_subset(spark.read.text(path), spec, pattern).filter(F.trim("value") != "")
    fields = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    parsed = lines.select(spec.group, fields.alias("_f"))
    names = [(spec.entity, "bigint"), (spec.order, "bigint"), *[(c, "double") for c in spec.base]]
    return parsed.select(spec.group, *[F.get("_f", F.lit(i)).cast(kind).alias(name)
                                       for i, (name, kind) in enumerate(names)])


def read_rul_labels(spark: SparkSession, path: str | list[str], spec: TelemetrySpec = SPEC,
                    pattern: str = GROUP_IN_PATH) -> DataFrame:
    """Label files, one value per line: (group, line_no, rul), line numbers from 1 without blank lines.

    Large files are read in splits. Lines of one split keep their order, so a line's number is its
    rank in the split plus the lines of earlier splits of the file.
    """
    lines = tag_subset(spark.read.text(path), spec, pattern).select(
        spec.group, "value", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at")).filter(F.trim("value") != "")
    counts = lines.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"))  # one row per split
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_file", "_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_file", "_start").orderBy("_at"))
    return lines.join(offsets, ["_file", "_start"]).select(
        spec.group, (rank + F.col("_before")).cast("bigint").alias("line_no"),
        F.trim("value").cast("double").cast("bigint").alias("rul"))


def prepared_schema(spec: TelemetrySpec = SPEC) -> T.StructType:
    return T.StructType([
        T.StructField(spec.entity, T.LongType()), T.StructField(spec.order, T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in spec.base],
        T.StructField(spec.target, T.LongType()), T.StructField(spec.group, T.IntegerType())])


def write_prepared(df: DataFrame, path: str, spec: TelemetrySpec = SPEC, fmt: str = "parquet") -> None:
    """Labelled telemetry, one folder per group for Parquet; CSV with a header keeps the group inside."""
    ordered = df.select(*[f.name for f in prepared_schema(spec)])
    if fmt == "csv":
        ordered.write.mode("overwrite").option("header", True).csv(path)
    else:
        ordered.write.mode("overwrite").partitionBy(spec.group).format(fmt).save(path)


def read_prepared(spark: SparkSession, path: str, spec: TelemetrySpec = SPEC, fmt: str = "parquet") -> DataFrame:
    """The schema is declared, never inferred."""
    reader = spark.read.schema(prepared_schema(spec))
    return reader.option("header", True).option("mode", "FAILFAST").csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def write_ready(train: DataFrame, test: DataFrame, last_rows: DataFrame, path: str, spec: TelemetrySpec = SPEC) -> None:
    """The three model tables, partitioned by group so that group predicates prune folders."""
    for name, df in (("train", train), ("test", test), ("test_last_rows", last_rows)):
        df.write.mode("overwrite").partitionBy(spec.group).parquet(f"{path}/{name}")


def read_ready(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}")

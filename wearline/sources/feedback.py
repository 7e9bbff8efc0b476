"""Feedback records: JSON lines in, typed rows out, rejects kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.functions import iso_timestamp

# Text first, types second: clients send numbers as text, and one odd field must not lose the record.
_RAW = T.StructType([
    T.StructField("feedback_id", T.StringType()), T.StructField("prediction_id", T.StringType()),
    T.StructField("predicted_rul", T.StringType()), T.StructField("actual_rul", T.StringType()),
    T.StructField("engine_id", T.StringType()), T.StructField("prediction_timestamp", T.StringType()),
    T.StructField("feedback_timestamp", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    T.StructField("_bad", T.StringType())])

_TYPES = {"predicted_rul": "double", "actual_rul": "double", "engine_id": "bigint"}
_REQUIRED = ("prediction_id", "predicted_rul", "actual_rul", "engine_id", "prediction_timestamp")


def append_feedback(df: DataFrame, path: str) -> None:
    """Add records as JSON lines; each task writes its own file."""
    df.write.mode("append").json(path)


def read_feedback_lenient(spark: SparkSession, path: str) -> DataFrame:
    """Skip blank lines, bad JSON, and records whose feedback time is missing or not a time."""
    return _typed(_raw(spark, path, "PERMISSIVE").filter(_readable()).drop("_bad"))


def feedback_rejects(spark: SparkSession, path: str) -> DataFrame:
    """What the lenient reader skips, with the reason."""
    raw = _raw(spark, path, "PERMISSIVE")
    reason = (F.when(F.col("_bad").isNotNull(), "bad_json").when(F.col("feedback_timestamp").isNull(), "no_timestamp")
              .otherwise("bad_timestamp"))
    return raw.filter(~_readable()).select(reason.alias("reason"), F.coalesce("_bad", F.to_json(F.struct(
        "prediction_id", "feedback_timestamp"))).alias("record"))


def read_feedback_strict(spark: SparkSession, path: str) -> DataFrame:
    """Every line must be JSON and every number a number, or the job fails."""
    schema = T.StructType([f for f in _RAW if f.name != "_bad"])
    raw = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return raw.withColumns({c: F.col(c).cast(t) for c, t in _TYPES.items()})


def parse_feedback_schema(df: DataFrame, value: str = "value") -> DataFrame:
    """Typed fields of a JSON text column, numeric text included; `valid` tells accepted from rejected rows.

    A record is accepted when all required fields are there and have their type; the feedback time is optional.
    """
    schema = T.StructType([f for f in _RAW if f.name != "_bad"])
    parsed = df.withColumn("_r", F.from_json(value, schema)).select(*df.columns, "_r.*")
    typed = parsed.withColumns({c: F.col(c).try_cast(t) for c, t in _TYPES.items()})
    ok = F.lit(True)
    for c in _REQUIRED:
        ok = ok & F.col(c).isNotNull()
    return typed.withColumn("valid", ok)


def _raw(spark: SparkSession, path: str, mode: str) -> DataFrame:
    return (spark.read.schema(_RAW).option("mode", mode).option("columnNameOfCorruptRecord", "_bad").json(path))


def _readable() -> Column:
    return F.col("_bad").isNull() & iso_timestamp(F.col("feedback_timestamp")).isNotNull()


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in _TYPES.items()}).withColumn(
        "feedback_timestamp", iso_timestamp(F.col("feedback_timestamp")))
